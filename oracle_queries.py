"""DuckDB SQL twins of the registered queries (the correctness oracle).

Tables ``lineitem events labels documents ...`` are views over the same parquet files. The
flow views, the md5-ordered stratified split and the number-text pattern are written here in
plain SQL, independently of the Spark code. Doubles are rounded to 6 decimals, as in the
Spark queries.
"""

from __future__ import annotations

# Number text as the reader of a CSV takes it, written here on its own.
NUMBER_PATTERN = r"^\s*[-+]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][-+]?[0-9]+)?|[iI][nN][fF]|[iI][nN][fF][iI][nN][iI][tT][yY]|[nN][aA][nN])\s*$"

FLOWS_LINEITEM = """
flows_lineitem AS (
  SELECT
    concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS "Flow ID",
    '10.0.' || CAST(l_suppkey AS VARCHAR) AS "Source IP",
    '192.168.' || CAST(l_partkey AS VARCHAR) AS "Destination IP",
    CAST(l_linenumber AS BIGINT) AS "Source Port",
    CAST(CAST(l_quantity AS INTEGER) AS BIGINT) AS "Destination Port",
    l_quantity AS "Quantity",
    l_extendedprice AS "Extended Price",
    l_discount AS "Discount",
    CASE WHEN l_linenumber <> 7 THEN l_tax END AS "Tax",
    CASE WHEN l_discount = 0 THEN 'Infinity'::DOUBLE ELSE l_extendedprice / l_discount END AS "Price Rate",
    CASE l_returnflag WHEN 'N' THEN 'BENIGN' WHEN 'R' THEN 'DDoS' ELSE 'PortScan' END AS "Label"
  FROM lineitem
)"""

FLOWS_EVENTS = """
flows_events AS (
  SELECT
    CAST(event_id AS VARCHAR) AS "Flow ID",
    'u' || CAST(user_id AS VARCHAR) AS "Source IP",
    event_type AS "Destination IP",
    json_extract_string(props, '$.k') AS "Destination Port",
    value AS "Value",
    CASE event_type WHEN 'error' THEN 'DDoS' WHEN 'signup' THEN 'PortScan' ELSE 'BENIGN' END AS "Label"
  FROM events
)"""

SCORED_LINEITEM = """
scored_lineitem AS (
  SELECT
    concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS key,
    CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS y,
    l_extendedprice AS score,
    CASE l_returnflag WHEN 'N' THEN 'BENIGN' WHEN 'R' THEN 'DDoS' ELSE 'PortScan' END AS raw_label
  FROM lineitem
)"""

SCORED_DOCUMENTS = """
scored_documents AS (
  SELECT CAST(l.doc_id AS VARCHAR) AS key, CAST(l.toxic AS INTEGER) AS y, CAST(d.n_chars AS DOUBLE) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
)"""

REPEATING_FLOWS = """repeating AS (SELECT * FROM flows_lineitem UNION ALL SELECT * FROM flows_lineitem WHERE "Source IP" LIKE '%7')"""

S2_LINES_SQL = """
SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_id % 89 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
       CASE WHEN event_id % 89 <> 0 THEN nullif(props, '') END AS props, CASE WHEN event_id % 89 <> 0 THEN nullif(event_type, '') END AS event_type
FROM events WHERE event_id % 97 <> 0"""

S2_QUARANTINE_SQL = """
SELECT concat(event_id, ',', user_id, ',"', replace(coalesce(props, ''), '"', '""'), '",', event_type, ',') AS line FROM events WHERE event_id % 97 = 0"""

EPS = "2.220446049250313e-16"
LI_FEATURES = ["Source Port", "Destination Port", "Quantity", "Extended Price", "Discount", "Tax", "Price Rate"]
GRAPH = [
    "graph_src_out_count", "graph_dst_in_count", "graph_edge_count", "graph_src_unique_dst",
    "graph_dst_unique_src", "graph_dst_port_count", "graph_src_dst_port_count", "graph_src_port_count",
]


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def r6(expr: str) -> str:
    """Round half away from zero on the decimal text of the value, as Spark's ``round`` does."""
    d = f"CAST({expr} AS DOUBLE)"
    return f"(CASE WHEN isnan({d}) OR isinf({d}) THEN {d} ELSE CAST(round(CAST({d} AS DECIMAL(38, 12)), 6) AS DOUBLE) + 0.0 END)"


def num(expr: str) -> str:
    """Number coercion: pattern-checked text to DOUBLE, NaN and +-inf to NULL."""
    d = f"(CASE WHEN regexp_matches(CAST({expr} AS VARCHAR), '{NUMBER_PATTERN}') THEN TRY_CAST(trim(CAST({expr} AS VARCHAR)) AS DOUBLE) END)"
    return f"(CASE WHEN isnan({d}) OR isinf({d}) THEN NULL ELSE {d} END)"


def num_typed(expr: str) -> str:
    d = f"CAST({expr} AS DOUBLE)"
    return f"(CASE WHEN isnan({d}) OR isinf({d}) THEN NULL ELSE {d} END)"


def y_of(label: str) -> str:
    return f"(CASE WHEN upper(coalesce(trim(CAST({label} AS VARCHAR)), 'nan')) IN ('BENIGN', 'NORMAL') THEN 0 ELSE 1 END)"


def split_ctes(src: str, key: str, share: float, seed: int, name: str) -> str:
    """Stratified split by y: train quota by floor + largest remainder, test = md5-first rows."""
    return f"""
{name}_b AS (SELECT *, md5(CAST({key} AS VARCHAR) || '|{seed}') AS __ok FROM {src}),
{name}_c AS (SELECT y, count(*) AS n_c FROM {name}_b GROUP BY y),
{name}_t AS (SELECT sum(n_c) AS n, CAST(ceil(CAST({share!r} AS DOUBLE) * CAST(sum(n_c) AS DOUBLE)) AS BIGINT) AS nt FROM {name}_c),
{name}_a AS (SELECT y, n_c, CAST(n_c AS DOUBLE) * CAST(n - nt AS DOUBLE) / CAST(n AS DOUBLE) AS cont,
                 floor(CAST(n_c AS DOUBLE) * CAST(n - nt AS DOUBLE) / CAST(n AS DOUBLE)) AS fl, n, nt
             FROM {name}_c, {name}_t),
{name}_r AS (SELECT *, row_number() OVER (ORDER BY cont - fl DESC, y) AS rr, (n - nt) - sum(fl) OVER () AS need FROM {name}_a),
{name}_q AS (SELECT y, n_c - fl - CASE WHEN rr <= need THEN 1 ELSE 0 END AS quota FROM {name}_r),
{name} AS (
  SELECT b.* EXCLUDE (__ok),
         CASE WHEN row_number() OVER (PARTITION BY b.y ORDER BY __ok) <= quota THEN 'test' ELSE 'train' END AS split
  FROM {name}_b b JOIN {name}_q USING (y))"""


def graph_ctes(src: str, rows_filter: str, name: str, with_sport: bool = True) -> str:
    """Count tables over ``src`` rows passing ``rows_filter``, joined back to every ``src`` row."""
    sport_cte = f",\n{name}_sport AS (SELECT k_sport, count(*) AS n FROM {name}_tr GROUP BY k_sport)" if with_sport else ""
    sport_join = f" LEFT JOIN {name}_sport sp ON f.k_sport = sp.k_sport" if with_sport else ""
    sport_col = ", ln(1 + coalesce(sp.n, 0)) AS graph_src_port_count" if with_sport else ""
    return f"""
{name}_tr AS (SELECT * FROM {src} WHERE {rows_filter}),
{name}_edge AS (SELECT k_src, k_dst, count(*) AS n FROM {name}_tr GROUP BY k_src, k_dst),
{name}_src AS (SELECT k_src, sum(n) AS c, count(*) AS u FROM {name}_edge GROUP BY k_src),
{name}_dst AS (SELECT k_dst, sum(n) AS c, count(*) AS u FROM {name}_edge GROUP BY k_dst),
{name}_dport AS (SELECT k_dport, count(*) AS n FROM {name}_tr GROUP BY k_dport),
{name}_sdport AS (SELECT k_src, k_dport, count(*) AS n FROM {name}_tr GROUP BY k_src, k_dport){sport_cte},
{name} AS (
  SELECT f.*,
    ln(1 + coalesce(s.c, 0)) AS graph_src_out_count,
    ln(1 + coalesce(d.c, 0)) AS graph_dst_in_count,
    ln(1 + coalesce(e.n, 0)) AS graph_edge_count,
    ln(1 + coalesce(s.u, 0)) AS graph_src_unique_dst,
    ln(1 + coalesce(d.u, 0)) AS graph_dst_unique_src,
    ln(1 + coalesce(p.n, 0)) AS graph_dst_port_count,
    ln(1 + coalesce(sp2.n, 0)) AS graph_src_dst_port_count{sport_col}
  FROM {src} f
  LEFT JOIN {name}_src s ON f.k_src = s.k_src
  LEFT JOIN {name}_dst d ON f.k_dst = d.k_dst
  LEFT JOIN {name}_edge e ON f.k_src = e.k_src AND f.k_dst = e.k_dst
  LEFT JOIN {name}_dport p ON f.k_dport = p.k_dport
  LEFT JOIN {name}_sdport sp2 ON f.k_src = sp2.k_src AND f.k_dport = sp2.k_dport{sport_join})"""


def keys(src_ip: str, dst_ip: str, sport: str | None, dport: str) -> str:
    parts = [
        f"coalesce(CAST({q(src_ip)} AS VARCHAR), 'unknown') AS k_src",
        f"coalesce(CAST({q(dst_ip)} AS VARCHAR), 'unknown') AS k_dst",
        f"coalesce(CAST({q(dport)} AS VARCHAR), 'unknown') AS k_dport",
    ]
    if sport:
        parts.append(f"coalesce(CAST({q(sport)} AS VARCHAR), 'unknown') AS k_sport")
    return ", ".join(parts)


def scale_select(src: str, feats: list[str], stats_rows: str) -> str:
    """Standardise with population moments of ``stats_rows``; near-constant columns divide by 1."""
    mom = ", ".join(f"avg({q(f)}) AS {q('m_' + f)}, var_pop({q(f)}) AS {q('v_' + f)}" for f in feats)
    cols = []
    for f in feats:
        m, v = q("m_" + f), q("v_" + f)
        scale = f"(CASE WHEN {v} <= n * {EPS} * {v} + (n * {m} * {EPS}) * (n * {m} * {EPS}) THEN 1.0 ELSE sqrt({v}) END)"
        cols.append(f"{r6(f'({q(f)} - {m}) / {scale}')} AS {q(f)}")
    return f"""
mom AS (SELECT count(*) AS n, {mom} FROM {stats_rows})
SELECT row_key, split, y, label_raw, {", ".join(cols)} FROM {src}, mom"""


def m20_sql() -> str:
    feats = LI_FEATURES
    num_cols = ", ".join(f"{num_typed(q(f))} AS {q(f)}" for f in feats)
    med = ", ".join(f"median({q(f)}) AS {q(f)}" for f in feats)
    fill = ", ".join(f"coalesce(n.{q(f)}, m.{q(f)}, 0.0) AS {q(f)}" for f in feats)
    return f"""
WITH {FLOWS_LINEITEM},
dd AS (SELECT DISTINCT * FROM flows_lineitem),
lab AS (SELECT *, {y_of('"Label"')} AS y, coalesce(trim("Label"), 'nan') AS label_raw, "Flow ID" AS row_key FROM dd),
{split_ctes('lab', 'row_key', 0.25, 42, 'sp')},
nm AS (SELECT row_key, split, y, label_raw, {keys('Source IP', 'Destination IP', 'Source Port', 'Destination Port')}, {num_cols} FROM sp),
med AS (SELECT {med} FROM nm WHERE split = 'train'),
filled AS (SELECT n.row_key, n.split, n.y, n.label_raw, n.k_src, n.k_dst, n.k_dport, n.k_sport, {fill} FROM nm n, med m),
{graph_ctes('filled', "split = 'train'", 'g')},
{scale_select('g', feats + GRAPH, "g WHERE split = 'train'")}
"""


def m21_sql() -> str:
    graph7 = GRAPH[:7]
    feats = ["Destination Port", "Value"] + graph7
    num_cols = f"{num(q('Destination Port'))} AS {q('Destination Port')}, {num_typed(q('Value'))} AS {q('Value')}, " + ", ".join(
        f"{num_typed(q(g))} AS {q(g)}" for g in graph7
    )
    med = ", ".join(f"median({q(f)}) AS {q(f)}" for f in feats)
    fill = ", ".join(f"coalesce(n.{q(f)}, m.{q(f)}, 0.0) AS {q(f)}" for f in feats)
    return f"""
WITH {FLOWS_EVENTS},
dd AS (SELECT DISTINCT * FROM flows_events),
lab AS (SELECT *, {y_of('"Label"')} AS y, "Flow ID" AS row_key,
        {keys('Source IP', 'Destination IP', None, 'Destination Port')} FROM dd),
lab2 AS (SELECT *, CASE WHEN y = 0 THEN 'BENIGN' ELSE 'Attack' END AS label_raw FROM lab),
{graph_ctes('lab2', 'TRUE', 'g', with_sport=False)},
{split_ctes('g', 'row_key', 0.25, 42, 'sp')},
nm AS (SELECT row_key, split, y, label_raw, {num_cols} FROM sp),
med AS (SELECT {med} FROM nm),
filled AS (SELECT n.row_key, n.split, n.y, n.label_raw, {fill} FROM nm n, med m),
{scale_select('filled', feats, "filled WHERE split = 'train'")}
"""


P5_SQL = f"""
WITH t AS (
  SELECT l_linenumber,
    CASE l_linenumber
      WHEN 1 THEN CAST(l_extendedprice AS VARCHAR)
      WHEN 2 THEN ' ' || CAST(l_quantity AS VARCHAR) || ' '
      WHEN 3 THEN 'Infinity'
      WHEN 4 THEN '-inf'
      WHEN 5 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || 'd'
      WHEN 6 THEN 'NaN'
      ELSE '0x10' END AS txt
  FROM lineitem),
v AS (SELECT l_linenumber, {num('txt')} AS v FROM t)
SELECT l_linenumber, count(*) AS n_rows, count(v) AS n_numeric, {r6('coalesce(sum(v), 0.0)')} AS sum_value
FROM v GROUP BY l_linenumber
"""

P8_SQL = f"""
WITH {FLOWS_EVENTS}
SELECT coalesce(trim("Label"), 'nan') AS label_raw, {y_of('"Label"')} AS y, count(*) AS n
FROM flows_events GROUP BY 1, 2
"""

S4_SQL = """
WITH t AS (SELECT l_returnflag, concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS k FROM lineitem)
SELECT l_returnflag, k FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY md5(k)) AS rn FROM t) WHERE rn <= 100
"""

S5_SQL = f"""
WITH {FLOWS_LINEITEM}
SELECT "Flow ID" AS flow_id, "Label" FROM flows_lineitem ORDER BY md5("Flow ID" || '|42') LIMIT 500
"""

U1_SQL = f"""
WITH {FLOWS_LINEITEM}, {FLOWS_EVENTS},
u AS (
  SELECT "Label", CAST("Destination Port" AS VARCHAR) AS dp, "Quantity" AS quantity, NULL::DOUBLE AS value FROM flows_lineitem
  UNION ALL
  SELECT "Label", "Destination Port", NULL::DOUBLE, "Value" FROM flows_events)
SELECT "Label", count(*) AS n, count(quantity) AS n_quantity, count(value) AS n_value, count(DISTINCT dp) AS n_dst_ports
FROM u GROUP BY "Label"
"""


def p20_sql() -> str:
    parts = []
    for c in ["Quantity", "Extended Price", "Discount", "Tax"]:
        h = f"(CAST(('0x' || substr(md5(concat_ws('|', \"Flow ID\", '{c}', '42')), 1, 13))::UBIGINT AS DOUBLE) / {float(16 ** 13)!r})"
        parts.append(
            f"SELECT '{c}' AS feature, CASE WHEN {h} < 0.15 THEN 0.0 ELSE coalesce({q(c)}, 0.0) END AS value FROM flows_lineitem"
        )
    return f"""
WITH {FLOWS_LINEITEM}, m AS ({' UNION ALL '.join(parts)})
SELECT feature, count_if(value = 0) AS n_zero, {r6('sum(value)')} AS sum_value FROM m GROUP BY feature
"""


A3_SQL = f"""
WITH {FLOWS_LINEITEM}
SELECT DISTINCT "Source Port", "Destination Port", "Label" FROM flows_lineitem
"""

A4_SQL = f"""
WITH {FLOWS_LINEITEM},
g AS (SELECT "Source Port", "Destination Port", "Label", count(*) AS n FROM flows_lineitem GROUP BY ALL)
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM g
"""


def a5_sql() -> str:
    parts = [f"SELECT '{f}' AS feature, {r6(f'median({num_typed(q(f))})')} AS median FROM flows_lineitem" for f in LI_FEATURES]
    return f"WITH {FLOWS_LINEITEM}\n" + "\nUNION ALL\n".join(parts)


def a6_sql() -> str:
    """Sums as whole numbers of 2^-60 (exact for these tables: values have no smaller bits), squared
    deviations as whole numbers of 2^-50; rounded to DOUBLE at the end only."""
    unit, unit2 = "1152921504606846976.0", "1125899906842624.0"
    parts = []
    for f in LI_FEATURES:
        x = num_typed(q(f))
        parts.append(
            f"SELECT '{f}' AS feature, n, {r6('m')} AS mean, {r6('s')} AS std FROM (SELECT any_value(n) AS n, any_value(m) AS m, "
            f"sqrt(CAST(sum(CAST(round((x - m) * (x - m) * {unit2}) AS HUGEINT)) AS DOUBLE) / {unit2} / any_value(n)) AS s FROM "
            f"(SELECT {x} AS x FROM flows_lineitem), (SELECT count(x) AS n, CAST(sum(CAST(x * {unit} AS HUGEINT)) AS DOUBLE) / {unit} / count(x) AS m "
            f"FROM (SELECT {x} AS x FROM flows_lineitem)))"
        )
    return f"WITH {FLOWS_LINEITEM}\n" + "\nUNION ALL\n".join(parts)


def p7_sql() -> str:
    parts = [f"SELECT '{f}' AS feature, count({num_typed(q(f))}) AS non_null FROM flows_lineitem" for f in LI_FEATURES]
    parts.append("SELECT 'Empty' AS feature, CAST(0 AS BIGINT) AS non_null FROM flows_lineitem LIMIT 1")
    return f"WITH {FLOWS_LINEITEM}, c AS (" + " UNION ALL ".join(f"({p})" for p in parts) + ") SELECT feature, non_null, non_null > 0 AS usable FROM c"


LI_KEYS = f"""
WITH {FLOWS_LINEITEM},
k AS (SELECT *, {keys('Source IP', 'Destination IP', 'Source Port', 'Destination Port')} FROM flows_lineitem)"""

A1_EDGE_SQL = LI_KEYS + "\nSELECT k_src AS src, k_dst AS dst, count(*) AS n FROM k GROUP BY ALL"

A2_SQL = LI_KEYS + """,
e AS (SELECT k_src, k_dst, count(*) AS n FROM k GROUP BY ALL)
SELECT 'src' AS role, k_src AS host, CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_peers FROM e GROUP BY k_src
UNION ALL
SELECT 'dst' AS role, k_dst AS host, CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_peers FROM e GROUP BY k_dst
"""

A1_PORT_SQL = LI_KEYS + """
SELECT 'dst_port' AS kind, k_dport AS key, NULL::VARCHAR AS src, count(*) AS n FROM k GROUP BY k_dport
UNION ALL SELECT 'src_port', k_sport, NULL::VARCHAR, count(*) FROM k GROUP BY k_sport
UNION ALL SELECT 'src_dst_port', k_dport, k_src, count(*) FROM k GROUP BY k_dport, k_src
"""


def j_sql() -> str:
    cols = ", ".join(f"{r6(g)} AS {g}" for g in GRAPH)
    return f"""
WITH {FLOWS_LINEITEM},
lab AS (SELECT *, {y_of('"Label"')} AS y, {keys('Source IP', 'Destination IP', 'Source Port', 'Destination Port')} FROM flows_lineitem),
{split_ctes('lab', '"Flow ID"', 0.25, 42, 'sp')},
{graph_ctes('sp', "split = 'train'", 'g')}
SELECT "Flow ID" AS flow_id, split, {cols} FROM g
"""


def w3_sql() -> str:
    cols = ", ".join(f"{r6(g)} AS {g}" for g in GRAPH[:7])
    return f"""
WITH {FLOWS_EVENTS},
k AS (SELECT *, {keys('Source IP', 'Destination IP', None, 'Destination Port')} FROM flows_events),
{graph_ctes('k', 'TRUE', 'g', with_sport=False)}
SELECT "Flow ID" AS flow_id, {cols} FROM g
"""


W4_SQL = f"""
WITH {FLOWS_LINEITEM},
lab AS (SELECT "Flow ID", {y_of('"Label"')} AS y FROM flows_lineitem),
{split_ctes('lab', '"Flow ID"', 0.25, 42, 'sp')}
SELECT "Flow ID" AS flow_id, y, split FROM sp
"""

W5_SQL = f"""
WITH {FLOWS_LINEITEM},
lab AS (SELECT "Flow ID", {y_of('"Label"')} AS y FROM flows_lineitem),
{split_ctes('lab', '"Flow ID"', 0.25, 42, 'sp')},
tr AS (SELECT "Flow ID", y FROM sp WHERE split = 'train'),
{split_ctes('tr', '"Flow ID"', 0.2, 43, 'fv')}
SELECT "Flow ID" AS flow_id, y, CASE split WHEN 'test' THEN 'valid' ELSE 'fit' END AS fit_split FROM fv
"""

SPLIT_SCORED = f"""
WITH {SCORED_LINEITEM},
{split_ctes('scored_lineitem', 'key', 0.25, 42, 'sp')}"""

A8_SQL = SPLIT_SCORED + "\nSELECT split, raw_label AS label, count(*) AS count FROM sp GROUP BY ALL"

A9_SQL = """
SELECT trim(coalesce(CAST(user_id AS VARCHAR), 'nan')) AS value, count(*) AS count
FROM events GROUP BY 1 ORDER BY count DESC, value ASC LIMIT 10
"""

LI_COLS_TYPED = [
    ("Flow ID", "str"), ("Source IP", "str"), ("Destination IP", "str"), ("Source Port", "num"),
    ("Destination Port", "num"), ("Quantity", "num"), ("Extended Price", "num"), ("Discount", "num"),
    ("Tax", "num"), ("Price Rate", "num"), ("Label", "str"),
]


def _missing_expr(cols) -> str:
    parts = []
    for c, t in cols:
        if t == "num":
            parts.append(f"count_if({q(c)} IS NULL OR isnan(CAST({q(c)} AS DOUBLE)))")
        else:
            parts.append(f"count_if({q(c)} IS NULL)")
    return " + ".join(parts)


def _inf_expr(cols, label="Label") -> str:
    parts = []
    for c, t in cols:
        if c == label:
            continue
        if t == "num":
            parts.append(f"count_if(coalesce(isinf(CAST({q(c)} AS DOUBLE)), FALSE))")
        else:
            d = f"(CASE WHEN regexp_matches({q(c)}, '{NUMBER_PATTERN}') THEN TRY_CAST(trim({q(c)}) AS DOUBLE) END)"
            parts.append(f"count_if(coalesce(isinf({d}), FALSE))")
    return " + ".join(parts)


A10_SQL = f"""
WITH {FLOWS_LINEITEM},
c AS (SELECT count(*) AS raw_rows, CAST({_missing_expr(LI_COLS_TYPED)} AS BIGINT) AS missing_cells,
             CAST({_inf_expr(LI_COLS_TYPED)} AS BIGINT) AS infinite_cells,
             avg({y_of('"Label"')}) AS ratio FROM flows_lineitem)
SELECT raw_rows, missing_cells, infinite_cells, {r6('ratio')} AS binary_attack_ratio,
       {r6('missing_cells / (raw_rows * 11)')} AS missing_value_ratio FROM c
"""

A15_SQL = f"""
WITH {FLOWS_LINEITEM},
c AS (SELECT count(*) AS raw_rows, CAST({_missing_expr(LI_COLS_TYPED)} AS BIGINT) AS missing_cells,
             CAST({_inf_expr(LI_COLS_TYPED)} AS BIGINT) AS infinite_cells,
             avg({y_of('"Label"')}) AS ratio FROM flows_lineitem),
d AS (SELECT count(*) AS n_distinct, count_if({y_of('"Label"')} = 0) AS b, count_if({y_of('"Label"')} = 1) AS a
      FROM (SELECT DISTINCT * FROM flows_lineitem)),
t AS (SELECT count(DISTINCT trim("Label")) AS n_types FROM flows_lineitem WHERE {y_of('"Label"')} = 1)
SELECT raw_rows, CAST(11 AS BIGINT) AS raw_columns, CAST(raw_rows - n_distinct AS BIGINT) AS duplicate_rows,
       'Label' AS label_column, CAST(least(n_types, 20) AS BIGINT) AS attack_type_count, n_types AS attack_type_count_exact,
       b AS benign_samples, a AS attack_samples, {r6('ratio')} AS binary_attack_ratio, missing_cells,
       {r6('missing_cells / (raw_rows * 11)')} AS missing_value_ratio, infinite_cells,
       CAST(15 AS BIGINT) AS feature_count_after_preprocess, CAST(8 AS BIGINT) AS graph_feature_count
FROM c, d, t
"""

P26_SQL = f"""
WITH {FLOWS_EVENTS},
p AS (SELECT "Source IP", "Destination IP", "Label" FROM flows_events),
c AS (SELECT count(*) AS raw_rows, count_if("Source IP" IS NULL) + count_if("Destination IP" IS NULL) + count_if("Label" IS NULL) AS missing FROM p),
d AS (SELECT count(*) AS n_distinct, count_if({y_of('"Label"')} = 0) AS b, count_if({y_of('"Label"')} = 1) AS a FROM (SELECT DISTINCT * FROM p)),
t AS (SELECT count(DISTINCT trim("Label")) AS n_types FROM p WHERE {y_of('"Label"')} = 1),
r AS (SELECT *, raw_rows - n_distinct AS dup, least(n_types, 20) AS atc, CAST(5 AS BIGINT) AS fc, 5 AS gc FROM c, d, t),
codes AS (SELECT concat_ws(',',
    CASE WHEN a = 0 THEN 'no_attack' END,
    CASE WHEN a > 0 AND atc < 2 THEN 'one_attack_type' END,
    CASE WHEN b = 0 THEN 'no_benign' END,
    CASE WHEN missing / (raw_rows * 3) > 0.05 THEN 'missing_over_5pct' END,
    CASE WHEN dup > 0 THEN 'duplicates' END,
    CASE WHEN gc = 0 THEN 'no_graph_features' END,
    CASE WHEN fc < 8 THEN 'few_features' END) AS codes, atc, fc FROM r)
SELECT CASE WHEN codes = '' THEN 'ok' ELSE codes END AS codes, CAST(atc AS BIGINT) AS attack_type_count, fc AS feature_count_after_preprocess FROM codes
"""

A14_SQL = f"""
WITH {FLOWS_LINEITEM},
dd AS (SELECT DISTINCT * FROM flows_lineitem),
lab AS (SELECT *, {y_of('"Label"')} AS y, coalesce(trim("Label"), 'nan') AS label_raw FROM dd),
{split_ctes('lab', '"Flow ID"', 0.25, 42, 'sp')}
SELECT split, count(*) AS samples, count_if(y = 0) AS benign, count_if(y = 1) AS attack,
       count(DISTINCT label_raw) AS label_kinds, any_value(labels) AS labels,
       CAST(15 AS BIGINT) AS feature_count, CAST(8 AS BIGINT) AS graph_feature_count
FROM sp JOIN (
  SELECT split, string_agg(label_raw || '=' || n, ',' ORDER BY label_raw) AS labels
  FROM (SELECT split, label_raw, count(*) AS n FROM sp GROUP BY ALL) GROUP BY split
) USING (split) GROUP BY split
"""

C1_SQL = SPLIT_SCORED + "\nSELECT split, y, count(*) AS count FROM sp GROUP BY ALL"

CUT = "50000.0"
CONF = f"""
WITH {SCORED_LINEITEM},
p AS (SELECT *, CASE WHEN score >= {CUT} THEN 1 ELSE 0 END AS pred FROM scored_lineitem)"""

A16_SQL = CONF + """
SELECT count_if(y = 0 AND pred = 0) AS tn, count_if(y = 0 AND pred = 1) AS fp,
       count_if(y = 1 AND pred = 0) AS fn, count_if(y = 1 AND pred = 1) AS tp FROM p
"""


def sdiv(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"


def metric_cols(tn="tn", fp="fp", fn="fn", tp="tp", rounded=True) -> str:
    items = {
        "accuracy": sdiv(f"{tp} + {tn}", f"{tp} + {tn} + {fp} + {fn}"),
        "precision": sdiv(tp, f"{tp} + {fp}"),
        "recall": sdiv(tp, f"{tp} + {fn}"),
        "f1": sdiv(f"2 * {tp}", f"2 * {tp} + {fp} + {fn}"),
    }
    return ", ".join(f"{r6(v) if rounded else v} AS {k}" for k, v in items.items())


def auc_cte(src: str, name: str, group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""
{name}_st AS (SELECT {g}score, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM {src} GROUP BY ALL),
{name}_cum AS (SELECT *, sum(neg) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cneg FROM {name}_st),
{name} AS (SELECT {g}CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (cneg - neg * 0.5)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) END AS roc_auc
           FROM {name}_cum {('GROUP BY ' + group) if group else ''})"""


A17_SQL = CONF + f""",
cm AS (SELECT count_if(y = 0 AND pred = 0) AS tn, count_if(y = 0 AND pred = 1) AS fp,
              count_if(y = 1 AND pred = 0) AS fn, count_if(y = 1 AND pred = 1) AS tp FROM p),
{auc_cte('p', 'auc')}
SELECT 'price_cut' AS model, {metric_cols()}, {r6('roc_auc')} AS roc_auc FROM cm, auc
"""

A18_SQL = f"""
WITH {SCORED_LINEITEM}, {SCORED_DOCUMENTS},
{auc_cte('scored_documents', 'a1')},
{auc_cte('scored_lineitem', 'a2')}
SELECT 'documents' AS dataset, {r6('roc_auc')} AS roc_auc FROM a1
UNION ALL SELECT 'lineitem', {r6('roc_auc')} FROM a2
"""

A19_SQL = f"""
WITH {SCORED_LINEITEM}
SELECT y, CAST(0.95 AS DOUBLE) AS q, {r6('quantile_cont(score, 0.95)')} AS value FROM scored_lineitem GROUP BY y
UNION ALL
SELECT y, CAST(0.99 AS DOUBLE) AS q, {r6('quantile_cont(score, 0.99)')} AS value FROM scored_lineitem GROUP BY y
"""

A21_SQL = f"""
WITH {SCORED_DOCUMENTS},
r0 AS (SELECT y, min(score) AS lo0, max(score) AS hi0 FROM scored_documents GROUP BY y),
r AS (SELECT y, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM r0),
c AS (SELECT s.y, least(34, CAST(floor((s.score - r.lo) / (r.hi - r.lo) * 35) AS INTEGER)) AS bin, count(*) AS n
      FROM scored_documents s JOIN r ON s.y = r.y GROUP BY ALL),
grid AS (SELECT y, lo, hi, CAST(b.bin AS INTEGER) AS bin FROM r, range(0, 35) b(bin))
SELECT g.y, g.bin, {r6('g.lo + g.bin * ((g.hi - g.lo) / 35)')} AS bin_lo, {r6('g.lo + (g.bin + 1) * ((g.hi - g.lo) / 35)')} AS bin_hi,
       coalesce(c.n, 0) AS count
FROM grid g LEFT JOIN c ON g.y = c.y AND g.bin = c.bin
"""

A22_SQL = CONF + f""",
lab AS (SELECT *, coalesce(trim(raw_label), 'nan') AS t, upper(coalesce(trim(raw_label), 'nan')) IN ('BENIGN', 'NORMAL') AS ben FROM p),
per AS (SELECT t AS attack_type, count(*) AS n, count_if(y = 1) AS n_y1, count_if(y = 1 AND pred = 1) AS n_tp, count_if(y = 0 AND pred = 1) AS n_fp
        FROM lab WHERE NOT ben AND t <> '' GROUP BY t),
bn AS (SELECT count(*) AS bs, count_if(y = 1) AS b_y1, count_if(y = 1 AND pred = 1) AS b_tp, count_if(y = 0 AND pred = 1) AS b_fp FROM lab WHERE ben),
m AS (SELECT attack_type, bs, n, n_tp + b_tp AS tp, n_fp + b_fp AS fp, (n_y1 + b_y1) - (n_tp + b_tp) AS fn,
             (n + bs) - (n_y1 + b_y1) - (n_fp + b_fp) AS tn FROM per, bn)
SELECT attack_type, CAST(bs AS BIGINT) AS benign_samples, n AS attack_samples, {metric_cols()} FROM m
"""

SCORE_MODELS = """
WITH base AS (SELECT CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS y, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem),
mm AS (SELECT avg(l_quantity) AS mq, avg(l_extendedprice) AS mp, avg(l_discount) AS md, avg(l_tax) AS mt FROM base),
cm AS (
  SELECT 'quantity' AS model, 0 AS run_order,
    count_if(y = 0 AND l_quantity < mq) AS tn, count_if(y = 0 AND l_quantity >= mq) AS fp,
    count_if(y = 1 AND l_quantity < mq) AS fn, count_if(y = 1 AND l_quantity >= mq) AS tp FROM base, mm
  UNION ALL
  SELECT 'price', 1, count_if(y = 0 AND l_extendedprice < mp), count_if(y = 0 AND l_extendedprice >= mp),
    count_if(y = 1 AND l_extendedprice < mp), count_if(y = 1 AND l_extendedprice >= mp) FROM base, mm
  UNION ALL
  SELECT 'discount', 2, count_if(y = 0 AND l_discount < md), count_if(y = 0 AND l_discount >= md),
    count_if(y = 1 AND l_discount < md), count_if(y = 1 AND l_discount >= md) FROM base, mm
  UNION ALL
  SELECT 'tax', 3, count_if(y = 0 AND l_tax < mt), count_if(y = 0 AND l_tax >= mt),
    count_if(y = 1 AND l_tax < mt), count_if(y = 1 AND l_tax >= mt) FROM base, mm),
ms AS (SELECT model, run_order, """ + metric_cols(rounded=False) + """ FROM cm)"""

A20_SQL = SCORE_MODELS + f"""
SELECT model, run_order, {r6('f1')} AS f1, CASE WHEN f1 IS NULL OR isnan(f1) THEN '' ELSE printf('%.4f', f1) END AS f1_text
FROM ms ORDER BY f1 DESC NULLS LAST, run_order ASC LIMIT 1
"""

M18_SQL = SCORE_MODELS + f"""
SELECT model, {r6('recall')} AS recall, {r6('f1')} AS f1,
       CASE WHEN precision IS NULL OR isnan(precision) THEN '' ELSE printf('%.4f', precision) END AS precision_text FROM ms
"""


def pr_sql(src_cte: str, src: str) -> str:
    return f"""
WITH {src_cte},
st AS (SELECT score, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM {src} GROUP BY score),
c AS (SELECT score, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp, sum(pos) OVER () AS P FROM st
      WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT {r6('score')} AS threshold, tp, fp, {r6(sdiv('tp', 'tp + fp'))} AS precision,
       {r6('CASE WHEN P = 0 THEN 1.0 ELSE CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) END')} AS recall FROM c
"""


W2_SQL = f"""
WITH {SCORED_DOCUMENTS},
st AS (SELECT score, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM scored_documents GROUP BY score),
c AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM st
      WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT score AS threshold, {r6(sdiv('fp', 'N'))} AS fpr, {r6(sdiv('tp', 'P'))} AS tpr FROM c
UNION ALL SELECT 'Infinity'::DOUBLE, 0.0, 0.0
"""

M10_SQL = f"""
WITH {SCORED_DOCUMENTS},
{split_ctes('scored_documents', 'key', 0.25, 42, 'sp')},
v AS (SELECT y, -score AS score FROM sp WHERE split = 'train'),
{auc_cte('v', 'a')}
SELECT CASE WHEN roc_auc < 0.5 THEN 'inverted_reconstruction_error' ELSE 'raw_reconstruction_error' END AS score_direction,
       {r6('roc_auc')} AS raw_validation_roc_auc,
       {r6('CASE WHEN roc_auc < 0.5 THEN 1 - roc_auc ELSE roc_auc END')} AS oriented_roc_auc FROM a
"""

VALID_PR = SPLIT_SCORED + """,
v AS (SELECT y, score FROM sp WHERE split = 'train'),
st AS (SELECT score, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM v GROUP BY score),
c AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS P FROM st
      WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
pr AS (SELECT score AS threshold, CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision,
              CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) AS recall FROM c),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pr),
strat AS (
  SELECT 0 AS strategy_order, 'target_recall_0.90' AS strategy,
         (SELECT threshold FROM f ORDER BY (recall >= 0.9) DESC, f1 DESC, threshold ASC LIMIT 1) AS threshold
  UNION ALL SELECT 1, 'best_f1', (SELECT threshold FROM f ORDER BY f1 DESC, threshold ASC LIMIT 1)
  UNION ALL SELECT 2, 'normal_95_percentile', (SELECT quantile_cont(score, 0.95) FROM v WHERE y = 0)
  UNION ALL SELECT 3, 'normal_99_percentile', (SELECT quantile_cont(score, 0.99) FROM v WHERE y = 0))"""

M11_SQL = VALID_PR + f"\nSELECT strategy, {r6('threshold')} AS threshold FROM strat"

M14_SQL = VALID_PR + f""",
t AS (SELECT y, score FROM sp WHERE split = 'test'),
cm AS (SELECT strategy_order, strategy, threshold,
              count_if(y = 0 AND score < threshold) AS tn, count_if(y = 0 AND score >= threshold) AS fp,
              count_if(y = 1 AND score < threshold) AS fn, count_if(y = 1 AND score >= threshold) AS tp
       FROM strat, t GROUP BY ALL),
{auc_cte('t', 'auc')}
SELECT 'price_score' AS model, strategy_order, strategy, {r6('threshold')} AS threshold, {metric_cols()},
       {r6('roc_auc')} AS roc_auc, tn, fp, fn, tp
FROM cm, auc
"""


def m7_sql() -> str:
    feats = LI_FEATURES + GRAPH
    centre = ", ".join(f"avg({q(f)}) AS {q('c_' + f)}" for f in feats)
    sq = " + ".join(f"({q(f)} - {q('c_' + f)}) * ({q(f)} - {q('c_' + f)})" for f in feats)
    return f"""
WITH p AS ({m20_sql()}),
c AS (SELECT {centre} FROM p WHERE split = 'train' AND y = 0)
SELECT row_key, split, y, {r6(f'({sq}) / {float(len(feats))!r}')} AS score FROM p, c
"""


A7_SQL = f"""
WITH {FLOWS_EVENTS}
SELECT count_if({y_of('"Label"')} = 0) AS BENIGN, count_if({y_of('"Label"')} = 1) AS Attack FROM flows_events
"""

A13_SQL = f"""
WITH {FLOWS_LINEITEM},
att AS (SELECT * FROM flows_lineitem WHERE {y_of('"Label"')} = 1),
top AS (SELECT trim(coalesce("Label", 'nan')) AS label, count(*) AS count FROM att GROUP BY 1 ORDER BY count DESC, label ASC LIMIT 20),
ex AS (SELECT count(DISTINCT coalesce(trim("Label"), 'nan')) AS attack_type_count_exact FROM att)
SELECT label, count, attack_type_count_exact FROM top, ex
"""

A12_SQL = f"""
WITH {FLOWS_EVENTS}
SELECT {r6(f'avg({y_of(chr(34) + "Label" + chr(34))})')} AS binary_attack_ratio FROM flows_events
"""


def _fmt4(expr: str) -> str:
    return f"(CASE WHEN ({expr}) IS NULL OR isnan({expr}) THEN '' ELSE printf('%.4f', {expr}) END)"


def p22_sql() -> str:
    items = {
        "accuracy": sdiv("tp + tn", "tp + tn + fp + fn"),
        "precision": sdiv("tp", "tp + fp"),
        "recall": sdiv("tp", "tp + fn"),
        "f1": sdiv("2 * tp", "2 * tp + fp + fn"),
    }
    cols = ", ".join(f"{_fmt4(v)} AS {k}" for k, v in items.items())
    return CONF + f""",
cm AS (SELECT raw_label, count_if(y = 0 AND pred = 0) AS tn, count_if(y = 0 AND pred = 1) AS fp,
              count_if(y = 1 AND pred = 0) AS fn, count_if(y = 1 AND pred = 1) AS tp FROM p GROUP BY raw_label)
SELECT translate(lower(raw_label || ' Model/v1'), ' /', '__') AS file_tag, {cols} FROM cm
"""


def _bigint_counts(sql: str) -> str:
    """DuckDB types ``count_if`` as HUGEINT; Spark's is BIGINT. Wrap every call in a cast."""
    out, i, tok = [], 0, "count_if("
    while True:
        j = sql.find(tok, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(tok)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k] + " AS BIGINT)")
        i = k


W4_REPEATED_SQL = """
WITH c AS (SELECT CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS y, count(*) AS n FROM lineitem GROUP BY 1),
t AS (SELECT *, sum(n) OVER () AS total FROM c),
q AS (SELECT y, n, total, total - CAST(ceil(0.25 * total) AS BIGINT) AS n_train FROM t),
f AS (SELECT y, n, n_train, CAST(floor(n * n_train / total) AS BIGINT) AS base, n * n_train / total - floor(n * n_train / total) AS rest FROM q),
r AS (SELECT *, row_number() OVER (ORDER BY rest DESC, y) AS place, n_train - sum(base) OVER () AS missing FROM f),
d AS (SELECT y, n, base + CASE WHEN place <= missing THEN 1 ELSE 0 END AS train FROM r)
SELECT y, 'train' AS split, CAST(train AS BIGINT) AS n FROM d
UNION ALL SELECT y, 'test', CAST(n - train AS BIGINT) FROM d
"""

A3_TEXT_IDS_SQL = """
SELECT DISTINCT CAST(9007199254740992 + l_orderkey % 64 AS VARCHAR) AS id, l_returnflag AS flag FROM lineitem
"""


def oracle_sql() -> dict[str, str]:
    return {k: _bigint_counts(v) for k, v in _oracle_sql().items()}


def _oracle_sql() -> dict[str, str]:
    return {
        "p5_to_number": P5_SQL,
        "s2_csv_lines": S2_LINES_SQL,
        "s2_quarantine": S2_QUARANTINE_SQL,
        "p8_binary_label": P8_SQL,
        "s4_head_per_group": S4_SQL,
        "s5_seeded_sample": S5_SQL,
        "u1_union_by_name": U1_SQL,
        "p20_mask_twin": p20_sql(),
        "a3_dedup": A3_SQL,
        "a4_duplicate_rows": A4_SQL,
        "a5_medians": a5_sql(),
        "a3_dedup_wide": f"WITH {FLOWS_LINEITEM}, {REPEATING_FLOWS} SELECT DISTINCT * REPLACE ({', '.join(f'{r6(q(c))} AS {q(c)}' for c in LI_FEATURES[2:])}) FROM repeating",
        "a4_duplicate_rows_wide": f"""WITH {FLOWS_LINEITEM}, {REPEATING_FLOWS}, g AS (SELECT *, count(*) AS n FROM repeating GROUP BY ALL)
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, count(*) FILTER (WHERE {y_of('"Label"')} = 0) AS benign_samples, count(*) FILTER (WHERE {y_of('"Label"')} = 1) AS attack_samples FROM g""",
        "a6_moments": a6_sql(),
        "p7_usable_columns": p7_sql(),
        "m20_prepare": m20_sql(),
        "m20_prepare_text": m20_sql(),
        "m20_transform_new_rows": f"SELECT * EXCLUDE (split, y, label_raw) FROM ({m20_sql()})",
        "m21_prepare_all": m21_sql(),
        "a1_edge_counts": A1_EDGE_SQL,
        "a2_host_degrees": A2_SQL,
        "a2_merged_periods": A2_SQL,
        "a2_sketched_degrees": f"SELECT role, host, rows, TRUE AS within_error FROM ({A2_SQL})",
        "a1_port_counts": A1_PORT_SQL,
        "j_graph_lookup": j_sql(),
        "j_graph_lookup_large": j_sql(),
        "w3_in_sample_graph": w3_sql(),
        "w4_stratified_split": W4_SQL,
        "w4_split_repeated_keys": W4_REPEATED_SQL,
        "a3_dedup_text_ids": A3_TEXT_IDS_SQL,
        "w5_fit_valid_split": W5_SQL,
        "a8_raw_label_counts": A8_SQL,
        "a9_top_values": A9_SQL,
        "a9_top_words": r"""SELECT trim(w) AS word, count(*) AS count FROM (SELECT unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w FROM documents)
GROUP BY ALL ORDER BY count DESC, word LIMIT 25""",
        "a10_cell_stats": A10_SQL,
        "a15_inspection": A15_SQL,
        "p26_recommendations": P26_SQL,
        "a14_dataset_summary": A14_SQL,
        "c1_label_distribution": C1_SQL,
        "a7_label_summary": A7_SQL,
        "a13_attack_labels": A13_SQL,
        "a12_attack_ratio": A12_SQL,
        "p22_p23_formats": p22_sql(),
        "a16_confusion": A16_SQL,
        "a17_metrics": A17_SQL,
        "a18_roc_auc": A18_SQL,
        "a19_quantiles": A19_SQL,
        "a21_histogram": A21_SQL,
        "a22_attack_types": A22_SQL,
        "a20_best_model": A20_SQL,
        "m18_model_comparison": M18_SQL,
        "w1_pr_curve": pr_sql(SCORED_DOCUMENTS, "scored_documents"),
        "w1_pr_curve_lineitem": pr_sql(SCORED_LINEITEM, "scored_lineitem"),
        "w2_roc_curve": W2_SQL,
        "w2_roc_chart": f"WITH {SCORED_LINEITEM}, {auc_cte('scored_lineitem', 'a2')} SELECT TRUE AS bounded, TRUE AS close, {r6('roc_auc')} AS roc_auc FROM a2",
        "m10_orient": M10_SQL,
        "m11_m13_thresholds": M11_SQL,
        "m14_threshold_analysis": M14_SQL,
        "m7_linear_reconstruction": m7_sql(),
    }
