"""CSV flow sources.

Files are listed with the ``binaryFile`` source and only ``path``/``length`` selected, so the
listing reads no file bytes. One distributed pass finds each file's header line and whether it is
valid UTF-8; files that share both are read as one scan with every column as text, so jobs and plan
size follow the number of different headers, not the number of files. Missing-value texts become
null, rows are tagged with their file's name, and the groups are unioned by column name (a column
missing in one group is null there).
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flowguard.functions.columns import na_to_null
from flowguard.operators.split import head_per_group, rows_per_file, seeded_sample
from flowguard.schema import SOURCE_FILE_COLUMN, dedup_names
from flowguard.session import path_exists

_BLOCK, _ROW = "__file_block", "__file_row"


def find_csv_files(spark: SparkSession, data_dir: str) -> DataFrame:
    """Recursive, sorted ``*.csv`` listing as ``(path, size)``; empty when the folder is absent.

    Any other failure (unknown scheme, no permission, store out of reach) is raised.
    """
    if not path_exists(spark, data_dir):
        return spark.createDataFrame([], "path STRING, size BIGINT")
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .load(data_dir)
        .select("path", F.col("length").alias("size"))
    )
    return listing.orderBy("path")


def csv_file_table(spark: SparkSession, data_dir: str) -> DataFrame:
    """S1 + P24: the listing with human-readable sizes, as the quality report shows it."""
    from flowguard.functions.columns import format_bytes

    return find_csv_files(spark, data_dir).select("path", format_bytes(F.col("size")).alias("size"))


def _decoded(encoded: str) -> Column:
    """A path or name out of ``_metadata``, which holds it URL-encoded (a plus stands for itself)."""
    return F.url_decode(F.replace(F.col(encoded), F.lit("+"), F.lit("%2B")))


def file_groups(spark: SparkSession, paths: list[str], encoding: str | None = None) -> list[tuple[list[str], str, list[str]]]:
    """``(column names, encoding, files)`` of files that can be read together, from one job.

    S2: a file is UTF-8 when all its lines are, else latin-1. The text source keeps the bytes of
    each line, so the check is a pass over the splits (no whole-file record). Q20: names are trimmed,
    later repeats become ``A.1``. Only one row per file comes back.
    """
    lines = spark.read.text(paths).select(_decoded("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"), "value")
    head = F.min_by(F.when(F.col("at") == 0, F.col("value").cast("binary")), F.when(F.col("at") == 0, F.col("n")))
    shapes = lines.groupBy("path").agg(head.alias("header"), F.count_if(~F.is_valid_utf8("value")).alias("bad"))
    groups: dict[tuple[bytes, str], list[str]] = {}
    for r in sorted(shapes.collect(), key=lambda r: r["path"]):
        enc = encoding or ("UTF-8" if not r["bad"] else "ISO-8859-1")
        groups.setdefault((bytes(r["header"] or b""), enc), []).append(r["path"])
    out = []
    for (header, enc), files in sorted(groups.items(), key=lambda g: g[1][0]):
        fields = next(csv.reader([header.decode(enc).lstrip("﻿").rstrip("\r")]), [])
        out.append((dedup_names(fields), enc, files))
    return out


#: What to do with a line that has more fields than its header. Shorter lines are filled up with nulls.
MALFORMED = ("raise", "skip", "cut")
_RAW, _MARK = "__raw_line", "\x02"
_OPTIONS = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": _RAW, "mode": "PERMISSIVE", "columnPruning": "false"}

def _with_a_field() -> Column:
    """True for every line: Spark refuses a scan that reads the column of malformed lines and no other."""
    return F.coalesce("c0", F.lit("")) != F.lit(_MARK * 2)


def _fields(n: int) -> list[StructField]:
    return [StructField(f"c{i}", StringType()) for i in range(n)]


def has_more_fields(line: Column, n: int) -> Column:
    """Does a CSV line have more than ``n`` fields (empty ones count).

    A mark is put on as one more field: it comes among the first ``n + 1`` unless others fill them.
    """
    kinds = StructType(_fields(n + 1)).simpleString()[len("struct<") : -1].replace(":", " ")
    marked = F.from_csv(F.concat(line, F.lit(f",{_MARK}")), kinds, {"quote": '"', "escape": '"'})
    seen = F.exists(F.array(*[marked[f"c{i}"] for i in range(n + 1)]), lambda c: c.contains(_MARK))
    return F.when(line.isNotNull(), ~F.coalesce(seen, F.lit(False))).otherwise(False)


def parse_lines(lines: DataFrame, line: str, n: int) -> DataFrame:
    """``lines`` with its text column ``line`` parsed into ``c0 .. c(n-1)``, and the line itself in
    ``__raw_line`` where it hasn't ``n`` fields: what the file reader gives for the same lines."""
    kinds = StructType([*_fields(n), StructField(_RAW, StringType())]).simpleString()[len("struct<") : -1].replace(":", " ")
    options = {k: v for k, v in _OPTIONS.items() if k != "columnPruning"}
    return lines.withColumn("__p", F.from_csv(F.col(line), kinds, options)).select("*", "__p.*").drop("__p", line)


def flow_rows(parsed: DataFrame, names: list[str], malformed: str = "raise", keep: list[Column] = (), where: Column | None = None) -> DataFrame:
    """Parsed columns under their names, NA texts as null (Q22), and the columns ``keep``.

    A line with more fields than ``names`` raises when it is read (with ``where`` it stands), is left
    out, or is cut, as ``malformed`` says.
    """
    if malformed not in MALFORMED:
        raise ValueError(f"malformed must be one of {', '.join(MALFORMED)}")
    longer = has_more_fields(F.col(_RAW), len(names))
    if malformed == "skip":
        parsed = parsed.where(~longer & _with_a_field())
    first = na_to_null("c0")
    if malformed == "raise":
        said = F.concat(F.lit(f"a line has more than the {len(names)} fields of its header"), F.coalesce(F.concat(F.lit(": "), where), F.lit("")) if where is not None else F.lit(""))
        first = F.when(longer, F.raise_error(said)).otherwise(first)
    columns = [first, *[na_to_null(f"c{i}") for i in range(1, len(names))]]
    return parsed.select(*[c.alias(n) for c, n in zip(columns, names, strict=True)], *keep)


def _scan(spark: SparkSession, n: int, encoding: str, files: list[str]) -> DataFrame:
    schema = StructType([*_fields(n), StructField(_RAW, StringType())])
    return spark.read.schema(schema).options(**_OPTIONS).option("header", "true").option("encoding", encoding).csv(files)


def read_group(spark: SparkSession, names: list[str], encoding: str, files: list[str], malformed: str = "raise") -> DataFrame:
    """Files of one header and encoding as one scan: all columns as text, NA texts as null
    (Q22), the file's name in ``__source_csv``, and the row's place in the file."""
    name = _decoded("_metadata.file_name")
    keep = [name.alias(SOURCE_FILE_COLUMN), F.col("_metadata.file_block_start").alias(_BLOCK), F.monotonically_increasing_id().alias(_ROW)]
    return flow_rows(_scan(spark, len(names), encoding, files), names, malformed, keep, name)


def quarantined_lines(spark: SparkSession, data_dir: str, encoding: str | None = None) -> DataFrame:
    """``(__source_csv, header_fields, line)``: the lines that ``malformed="skip"`` leaves out."""
    files = [r["path"] for r in find_csv_files(spark, data_dir).collect()]
    out = spark.createDataFrame([], f"{SOURCE_FILE_COLUMN} STRING, header_fields INT, line STRING")
    for names, enc, paths in file_groups(spark, files, encoding) if files else []:
        rows = _scan(spark, len(names), enc, paths).where(has_more_fields(F.col(_RAW), len(names)) & _with_a_field())
        out = out.unionByName(rows.select(_decoded("_metadata.file_name").alias(SOURCE_FILE_COLUMN), F.lit(len(names)).alias("header_fields"), F.col(_RAW).alias("line")))
    return out


def read_flow_csv(spark: SparkSession, path: str, nrows: int | None = None, encoding: str | None = None, malformed: str = "raise") -> DataFrame:
    """One CSV file, header row, all columns as text, NA texts as null, trimmed headers.

    ``malformed``: a line with more fields than the header raises (as the reference's reader does),
    is skipped (see :func:`quarantined_lines`) or cut.
    """
    groups = file_groups(spark, [path], encoding)
    if not groups:
        raise ValueError(f"{path} has no header line")
    df = read_group(spark, *groups[0], malformed)
    if nrows is not None:  # S4: first rows of the file
        df = df.orderBy(_BLOCK, _ROW).limit(nrows)
    return df.drop(SOURCE_FILE_COLUMN, _BLOCK, _ROW)


def load_traffic_csvs(spark: SparkSession, data_dir: str, max_rows: int | None = None, seed: int = 42,
                      encoding: str | None = None, malformed: str = "raise") -> DataFrame:
    """S3 + S4 + S5: all files unioned by name with a file tag; optional row cap; ``malformed`` as in
    :func:`read_flow_csv`."""
    files = [r["path"] for r in find_csv_files(spark, data_dir).collect()]
    if not files:
        raise FileNotFoundError(f"no CSV file under {data_dir}")
    data = None
    for names, enc, paths in file_groups(spark, files, encoding):
        part = read_group(spark, names, enc, paths, malformed)
        data = part if data is None else data.unionByName(part, allowMissingColumns=True)
    if data is None:
        raise ValueError(f"the CSV files under {data_dir} have no header line")
    tail = [SOURCE_FILE_COLUMN, _BLOCK, _ROW]
    data = data.select(*[F.col(f"`{c}`") for c in data.columns if c not in tail], *tail)
    if max_rows is not None:
        data = head_per_group(data, SOURCE_FILE_COLUMN, [_BLOCK, _ROW], rows_per_file(max_rows, len(files)))
    data = data.drop(_BLOCK, _ROW)
    if max_rows is not None:
        key = F.to_json(F.struct(*[F.col(f"`{c}`") for c in data.columns]))
        data = seeded_sample(data, key, max_rows, seed)
    return data


def load_or_build(spark: SparkSession, data_dir: str, max_rows: int | None = None, demo_data: bool = False,
                  demo_samples: int = 2400, seed: int = 42, malformed: str = "raise") -> tuple[DataFrame, str]:
    """Files when present, else the demo table when allowed, else an error."""
    from flowguard.sources.demo import build_demo_flows

    if find_csv_files(spark, data_dir).limit(1).count() > 0:
        return load_traffic_csvs(spark, data_dir, max_rows, seed, malformed=malformed), "files"
    if demo_data:
        return build_demo_flows(spark, demo_samples, seed), "demo"
    raise FileNotFoundError(f"no CSV file under {data_dir}; pass demo_data=True to use the demo table")
