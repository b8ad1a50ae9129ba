"""DuckDB twins of the queries that SQL can express over whole tables."""

from __future__ import annotations

#: Words, document windows and item windows; every occurrence of an item's window in a document.
OP2 = r"""
with
lowered as (select doc_id, row_number() over () as r, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
doc as (select doc_id, r, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from lowered),
item as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
item_window as (
    select distinct item_id, least(len(w), 10) as n, array_to_string(list_slice(w, k, k + least(len(w), 10) - 1), ' ') as g
    from (select item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) as k from item where len(w) > 0)
),
sizes as (select distinct n from item_window),
doc_window as (
    select r, n, k, array_to_string(list_slice(w, k, k + n - 1), ' ') as g
    from (select r, w, n, unnest(generate_series(1, len(w) - n + 1)) as k from doc, sizes where len(w) >= n)
),
found as (select d.r, d.k, d.n, i.item_id from doc_window d join item_window i on d.n = i.n and d.g = i.g),
hit as (select r, count(distinct p) as n_hit from (select r, unnest(generate_series(k, k + n - 1)) as p from found) group by r),
named as (select r, count(*) as n_items, string_agg(i, ',' order by i) as items from (select distinct r, cast(item_id as varchar) as i from found) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join hit using (r) left join named using (r)
"""

OP3 = r"""
with
d as (
    select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
           cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || '|17'), 1, 15) as bigint) as key
    from documents
),
s1 as (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as sid from d group by source),
s2 as (select *, [3.0::double, 1.0::double, 2.0::double][sid % 3 + 1] as weight, source_size * 2.0::double as most, cast(sum(source_size) over () as double) * 1.5::double as goal from s1),
s3 as (
    select *, (goal - coalesce(sum(most) over (order by most / weight, sid rows between unbounded preceding and 1 preceding), 0.0::double))
              / sum(weight) over (order by most / weight, sid rows between current row and unbounded following) as level
    from s2
),
s4 as (select *, most <= weight * level as is_full, max(case when not (most <= weight * level) then level end) over () as final from s3),
s5 as (
    select sid, source, source_size, case when is_full then most else least(most, weight * final) end as target,
           greatest(1, least(1024, source_size // 4096)) as block
    from s4
),
s6 as (select *, (source_size + block - 1) // block as n_blocks from s5),
s as (
    select *, least(cast(floor(target / block + 0.5) as bigint), 2 * n_blocks) as quota,
           case when n_blocks <= 1 then 99999989 else list_filter([99999989, 99999971, 99999959, 99999941, 99999931, 99999847, 99999839], lambda p: p % n_blocks != 0 and n_blocks % p != 0)[1] end as prime
    from s6
),
line as (
    select s.*, d.doc_id, d.size, row_number() over () as r,
           cast(sum(d.size) over (partition by s.sid order by d.key, d.doc_id, d.size rows between unbounded preceding and current row) as bigint) - d.size as off
    from d join s on d.source is not distinct from s.source
),
piece as (select *, unnest(generate_series(off // block, (off + size - 1) // block)) as b from line where size > 0),
ranked as (select *, cast((cast(b as hugeint) * prime + sid) % n_blocks as bigint) as rank from piece),
got as (
    select r, cast(sum((least(off + size, (b + 1) * block) - greatest(off, b * block)) * ((rank < quota)::int + (rank + n_blocks < quota)::int)) as bigint) as taken
    from ranked group by r
)
select doc_id, size, source_size, target, coalesce(taken, 0) as taken from line left join got using (r)
"""

OP9 = r"""
with
c as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
),
e as (
    select *, replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') as r, replace(replace(text, '\', '\\'), '<|', '<\|') as t
    from c
),
g as (
    select conv_id, count(*) as n_turns,
           string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as turns,
           coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '') as learned,
           sum(12 + length(r) + 1 + length(t) + 11) as formatted_chars
    from e group by conv_id
)
select conv_id, n_turns, sha256(turns) as turns_sha256, cast(length(learned) as bigint) as loss_chars, sha256(learned) as loss_sha256,
       cast(formatted_chars as bigint) as formatted_chars
from g
"""

#: crc32 (reflected polynomial EDB88320) of the ASCII text of ``{x}``, bit by bit.
CRC32 = (
    "xor(list_reduce(list_transform(string_split({x}, ''), lambda c: cast(ascii(c) as bigint)), "
    "lambda h, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::bigint[], lambda v, k: xor(v >> 1, (v & 1) * 3988292384), xor(h, b)), 4294967295::bigint), 4294967295::bigint)"
)

#: Pairs of equal words p places apart; islands of such pairs are the stretches with period p.
OP13 = (
    r"""
with
doc as (
    select doc_id, row_number() over () as r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w, """
    + CRC32.format(x="cast(doc_id as varchar)")
    + r""" as h
    from documents
),
sized as (
    select *, cast(len(w) as bigint) as n, h // 10 as g, case when h % 10 = 0 and len(w) > 0 then (h // 10) % len(w) end as a,
           case when h % 10 = 0 and len(w) > 0 then 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) end as p
    from doc
),
word as (
    select r, k, case when a is null or k < a then w[k + 1] else w[a + (k - a) % p + 1] end as x
    from (select *, unnest(generate_series(0, n - 1)) as k from sized where n > 0)
),
pair as (select u.r, u.k, v.k - u.k as p from word u join word v on u.r = v.r and u.x = v.x and u.k < v.k),
island as (select r, p, k, k - row_number() over (partition by r, p order by k) as i from pair),
stretch as (select r, p, min(k) as s, count(*) + p as n from island group by r, p, i having count(*) + p >= greatest(12, 2 * p)),
run as (select r, s, n, min(p) as p from stretch group by r, s, n),
dropped as (select distinct r, unnest(generate_series(s + p, s + n - 1)) as k from run),
kept as (select r, string_agg(x, ' ' order by k) as t from word anti join dropped using (r, k) group by r),
told as (
    select r, count(*) as n_runs, string_agg(s || ',' || n || ',' || p || chr(10), '' order by s, p) as lines,
           max_by(struct_pack(s := s, n := n, p := p), (n, -s, -p)) as best
    from run group by r
)
select doc_id, coalesce(n_runs, 0) as n_runs, best.s as start, cast(best.n as bigint) as length, best.p as period,
       cast(1000 * best.n // best.p as bigint) as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(t, '')) as collapsed_sha256
from sized left join told using (r) left join kept using (r)
"""
)

#: Rows after the damage; then, from a conversation's last row to its first, the least (cost,
#: initials) from each state of the pattern (nothing yet, after s, after u, after a) to the end.
OP12 = (
    r"""
with recursive
given as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, """
    + CRC32.format(x="(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '))")
    + r""" % 20 as how
    from conversations
),
hurt as (
    select conv_id, turn, case when how = 4 then 'user' else role end as role,
           case when how = 1 then '' when how = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
           unnest(case when how = 3 then [0, 1] else [0] end) as copy
    from given where how <> 0
),
placed as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) as k,
           row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen, rtrim(text, e' 	

') as body
    from hurt
),
faulty as (
    select conv_id as c, turn, role, text, k, substr(role, 1, 1) as i,
           case when body = '' then 'blank' when seen > 1 then 'duplicate' when right(body, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault
    from placed
),
convs as (select c, count(*) as n from faulty group by c),
fold as (
    select c, n as k, {'c': 0, 's': ''} as v0, {'c': 6, 's': 'II'} as v1, {'c': 3, 's': 'I'} as v2, {'c': 0, 's': ''} as v3 from convs
    union all
    select c, k, list_min([b0, {'c': v2.c + 3, 's': 'I' || v2.s}]), list_min([b1, {'c': v2.c + 3, 's': 'I' || v2.s}]), v2, v3
    from (
        select c, k, b0, b1, list_min([b2, {'c': b3.c + 3, 's': 'I' || b3.s}]) as v2, list_min([b3, {'c': b2.c + 3, 's': 'I' || b2.s}]) as v3
        from (
            select f.c, f.k - 1 as k,
                   list_min([{'c': v0.c + 4, 's': 'D' || v0.s}, {'c': case when bad then 999999999 else v2.c + 3 + more end, 's': 'R' || v2.s},
                             {'c': case when bad or i not in ('s', 'u') then 999999999 when i = 's' then v1.c + more else v2.c + more end, 's': 'K' || case when i = 's' then v1.s else v2.s end}]) as b0,
                   list_min([{'c': v1.c + 4, 's': 'D' || v1.s}, {'c': case when bad then 999999999 else v2.c + 3 + more end, 's': 'R' || v2.s},
                             {'c': case when bad or i <> 'u' then 999999999 else v2.c + more end, 's': 'K' || v2.s}]) as b1,
                   list_min([{'c': v2.c + 4, 's': 'D' || v2.s}, {'c': case when bad then 999999999 else v3.c + 3 + more end, 's': 'R' || v3.s},
                             {'c': case when bad or i <> 'a' then 999999999 else v3.c + more end, 's': 'K' || v3.s}]) as b2,
                   list_min([{'c': v3.c + 4, 's': 'D' || v3.s}, {'c': case when bad then 999999999 else v2.c + 3 + more end, 's': 'R' || v2.s},
                             {'c': case when bad or i <> 'u' then 999999999 else v2.c + more end, 's': 'K' || v2.s}]) as b3
            from fold f
            join (select *, fault in ('blank', 'duplicate') as bad, case when fault = 'truncated' then 3 else 0 end as more from faulty) r
              on f.c is not distinct from r.c and f.k = r.k
        )
    )
),
best as (select c, v0.c as cost, v0.s as audit from fold where k = 0),
step as (select c, unnest(string_split(audit, '')) as e, generate_subscripts(string_split(audit, ''), 1) as j from best where audit <> ''),
walked as (
    select *, sum((e <> 'I')::int) over (partition by c order by j) as k, sum((e <> 'D')::int) over (partition by c order by j) - 1 as o from step
),
lined as (
    select w.*, r.role, r.text, coalesce(max(case when e = 'K' and o = 0 and r.i = 's' then 1 else 0 end) over (partition by w.c), 0) as s
    from walked w left join faulty r on w.e <> 'I' and w.c is not distinct from r.c and w.k = r.k
),
told as (
    select c, string_agg((case when e = 'K' then role when (o - s) % 2 = 0 then 'user' else 'assistant' end) || ':' || (case when e = 'I' then '' else text end), chr(10) order by j)
              filter (where e <> 'D') as t
    from lined group by c
),
counted as (
    select c, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 'blank') as blank,
           count(*) filter (where fault = 'duplicate') as duplicate, count(*) filter (where fault = 'truncated') as truncated,
           count(*) filter (where before is not null and before || i not in ('su', 'ua', 'au')) as illegal
    from (select *, lag(i) over (partition by c order by k) as before from faulty) group by c
)
select x.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, cast(coalesce(cost, 0) as bigint) as cost, coalesce(audit, '') as audit, sha256(coalesce(t, '')) as repaired_sha256
from (select distinct conv_id from conversations) x
left join counted a on x.conv_id is not distinct from a.c
left join best b on x.conv_id is not distinct from b.c
left join told d on x.conv_id is not distinct from d.c
"""
)



def _op11() -> str:
    """Matches with the texts between them, running sums for places, and a plain interval join."""
    from flowguard.llm import linked_secrets as k

    q = lambda pattern: "'" + pattern.replace("'", "''") + "'"  # noqa: E731
    all_parts = f"{k.BREAK}|{k.PARTS}"
    passes = " union all ".join(
        f"select r, {n} as pass, unnest(regexp_extract_all(text, {q(p)})) as m, unnest(list_slice(string_split_regex(text, {q(p)}), 1, -2)) as gap, "
        f"generate_subscripts(regexp_extract_all(text, {q(p)}), 1) as i from doc where regexp_matches(text, {q(p)})"
        for n, p in enumerate([k.ASSIGN, k.ACCESS, k.HEX, all_parts])
    )
    whole = lambda p: q(f"^(?:{p})$")  # noqa: E731
    value, name = f"length(regexp_extract(m, {whole(k.ASSIGN)}, 2))", f"length(regexp_extract(m, {whole(k.IDENTIFIER)}, 2))"
    mixed = " and ".join(f"regexp_matches(m, {q(p)})" for p in k.MIXED)
    return rf"""
with
doc as (select doc_id, row_number() over () as r, coalesce(text, '') as text from documents),
found as ({passes}),
kinds as (
    select *, case when m[1] = chr(10) then 'break'
                   when pass in (0, 3) and regexp_matches(m, {whole(k.ASSIGN)}) then case when {value} >= {k.LEAST_VALUE} then 'assign' when pass = 3 and {value} >= {k.LEAST_WEAK} then 'key' end
                   when pass in (1, 3) and regexp_matches(m, {whole(k.ACCESS)}) then case when length(m) >= {k.LEAST_ACCESS} then 'access' end
                   when pass = 2 then 'hex'
                   when regexp_matches(m, {whole(k.IDENTIFIER)}) then case when {name} >= {k.LEAST_NAME} then 'identifier' end
                   when regexp_matches(m, {whole(k.URL)}) or regexp_matches(m, {whole(k.HOST)}) then 'endpoint'
                   when regexp_matches(m, {whole(k.HEX)}) then 'hex'
                   when {mixed} then 'key' end as kind
    from found
),
place as (
    select r, pass, kind, cast(sum(length(gap) + length(m)) over w as bigint) as e, e - length(m) as s,
           count(*) filter (where kind = 'break') over w as scope
    from kinds window w as (partition by r, pass order by i)
),
part as (select * from place where pass = 3 and kind is not null and kind <> 'break'),
weak as (
    select distinct a.r, a.kind, a.s, a.e, bool_or(b.kind in ('access', 'identifier')) over w as has_name, bool_or(b.kind in ('assign', 'hex', 'key')) over w as has_secret
    from part a join part b on a.r = b.r and a.scope = b.scope and b.s < a.e + {k.REACH} and b.e > a.s - {k.REACH}
    where a.kind in ('key', 'identifier', 'endpoint')
    window w as (partition by a.r, a.s, a.e, a.kind)
),
span as (
    select r, kind, s, e from place where pass < 3 and kind is not null
    union all
    select r, kind, s, e from weak where case kind when 'key' then has_name when 'identifier' then has_secret else has_name and has_secret end
),
listed as (select *, list_position({list(k.KINDS)}, kind) as rank, kind || ':' || s || ':' || e as t from span),
told as (
    select r, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access, count(*) filter (where kind = 'hex') as n_hex,
           string_agg(t, ',' order by s, rank) filter (where rank <= 3) as base, string_agg(t, ',' order by s, rank) as spans
    from listed group by r
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from doc left join told using (r)
"""


OP11 = _op11()

SQL: dict[str, str] = {"op2_decontamination": OP2, "op3_mixing": OP3, "op9_chat": OP9, "op11_linked_secrets": OP11, "op12_turn_repair": OP12, "op13_periodic_runs": OP13}
