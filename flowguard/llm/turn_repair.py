"""Repair of conversations: the cheapest edits that bring the turns' roles into legal order.

Rows of a conversation are taken by turn (null first, ties by role and text). A row's first fault
counts: *blank* (no character but white space), *duplicate* (role and text stand earlier in the
conversation), *truncated* (the last such character is none of ``.!?``). Edits: Keep (0), Rerole to
user or assistant (3), Delete (4; the only one for blank and duplicate rows), Insert an empty turn of
user or assistant (3); a truncated row that stays costs 3 more. The initials of the roles that are
left read ``(s?(ua)+)?``. Of the cheapest edits the ASCII-least sequence of their initials is taken.

Method. A conversation is a lattice: columns are rows, nodes are states of the pattern (nothing yet,
after s, after u, after a), arcs are edits with whole costs. The auction algorithm for shortest paths
keeps a price per node with ``price[i] <= cost(i, j) + price[j]`` on every arc, and a path: where the
last node's price is below its best arc, it is raised to it and the path contracts by that node; else
the path is extended along that arc. A path that comes to a node with a final price makes all prices
on it final. Columns are taken from the end, with the least price of the next column (and the least
cost of the row) to begin with, so prices rise by a few units only. Arcs on which the inequality is
tight are those of cheapest edits; the trace takes the ASCII-least one at each node.

A conversation of any length is cut into segments of some thousand rows (one byte a row). Its
segments' costs between states are found in parallel; the conversation's chain of 4 x 4 tables gives
every segment its prices at the end, segments are traced in parallel from each state, and the chain
of traces tells which one holds. Rows are numbered by a range sort, so no task holds a conversation;
the one sequential pass is that of ``reports``, which streams a conversation's rows through a digest.

Null roles and texts count as one space. Null conversation ids are one conversation, null turns come
first. Repeated rows are duplicates. An empty table gives empty tables. Further columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import ready, store

SEGMENT_ROWS = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"

_INF = float("inf")
_END = -1
_BLANK, _DUPLICATE, _TRUNCATED = 1, 2, 3
#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
_NEXT = (2, 2, 3, 2)
_KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_INITIALS = "sua "
#: States from which a state can be reached at all.
_BEFORE = ((0,), (0, 1), (0, 1, 2, 3), (0, 1, 2, 3))


def _arcs(code: int) -> list[list[tuple[str, int, int, int]]]:
    """Arcs of a row by state, in ASCII order: initial, cost, columns on, next state."""
    initial, fault = _INITIALS[code % 4], code // 4
    more = TRUNCATED if fault == _TRUNCATED else 0
    out = []
    for state in range(4):
        arcs = [("D", DELETE, 1, state), ("I", INSERT, 0, _NEXT[state])]
        if fault not in (_BLANK, _DUPLICATE):
            if initial in _KEPT[state]:
                arcs.append(("K", KEEP + more, 1, _KEPT[state][initial]))
            arcs.append(("R", REROLE + more, 1, _NEXT[state]))
        out.append(arcs)
    return out


_ARCS = [_arcs(code) for code in range(16)]
_LEAST = [min(arc[1] for arcs in by_state for arc in arcs if arc[2]) for by_state in _ARCS]


class Auction:
    """Prices of the lattice of one segment's rows.

    ``ends``: the price of each state after the last row; None where the conversation ends there,
    which insertions can still complete. ``states``: those from which the end can be reached.
    """

    def __init__(self, codes: bytes, ends: tuple | None, states: tuple = (0, 1, 2, 3)):
        self.codes, self.ends = codes, ends
        n = len(codes)
        self.price: list = [_INF] * (4 * (n + 1))
        self.final = bytearray(b"\x01" * (4 * (n + 1)))
        for column in range(n, -1, -1):
            low = 0
            if column < n:
                low = min(self.price[4 * column + 4 : 4 * column + 8]) + _LEAST[codes[column]]
            for state in states:
                self.price[4 * column + state] = low
                self.final[4 * column + state] = 0
            for state in states:
                self._settle(4 * column + state)

    def arcs(self, node: int) -> list[tuple[str, float, int]]:
        column, state = divmod(node, 4)
        if column < len(self.codes):
            return [(e, cost, node + 4 * on + to - state) for e, cost, on, to in _ARCS[self.codes[column]][state]]
        if self.ends is not None:
            return [("", self.ends[state], _END)]
        done = [("", 0, _END)] if state in (0, 3) else []
        return [*done, ("I", INSERT, node + _NEXT[state] - state)]

    def _best(self, node: int) -> tuple[float, int]:
        price = self.price
        return min((cost + (price[to] if to != _END else 0), to) for _, cost, to in self.arcs(node))

    def _settle(self, origin: int) -> None:
        path = [origin]
        while True:
            node = path[-1]
            if node == _END or self.final[node]:
                for x in path:
                    if x != _END:
                        self.final[x] = 1
                return
            best, to = self._best(node)
            if self.price[node] < best:
                self.price[node] = best  # raise, and contract the path by this node
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)

    def trace(self, state: int) -> tuple[str, int]:
        """ASCII-least initials of cheapest edits from a state, and the state at the end."""
        out, node = [], state
        while True:
            for e, cost, to in self.arcs(node):
                if self.price[node] == cost + (self.price[to] if to != _END else 0):
                    out.append(e)
                    break
            if to == _END:
                return "".join(out), node % 4
            node = to


@lru_cache(maxsize=1 << 14)
def _short_audit(codes: bytes) -> str:
    return Auction(codes, None).trace(0)[0]


def whole_audit(codes: bytes) -> str:
    """Audit of a conversation that is one segment."""
    return _short_audit(codes) if len(codes) <= 32 else Auction(codes, None).trace(0)[0]


def between_states(codes: bytes, last: bool) -> list[float]:
    """Least costs from each state before a segment to each state after it; for the last segment of
    a conversation to its end (in all four places)."""
    if last:
        prices = Auction(codes, None).price[:4]
        return [p for p in prices for _ in range(4)]
    table = [_INF] * 16
    for to in range(4):
        ends = tuple(0 if s == to else _INF for s in range(4))
        prices = Auction(codes, ends, _BEFORE[to]).price
        for state in _BEFORE[to]:
            table[4 * state + to] = prices[state]
    return table


# ------------------------------------------------------------------------------ rows and segments


def numbered(rows: DataFrame) -> DataFrame:
    """Stored rows ``(conv_id, turn, role, text, text_key, at)``; ``at`` ascends within a conversation
    in its order, without gaps inside a partition of the range sort."""
    text, role = F.coalesce(F.col("text"), F.lit(" ")), F.coalesce(F.col("role"), F.lit(" "))
    narrow = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    order = ["conv_id", "turn", "role", "text_key"]
    keyed = narrow.withColumn("text_key", F.md5(F.col("text").cast("binary"))).withColumn("tie", F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(*order, "tie").sortWithinPartitions(*order)
    return store(dealt.drop("tie").withColumn("at", F.monotonically_increasing_id()), "turn-rows")


def _code(role: Column, text: Column, earlier: Column) -> Column:
    left = F.rtrim(text, F.lit(WHITE))
    fault = F.when(left == "", _BLANK).when(earlier, _DUPLICATE).when(~F.substring(left, -1, 1).isin(".", "!", "?"), _TRUNCATED).otherwise(0)
    initial = F.substring(role, 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return (fault * 4 + place).cast("tinyint")


def coded(rows: DataFrame) -> DataFrame:
    """``(conv_id, at, code)`` of numbered rows. Only texts that a conversation repeats are joined."""
    again = rows.groupBy("conv_id", "role", "text_key").agg(F.min("at").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    again = again.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text_key").alias("k"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text_key") == F.col("k"))
    left = rows.select("conv_id", "at", "role", "text_key", _code(F.col("role"), F.col("text"), F.lit(False)).alias("own"))
    joined = left.join(again, same, "left")
    blank = F.floor(F.col("own") / 4) == _BLANK
    earlier = F.coalesce(F.col("at") > F.col("first"), F.lit(False))
    code = F.when(earlier & ~blank, _DUPLICATE * 4 + F.col("own") % 4).otherwise(F.col("own"))
    return joined.select("conv_id", "at", code.cast("tinyint").alias("code"))


def segments(codes: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """``(conv_id, seg, codes)``: up to ``segment_rows`` consecutive rows; ``seg`` is the first
    row's number."""
    part = F.shiftright("at", 33).alias("part")
    block = F.floor(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) / segment_rows).alias("block")
    rows = F.array_sort(F.collect_list(F.struct("at", "code")))
    found = codes.groupBy("conv_id", part, block).agg(F.min("at").alias("seg"), rows.alias("rows"))
    return found.select("conv_id", "seg", F.col("rows.code").alias("codes"))


# -------------------------------------------------------------------------------------------- audit


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32())}


def _map(df: DataFrame, columns: dict[str, str], each) -> DataFrame:
    """Rows through a Python function of one row's values, in Arrow batches."""
    schema = pa.schema([(n, _TYPES[t]) for n, t in columns.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [each(*x) for x in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return df.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in columns.items()))


def audits(segs: DataFrame) -> DataFrame:
    """``(seg, audit, entry)`` of stored segments: the edits' initials of each, and the state
    before it."""
    many = segs.groupBy(F.col("conv_id").alias("c")).agg(F.count("*").alias("n_segs"), F.max("seg").alias("last_seg")).where("n_segs > 1")
    many = store(many.select("c", "last_seg"), "turn-long")
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    single = segs.join(many, same, "left_anti").select("seg", "codes")
    alone = _map(single, {"seg": "long", "audit": "string", "entry": "int"}, lambda seg, codes: (seg, whole_audit(bytes(codes)), 0))
    found = store(alone, "turn-short-audits")
    if many.isEmpty():
        return found
    split = store(segs.join(many, same).select("conv_id", "seg", (F.col("seg") == F.col("last_seg")).alias("is_last"), "codes"), "turn-long-segments")
    tables = _map(split.select("seg", "is_last", "codes"), {"seg": "long", "costs": "array<double>"}, lambda seg, last, codes: (seg, between_states(bytes(codes), last)))
    chain = split.select("conv_id", "seg", "is_last").join(store(tables, "turn-costs"), "seg")
    ends = chain.groupBy("conv_id").applyInArrow(_exit_prices, "seg long, ends array<double>")
    priced = split.select("seg", "codes").join(ends, "seg")
    traces = _map(priced, {"seg": "long", "ways": "array<string>", "exits": "array<int>"}, _traces)
    traces = store(traces, "turn-traces")
    entries = split.select("conv_id", "seg").join(traces.select("seg", "exits"), "seg").groupBy("conv_id").applyInArrow(_entries, "seg long, entry int")
    chosen = traces.join(entries, "seg").select("seg", F.element_at("ways", F.col("entry") + 1).alias("audit"), "entry")
    return found.unionByName(store(chosen, "turn-long-audits"))


def _exit_prices(group: pa.Table) -> pa.Table:
    """Prices after each segment of a conversation, from its last segment to its first."""
    rows = sorted(zip(group.column("seg").to_pylist(), group.column("costs").to_pylist(), strict=True), reverse=True)
    segs, ends, now = [], [], [0.0] * 4
    for k, (seg, costs) in enumerate(rows):
        segs.append(seg)
        ends.append(None if k == 0 else list(now))
        now = [min(costs[4 * s + t] + (now[t] if k else 0) for t in range(4)) for s in range(4)]
    return pa.table({"seg": pa.array(segs, pa.int64()), "ends": pa.array(ends, pa.list_(pa.float64()))})


def _traces(seg: int, codes: list[int], ends: list[float] | None) -> tuple[int, list[str], list[int]]:
    auction = Auction(bytes(codes), tuple(ends) if ends is not None else None)
    ways = [auction.trace(s) for s in range(4)]
    return seg, [w for w, _ in ways], [s for _, s in ways]


def _entries(group: pa.Table) -> pa.Table:
    """The state before each segment, from the first on."""
    rows = sorted(zip(group.column("seg").to_pylist(), group.column("exits").to_pylist(), strict=True))
    entry, state = [], 0
    for _, exits in rows:
        entry.append(state)
        state = exits[state]
    return pa.table({"seg": pa.array([r[0] for r in rows], pa.int64()), "entry": pa.array(entry, pa.int32())})


# ------------------------------------------------------------------------------------ repaired rows


def _edits(seg: int, audit: str, entry: int, codes: list[int]) -> tuple[list, list, list, list, list]:
    """Edits of a segment: place, initial, number of the row (None for an insertion), new role
    (None for kept and deleted rows) and the row's fault."""
    at, roles, faults, state, row = [], [], [], entry, 0
    for e in audit:
        if e == "K":
            state = _KEPT[state][_INITIALS[codes[row] % 4]]
        elif e != "D":
            state = _NEXT[state]
        roles.append(("", "", "user", "assistant")[state] if e in "IR" else None)
        at.append(None if e == "I" else seg + row)
        faults.append(None if e == "I" else codes[row] // 4)
        row += e != "I"
    return list(range(len(audit))), list(audit), at, roles, faults


def repaired(rows: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Every row and insertion in order: ``(conv_id, seg, place, edit, turn, role, text, new_role,
    fault)``; ``(seg, place)`` orders a conversation, deleted rows have edit D and no new role."""
    ready(rows.sparkSession)
    stored = numbered(rows)
    codes = store(coded(stored), "turn-codes")
    segs = store(segments(codes, segment_rows), "turn-segments")
    found = audits(segs).join(segs.select("conv_id", "seg", "codes"), "seg")
    ident = segs.schema["conv_id"].dataType.simpleString()
    result = f"conv_id {ident}, seg long, place int, edit string, at long, new_role string, fault int"

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                seg, audit, entry, codes = (one.column(c)[0].as_py() for c in (1, 2, 3, 4))
                place, edit, at, role, fault = _edits(seg, audit, entry, codes)
                columns = [pa.repeat(one.column(0)[0], len(place)), pa.repeat(pa.scalar(seg, pa.int64()), len(place)), pa.array(place, pa.int32()), pa.array(edit, pa.string()), pa.array(at, pa.int64()), pa.array(role, pa.string()), pa.array(fault, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "seg", "place", "edit", "at", "new_role", "fault"])

    steps = store(found.select("conv_id", "seg", "audit", "entry", "codes").mapInArrow(edits, result), "turn-edits")
    own = stored.select("at", "turn", "role", "text")
    kept = steps.where("edit != 'I'").join(own, "at")
    new = steps.where("edit = 'I'").withColumn("turn", F.lit(None).cast(own.schema["turn"].dataType)).withColumn("role", F.lit(None).cast("string")).withColumn("text", F.lit(""))
    role = F.when(F.col("edit") == "K", F.col("role")).otherwise(F.col("new_role"))
    both = kept.unionByName(new)
    return both.select("conv_id", "seg", "place", "edit", "turn", "role", "text", role.alias("new_role"), "fault")


class _Report:
    """What a conversation's rows in order come to."""

    def __init__(self) -> None:
        self.turns: list | None = None
        self.last = None
        self.faults = [0, 0, 0, 0]
        self.illegal = self.cost = 0
        self.audit, self.digest, self.wrote = bytearray(), hashlib.sha256(), False

    def add(self, edit: str, turn, role, text: str, new_role, fault) -> None:
        self.audit += edit.encode()
        self.cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + (TRUNCATED if fault == _TRUNCATED and edit != "D" else 0)
        if edit != "I":
            self.faults[fault] += 1
            self.illegal += self.last is not None and self.last + role[:1] not in ("su", "ua", "au")
            self.last = role[:1]
            if turn is not None:
                low, high, distinct = self.turns or (turn, turn - 1, 0)
                self.turns = [low, turn, distinct + (turn != high)]
        if edit != "D":
            self.digest.update(("\n" if self.wrote else "").encode() + f"{new_role}:{text}".encode())
            self.wrote = True

    def row(self) -> tuple:
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return gaps, *self.faults[1:], self.illegal, self.cost, self.audit.decode(), self.digest.hexdigest()


_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def reports(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repaired``: turn gaps, faults, illegal neighbours, cost, audit
    and digest of the repaired ``role:text`` lines. Rows stream by, so memory is a batch of rows and
    a byte an edit; a digest over a conversation's text is one task's work by its nature."""
    ident = edits.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "seg", "place"]
    rows = edits.select(*order, "edit", "turn", "role", "text", "new_role", "fault").repartition("conv_id").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, report, kind = None, None, None

        def out(done: list) -> pa.RecordBatch:
            cells = list(zip(*((c, *r.row()) for c, r in done), strict=True))
            types = [kind, *[pa.int64()] * len(_REPORT), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cells, types, strict=True)], names=["conv_id", *_REPORT, "audit", "repaired_sha256"])

        for batch in batches:
            kind, done = batch.column(0).type, []
            for conv, _, _, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if report is None or conv != now:
                    if report is not None:
                        done.append((now, report))
                    now, report = conv, _Report()
                report.add(*row)
            if done:
                yield out(done)
        if report is not None:
            yield out([(now, report)])

    return rows.mapInArrow(run, f"conv_id {ident}, " + ", ".join(f"{n} long" for n in _REPORT) + ", audit string, repaired_sha256 string")
