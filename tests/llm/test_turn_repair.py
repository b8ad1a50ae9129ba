"""Repair of conversations against a plain search, in segments of any size, and odd inputs."""

import hashlib
import random
import re
from functools import cache

import pytest

from flowguard.llm import queries as Q
from flowguard.llm import turn_repair as T

SCHEMA = "other string, conv_id long, turn long, role string, text string, audit string"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def plain(rows):
    """Least (cost, initials) by trying every edit, and what follows from it."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(T.WHITE)
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    @cache
    def best(k, state, inserts):
        found = []
        if k == len(rows) and state in ("", "a"):
            found.append((0, ""))
        if inserts < 2:
            c, s = best(k, NEXT[state], inserts + 1)
            found.append((c + 3, "I" + s))
        if k < len(rows):
            c, s = best(k + 1, state, 0)
            found.append((c + 4, "D" + s))
            if faults[k] not in ("b", "d"):
                more, i = 3 * (faults[k] == "t"), rows[k][1][:1]
                c, s = best(k + 1, NEXT[state], 0)
                found.append((c + 3 + more, "R" + s))
                if i == NEXT[state] or (i == "s" and state == ""):
                    c, s = best(k + 1, i, 0)
                    found.append((c + more, "K" + s))
        return min(found, default=(10**9, ""))

    cost, audit = best(0, "", 0)
    out, k, state = [], 0, ""
    for e in audit:
        if e == "K":
            out.append((rows[k][1], rows[k][2]))
            state = rows[k][1][:1]
        elif e != "D":
            state = NEXT[state]
            out.append(({"u": "user", "a": "assistant"}[state], rows[k][2] if e == "R" else ""))
        k += e != "I"
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in "bdt"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)


def conversation(rng, n):
    role = lambda: rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", ""])
    text = lambda: rng.choice(["A.", "B?", "cut", " \t", "", "C! \n", "é.", "one", "two.", "3!", "4?"]) + rng.choice(["", "", f" {rng.random()}."])
    turns = sorted(rng.sample(range(n * 2), n))
    return [(t, role(), text()) for t in turns]


@pytest.mark.parametrize("segment_rows", [1, 3, 4096])
def test_against_every_edit(spark, segment_rows):
    rng = random.Random(segment_rows)
    convs = {c: conversation(rng, rng.choice([1, 2, 3, 5, 8, 13, 40])) for c in range(60)}
    rows = [("x", c, t, r, x, "y") for c, conv in convs.items() for t, r, x in conv]
    rng.shuffle(rows)
    got = T.reports(T.repaired(spark.createDataFrame(rows, SCHEMA), segment_rows)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: plain(conv) for c, conv in convs.items()}


def test_prices_of_a_long_lattice():
    """Twenty thousand rows of one role, and prices across a cut."""
    codes = bytes([1]) * 20_000
    whole = T.Auction(codes, None)
    assert whole.price[0] == 30_000
    assert whole.trace(0) == ("KR" * 10_000, 3)
    rng = random.Random(5)
    codes = bytes(rng.randrange(16) for _ in range(400))
    left, right = codes[:150], codes[150:]
    table, after = T.between_states(left, False), T.Auction(right, None).price[:4]
    joined = [min(table[4 * s + t] + after[t] for t in range(4)) for s in range(4)]
    assert joined == T.Auction(codes, None).price[:4] == T.Auction(left, tuple(after)).price[:4]


def test_one_conversation_of_many_rows(spark):
    """One conversation in segments of 20 rows over several partitions."""
    rng = random.Random(2)
    conv = conversation(rng, 200)
    rows = [("x", None, t, r, x, "y") for t, r, x in conv]
    got = T.reports(T.repaired(spark.createDataFrame(rows, SCHEMA).repartition(7), 20)).collect()
    assert [tuple(r) for r in got] == [(None, *plain(conv))]


def test_odd_rows(spark):
    rows = [
        ("x", None, None, None, None, "y"),  # a blank row of no role, deleted
        ("x", 1, None, "user", "Null turn first.", "y"),
        ("x", 1, 4, "assistant", "Yes.", "y"),
        ("x", 2, 1, "user", "Same.", "y"),
        ("x", 2, 1, "user", "Same.", "y"),
        ("x", 3, 0, "user", "long " * 300_000 + "end.", "y"),
    ]
    got = {r.conv_id: r for r in T.reports(T.repaired(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert (got[None].audit, got[None].blank, got[None].cost, got[None].gaps) == ("D", 1, 4, 0)
    assert (got[1].audit, got[1].gaps, got[1].cost) == ("KK", 0, 0)
    assert (got[2].audit, got[2].duplicate, got[2].illegal, got[2].cost) == ("KDI", 1, 1, 7)
    assert got[3].audit == "KI"
    empty = spark.createDataFrame([], SCHEMA)
    assert T.reports(T.repaired(empty)).count() == 0


def test_query_without_rows_after_damage(spark, tmp_path):
    """Every conversation is named; one whose rows all go has zeros and digests of nothing."""
    import zlib

    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    kept = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 > 4)
    rows = [(gone, 0, "user", "Hello."), (kept, 0, "user", "Hello.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in Q.op12_turn_repair(spark, str(tmp_path)).collect()}
    assert got[gone] == (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    assert got[kept][5:7] == (3, "KI")
