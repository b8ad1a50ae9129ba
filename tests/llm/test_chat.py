import hashlib

import duckdb
from pyspark.sql import functions as F

from flowguard.llm import chat
from flowguard.llm.queries import op9_chat
from flowguard.llm.sql import SQL

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["", "\\", "<|", "<\\|", "\\<|", "<\\\\|", "<", "|>", "a\nb", "<|im_end|>\n", "\\n", "\\\\n", "<|im_start|>user\nhi<|im_end|>\n", "é<", "x\\"]


def digest(rows):
    turns = "".join(f"{r or ''}\n{t or ''}\n" for r, t in rows)
    loss = "".join(t or "" for r, t in rows if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(rows), sha(turns), len(loss), sha(loss)


def test_round_trip_of_control_strings(spark):
    rows = [(c, i, "assistant" if (i + c) % 2 else r, t) for c, r in enumerate(["user", "", None, "a\nb", "\\n", "<|x", "r\\"]) for i, t in enumerate([*NASTY, None])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("tree", F.lit(1)).withColumn("segments", F.lit("x")).withColumn("score", F.lit(None))
    chats = chat.formatted(chat.conversation_nodes(df))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(chats).collect()}
    for c in range(7):
        assert got[c] == digest([(r, t) for k, _, r, t in rows if k == c])
    for r in chats.collect():
        assert r.formatted == "".join(s.text for s in r.segments)
        assert r.formatted.count("<|im_end|>") == len(NASTY) + 1 == r.formatted.count("<|im_start|>")


def test_reply_trees(spark):
    #      1(0)
    #   2(5)   3(1)
    #  4(1)   5(9) 6(2)     and an orphan 8, a circle 9-10
    nodes = [("t", 1, None, 0.0), ("t", 2, 1, 5.0), ("t", 3, 1, 1.0), ("t", 4, 2, 1.0), ("t", 5, 3, 9.0), ("t", 6, 3, 2.0), ("t", 8, 77, 4.0), ("u", 9, 10, 1.0), ("u", 10, 9, 1.0)]
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, score double")
    paths = {}
    for r in chat.best_paths(df, 3).collect():
        paths.setdefault((r.tree, r.branch), {})[r.back] = r.node
    assert {k: [v[b] for b in sorted(v, reverse=True)] for k, v in paths.items()} == {("t", 1): [1, 3, 5], ("t", 2): [1, 2, 4], ("t", 3): [8]}
    text = df.withColumn("conv_id", F.lit(3)).withColumn("role", F.lit("user")).withColumn("text", F.concat(F.lit("n"), "node"))
    got = {r.branch: r.formatted for r in chat.formatted(text, 2).collect()}
    assert got[1] == "".join(f"<|im_start|>user\nn{n}<|im_end|>\n" for n in (1, 3, 5)) and len(got) == 2


def test_long_chain_order_and_edges(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(300)] + [(None, 0, "user", "x"), (None, None, "assistant", "first"), (2, 1, "user", "b"), (2, 1, "user", "a"), (2, 1, "user", "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(chat.formatted(chat.conversation_nodes(df))).collect()}
    assert got[1] == digest([(r, t) for c, _, r, t in rows if c == 1])
    assert got[None] == digest([("assistant", "first"), ("user", "x")])
    assert got[2] == digest([("user", "a"), ("user", "a"), ("user", "b")])
    assert chat.formatted(chat.conversation_nodes(df.where("false"))).count() == 0


def test_sql_twin(spark):
    c = duckdb.connect()
    c.sql("create view conversations as select * from '/root/testdata/sf0.001/conversations.parquet'")
    cols = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    want = sorted(c.sql(f"select {','.join(cols)} from ({SQL['op9_chat']})").fetchall())
    assert sorted(tuple(r) for r in op9_chat(spark, "/root/testdata/sf0.001").select(*cols).collect()) == want
    assert want[0][0] == -1
