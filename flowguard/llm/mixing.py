"""Mixing sources to target weights, in DataFrame and SQL functions only.

Targets: sources (by code point, null last) have weights 3, 1, 2, repeating; they share 150 % of
all words by weight; no target goes over twice its source's size, the excess being shared again by
weight. (In one pass: with sources sorted by cap / weight, those below the common level stop at
their cap.)

Draws: the words of a source lie on one line, documents in a hashed order (prefix sums in two
levels: buckets of bounded size, then inside each bucket). The line is cut into blocks of equal
length. Draw number j of a source takes the block of rank j modulo n, ranks being a permutation of
the n blocks, so the draws of one epoch are disjoint, a quota of q blocks is exact, and no document
is taken more often than the target's epochs (2 at most).

Splitting tree: the sources' block quotas are halved recursively among the output shards; each left
child draws its part from the node's quotas by a multivariate hypergeometric draw (one source after
the other, each an inverse-CDF hypergeometric draw with a hashed uniform number), so every shard
gets an exact number of blocks whose sources mix as in a random shuffle of everything. A shard's
blocks of a source are a run of draw numbers, hence disjoint from all others; a shard is then
shuffled locally by a hashed key, in cells of that key, so that no task sorts a whole shard.

Rows are numbered in a stored table first and keep their number through lines, draws and texts, so
null and repeated ids are documents like any other. A document's text meets the list of its draws
once and is cut into pieces there; the words taken are the words of these pieces. Its words are one
array while it is cut, so a task needs room for the longest text.

The table of sources (and source x shard quotas) is treated as metadata: its weights are parameters.
It is sorted in one task; nothing else is.

Cases: null text: size 0, taken 0. A null source is a source of its own. Repeated rows are documents
of their own. Empty sources have target 0; an empty table gives no rows. Clashing extra columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.llm.common import store

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
SHARDS = 16
SEED = 17
#: Words of a block: a 4096th of the source, 1024 at most.
BLOCK_WORDS, LEAST_BLOCKS = 1024, 4096
#: Documents of a bucket of the hashed order, about.
BUCKET_ROWS = 50_000
#: Words of a cell of a shard's shuffled order, about.
CELL_WORDS = 4_000_000
#: Primes; the first that does not divide the number of blocks permutes them.
PRIMES = (99999989, 99999971, 99999959, 99999941, 99999931, 99999847, 99999839)

SIZE = r"[^\x20\x09-\x0D]+"


def numbered(docs: DataFrame) -> DataFrame:
    """``row, doc_id, source, text, size``, stored: each row with a number of its own and its words."""
    size = F.coalesce(F.regexp_count("text", F.lit(SIZE)), F.lit(0)).cast("long")
    return store(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", "text", size.alias("size")), "mix-rows")


def sized(rows: DataFrame) -> DataFrame:
    """``row, doc_id, source, size, key``: words of each row and its place in the hashed order."""
    return rows.select(
        "row",
        "doc_id",
        "source",
        "size",
        F.conv(F.substring(F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(str(SEED)))), 1, 15), 16, 10).cast("long").alias("key"),
    )


def source_plan(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per source: ``sid, source, source_size, target, block, n_blocks, quota, prime``."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("sid", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    s = s.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("sid") % len(weights))).withColumn("most", F.col("source_size") * F.lit(cap))
    everything = Window.partitionBy(F.lit(1))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "sid")
    s = s.withColumn("goal", F.sum("source_size").over(everything) * F.lit(share))
    s = s.withColumn("before", F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("level", (F.col("goal") - F.col("before")) / F.col("open")).withColumn("full", F.col("most") <= F.col("weight") * F.col("level"))
    final = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)  # levels only fall after the first that isn't full
    s = s.withColumn("target", F.when(F.col("full"), F.col("most")).otherwise(F.least("most", F.col("weight") * final)))
    s = s.withColumn("block", F.expr(f"greatest(1, least({BLOCK_WORDS}, source_size div {LEAST_BLOCKS}))").cast("long"))
    s = s.withColumn("n_blocks", F.expr("(source_size + block - 1) div block"))
    s = s.withColumn("quota", F.least(F.floor(F.col("target") / F.col("block") + 0.5), F.expr("2 * n_blocks")).cast("long"))
    prime = F.get(F.filter(F.array(*[F.lit(p).cast("long") for p in PRIMES]), lambda p: (F.col("n_blocks") <= 1) | (p % F.greatest(F.col("n_blocks"), F.lit(1)) != 0) & (F.col("n_blocks") % p != 0)), F.lit(0))
    return s.withColumn("prime", F.coalesce(prime, F.lit(1).cast("long"))).select("sid", "source", "source_size", "target", "block", "n_blocks", "quota", "prime")


def uniform(*parts: Column) -> Column:
    """A hashed number in (0, 1)."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``marked`` among ``total`` fall into a sample of ``drawn``: the smallest k whose
    cumulative probability reaches u. Terms follow from each other by their ratio; the sum runs
    over 8 standard deviations about the mean, beyond which less than 1e-13 lies."""
    t, m, d = (x.cast("double") for x in (total, marked, drawn))
    mean = d * m / F.greatest(t, F.lit(1.0))
    sd = F.sqrt(F.greatest(mean * (1 - m / F.greatest(t, F.lit(1.0))) * (t - d) / F.greatest(t - 1, F.lit(1.0)), F.lit(0.0)))
    low = F.greatest(F.greatest(F.lit(0.0), d - (t - m)), F.floor(mean - 8 * sd - 3).cast("double"))
    high = F.least(F.least(d, m), F.ceil(mean + 8 * sd + 3).cast("double"))
    steps = F.sequence(low.cast("long"), F.greatest(low, high).cast("long"))

    def ratio(k: Column) -> Column:
        return (m - k) * (d - k) / ((k + 1) * F.greatest(t - m - d + k + 1, F.lit(1.0)))

    zero = F.lit(0.0)
    mass = F.aggregate(steps, F.struct(F.lit(1.0).alias("w"), zero.alias("sum")), lambda a, k: F.struct((a["w"] * ratio(k)).alias("w"), (a["sum"] + a["w"]).alias("sum")))["sum"]
    aim = u * mass
    below = F.aggregate(
        steps,
        F.struct(F.lit(1.0).alias("w"), zero.alias("sum"), F.lit(0).cast("long").alias("n")),
        lambda a, k: F.struct((a["w"] * ratio(k)).alias("w"), (a["sum"] + a["w"]).alias("sum"), (a["n"] + (a["sum"] + a["w"] < aim).cast("long")).alias("n")),
    )["n"]
    return F.least(low.cast("long") + below, F.greatest(low, high).cast("long"))


def shard_quotas(plan: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``sid, bounds``: draw numbers ``bounds[h]`` to ``bounds[h + 1]`` of a source go to shard h."""
    longs = lambda: F.array().cast("array<long>")
    node = plan.agg(F.transform(F.array_sort(F.collect_list(F.struct("sid", "quota"))), lambda x: x["quota"]).alias("quotas"))
    node = node.withColumn("from", F.lit(0)).withColumn("to", F.lit(shards))
    levels = max(shards - 1, 0).bit_length()
    for level in range(levels):
        size = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, x: a + x)
        middle = F.expr("`from` + (`to` - `from`) div 2")
        node = node.withColumn("all", size).withColumn("mid", middle).withColumn("part", F.expr("`all` * (`mid` - `from`) div (`to` - `from`)"))

        def draw(a: Column, q: Column) -> Column:
            k = hypergeometric(a["rest"], q, a["want"], uniform(F.lit(SEED), F.col("from"), F.col("to"), F.size(a["out"])))
            # an array of one, so that k is computed once though it stands in two fields
            one = F.transform(F.array(k), lambda k: F.struct((a["rest"] - q).alias("rest"), (a["want"] - k).alias("want"), F.concat(a["out"], F.array(k)).alias("out")))
            return one[0]

        start = F.struct(F.col("all").alias("rest"), F.col("part").alias("want"), longs().alias("out"))
        node = node.withColumn("left", F.aggregate("quotas", start, draw, lambda a: a["out"]))
        right = F.transform("quotas", lambda q, i: q - F.get(F.col("left"), i))
        child = F.array(
            F.struct(F.col("left").alias("quotas"), F.col("from"), F.col("mid").alias("to")),
            F.struct(right.alias("quotas"), F.col("mid").alias("from"), F.col("to")),
        )
        split = node.where("`to` - `from` > 1").select(F.explode(child).alias("c")).select("c.*")
        node = split.unionByName(node.where("`to` - `from` = 1").select("quotas", "from", "to"))
        node = store(node, f"mix-tree-{level}")
    rows = node.select("from", F.posexplode("quotas").alias("sid", "n"))
    counts = rows.groupBy("sid").agg(F.transform(F.array_sort(F.collect_list(F.struct("from", "n"))), lambda x: x["n"]).alias("counts"))
    add = lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n))
    return counts.select("sid", F.aggregate("counts", F.array(F.lit(0).cast("long")), add).alias("bounds"))


def on_line(sizes: DataFrame, plan: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``sid, row, doc_id, size, off``: where each document's words begin on its source's line."""
    rows = sizes.join(plan.select("sid", F.col("source").alias("s")), F.col("source").eqNullSafe(F.col("s"))).select("sid", "row", "doc_id", "size", "key")
    buckets = max(1, rows.count() // bucket_rows)
    width = (1 << 60) // buckets + 1
    rows = rows.withColumn("bucket", F.expr(f"key div {width}L"))
    totals = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("sid", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0).cast("long")).alias("base"))
    inside = Window.partitionBy("sid", "bucket").orderBy("key", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("size").over(inside)).join(totals, ["sid", "bucket"])
    return rows.select("sid", "row", "doc_id", "size", (F.col("base") + F.col("upto") - F.col("size")).alias("off"))


def block_draws(placed: DataFrame, plan: DataFrame, bounds: DataFrame) -> DataFrame:
    """One row per taken piece of a document: ``sid, off, row, doc_id, draw, epoch, shard, shuffle_key,
    from_word, n_words`` (``from_word`` counts from 0 in the document)."""
    p = placed.where("size > 0").join(plan.select("sid", "block", "n_blocks", "quota", "prime").join(bounds, "sid"), "sid")
    p = p.withColumn("b", F.explode(F.expr("sequence(off div block, (off + size - 1) div block)")))
    p = p.withColumn("rank", F.expr("(b * prime + sid) % n_blocks"))
    p = p.withColumn("draw", F.explode(F.expr("filter(array(rank, rank + n_blocks), j -> j < quota)")))
    shard = F.size(F.filter("bounds", lambda x: x <= F.col("draw"))) - 1
    return p.select(
        "sid", "off", "row", "doc_id", "draw", F.expr("draw div n_blocks").alias("epoch"), shard.alias("shard"), F.xxhash64(F.lit(SEED), "sid", "draw").alias("shuffle_key"),
        F.expr("greatest(off, b * block) - off").alias("from_word"), F.expr("least(off + size, (b + 1) * block) - greatest(off, b * block)").alias("n_words"),
    )


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, shards: int = SHARDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(plan per source, documents on their lines, draws)."""
    return mix_rows(numbered(docs), weights, share, shards)


def mix_rows(rows: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, shards: int = SHARDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``mix`` of ``numbered`` rows."""
    sizes = sized(rows)
    plan = store(source_plan(sizes, weights, share), "mix-plan")
    placed = store(on_line(sizes, plan), "mix-lines")
    return plan, placed, block_draws(placed, plan, shard_quotas(plan, shards))


def pieces(rows: DataFrame, draws: DataFrame) -> DataFrame:
    """``row, doc_id, shard, shuffle_key, sid, draw, off, text, n_words`` of each draw: the text cut out
    of its row (words joined by one space) and the words it has."""
    fields = ["shard", "shuffle_key", "sid", "draw", "off", "from_word", "n_words"]
    lists = draws.groupBy("row").agg(F.collect_list(F.struct(*fields)).alias("draws"))
    both = rows.where("size > 0").select("row", "doc_id", "text").join(lists, "row")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def cut(words: Column, d: Column) -> Column:
        part = F.slice(words, d["from_word"].cast("int") + 1, d["n_words"].cast("int"))
        return F.struct(*[d[f].alias(f) for f in fields[:5]], F.array_join(part, " ").alias("text"), F.size(part).cast("long").alias("n_words"))

    # an array of one, so that a text is split once however many draws it has
    cuts = F.transform(F.array(words), lambda w: F.transform("draws", lambda d: cut(w, d)))[0]
    return both.select("row", "doc_id", F.explode(cuts).alias("p")).select("row", "doc_id", "p.*")


def taken(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, shards: int = SHARDS) -> DataFrame:
    """Per document row: ``doc_id, size, source_size, target, taken`` (words of its pieces)."""
    rows = numbered(docs)
    plan, placed, draws = mix_rows(rows, weights, share, shards)
    got = pieces(rows, draws).groupBy("row").agg(F.sum("n_words").alias("words"))
    out = placed.join(got, "row", "left").join(plan.select("sid", "source_size", "target"), "sid")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0).cast("long")).alias("taken"))


def shard_texts(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, shards: int = SHARDS, cell_words: int = CELL_WORDS) -> DataFrame:
    """The mix itself: ``shard, cell, shuffle_key, draw, doc_id, text``. A shard is read cell by cell;
    a cell's blocks are in shuffled order, and the pieces of one block in line order."""
    rows = numbered(docs)
    plan, _, draws = mix_rows(rows, weights, share, shards)
    words = plan.agg(F.sum(F.col("quota") * F.col("block"))).first()[0] or 0
    cells = -(-words // (shards * cell_words)) or 1
    # shuffle keys are uniform over 64 bits, negative ones first
    cell = F.floor((F.col("shuffle_key").cast("double") / F.lit(2.0**64) + 0.5) * cells)
    out = pieces(rows, draws).withColumn("cell", F.least(cell, F.lit(cells - 1)).cast("long"))
    out = out.repartition(shards * cells, "shard", "cell").sortWithinPartitions("shard", "cell", "shuffle_key", "sid", "draw", "off")
    return out.select("shard", "cell", "shuffle_key", "draw", "doc_id", "text")
