"""One query per numbered operator over the tables of a folder: each calls its operator with
production parameters on the whole table and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowguard.llm import embed_dedup

    return embed_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowguard.llm import decontam

    found = decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowguard.llm import mixing

    return mixing.taken(read(spark, sf_dir, "documents"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowguard.llm import html_extract

    return html_extract.main_texts(read(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowguard.llm import quality

    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowguard.llm import toxicity

    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowguard.llm import lm_score

    return lm_score.scored(read(spark, sf_dir, "documents"))


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per repeated passage: the document and span, and the earlier document's span."""
    from flowguard.llm import substring

    found = substring.passages(read(spark, sf_dir, "documents"))
    return found.select(
        F.col("doc").alias("doc_id"), "first_word", "n_words", F.col("source").alias("source_doc_id"), "source_first_word", "source_words", "equal_words",
        (F.col("equal_words") / F.greatest("n_words", "source_words")).alias("identity"),
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowguard.llm import chat

    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(chat.control_conversation(spark))
    return chat.digests(chat.formatted(chat.conversation_nodes(rows)))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowguard.llm import simhash

    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op11_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowguard.llm import linked_secrets

    found = linked_secrets.secret_spans(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["rank"] <= 3)
    told = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    number = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", number("assign"), number("access"), number("hex"), F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def damaged(rows: DataFrame) -> DataFrame:
    """The rows of op12's contract: what the crc32 of a row's conversation and turn does to it."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    kept = rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), how.alias("how")).where("how != 0")
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("how") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowguard.llm import turn_repair

    rows = read(spark, sf_dir, "conversations")
    found = turn_repair.reports(turn_repair.repaired(damaged(rows)))
    every = rows.select(F.col("conv_id").alias("id")).distinct()
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )


#: Words of a text as the contracts count them.
SPACE = r"[\x20\x09-\x0D]+"


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """The documents of op13's contract: a text whose id's crc32 is divisible by 10 ends in a word
    sequence repeated from word a on with period p, both from the crc32 and the number of words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    chosen = docs.select("doc_id", "text", g.alias("g"), (F.coalesce(h % 10 == 0, F.lit(False)) & F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("tail"))
    words = F.when(F.col("tail"), F.filter(F.split("text", SPACE), lambda w: w != ""))
    sized = chosen.withColumn("w", words).withColumn("n", F.size("w").cast("long")).withColumn("a", F.when(F.col("tail"), F.col("g") % F.col("n")))
    sized = sized.withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8)))
    rest = F.col("n") - F.col("a")
    period = F.slice("w", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    again = F.slice(F.flatten(F.array_repeat(period, F.ceil(rest / F.col("p")).cast("int"))), F.lit(1), rest.cast("int"))
    changed = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), again), " ")
    return sized.select("doc_id", F.when(F.col("tail"), changed).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flowguard.llm import periodic_runs

    found = periodic_runs.periodic_runs(with_periodic_tails(read(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.n") / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_mixing": op3_mixing,
    "op4_html": op4_html,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_lm_score": op7_lm_score,
    "op8_substring": op8_substring,
    "op9_chat": op9_chat,
    "op10_simhash": op10_simhash,
    "op11_linked_secrets": op11_linked_secrets,
    "op12_turn_repair": op12_turn_repair,
    "op13_periodic_runs": op13_periodic_runs,
}
