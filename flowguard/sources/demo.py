"""Demo flow table (S8): 65% benign, 35% attack, generated by Spark from ``spark.range``.

Normal columns come from ``randn``, Bernoulli flags from ``rand``, Poisson counts by inverse
CDF (a fold over 0..K with K far in the tail). Lower clips use ``greatest``. Generation is
seeded and partition-parallel; no data passes through the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Demo column distributions (mean, sd, lower clip) for benign / attack rows.
NORMAL_COLUMNS = (
    ("Flow Duration", (85000, 12000, 1000), (26000, 9000, 500)),
    ("Fwd Packet Length Mean", (420, 70, 40), (960, 170, 80)),
    ("Bwd Packet Length Mean", (390, 65, 40), (120, 50, 20)),
    ("Flow Bytes/s", (18000, 3000, 1000), (62000, 12000, 3000)),
    ("Flow Packets/s", (28, 6, 1), (110, 24, 5)),
    ("Down/Up Ratio", (1.1, 0.2, 0.1), (0.35, 0.12, 0.02)),
)
POISSON_COLUMNS = (("Total Fwd Packets", 8, 28), ("Total Backward Packets", 7, 2))
BERNOULLI_COLUMNS = (("SYN Flag Count", 0.08, 0.76), ("ACK Flag Count", 0.92, 0.35))
COLUMN_ORDER = (
    "Flow Duration", "Total Fwd Packets", "Total Backward Packets", "Fwd Packet Length Mean",
    "Bwd Packet Length Mean", "Flow Bytes/s", "Flow Packets/s", "SYN Flag Count", "ACK Flag Count",
    "Down/Up Ratio", "Label",
)
BENIGN_SHARE = 0.65


def poisson(lam: Column | float, u: Column, k_max: int) -> Column:
    """Inverse-CDF Poisson draw for uniform ``u`` (fold over k = 0..k_max)."""
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    init = F.struct(F.lit(0).alias("k"), F.exp(-lam).alias("p"), F.exp(-lam).alias("c"), F.lit(-1).alias("x"))

    def step(acc, k):
        x = F.when((acc["x"] < 0) & (u <= acc["c"]), k).otherwise(acc["x"])
        p_next = acc["p"] * lam / (k + 1)
        return F.struct((k + 1).alias("k"), p_next.alias("p"), (acc["c"] + p_next).alias("c"), x.alias("x"))

    res = F.aggregate(F.sequence(F.lit(0), F.lit(k_max)), init, step)
    return F.when(res["x"] < 0, F.lit(k_max)).otherwise(res["x"])


def build_demo_flows(spark: SparkSession, n_samples: int = 2400, seed: int = 42) -> DataFrame:
    """The demo table with the reference tool's column set and class shapes."""
    n_normal = int(n_samples * BENIGN_SHARE)
    base = spark.range(n_samples).withColumn("__attack", F.col("id") >= n_normal)
    att = F.col("__attack")
    cols: dict[str, Column] = {}
    for i, (name, (m0, s0, c0), (m1, s1, c1)) in enumerate(NORMAL_COLUMNS):
        z = F.randn(seed * 101 + i)
        v = F.when(att, F.greatest(z * s1 + m1, F.lit(float(c1)))).otherwise(F.greatest(z * s0 + m0, F.lit(float(c0))))
        cols[name] = v.cast("double")
    for j, (name, l0, l1) in enumerate(POISSON_COLUMNS):
        u = F.rand(seed * 211 + j)
        k_max = int(math.ceil(max(l0, l1) + 12 * math.sqrt(max(l0, l1)) + 20))
        lam = F.when(att, F.lit(float(l1))).otherwise(F.lit(float(l0)))
        cols[name] = (poisson(lam, u, k_max) + 1).cast("long")
    for j, (name, p0, p1) in enumerate(BERNOULLI_COLUMNS):
        u = F.rand(seed * 307 + j)
        cols[name] = F.when(u < F.when(att, F.lit(p1)).otherwise(F.lit(p0)), 1).otherwise(0).cast("long")
    cols["Label"] = F.when(att, F.lit("Attack")).otherwise(F.lit("BENIGN"))
    return base.withColumns(cols).select(*COLUMN_ORDER)
