"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, stage


def _state(df: DataFrame) -> tuple:
    r = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return r["n"], r["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come as u > v."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component): each node of ``edges`` and the smallest node it reaches.

    ``edges`` has two columns of one orderable type (other columns are not
    looked at); direction, repeats and self-links do not matter, links with a
    null end are left out. Every round is one large-star and one small-star,
    written to the shared folder (the one before is deleted); it ends when a round changes nothing. Nodes
    without a link do not appear. No links: an empty result.
    """
    a, b = edges.columns[:2]
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"),
                     (F.col(a).isNotNull() & F.col(b).isNotNull()).alias("_ok"))
    e = stage(e.where("_ok and u <> v").select("u", "v").distinct(), "cc")
    state = _state(e)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        old, e = e, stage(_small_star(_large_star(e)), "cc")
        discard(old)
        new = _state(e)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
