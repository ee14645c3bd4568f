"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut


def split_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key`` so that adaptive execution may split a hot key of ``left``.

    A side that was just aggregated by the key would be joined where it lies,
    in one task per key. The extra hash column makes both sides be dealt anew.
    """
    tag = lambda df: df.withColumn("_tag", F.xxhash64(key))
    return tag(left).join(tag(right), ["_tag", key], how).drop("_tag")


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step; ``edges`` holds a > b once each."""
    if larger:  # every larger neighbour of u points at the least of u and its neighbours
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = split_join(both.where("v > u"), least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:  # u and its smaller neighbours point at the least of them
        down = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        out = split_join(down, least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of any orderable type -> (node, root): the least node that each linked node reaches.

    Nodes without an edge don't appear; self links and repeated edges count
    for nothing; an edge with a null end is no edge. Every round is written to
    the shared folder, so a lost executor costs a part of one round at most.
    """
    cur = cut(edges.where("a is not null and b is not null and a <> b")
              .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    sign = lambda df: tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
    seen = sign(cur)
    while seen[0]:
        cur = cut(_stars(_stars(cur, True), False))
        now = sign(cur)
        if now == seen:
            break
        seen = now
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
