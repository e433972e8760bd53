"""Connected components over an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.llm.shared import counted_broadcasts, cut, planned_once


#: Parts into which a node's edges are dealt, so that a hub's do not meet in one task.
PARTS = 8


def _minimum(edges: DataFrame) -> DataFrame:
    """Each row (u, v) with the least of u and u's neighbours; minima are aggregated apart and joined to every part of u's rows."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    dealt = edges.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(PARTS)).cast("int"))
    return dealt.join(least.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))), ["u", "part"]).drop("part")


def _state(edges: DataFrame):
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in ``edges(u, v)``; loops and repeated edges may occur.

    Every round is written to the shared folder. Ids without a neighbour are not returned. Empty in, empty out.
    """
    own = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = cut(own, "cc")
    before = _state(now)
    if not before[0]:
        return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    # minima are dealt to every part of a node's rows: as many rows as edges, which no driver should hold
    with planned_once(edges.sparkSession, 2 * before[0]), counted_broadcasts(edges.sparkSession):
        return _rounds(now, before, max_rounds)


def _rounds(now: DataFrame, before, max_rounds: int) -> DataFrame:
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        near = _minimum(large)
        small = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", F.col("m").alias("v")))
        now = cut(small.where("u <> v").distinct(), "cc")
        after = _state(now)
        if after == before:
            roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
        before = after
    raise RuntimeError("components did not settle")
