"""Connected components over an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import dropped, staged


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id on an edge: component is the smallest id reachable.

    ``edges`` has a and b (longs, any order; loops and repeats allowed). Rows stay linear in the
    edges; each round is written to the shared folder. A hub's row count is one side of a join
    whose other side has one row a key, so it can be split.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    before = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = staged(large, "cc")
        dropped(now)  # nothing reads a round's table once the next one is written
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        joined = large.join(least, F.col("a") == F.col("u"))
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
        now = staged(small, "cc")
        dropped(large)
        after = _state(now)
        if after == before:
            break
        before = after
    roots = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    return roots.unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
