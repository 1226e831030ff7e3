"""Distinct counts that are kept by batch: sketches of each group, united without the rows they came from.

A batch's ids are summed up to one HyperLogLog sketch a group, of 2^``size`` buckets. Sketches are small
and united in any order, so a store holds one a group, and a batch that comes twice changes nothing.
Up to EXACT_SHARE * 2^size distinct ids a group's sketch still holds them one by one and its estimate
is the count; beyond that the relative error has a standard deviation of about 0.83 / sqrt(2^size).

Where the count must be right at any size, a store keyed by group and id holds each id of a group once
(``add_ids``), and ``exact_counts`` counts them: its size follows the distinct ids, not a bound.

Defined results: null ids do not count; a null group is a group; a group with null ids only has 0;
an empty table has no groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.keyed_store import KeyedStore

SIZE = 14
EXACT_SHARE = 1 / 16


def sketches(df: DataFrame, by: list[str], ident: str, size: int = SIZE) -> DataFrame:
    """(*by, sketch, rows) of a batch."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.xxhash64(ident) if dict(df.dtypes)[ident] not in ("bigint", "int", "string", "binary") else F.col(ident), size).alias("sketch"), F.count("*").alias("rows"))


def united(parts: DataFrame, by: list[str]) -> DataFrame:
    """One sketch a group from many."""
    return parts.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("rows").alias("rows"))


def counts(parts: DataFrame, by: list[str], size: int = SIZE) -> DataFrame:
    """(*by, rows, n, exact): distinct ids of each group, and whether the count is still exact."""
    n = F.hll_sketch_estimate("sketch")
    return united(parts, by).select(*by, "rows", n.alias("n"), (n <= EXACT_SHARE * (1 << size)).alias("exact"))


def add_batch(store: KeyedStore, df: DataFrame, ident: str, writer: str | None = None, number: int | None = None, size: int = SIZE) -> None:
    """Unites a batch's sketches with those of a store whose keys are the groups."""
    by = store.keys
    merge = lambda old, new: united(new.unionByName(old.select(*new.columns)), by)
    store.modify(sketches(df, by, ident, size), merge, writer, number)


def add_ids(store: KeyedStore, df: DataFrame, writer: str | None = None, number: int | None = None) -> None:
    """Adds a batch's rows to a store whose keys are the groups and, last, the id: one row an id with its rows so far."""
    merge = lambda old, new: new.unionByName(old.select(*new.columns)).groupBy(*store.keys).agg(F.sum("rows").alias("rows"))
    store.modify(df.groupBy(*store.keys).agg(F.count("*").alias("rows")), merge, writer, number)


def exact_counts(ids: DataFrame, by: list[str], ident: str) -> DataFrame:
    """(*by, rows, n, exact) of the rows of such a store: distinct ids of each group, whatever their number."""
    return ids.groupBy(*by).agg(F.sum("rows").alias("rows"), F.count(ident).alias("n"), F.lit(True).alias("exact"))
