"""Cross-store quality checks: rows of (check, status, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Warn and fail thresholds.
DRIFT, MISSING, ERRORS = (0.02, 0.10), (0.0, 0.05), (0.05, 0.20)
SAMPLE = 300


def graded(rate: Column, warn: float, fail: float) -> Column:
    return F.when(rate >= fail, "FAIL").when(rate >= warn, "WARN").otherwise("PASS")


def drift(a: Column, b: Column) -> Column:
    return F.abs(a - b) / F.greatest(a, b, F.lit(1))


def reconciliation(done: DataFrame, store: DataFrame, key: str, name: str = "reconciliation") -> DataFrame:
    """Documents done against distinct documents stored."""
    both = done.agg(F.countDistinct(key).alias("done")).join(F.broadcast(store.agg(F.countDistinct(key).alias("stored"))))
    rate = drift(F.col("done"), F.col("stored"))
    status = F.when(F.col("done") == 0, "INFO").when(F.col("stored") == 0, "FAIL").otherwise(graded(rate, *DRIFT))
    return both.select(F.lit(name).alias("check"), status.alias("status"), F.round(rate, 6).alias("rate"), F.col("done").cast("long").alias("n"), F.col("stored").cast("long").alias("other"))


def completeness(done: DataFrame, store: DataFrame, key: str, order: Column, sample: int = SAMPLE, name: str = "completeness") -> DataFrame:
    """Share of a fixed sample of done documents that the store lacks; null keys count in n alone."""
    drawn = done.orderBy(order, key).limit(sample)
    missing = drawn.where(F.col(key).isNotNull()).join(store.select(key).distinct(), key, "left_anti").agg(F.count("*").alias("other"))
    both = drawn.agg(F.count("*").alias("n")).join(F.broadcast(missing))
    rate = F.col("other") / F.greatest("n", F.lit(1))
    status = F.when(F.col("n") == 0, "INFO").when(rate >= MISSING[1], "FAIL").when(F.col("other") > 0, "WARN").otherwise("PASS")
    return both.select(F.lit(name).alias("check"), status.alias("status"), F.round(rate, 6).alias("rate"), "n", "other")


def error_budget(catalog: DataFrame, status: str = "scrape_status", name: str = "error_budget") -> DataFrame:
    bad = catalog.agg(F.count("*").alias("n"), F.count_if(F.col(status).isin("error", "needs_ocr")).alias("other"))
    rate = F.col("other") / F.greatest("n", F.lit(1))
    return bad.select(F.lit(name).alias("check"), graded(rate, *ERRORS).alias("status"), F.round(rate, 6).alias("rate"), "n", "other")


def retrieval(results: DataFrame, queries: DataFrame, query: str, name: str = "retrieval") -> DataFrame:
    """Queries without any hit."""
    empty = queries.join(results.select(query).distinct(), query, "left_anti").agg(F.count("*").alias("other"))
    both = queries.agg(F.count("*").alias("n")).join(F.broadcast(empty))
    status = F.when(F.col("n") == 0, "INFO").when(F.col("other") > 0, "WARN").otherwise("PASS")
    return both.select(F.lit(name).alias("check"), status.alias("status"), F.round(F.col("other") / F.greatest("n", F.lit(1)), 6).alias("rate"), "n", "other")


def all_checks(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def verdict(checks: DataFrame) -> DataFrame:
    """The worst status: FAIL, WARN, INFO only without any PASS, else PASS."""
    found = F.collect_set("status")
    worst = F.when(F.array_contains(found, "FAIL"), "FAIL").when(F.array_contains(found, "WARN"), "WARN").when(F.array_contains(found, "INFO") & ~F.array_contains(found, "PASS"), "INFO").otherwise("PASS")
    return checks.agg(worst.alias("verdict"))
