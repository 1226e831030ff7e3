"""Crawl planning: frontiers by joins, date windows under a portal's row cap."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def frontier(links: DataFrame, start: DataFrame, depth: int) -> DataFrame:
    """(node, depth) of what is reachable over (a, b) links within ``depth`` steps.

    Each step joins the last frontier with the links and leaves out what was seen; lineage is cut by
    a checkpoint each step where the session has a checkpoint folder.
    """
    spark = links.sparkSession
    cut = spark.sparkContext._jsc.sc().getCheckpointDir().isDefined()
    seen = start.select("node", F.lit(0).alias("depth")).dropDuplicates(["node"])
    last = seen
    for step in range(1, depth + 1):
        found = last.join(links, F.col("node") == F.col("a")).select(F.col("b").alias("node"), F.lit(step).alias("depth")).dropDuplicates(["node"])
        last = found.join(seen, "node", "left_anti")
        last = last.checkpoint() if cut else last
        if cut and last.isEmpty():
            break
        seen = seen.unionByName(last)
    return seen


def bisect(first: date, last: date, count, most: int = 100) -> list[tuple[date, date, int]]:
    """Date windows of at most ``most`` rows: halves a window while it holds more; a single day stays.

    ``count(first, last)`` asks the portal. Windows without rows are left out.
    """
    todo, out = [(first, last)], []
    while todo:
        a, b = todo.pop()
        n = count(a, b)
        if n > most and a < b:
            middle = a + timedelta(days=(b - a).days // 2)
            todo += [(middle + timedelta(days=1), b), (a, middle)]
        elif n:
            out.append((a, b, n))
    return sorted(out)


DEPTH = 24  # halvings of a span of days; 2^24 days are 45,000 years


def _halved(day: Column, first: Column, last: Column) -> Column:
    """Windows (desde, hasta), in days, that halving the whole span puts a day into, the whole first, down to the day."""
    whole = F.struct(first.alias("a"), last.alias("b"))

    def step(path: Column, _: Column) -> Column:
        w = F.element_at(path, -1)
        middle = w["a"] + F.floor((w["b"] - w["a"]) / 2).cast("int")
        half = F.when(day <= middle, F.struct(w["a"].alias("a"), middle.alias("b"))).otherwise(F.struct((middle + 1).alias("a"), w["b"].alias("b")))
        return F.when(w["a"] < w["b"], F.array_append(path, half)).otherwise(path)

    return F.aggregate(F.sequence(F.lit(1), F.lit(DEPTH)), F.array(whole), step)


def bisected(rows: DataFrame, day: str, most: int, axes: list[str] = (), count: Column | None = None) -> DataFrame:
    """(desde, hasta, *axes, n, lost): the windows by which a portal that lists ``most`` rows a search gives all rows.

    A window of more rows is halved down to a day; a day of more rows is split by the first axis, what is
    still more by the next one; where no axis is left, ``lost`` counts the rows beyond ``most``. An axis
    is null where it was not needed (and for rows without a value). All windows of the tree are counted
    at once, by grouping each day's rows under all windows that it can be in, and those taken whose
    parent is too large. Rows without a day are left out. With ``count`` a row stands for so many.
    """
    axes = list(axes)
    counted = rows.where(F.col(day).isNotNull()).groupBy(F.unix_date(F.col(day).cast("date")).alias("_d"), *axes).agg(F.sum(F.lit(1) if count is None else count).cast("long").alias("n")).where("n > 0")
    days = counted.groupBy("_d").agg(F.sum("n").alias("n"))
    ends = days.agg(F.min("_d").alias("_first"), F.max("_d").alias("_last"))
    path = days.join(F.broadcast(ends)).select("n", F.explode(F.transform(_halved(F.col("_d"), F.col("_first"), F.col("_last")), lambda w, i: F.struct(w["a"].alias("a"), w["b"].alias("b"), i.alias("depth")))).alias("w"))  # one row of ends
    tree = path.groupBy("w.a", "w.b", "w.depth").agg(F.sum("n").alias("n"))
    # a window's parent is one of the two that could have been halved to it: the large ones say what they were halved to
    middle = F.col("a") + F.floor((F.col("b") - F.col("a")) / 2).cast("int")
    halves = tree.where((F.col("n") > most) & (F.col("a") < F.col("b"))).select(F.explode(F.array(F.struct(F.col("a").alias("a"), middle.alias("b"), (F.col("depth") + 1).alias("depth")), F.struct((middle + 1).alias("a"), F.col("b").alias("b"), (F.col("depth") + 1).alias("depth")))).alias("h")).select("h.*")
    reached = tree.where("depth = 0").unionByName(tree.join(halves, ["a", "b", "depth"], "left_semi"))
    whole = reached.where((F.col("n") <= most) | (F.col("a") == F.col("b")))
    dated = lambda c: F.date_from_unix_date(F.col(c))
    none = [F.lit(None).cast(rows.schema[x].dataType).alias(x) for x in axes]
    lost = F.greatest(F.col("n") - most, F.lit(0)).cast("long").alias("lost")
    fine = whole if not axes else whole.where(F.col("n") <= most)
    out = fine.select(dated("a").alias("desde"), dated("b").alias("hasta"), *none, "n", lost)
    dense = counted.join(days.where(F.col("n") > most).select("_d"), "_d", "left_semi")
    for k, axis in enumerate(axes):
        split = axes[: k + 1]
        parts = dense.groupBy("_d", *split).agg(F.sum("n").alias("n"))
        last = k + 1 == len(axes)
        taken = parts if last else parts.where(F.col("n") <= most)
        out = out.unionByName(taken.select(dated("_d").alias("desde"), dated("_d").alias("hasta"), *[F.col(x) if x in split else none[axes.index(x)] for x in axes], "n", lost))
        if not last:
            large = parts.where(F.col("n") > most).select(F.col("_d").alias("_l"), *[F.col(x).alias(f"_{x}") for x in split])
            same = [dense["_d"] == large["_l"], *[dense[x].eqNullSafe(large[f"_{x}"]) for x in split]]
            dense = dense.join(large, same, "left_semi")
    return out


def bisected_days(daily: DataFrame, most: int) -> DataFrame:
    """(desde, hasta, n, denso): windows over a table of day counts (day, n); ``denso`` days hold more than ``most``."""
    return bisected(daily, "day", most, count=F.col("n")).select("desde", "hasta", "n", (F.col("lost") > 0).alias("denso"))
