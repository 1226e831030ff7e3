"""Running counts of misses and early stops over long ordered sequences, without a task that gets a whole sequence.

Rows are dealt to parts by ranges of key and order, so a sequence of any length spans many parts. Each part
counts its own runs and is summed up as (rows, hits, misses at its end). These summaries, one a part and
key, are combined in order: what a part ends with is its own tail if it has a hit, else its length on top
of what the part before it ends with. That carry is added to the rows before a part's first hit.

Defined results: a null hit is a miss; null keys are a key; rows that are equal in key and order are ordered
by their hash; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.folders import stored

PART_ROWS = 1_000_000
BROADCAST_ROWS = 100_000


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_{k}"]) for k in keys], F.lit(True))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def miss_runs(df: DataFrame, keys: list[str], order: list[str], hit: Column, part_rows: int = PART_ROWS) -> DataFrame:
    """``df`` with ``run``: how many misses in a row end at each row of its key's sequence; 0 at a hit."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // part_rows))
    marked = df.withColumn("_hit", F.coalesce(hit, F.lit(False))).withColumn("_tie", F.xxhash64(*columns))
    ranged = marked.repartitionByRange(parts, *keys, *order, "_tie").withColumn("_part", F.spark_partition_id())
    ranged = stored(ranged, "ranged")  # written once: parts stay as they are
    at = [*order, "_tie"]
    island = F.sum(F.col("_hit").cast("int")).over(Window.partitionBy("_part", *keys).orderBy(*at).rowsBetween(Window.unboundedPreceding, 0))
    place = F.row_number().over(Window.partitionBy("_part", *keys, "_island").orderBy(*at))
    own = ranged.withColumn("_island", island).withColumn("_run", F.when(F.col("_hit"), 0).otherwise(place - F.when(F.col("_island") > 0, 1).otherwise(0)))
    ends = own.groupBy("_part", *keys).agg(F.count("*").alias("_n"), F.max("_island").alias("_hits"), F.max_by("_run", F.struct(*at)).alias("_tail"))
    before = Window.partitionBy(*keys).orderBy("_part")  # a row a part and key
    ends = ends.withColumn("_s", F.sum((F.col("_hits") > 0).cast("int")).over(before)).withColumn("_c", F.when(F.col("_hits") > 0, F.col("_tail")).otherwise(F.col("_n")))
    ends = ends.withColumn("_total", F.sum("_c").over(Window.partitionBy(*keys, "_s").orderBy("_part")))
    carry = ends.withColumn("_carry", F.lag("_total").over(before)).where("_carry > 0").select("_part", *[F.col(k).alias(f"_{k}") for k in keys], "_carry")
    carry = _small(stored(carry.withColumnRenamed("_part", "_p"), "carries"))
    out = own.join(carry, (own["_part"] == carry["_p"]) & (own["_island"] == 0) & _same(own, carry, keys), "left")
    run = F.col("_run") + F.when(F.col("_hit"), 0).otherwise(F.coalesce("_carry", F.lit(0)))
    return out.select(*columns, run.cast("long").alias("run"))


def until_misses(df: DataFrame, keys: list[str], order: list[str], hit: Column, most: int, part_rows: int = PART_ROWS) -> DataFrame:
    """``df`` with ``run`` and ``kept``: false after the row at which a key's sequence first has ``most`` misses in a row."""
    runs = stored(miss_runs(df, keys, order, hit, part_rows), "runs")
    stops = runs.where(F.col("run") == most).groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(F.struct(*order)).alias("_stop"))
    stops = _small(stored(stops, "stops"))
    out = runs.join(stops, _same(runs, stops, keys), "left")
    return out.withColumn("kept", F.coalesce(F.struct(*order) <= F.col("_stop"), F.lit(True))).select(*(F.col(f"`{c}`") for c in runs.columns), "kept")
