"""The incremental cycle: new captures in, current tables out, with Structured Streaming.

A file source with ``availableNow`` takes what has arrived since the last run; ``foreachBatch``
commits it to a store that is merged by key. The store remembers the last batch of a stream, so a
batch that is run again changes nothing, and what it writes follows the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.catalog import keep_first, requeue_errors
from ..sources.keyed_store import KeyedStore


def current_captures(log: DataFrame, keys: list[str], newest: str = "capture_ts") -> DataFrame:
    """Newest capture of each key."""
    return keep_first(log, keys, [F.desc_nulls_last(newest), F.xxhash64(*log.columns)])


def merge_batch(store: KeyedStore, writer: str):
    """foreachBatch function: commits each batch of the stream ``writer`` once."""

    def merge(batch: DataFrame, epoch: int) -> None:
        store.upsert(batch, writer, epoch)

    return merge


def latest_version(spark: SparkSession, target: str, version: int | None = None) -> DataFrame | None:
    """The table at ``target``, or an earlier version of it; None before its first commit."""
    store = KeyedStore.open(spark, target)
    return None if store is None else store.read(version)


def ingest_new(spark: SparkSession, incoming: str, schema: str, target: str, checkpoint: str, keys: list[str], newest: str = "capture_ts", buckets: int = 64) -> StreamingQuery:
    """One run over the Parquet files that are new in ``incoming``; returns when they are merged."""
    store = KeyedStore(spark, target, keys, newest, buckets)
    stream = spark.readStream.schema(schema).parquet(incoming)
    query = stream.writeStream.foreachBatch(merge_batch(store, checkpoint)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def next_cycle(catalog: DataFrame, results: DataFrame, max_attempts: int = 3) -> DataFrame:
    """Catalog for the next run: captured statuses applied, errors under the cap waiting again."""
    from ..operators.catalog import update_scrape

    return requeue_errors(update_scrape(catalog, results), max_attempts).drop("requeued")


def event_windows(events: DataFrame, size: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts per tumbling window and type with a watermark; works on streams and tables."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    return marked.groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
