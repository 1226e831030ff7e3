"""Stored captures and parsed documents as Parquet: append, newest wins, skip what is known.

Captures are append-only, partitioned by source; the current one of a document is the newest.
Parsed documents overwrite the partitions they touch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import keep_first
from ..schemas import CAPTURE_METADATA

KEY = ["source", "tipo", "suin_id"]


def hashed(captures: DataFrame) -> DataFrame:
    """Captures (source, tipo, suin_id, content, capture_ts, ...) with the hash and length of their bytes."""
    content = F.col("content").cast("binary")
    return captures.withColumn("content_hash", F.sha2(content, 256)).withColumn("content_length", F.length(content).cast("long"))


def new_captures(captures: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Captures whose content differs from the stored newest of their document."""
    fresh = hashed(captures)
    if stored is None:
        return fresh
    return fresh.join(current(stored).select(*KEY, "content_hash"), [*KEY, "content_hash"], "left_anti")


def append_captures(captures: DataFrame, path: str) -> None:
    captures.write.mode("append").partitionBy("source").parquet(path)


def current(stored: DataFrame) -> DataFrame:
    """Newest capture of each document."""
    return keep_first(stored, KEY, [F.desc("capture_ts"), F.col("content_hash")])


def raw_path() -> Column:
    """Relative path of a capture: source/type/id/file."""
    return F.concat_ws("/", "source", "tipo", "suin_id", "raw_filename")


def read_metadata(spark: SparkSession, paths: str) -> DataFrame:
    """Metadata documents with an explicit schema and the key their path names."""
    rows = spark.read.schema(CAPTURE_METADATA).json(paths, multiLine=True).withColumn("_p", F.input_file_name())
    return rows.withColumn("tipo", F.url_decode(F.regexp_extract("_p", r"/([^/]+)/[^/]+/[^/]+$", 1))).drop("_p")


def write_parsed(parsed: DataFrame, path: str) -> None:
    """Overwrites the (source, tipo) partitions that ``parsed`` holds, no others."""
    parsed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "tipo").parquet(path)


def by_source_priority(parsed: DataFrame, wanted: DataFrame, order: tuple[str, ...] = ("suin", "corte_constitucional", "csj", "consejo_estado")) -> DataFrame:
    """Parsed document of each wanted (tipo, suin_id, source): of its own source, else of the first in ``order``."""
    own = wanted.select("tipo", "suin_id", F.col("source").alias("_own"))
    place = F.array_position(F.array(*map(F.lit, order)), F.col("source"))
    rank = F.when(F.col("source") == F.col("_own"), 0).when(place > 0, place).otherwise(1_000)
    return keep_first(parsed.join(own, ["tipo", "suin_id"]), ["tipo", "suin_id"], [rank, F.col("source")]).drop("_own")


def cited_rulings(parsed: DataFrame) -> DataFrame:
    """Rulings named in affectations of parsed norms: (prefijo, numero, anio), each once."""
    both = parsed.select(F.explode(F.concat("modifications", "jurisprudence")).alias("a"))
    code = r"(?iu)\b(C|T|SU|A)-?(\d+)\s*(?:de|/)\s*(\d{4})"
    parts = [F.regexp_extract_all("a.source_text", F.lit(code), k).alias(n) for k, n in ((1, "prefijo"), (2, "numero"), (3, "anio"))]
    rows = both.select(F.explode(F.arrays_zip(*parts)).alias("x"))
    return rows.select(F.upper("x.prefijo").alias("prefijo"), "x.numero", "x.anio").distinct()
