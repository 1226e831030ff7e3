"""Shared storage for operators that write files or cut lineage.

Everything goes below the folder named in ``spark.checkpoint.dir``, which driver and executors
share. Only where that setting is absent (local tests) a folder of our own is made.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, label: str) -> str:
    """URI of a fresh folder name below the cluster's shared folder (not created yet).

    Without ``spark.checkpoint.dir`` a folder of this machine is made, for a local master only.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not (spark.sparkContext.master or "").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lexmill-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{qualified(spark, base).rstrip('/')}/lexmill/{label}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, base: str) -> str:
    """URI of a folder: without a scheme it is one of the cluster's default store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    uri = str(path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString())
    return "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and not uri.startswith("file://") else uri


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: lineage ends there."""
    return staged_twice(df, label)[0]


def staged_twice(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """As ``staged``, as two relations, so that one can be joined with what comes of the other."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    read = df.sparkSession.read.schema(df.schema)
    out = read.parquet(path), read.parquet(path)
    for x in out:
        x._staged_at = path
    return out


def dropped(df: DataFrame) -> None:
    """Deletes a staged table that nothing reads any more."""
    fs, path = open_store(df._staged_at)
    fs.delete_dir(path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files that nothing refers to: its cleaner follows the driver's collector."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        name = f"_{name}"
        while name in taken:
            name = f"_{name}"
        taken.add(name)
        out.append(name)
    return out


def open_store(uri: str):
    """(pyarrow filesystem, path) of a URI in the shared store; runs on executors."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def bloom(ids: DataFrame, bits: int):
    """Bloom filter (two probes, ``bits`` a power of two) of the one long column of ``ids``.

    Built by Spark; at most bits / 32 words reach the driver, however many ids there are.
    """
    import numpy as np
    from pyspark.sql import functions as F

    key = F.col(ids.columns[0])
    spot = F.explode(F.array(F.xxhash64(key), F.xxhash64(key, F.lit(1)))).alias("h")
    spots = ids.select(spot).select(F.col("h").bitwiseAND(F.lit(bits - 1)).alias("s"))
    words = spots.groupBy(F.shiftright("s", 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 31 AS int))")).alias("b")).toPandas()
    out = np.zeros(bits // 32, dtype=np.uint32)
    out[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).astype(np.uint32)
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Operator to the function that empties what it remembers in a Python worker.
MEMORIES: dict[str, object] = {}


_serves: str | None = None


def only(name: str) -> None:
    """Called by an operator's tasks: a worker that served other operators forgets what they held.

    What was freed is handed back to the system, where the C library can.
    """
    global _serves
    if _serves == name:
        return
    for other, forget in MEMORIES.items():
        if other != name:
            forget()
    if _serves is not None:
        import ctypes
        import gc

        import pyarrow as pa

        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)
    _serves = name


class Remembered:
    """A dictionary of at most ``most`` entries in two generations: what is asked for again stays."""

    def __init__(self, most: int):
        self.half, self.young, self.old = most // 2, {}, {}

    def missing(self, keys: set) -> list:
        """Keys of which nothing is known; afterwards ``young`` has the others."""
        new = keys.difference(self.young)
        again = new.intersection(self.old)
        if len(self.young) + len(new) > self.half:
            self.old, kept = self.young, self.old
            self.young = {k: self.old[k] for k in keys.intersection(self.old)}
            self.young.update((k, kept[k]) for k in again)
        else:
            self.young.update((k, self.old[k]) for k in again)
        return list(new.difference(again))
