"""A table on shared storage that is merged by key: bucketed base files, delta files, merge on read.

Rows belong to one of a fixed number of buckets by the hash of their key. A commit writes its rows as
Parquet below ``data/_commit=<token>/_bucket=<n>`` and then one manifest, ``manifest/<version>.json``,
that names for every bucket the commit of its base files and the commits of its deltas, oldest first.
A manifest is written under another name and renamed, which fails where that version exists (on stores
whose rename does so), so one of two writers wins and the other takes the next version; files without a
manifest (torn batches) are never read. Writers that number their batches (streams) are remembered with
their last number: a batch that comes again changes nothing.

Reading takes buckets without deltas as they are, without a shuffle; in the others the winner of each key
is chosen: by ``newest`` (nulls last), then the later commit, then the row's hash. A row marked as
deleted wins like others and is left out. Bytes written follow the batch; ``compact`` rewrites only
buckets that have deltas; ``vacuum`` deletes files of versions that are no longer wanted.

Defined results: rows with a null key part are rows of that key; of equal keys in a batch the newest
counts; columns that a batch lacks are null in its rows, columns that the store lacks are added; an empty
batch commits nothing; a store without commits reads as None.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

COMMIT, BUCKET, DELETED = "_commit", "_bucket", "_deleted"
RETRIES = 20


class Conflict(RuntimeError):
    """Another writer committed that version."""


@dataclass(frozen=True)
class Manifest:
    """One version: where each bucket's base is, which commits came after it, and what each writer has done."""

    version: int = 0
    table: dict = field(default_factory=dict)  # keys, newest, buckets
    schema: dict | None = None
    base: dict[int, str] = field(default_factory=dict)
    deltas: dict[int, list[str]] = field(default_factory=dict)
    ages: dict[str, int] = field(default_factory=dict)  # delta: the version that it came with
    writers: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def of_json(cls, text: str) -> Manifest:
        d = json.loads(text)
        return cls(**d | {n: {int(k): v for k, v in d[n].items()} for n in ("base", "deltas")})

    def commits(self) -> set[str]:
        return set(self.base.values()).union(*self.deltas.values())


class Files:
    """The few file operations of a store, on whatever file system its path names."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        where = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(where)) if self.fs.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Writes a file that must not exist yet: by a rename, which readers see whole or not at all."""
        part = self.path(f"{name}.{uuid.uuid4().hex}.part")
        stream = self.fs.create(part, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.fs.exists(self.path(name)) or not self.fs.rename(part, self.path(name)):
            self.fs.delete(part, False)
            raise Conflict(name)

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def size(self, name: str) -> int:
        return self.fs.getContentSummary(self.path(name)).getLength()


class KeyedStore:
    """Rows by key below ``path``; ``newest`` names the column by which later rows win."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], newest: str | None = None, buckets: int = 64):
        self.spark, self.keys, self.newest, self.buckets = spark, list(keys), newest, buckets
        self.files = Files(spark, path)
        self.table = {"keys": self.keys, "newest": newest, "buckets": buckets}
        known = self.manifest().table
        if known and known != self.table:
            raise ValueError(f"the store at {path} has {known}")

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> KeyedStore | None:
        """The store at ``path`` as it was made; None without one."""
        files = Files(spark, path)
        names = [n for n in files.names("manifest") if re.fullmatch(r"\d{12}\.json", n)]
        return cls(spark, path, **Manifest.of_json(files.read(f"manifest/{names[-1]}")).table) if names else None

    # --- versions -----------------------------------------------------------------------------------
    def versions(self) -> list[int]:
        return [int(m.group(1)) for m in (re.fullmatch(r"(\d{12})\.json", n) for n in self.files.names("manifest")) if m]

    def manifest(self, version: int | None = None) -> Manifest:
        known = self.versions()
        version = version if version is not None else (known[-1] if known else 0)
        return Manifest.of_json(self.files.read(f"manifest/{version:012d}.json")) if version else Manifest()

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _commit(self, change: Callable[[Manifest], Manifest | None]) -> Manifest:
        """Writes the manifest that follows the newest one; ``change`` runs again if another writer was first."""
        for _ in range(RETRIES):
            now = self.manifest()
            new = change(now)
            if new is None:
                return now
            try:
                self.files.create(f"manifest/{new.version:012d}.json", new.to_json())
            except Conflict:
                continue
            return new
        raise Conflict(f"no commit in {RETRIES} tries")

    # --- writing ------------------------------------------------------------------------------------
    def _order(self, *last: Column) -> list[Column]:
        return [*([F.desc_nulls_last(self.newest)] if self.newest else []), *last]

    def _write(self, rows: DataFrame, spread: int = 1) -> tuple[str, list[int]]:
        """Files of a commit: (its name, buckets). One task writes a bucket, or ``spread`` tasks."""
        name = f"{uuid.uuid4().hex}"
        deal = [BUCKET] if spread == 1 else [BUCKET, F.pmod(F.xxhash64(*self.keys, F.lit(1)), F.lit(spread))]
        out = rows.withColumn(BUCKET, self.bucket_of()).repartition(*deal)
        out.write.partitionBy(BUCKET).parquet(str(self.files.path(f"data/{COMMIT}={name}").toString()))
        found = [int(n.split("=")[1]) for n in self.files.names(f"data/{COMMIT}={name}") if n.startswith(f"{BUCKET}=")]
        return name, found

    def upsert(self, batch: DataFrame, writer: str | None = None, number: int | None = None) -> Manifest:
        """Commits a batch: its newest row of each key as a delta. ``writer`` and ``number`` make it harmless to repeat."""
        if writer is not None and self.manifest().writers.get(writer, -1) >= number:
            return self.manifest()
        if DELETED not in batch.columns:
            batch = batch.withColumn(DELETED, F.lit(False))
        columns = [F.col(f"`{c}`") for c in batch.columns]
        rank = F.row_number().over(Window.partitionBy(*self.keys).orderBy(*self._order(F.xxhash64(*columns))))
        rows = batch.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
        name, touched = self._write(rows)

        def change(now: Manifest) -> Manifest | None:
            if writer is not None and now.writers.get(writer, -1) >= number:
                self.files.delete(f"data/{COMMIT}={name}")
                return None
            if not touched and writer is None:
                return None
            deltas = {b: [*now.deltas.get(b, []), name] if b in touched else d for b, d in ({b: [] for b in touched} | now.deltas).items()}
            writers = now.writers | ({writer: number} if writer is not None else {})
            ages = now.ages | ({name: now.version + 1} if touched else {})
            return replace(now, version=now.version + 1, table=self.table, schema=self._widened(now, rows.schema), deltas=deltas, ages=ages, writers=writers)

        return self._commit(change)

    def delete(self, keys: DataFrame, newest: Column | None = None) -> Manifest:
        """Marks the keys as deleted, as of ``newest`` where the store goes by a column."""
        marks = keys.select(*self.keys).distinct().withColumn(DELETED, F.lit(True))
        return self.upsert(marks.withColumn(self.newest, newest) if self.newest else marks)

    def modify(self, batch: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], writer: str | None = None, number: int | None = None) -> Manifest:
        """Commits merge(stored rows of the batch's keys, batch): an update of some columns writes its keys' rows only.

        For one writer at a time: rows that another one commits meanwhile are not seen by ``merge``.
        """
        held = self.rows_of(batch.select(*self.keys))
        return self.upsert(merge(batch.limit(0) if held is None else held, batch), writer, number)

    def _widened(self, now: Manifest, schema: StructType) -> dict:
        """The store's schema with columns that it did not have; all are nullable."""
        known = StructType.fromJson(now.schema).fields if now.schema else []
        names = {f.name for f in known}
        return StructType([*known, *(StructField(f.name, f.dataType, True) for f in schema.fields if f.name not in names)]).jsonValue()

    # --- reading ------------------------------------------------------------------------------------
    def _scan(self, m: Manifest, places: list[tuple[str, int]]) -> DataFrame:
        """Rows of (commit, bucket) folders with both as columns."""
        paths = [str(self.files.path(f"data/{COMMIT}={c}/{BUCKET}={b}").toString()) for c, b in places]
        schema = StructType([*StructType.fromJson(m.schema).fields, StructField(COMMIT, StringType()), StructField(BUCKET, IntegerType())])
        return self.spark.read.schema(schema).option("basePath", str(self.files.path("data").toString())).parquet(*paths)

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
        """The table as of a version, or only some of its buckets."""
        m = self.manifest(version)
        if not m.schema:
            return None
        wanted = set(m.base) | set(m.deltas) if buckets is None else set(buckets)
        clean = [(c, b) for b, c in m.base.items() if b in wanted and not m.deltas.get(b)]
        dirty = [(c, b) for b, c in m.base.items() if b in wanted and m.deltas.get(b)] + [(c, b) for b, d in m.deltas.items() if b in wanted for c in d]
        parts = []
        if clean:
            parts.append(self._scan(m, clean).drop(COMMIT, BUCKET))
        if dirty:
            parts.append(self._merged(m, dirty))
        if not parts:
            return self.spark.createDataFrame([], StructType.fromJson(m.schema)).drop(DELETED)
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return out.where(f"NOT coalesce({DELETED}, false)").drop(DELETED)

    def _merged(self, m: Manifest, places: list[tuple[str, int]]) -> DataFrame:
        """Winners of the keys of buckets with deltas: one row a key and commit meets in one task."""
        rows = self._scan(m, places)
        age = F.lit(0)
        if m.ages:  # base files are older than all deltas
            age = F.coalesce(F.create_map(*[F.lit(x) for pair in m.ages.items() for x in pair])[F.col(COMMIT)], age)
        columns = [F.col(f"`{c}`") for c in rows.columns if c not in (COMMIT, BUCKET)]
        ranked = rows.withColumn("_age", age)
        rank = F.row_number().over(Window.partitionBy(*self.keys).orderBy(*self._order(F.desc("_age"), F.xxhash64(*columns))))
        return ranked.withColumn("_rank", rank).where("_rank = 1").drop("_rank", "_age", COMMIT, BUCKET)

    def rows_of(self, keys: DataFrame) -> DataFrame | None:
        """Stored rows of the given keys; only the buckets that can hold them are read."""
        at = [r[0] for r in keys.select(self.bucket_of()).distinct().collect()]  # at most the number of buckets
        held = self.read(buckets=at)
        if held is None:
            return None
        wanted = keys.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)]
        return held.join(wanted, same, "left_semi")

    def get(self, **key) -> DataFrame | None:
        """Point lookup: the row of one key, from one bucket, with the key pushed down to its files."""
        m = self.manifest()
        if not m.schema:
            return None
        schema = StructType.fromJson(m.schema)
        one = self.spark.range(1).select(*[F.lit(key[k]).cast(schema[k].dataType).alias(k) for k in self.keys])
        held = self.read(m.version, [one.select(self.bucket_of()).first()[0]])
        for k in self.keys:
            held = held.where(F.col(k).eqNullSafe(F.lit(key[k]).cast(schema[k].dataType)))
        return held

    # --- upkeep -------------------------------------------------------------------------------------
    def compact(self, least_deltas: int = 1, spread: int = 1) -> Manifest:
        """Rewrites the buckets that have ``least_deltas`` deltas or more, one task a bucket or ``spread`` tasks."""
        start = self.manifest()
        touched = {b: d for b, d in start.deltas.items() if len(d) >= max(least_deltas, 1)}
        if not touched:
            return start
        places = [(start.base[b], b) for b in touched if b in start.base] + [(c, b) for b, d in touched.items() for c in d]
        # rows marked as deleted stay: an older row of their key may still come
        name, found = self._write(self._merged(start, places), spread)

        def change(now: Manifest) -> Manifest | None:
            if any(now.base.get(b) != start.base.get(b) or now.deltas.get(b, [])[: len(d)] != d for b, d in touched.items()):
                self.files.delete(f"data/{COMMIT}={name}")  # another compaction was first
                return None
            base = {b: c for b, c in now.base.items() if b not in touched} | {b: name for b in touched if b in found}
            deltas = {b: d[len(touched.get(b, [])) :] for b, d in now.deltas.items()}
            deltas = {b: d for b, d in deltas.items() if d}
            ages = {c: v for c, v in now.ages.items() if any(c in d for d in deltas.values())}
            return replace(now, version=now.version + 1, base=base, deltas=deltas, ages=ages)

        return self._commit(change)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Deletes all but the newest ``keep`` manifests and what none of those names; no writer may be at work."""
        known = self.versions()
        used = set().union(*(self.manifest(v).commits() for v in known[-keep:])) if known else set()
        for v in known[:-keep]:
            self.files.delete(f"manifest/{v:012d}.json")
        gone = [n for n in self.files.names("data") if n.removeprefix(f"{COMMIT}=") not in used]
        for n in gone:
            self.files.delete(f"data/{n}")
        return gone
