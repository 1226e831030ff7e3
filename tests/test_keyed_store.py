"""The merge-by-key store: merge on read, replays, torn batches, compaction, bytes written."""

import pytest
from pyspark.sql import functions as F

from lexmill.sources.keyed_store import Conflict, KeyedStore, Manifest

ROWS = "k string, part int, v string, at int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def brute(batches):
    """Newest ``at`` (None last) of each key, then the later batch."""
    best = {}
    for age, batch in enumerate(batches):
        for k, part, v, at in batch:
            if (k, part) not in best or (at is not None, at or 0, age) >= best[k, part][0]:
                best[k, part] = ((at is not None, at or 0, age), (k, part, v, at))
    return sorted((r for _, r in best.values()), key=str)


def test_merge_on_read(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ["k", "part"], "at", buckets=5)
    assert store.read() is None and KeyedStore.open(spark, str(tmp_path / "s")) is None
    batches = [[(f"k{i}", i % 3, f"a{i}", 10) for i in range(40)], [(f"k{i}", i % 3, f"b{i}", 5 + i) for i in range(0, 20, 2)], [(None, None, "null", None), ("k1", 1, "late", None), ("k3", 0, "c", 10)], [(None, None, "null2", 1)]]
    for n, batch in enumerate(batches):
        store.upsert(spark.createDataFrame(batch, ROWS))
        assert rows(store.read()) == brute(batches[: n + 1])
    assert rows(store.read(2)) == brute(batches[:2])  # an earlier version stays readable
    assert store.upsert(spark.createDataFrame([], ROWS)).version == 4  # an empty batch commits nothing
    assert rows(store.get(k="k3", part=0)) == [("k3", 0, "c", 10)] and rows(store.get(k="none", part=0)) == []
    assert rows(store.get(k=None, part=None)) == [(None, None, "null2", 1)]
    before = rows(store.read())
    m = store.compact()
    assert not m.deltas and rows(store.read()) == before
    store.upsert(spark.createDataFrame([("k1", 1, "new", 99)], ROWS))
    assert len(store.manifest().deltas) == 1
    assert rows(store.read()) == brute([*batches, [("k1", 1, "new", 99)]])
    assert store.vacuum() and rows(store.read()) == brute([*batches, [("k1", 1, "new", 99)]])
    with pytest.raises(ValueError):
        KeyedStore(spark, str(tmp_path / "s"), ["k"], "at", buckets=5)
    assert rows(KeyedStore.open(spark, str(tmp_path / "s")).read()) == rows(store.read())


def test_only_touched_buckets_are_merged(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ["k"], buckets=8)
    store.upsert(spark.range(2000).select(F.col("id").alias("k"), F.lit("x" * 50).alias("v")))
    first = store.files.size("data")
    store.compact()
    plan = store.read()._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Window" not in plan  # clean buckets are read as they are
    before = store.files.size("data")
    m = store.upsert(spark.createDataFrame([(7, "y")], "k long, v string"))
    assert list(map(len, m.deltas.values())) == [1]
    assert store.files.size("data") - before < first / 20  # bytes follow the batch
    held = store.get(k=7)
    assert held.first().v == "y" and len({f.split("_bucket=")[1].split("/")[0] for f in held.inputFiles()}) == 1


def test_replays_and_torn_batches(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ["k"], buckets=3)
    one = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    store.upsert(one, "stream", 0)
    store.upsert(one.withColumn("v", F.lit(2)), "stream", 1)
    version = store.manifest().version
    assert store.upsert(one, "stream", 0).version == version and rows(store.read()) == [("a", 2), ("b", 2)]
    assert store.upsert(one.limit(0), "stream", 2).writers == {"stream": 2}  # an empty batch is done, too
    # a writer that dies before its manifest leaves files that nobody reads
    name, _ = store._write(one.withColumn("v", F.lit(9)).withColumn("_deleted", F.lit(False)))
    (tmp_path / "s" / "manifest" / "000000000009.json.abc.part").write_text("{")
    assert rows(store.read()) == [("a", 2), ("b", 2)]
    assert f"_commit={name}" in store.vacuum(keep=2)
    with pytest.raises(Conflict):
        store.files.create(f"manifest/{store.manifest().version:012d}.json", "{}")


def test_two_writers(spark, tmp_path, monkeypatch):
    """A writer that is overtaken takes the next version; both batches stay."""
    path = str(tmp_path / "s")
    a, b = (KeyedStore(spark, path, ["k"], buckets=3) for _ in range(2))
    frame = lambda v: spark.createDataFrame([(v, 1)], "k string, v int")
    a.upsert(frame("first"))
    create, calls = a.files.create, []

    def overtaken(name, text):
        if not calls:
            calls.append(name)
            b.upsert(frame("second"))
        create(name, text)

    monkeypatch.setattr(a.files, "create", overtaken)
    assert a.upsert(frame("third")).version == 3
    assert rows(a.read()) == [("first", 1), ("second", 1), ("third", 1)]


def test_deletes_updates_and_new_columns(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), ["k"], "at", buckets=4)
    store.upsert(spark.createDataFrame([("a", 1, 10), ("b", 2, 10), ("c", 3, 10)], "k string, v int, at int"))
    store.delete(spark.createDataFrame([("a",), ("zzz",)], "k string"), F.lit(20))
    store.upsert(spark.createDataFrame([("a", 5, 15)], "k string, v int, at int"))  # older than the deletion
    assert rows(store.read()) == [("b", 2, 10), ("c", 3, 10)]
    store.compact()
    store.upsert(spark.createDataFrame([("a", 6, 15)], "k string, v int, at int"))
    assert rows(store.read()) == [("b", 2, 10), ("c", 3, 10)]
    store.upsert(spark.createDataFrame([("d", "new", 30)], "k string, note string, at int"))
    assert store.read().columns == ["k", "v", "at", "note"]
    merge = lambda old, new: old.drop("note", "at").join(new, "k")
    store.modify(spark.createDataFrame([("b", "seen", 40), ("nobody", "x", 40)], "k string, note string, at int"), merge)
    assert rows(store.read()) == [("b", 2, 40, "seen"), ("c", 3, 10, None), ("d", None, 30, "new")]


def test_manifest_round_trip():
    m = Manifest(3, {"keys": ["k"]}, {"type": "struct", "fields": []}, {1: "x"}, {2: ["y", "z"]}, {"y": 1}, {"w": 4})
    assert Manifest.of_json(m.to_json()) == m and m.commits() == {"x", "y", "z"}
