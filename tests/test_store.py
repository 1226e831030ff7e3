"""Captures, parsed documents and the source registry."""

from datetime import datetime

from lexmill.sources import registry, store
from lexmill.schemas import PARSED_NORM

CAPTURE = "source string, tipo string, suin_id string, content string, capture_ts timestamp"


def test_captures(spark, tmp_path):
    path = str(tmp_path / "raw")
    first = spark.createDataFrame([("suin", "LEY", "1", "a", datetime(2020, 1, 1)), ("suin", "LEY", "2", None, datetime(2020, 1, 1))], CAPTURE)
    store.append_captures(store.new_captures(first, None), path)
    second = spark.createDataFrame([("suin", "LEY", "1", "a", datetime(2020, 2, 1)), ("suin", "LEY", "1", "b", datetime(2020, 3, 1))], CAPTURE)
    fresh = store.new_captures(second, spark.read.parquet(path))
    assert [r.content for r in fresh.collect()] == ["b"]
    store.append_captures(fresh, path)
    assert {r.suin_id: r.content for r in store.current(spark.read.parquet(path)).collect()} == {"1": "b", "2": None}


def test_parsed(spark, tmp_path):
    path = str(tmp_path / "parsed")
    rows = spark.createDataFrame([("suin", "LEY", "1", 1), ("csj", "LEY", "1", 2), ("x", "LEY", "3", 3)], "source string, tipo string, suin_id string, v int")
    store.write_parsed(rows, path)
    store.write_parsed(rows.where("source = 'csj'").selectExpr("source", "tipo", "suin_id", "9 AS v"), path)
    read = spark.read.parquet(path)
    assert sorted(r.v for r in read.collect()) == [1, 3, 9]
    wanted = spark.createDataFrame([("LEY", "1", "csj"), ("LEY", "3", "suin")], "tipo string, suin_id string, source string")
    assert sorted(r.v for r in store.by_source_priority(read, wanted).collect()) == [3, 9]


def test_cited_rulings(spark):
    text = lambda s: {"source_text": s}
    rows = [{"suin_id": "1", "modifications": [text("Sentencia C-274 de 2013 y T-1/2000")], "jurisprudence": [text("sentencia c-274 de 2013"), text(None)]}]
    got = store.cited_rulings(spark.createDataFrame(rows, PARSED_NORM))
    assert sorted(tuple(r) for r in got.collect()) == [("C", "274", "2013"), ("T", "1", "2000")]


def test_registry(spark):
    every = registry.sources(spark)
    assert every.count() == 20 and registry.sources(spark, capa="D").count() == 2 and registry.sources(spark, pending=True).count() == 0
    new = registry.with_measured(every, spark.createDataFrame([("can", 5)], "key string, volumen long")).where("key = 'can'").first()
    assert (new.volumen, new.calidad) == (5, "medido")
