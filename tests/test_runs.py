"""Runs of misses across part borders and windows of a bisection, against plain loops."""

from collections import defaultdict
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.operators import runs
from lexmill.sources import crawl


@pytest.mark.parametrize("part_rows,small", [(1_000_000, 100_000), (7, 100_000), (7, 0)])
def test_runs(spark, monkeypatch, part_rows, small):
    monkeypatch.setattr(runs, "BROADCAST_ROWS", small)
    rng = np.random.default_rng(1)
    keys = [None, "a", "a", "a", "b"]
    rows = [(keys[rng.integers(5)], int(i), bool(rng.random() < 0.15) if i % 9 else None) for i in range(300)]
    rows += [("long", i, i == 0) for i in range(100)] + [("never", i, False) for i in range(40)]
    order = rng.permutation(len(rows))
    frame = spark.createDataFrame([rows[i] for i in order], "k string, pos int, found boolean")
    got = {(r.k, r.pos): (r.run, r.kept) for r in runs.until_misses(frame, ["k"], ["pos"], F.col("found"), 12, part_rows).collect()}
    want, run, over = {}, defaultdict(int), set()
    for k, pos, hit in sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1])):
        run[k] = 0 if hit else run[k] + 1
        want[k, pos] = (run[k], k not in over)
        if run[k] == 12:
            over.add(k)
    assert got == want
    assert runs.until_misses(frame.limit(0), ["k"], ["pos"], F.col("found"), 12).count() == 0


def test_runs_without_keys(spark):
    frame = spark.createDataFrame([(i, i % 50 == 3) for i in range(400)], "pos int, found boolean").repartition(7)
    got = {r.pos: r.run for r in runs.miss_runs(frame, [], ["pos"], F.col("found"), 13).collect()}
    assert got == {i: i + 1 if i < 3 else (i - 3) % 50 for i in range(400)}


def harvest(rows, first, last, most, axes, k=0, fixed=()):
    """The portal's search: halve the window, then split a day by one axis after another."""
    here = [r for r in rows if first <= r[0] <= last and all(r[1 + i] == v for i, v in enumerate(fixed))]
    window = (first, last, *fixed, *[None] * (axes - len(fixed)))
    if not here:
        return []
    if len(here) <= most:
        return [(*window, len(here), 0)]
    if first < last:
        middle = first + timedelta(days=(last - first).days // 2)
        return harvest(rows, first, middle, most, axes) + harvest(rows, middle + timedelta(days=1), last, most, axes)
    if k < axes:
        return [w for v in {r[1 + k] for r in here} for w in harvest(rows, first, last, most, axes, k + 1, (*fixed, v))]
    return [(*window, len(here), len(here) - most)]


@pytest.mark.parametrize("axes", [0, 1, 2])
def test_bisected(spark, axes):
    rng = np.random.default_rng(2)
    days = [date(2019, 12, 25) + timedelta(days=int(d)) for d in rng.choice([0, 1, 2, 17, 18, 40, 41, 100], 400, p=[0.1, 0.05, 0.3, 0.1, 0.1, 0.05, 0.2, 0.1])]
    rows = [(d, "xyz"[rng.integers(3)] if rng.random() < 0.9 else None, int(rng.integers(4))) for d in days]
    frame = spark.createDataFrame([*rows, (None, "x", 1)], "day date, kind string, part int")
    got = crawl.bisected(frame, "day", 15, ["kind", "part"][:axes])
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(harvest(rows, min(days), max(days), 15, axes), key=key)
    assert got.agg(F.sum("n")).first()[0] == len(rows)
    assert crawl.bisected(frame.limit(0), "day", 15, ["kind"]).count() == 0


def test_bisected_days_equals_the_portal_loop(spark):
    days = {date(2020, 1, 1) + timedelta(days=i): (i * 37) % 60 for i in range(0, 200, 3)}
    daily = spark.createDataFrame(list(days.items()), "day date, n long")
    known = {d: n for d, n in days.items() if n}
    want = crawl.bisect(min(known), max(known), lambda a, b: sum(n for d, n in known.items() if a <= d <= b), 50)
    assert sorted((r.desde, r.hasta, r.n) for r in crawl.bisected_days(daily, 50).collect()) == want


def test_texts_at_many_dates(spark):
    """Every (key, date) gets what the one-date operator gives; brute force over closed intervals."""
    from lexmill.operators import validity

    rng = np.random.default_rng(3)
    first = date(1900, 1, 1)
    rows = []
    for k in ("hot", "b", "c"):
        for orden in range(1, 300 if k == "hot" else 6):
            a = first + timedelta(days=int(rng.integers(60_000)))
            b = a + timedelta(days=int(rng.integers(-2, 900)))
            rows.append((k, orden, f"{k}{orden}", a if rng.random() < 0.9 else None, b if rng.random() < 0.9 else None, False))
        if k != "c":
            rows.append((k, 1000, f"{k} now", None, None, True))
    timeline = spark.createDataFrame(rows, "k string, orden int, texto string, desde date, hasta date, vigente boolean")
    asked = [(k, first + timedelta(days=int(rng.integers(62_000)))) for k in ("hot", "b", "c") for _ in range(150)] + [("hot", None), ("c", None), ("none", first), ("b", first), ("b", first)]
    got = {(r.k, r["at"]): r.texto for r in validity.texts_as_of(timeline, ["k"], spark.createDataFrame(asked, "k string, at date")).collect()}
    want = {}
    for k, at in asked:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        hits = [r for r in mine if at and (r[3] is None or r[3] <= at) and (r[4] is None or at <= r[4])] or [r for r in mine if r[5]]
        if hits:
            want[k, at] = hits[0][2]
    assert got == want


def test_library_filter(spark):
    from lexmill.operators import taxonomy

    placed = [("Ejecutiva", "Minas", "Ágora"), ("Ejecutiva", "Minas", "CREG"), ("Ejecutiva", "Salud", "INS"), ("Judicial", "Cortes", "Minería"), (None, None, "Otra")]
    tree = taxonomy.library_rollup(spark.createDataFrame(placed, "rama string, cabeza string, entidad string"))
    names = lambda q: sorted(f"{r.nivel}{r.nombre}" for r in taxonomy.library_filter(tree, q).collect())
    assert names("  ") == sorted(f"{r.nivel}{r.nombre}" for r in tree.collect())
    assert names("MINÁS") == ["0Biblioteca", "1Ejecutiva", "2Minas", "3CREG", "3Ágora"]
    assert names("agora ") == ["0Biblioteca", "1Ejecutiva", "2Minas", "3Ágora"]
    assert names("judic") == ["0Biblioteca", "1Judicial", "2Cortes", "3Minería"]
    assert names("mine") == ["0Biblioteca", "1Judicial", "2Cortes", "3Minería"]
    assert names("nada") == ["0Biblioteca"]


def test_comptroller_enumeration(spark):
    from lexmill.sources import connectors

    numbers = spark.range(1, 60).selectExpr("'CONCEPTO' AS serie", "cast(id AS int) AS numero", "2020 AS anio").unionByName(spark.createDataFrame([("RESOLUCION_OGZ", 12345, 2021)], "serie string, numero int, anio int"))
    tried = connectors.comptroller_candidates(numbers)
    base = "https://relatoria.blob.core.windows.net/$web/files/conceptos-juridicos/CGR-OJ-"
    assert [r.url for r in tried.where("numero = 7").orderBy("intento").collect()] == [f"{base}007-2020.PDF", f"{base}007-2020.pdf", f"{base}0007-2020.PDF", f"{base}0007-2020.pdf"]
    assert {r.url.rsplit("/", 1)[1] for r in tried.where("anio = 2021").collect()} == {"OGZ-12345-2021.PDF", "OGZ-12345-2021.pdf"}
    answers = spark.createDataFrame([(f"{base}001-2020.pdf", 200), (f"{base}0001-2020.pdf", 200), (f"{base}0010-2020.PDF", 206), (f"{base}011-2020.pdf", 404), (f"{base}040-2020.pdf", 200)], "url string, status int")
    got = {r.numero: r.url for r in connectors.comptroller_found(tried, answers).where("serie = 'CONCEPTO'").collect()}
    assert sorted(got) == list(range(1, 23))  # 11 to 22 are twelve misses in a row: what follows is not seen
    assert {k: v for k, v in got.items() if v} == {1: f"{base}001-2020.pdf", 10: f"{base}0010-2020.PDF"}


def test_sketches(spark, tmp_path):
    from lexmill.operators import distinct
    from lexmill.sources.keyed_store import KeyedStore

    rows = spark.range(60_000).selectExpr("if(id < 50000, 'big', if(id < 50900, 'small', null)) AS g", "if(id % 7 = 0, null, id) AS u").unionByName(spark.createDataFrame([("none", None)], "g string, u long"))
    want = {r.g: r.n for r in rows.groupBy("g").agg(F.countDistinct("u").alias("n")).collect()}
    store = KeyedStore(spark, str(tmp_path / "s"), ["g"], buckets=2)
    for k in range(3):
        distinct.add_batch(store, rows.where(f"coalesce(u, 0) % 3 = {k}"), "u", "w", k)
    distinct.add_batch(store, rows.where("u % 3 = 0"), "u", "w", 0)
    got = {r.g: (r.n, r.exact) for r in distinct.counts(store.read(), ["g"]).collect()}
    assert set(got) == set(want) and all(got[g] == (want[g], True) for g in ("small", "none"))
    assert not got["big"][1] and abs(got["big"][0] / want["big"] - 1) < 4 * 0.83 / 2**7 and not got[None][1]
    assert distinct.counts(distinct.sketches(rows.limit(0), ["g"], "u"), ["g"]).count() == 0


def test_exact_distinct_counts(spark, tmp_path):
    """The query's counts equal its SQL's where types have more ids than a sketch keeps apart."""
    import duckdb

    from lexmill.plans import queries

    spark.range(20_000).selectExpr("id AS event_id", "if(id % 11 = 0, null, id % 6001) AS user_id", "if(id % 3 = 0, 'view', if(id % 50 = 1, null, 'buy')) AS event_type").unionByName(spark.sql("SELECT 20001L AS event_id, CAST(null AS LONG) AS user_id, 'none' AS event_type")).write.parquet(str(tmp_path / "events.parquet"))
    want = duckdb.sql(queries.ORACLE_SQL["distinct_sketches"].replace("FROM events", f"FROM '{tmp_path}/events.parquet/*.parquet'")).fetchall()
    got = [(r.event_type, r.rows, r.n, r.exact) for r in queries.QUERIES["distinct_sketches"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and max(r[2] for r in got) > 1_024
