"""SQLite files and stored pages as Spark data sources."""

import sqlite3

import pytest

from lexmill.sources import datasources


@pytest.fixture(scope="module", autouse=True)
def known(spark):
    datasources.register(spark)


def read(spark, path, **options):
    out = spark.read.format("lexmill_sqlite").option("path", str(path)).option("table", "cat a")
    for k, v in options.items():
        out = out.option(k, v)
    return out.load()


@pytest.fixture
def file(tmp_path):
    db = sqlite3.connect(tmp_path / "c.sqlite")
    db.execute('CREATE TABLE "cat a" (id INTEGER, tipo VARCHAR(9), "a ""b" TEXT, x REAL, raw BLOB, odd)')
    rows = [(i, "LEY" if i % 3 else None, f"é{i}", i / 4, bytes([i % 256]), "free") for i in range(1, 1001)]
    db.executemany('INSERT INTO "cat a" VALUES (?, ?, ?, ?, ?, ?)', [*rows, (None, "LEY", "no id", None, None, 5), (2000, "LEY", b"\xff", "not a number", "text", None)])
    db.commit()
    db.close()
    return tmp_path / "c.sqlite"


def test_sqlite_rows_and_types(spark, file):
    df = read(spark, file, rows=100)
    assert df.dtypes == [("id", "bigint"), ("tipo", "string"), ('a "b', "string"), ("x", "double"), ("raw", "binary"), ("odd", "binary")]
    assert df.count() == 1002 and df.rdd.getNumPartitions() == 11
    assert {tuple(r)[:4] for r in df.where("id = 7 OR id IS NULL OR id = 2000").collect()} == {(7, "LEY", "é7", 1.75), (None, "LEY", "no id", None), (2000, "LEY", "�", None)}
    assert df.agg({"x": "sum"}).first()[0] == sum(i / 4 for i in range(1, 1001))
    assert read(spark, file, key="id", rows=100).count() == 1002


@pytest.mark.parametrize("where", ["id >= 250 AND id < 260", "id = 9", "tipo IS NULL AND id > 990", "tipo = 'LEY' AND id IN (1, 2, 3)", "id <> 5", "NOT (tipo = 'LEY')", "`a \"b` LIKE 'é99%'", "x > 200.5", "id > 5 AND id < 3", "tipo <=> NULL", "id = 3.0"])
def test_sqlite_filters_mean_the_same(spark, file, where):
    whole = read(spark, file).cache()  # Spark's own filter over rows that are held
    whole.count()
    want = sorted((str(tuple(r)[:4]) for r in whole.where(where).collect()))
    whole.unpersist()
    for options in ({}, {"key": "id", "rows": 64}):
        assert sorted(str(tuple(r)[:4]) for r in read(spark, file, **options).where(where).collect()) == want


def test_sqlite_ranges_are_pruned(spark, file):
    assert read(spark, file, key="id", rows=100).where("id >= 250 AND id < 260").rdd.getNumPartitions() == 1
    assert read(spark, file, key="id", rows=100).where("id >= 250 AND id < 460").rdd.getNumPartitions() == 3


def test_sqlite_written_and_read(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(500).selectExpr("id", "if(id % 7 = 0, null, concat('t', id)) AS t", "id / 3 AS x", "id % 2 = 0 AS even")
    write = lambda d, mode: d.write.format("lexmill_sqlite").option("path", path).option("table", "t").mode(mode).save()
    load = lambda: spark.read.format("lexmill_sqlite").option("path", path).option("table", "t").load()
    write(df.repartition(3), "append")
    assert {tuple(r) for r in load().collect()} == {tuple(r) for r in df.selectExpr("id", "t", "x", "cast(even AS long)").collect()}
    write(df.limit(10), "append")
    assert load().count() == 510
    (tmp_path / "out" / "torn.sqlite").write_bytes(b"x")  # a file that no commit names
    assert load().count() == 510
    write(df.limit(4), "overwrite")
    assert load().count() == 4


def test_pages_stop_early(spark, tmp_path):
    for year, pages in {2021: ["<tr>a", "<tr>b", "none", "<tr>late"], 2022: ["<tr>c"], 2023: ["none", "<tr>d"], 2024: []}.items():
        (tmp_path / str(year)).mkdir()
        for i, text in enumerate(pages, 9):
            (tmp_path / str(year) / f"{i}.html").write_text(text)
    (tmp_path / "notes").mkdir()
    load = lambda misses: spark.read.format("lexmill_pages").option("path", str(tmp_path)).option("row_pattern", "<tr>").option("misses", misses).load()
    rows = lambda df: sorted((r.anio, r.pagina, r.contenido) for r in df.collect())
    assert rows(load(1)) == [(2021, 9, "<tr>a"), (2021, 10, "<tr>b"), (2022, 9, "<tr>c")]
    assert rows(load(2)) == [(2021, 9, "<tr>a"), (2021, 10, "<tr>b"), (2021, 12, "<tr>late"), (2022, 9, "<tr>c"), (2023, 10, "<tr>d")]
    window = load(2).where("anio >= 2022 AND anio < 2024")
    assert rows(window) == [(2022, 9, "<tr>c"), (2023, 10, "<tr>d")] and window.rdd.getNumPartitions() == 2
    assert rows(load(1).where("anio = 1900")) == []
