"""The public functions over small tables."""

import pytest

from lexmill.operators.search import IndexMissing
from lexmill.plans.api import Library


@pytest.fixture(scope="module")
def library(spark):
    chunks = spark.createDataFrame(
        [("u1", "co:ley:1:2020", "co:ley:1:2020", "art 1", "agua limpia para todos", "agua limpia para todos", [1.0, 0.0]), ("u2", "co:ley:2:2020", "co:ley:2:2020", "art 1", "tarifas de agua", "tarifas de agua", [0.0, 1.0]), ("u3", "co:ley:3:2020", "co:ley:3:2020", "art 1", "impuesto de renta", "impuesto de renta", [0.1, 1.0])],
        "uid string, canonical_id string, norm_canonical_id string, section string, text string, body string, embedding array<double>",
    )
    edges = spark.createDataFrame([("a", "b", "CITA_A"), ("a", "c", "CITA_A"), ("d", "a", "MODIFICA")], "src string, dst string, rel string")
    articles = spark.createDataFrame([("co:ley:1:2020:art:1", "texto actual")], "canonical_id string, text string")
    versions = spark.createDataFrame([("co:ley:1:2020:art:1", 0, "texto viejo", "desde 01/01/2020 hasta 31/12/2020")], "canonical_id string, pos int, text string, date_range string")
    return Library(chunks=chunks, edges=edges, articles=articles, versions=versions)


def test_search(library):
    lexical = library.search("agua").collect()
    assert {r.uid for r in lexical} == {"u1", "u2"} and [r["rank"] for r in lexical] == [1, 2]
    hybrid = library.search("agua", vector=[0.0, 2.0]).collect()
    assert hybrid[0].uid == "u2" and {r.uid for r in hybrid} == {"u1", "u2", "u3"}
    with pytest.raises(ValueError):
        library.search("agua", limit=99)
    with pytest.raises(IndexMissing):
        library.stats()


def test_text_in_force(library):
    assert [r.texto for r in library.text_in_force("co:ley:1:2020", article="1").collect()] == ["texto actual"]
    assert [r.texto for r in library.text_in_force("co:ley:1:2020:art:1", "2020-06-01").collect()] == ["texto viejo"]


def test_neighbours(library):
    assert library.neighbours("a").count() > 0
    with pytest.raises(ValueError):
        library.neighbours("a", limit=0)


def test_pages_by_key_and_whole_documents(spark, library):
    from dataclasses import replace

    rows = [(i, f"co:{i}", str(i), "LEY", n, a, None, "Vigente") for i, (a, n) in enumerate([("2020", "1"), ("2020", "1"), ("2020", None), ("2019", "7"), (None, "3"), (None, None), (None, "9"), ("2021", "2")])]
    catalog = spark.createDataFrame(rows, "id int, canonical_id string, suin_id string, tipo string, numero string, anio string, suin_vigencia string, vigencia string")
    one = replace(library, catalog=catalog)
    whole = [r.id for r in catalog.orderBy("anio", "numero", "id").sort(catalog["anio"].desc(), catalog["numero"].desc(), "id").collect()]
    got, last = [], None
    while page := one.page_after(last, limit=3).collect():
        got += [r.id for r in page]
        last = (page[-1].anio, page[-1].numero, page[-1].id)
    assert got == whole and len(got) == 8
    named = spark.createDataFrame([(9, "co:ley:1:2020", "s9", "LEY", "1", "2020", None, "Vigente")], catalog.schema)
    touched = spark.createDataFrame([("s9", "1", "MODIFICA", "x", "suin")], "doc_id string, article_affected string, normalized_type string, source_text string, kind string")
    found = replace(library, catalog=named).document("co:ley:1:2020")
    assert {k: v.count() for k, v in found.items()} == {"catalog": 1, "articles": 1, "chunks": 1, "graph": 0} and touched.count() == 1
