"""Connectors, crawl planning and the incremental cycle on small inputs."""

from datetime import date, datetime

import pytest

from lexmill.operators import catalog, graph
from lexmill.sources import connectors, crawl
from lexmill.streaming import incremental


def page(spark, html, name="html"):
    return spark.createDataFrame([(html,)], f"{name} string")


def rows(df):
    return sorted(tuple(r[c] for c in ("tipo", "numero", "anio", "external_id")) for r in df.collect())


def test_normogram(spark):
    links = spark.createDataFrame([("https://x/docs/resolucion_creg_0012_2019.htm",), ("https://x/oficio_dian_5_9999.htm",), ("https://x/index.html",)], "url string")
    found = connectors.normogram_links(links, "url", "creg", "creg").collect()
    assert [(r.tipo, r.numero, r.canonical_id) for r in found] == [("RESOLUCION", "0012", "co:resolucion:0012:2019")]
    items = spark.createDataFrame([("Resoluciones", "2020", " 7 ", None, "a.htm"), ("raro", "x", None, None, "decreto_dian_8_2001.htm"), ("leyes", "20", "3", "E", "b"), ("leyes", "2000", "3", "E", "")], "tipo string, year string, numero string, entidad string, link string")
    assert rows(connectors.normogram_items(items, "dian", "dian", "d/"))[0][:3] == ("DECRETO", "8", "2001")
    assert connectors.normogram_items(items, "dian", "dian", "d/").count() == 3


def test_listings(spark):
    gaz = page(spark, "index2.xhtml?ent=senado&amp;fec=27-4-2023&num=399 index2.xhtml?ent=Senado&fec=27-4-2023&num=399 index2.xhtml?ent=Camara&fec=1-1-2020&num=4")
    assert rows(connectors.congress_gazettes(gaz, "html")) == [("GACETA", "399", "2023", "399"), ("GACETA", "4", "2020", "4")]
    eva = page(spark, '<a href="norma.php?i=7">Ley 1437 de 2011</a><a href="norma.php?i=7">otra</a><a href="norma.php?i=8">Sin numero</a>')
    assert rows(connectors.eva_index(eva, "html")) == [("LEY", "1437", "2011", "7"), ("NORMA", "", None, "8")]
    sic = page(spark, '<a href="/d/1">Circular Externa 002 de 2020</a><a href="http://x">Circular externa 002 de 2020</a><a href="#">Inicio</a>')
    assert rows(connectors.commerce_publications(sic, "html")) == [("CIRCULAR EXTERNA", "002", "2020", None)]
    cgr = page(spark, "https://relatoria.blob.core.windows.net/$web/files/conceptos-juridicos/CGR-OJ-005-2019.pdf")
    assert rows(connectors.comptroller_index(cgr, "html")) == [("CONCEPTO", "5", "2019", "CGR-OJ-005-2019")]
    cndj = page(spark, "F52001250200020230046801ADJUNTA20240207110359.pdf")
    assert rows(connectors.discipline_results(cndj, "html"))[0][2] == "2023"
    diario = page(spark, '<tr data-rk="53.526"><label id="a:0:numeroDiario">53.526</label><label id="a:0:fechaDiario">02/03/2024</label></tr>')
    assert rows(connectors.gazette_rows(diario, "html")) == [("DIARIO OFICIAL", "53526", "2024", "53526")]
    cne = page(spark, '<a href="/x/Res.%2006772%20de%202024.pdf">ver</a><a href="#a">Resolución 1 de 2020</a>')
    assert rows(connectors.cne_year_page(cne, "html")) == [("RESOLUCION", "06772", "2024", "06772-2024")]
    can = connectors.can_listing(page(spark, '<a href="/DocOficialesFiles/decisiones/DECISION12.pdf">Decisión 12 (1977)</a><a href="/DocOficialesFiles/Procesos/1-IP-90.pdf">x</a>'), "html")
    assert rows(can) == [("DECISION CAN", "12", "1977", "12"), ("SENTENCIA", "1-IP-90", None, "1-IP-90")]
    assert connectors.patterned_decisions(11, 13, can).count() == 4


def test_records(spark):
    bog = page(spark, "<title>Decreto 5 de 2010 Alcaldía</title>").selectExpr("html", "'13' AS i")
    assert rows(connectors.bogota_records(bog, "html", "i")) == [("DECRETO", "5", "2010", "13")]
    idh = page(spark, "<b>Estado Demandado</b>: Colombia Sumilla ... Sentencia de Fondo: 22 sentencia de fondo del 8 de diciembre de 1995 Reparaciones y Costas: 31").selectExpr("html", "'9' AS f")
    assert rows(connectors.iachr_phases(idh, "html", "f")) == [("SENTENCIA", "22", "1995", "9-22"), ("SENTENCIA", "31", None, "9-31")]
    csj = page(spark, '<tr data-rk="77" role="row"><td>NÚMERO DE PROVIDENCIA: SL1-2020 PONENTE: JUAN FECHA: 01/02/2020 TEMA: X</td></tr>')
    assert rows(connectors.ruling_rows(csj, "html", "csj", "csj", "u")) == [("SENTENCIA", "SL1-2020", "2020", "77")]
    court = spark.createDataFrame([("T-012/92", "T", "M", None, None), ("C-1/2004", "C", "M", "Sala Plena", "2004-05-01")], "sentencia string, sentencia_tipo string, magistrado_a string, sala string, fecha_sentencia string")
    assert [r.canonical_id for r in connectors.court_dataset(court).collect()] == ["co:sentencia:cc:revision:t-012:1992", "co:sentencia:cc:plena:c-1:2004"]
    with pytest.raises(ValueError):
        connectors.connector("nada")


def test_bisection():
    days = {date(2020, 1, d): d * 10 for d in range(1, 13)}
    windows = crawl.bisect(date(2020, 1, 1), date(2020, 1, 31), lambda a, b: sum(n for d, n in days.items() if a <= d <= b))
    assert sum(n for _, _, n in windows) == sum(days.values())
    assert all(n <= 100 or a == b for a, b, n in windows)


def test_nulls_and_empty_tables(spark):
    rows_ = spark.createDataFrame([(1, "LEY", "1", None, "E", None, "suin"), (2, "LEY", "1", None, "E", None, "suin"), (3, "LEY", "1", "2000", "E", None, "suin"), (4, "LEY", "1", "2000", "E", None, "suin")], "id long, tipo string, numero string, anio string, entidad string, canonical_id string, source string")
    assert catalog.insert_ignore(rows_.limit(0), rows_, [rows_["id"]]).count() == 3
    assert catalog.insert_ignore(rows_.limit(0), rows_, [rows_["id"]], nulls_distinct=False).count() == 2
    edges = spark.createDataFrame([], "src string, dst string, rel string")
    nodes = spark.createDataFrame([("a",)], "id string")
    assert graph.integrity(nodes, edges).first() == (1, 0, 1, 1.0)
    with pytest.raises(ValueError):
        graph.neighbourhood(edges, "a", direction="x")


def test_incremental(spark, tmp_path):
    schema = "suin_id string, capture_ts timestamp, v int"
    incoming, target, check = (str(tmp_path / n) for n in ("in", "out", "ck"))
    spark.createDataFrame([("a", datetime(2020, 1, 1), 1), ("b", datetime(2020, 1, 1), 1)], schema).write.parquet(incoming)
    incremental.ingest_new(spark, incoming, schema, target, check, ["suin_id"])
    spark.createDataFrame([("a", datetime(2020, 2, 1), 2), ("b", datetime(2019, 1, 1), 0)], schema).write.mode("append").parquet(incoming)
    incremental.ingest_new(spark, incoming, schema, target, check, ["suin_id"])
    got = {r.suin_id: r.v for r in incremental.latest_version(spark, target).collect()}
    assert got == {"a": 2, "b": 1}


def test_markdown_leaves_no_tree():
    """A page's tree goes at once, without the collector."""
    import gc

    from lexmill.sources import html

    gc.collect()
    gc.disable()
    try:
        assert html.markdown("<div><h1>A</h1><p>b <b>c</b></p></div>" * 20).startswith("# A\n\nb c")
        assert not any(isinstance(o, html.Node) for o in gc.get_objects())
    finally:
        gc.enable()
