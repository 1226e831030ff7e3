"""Nodes, edges and graphs of documents, parsed rulings, chunks, and listings, on small tables."""

from pyspark.sql import functions as F

from lexmill import schemas
from lexmill.operators import catalog, chunking, graph, nodes, rulings, search, validity
from lexmill.sources import connectors
from lexmill.streaming import incremental


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def parsed_norm(spark):
    affects = [("DEROGA_TOTAL", "Deroga", True, "Ley 9 de 1990", "77", None, None), ("DEROGA_TOTAL", "Deroga", True, "Ley 9 de 1990", "77", None, None), ("rara", "?", False, "Decreto 3 de 1999", None, None, None)]
    articles = [("a1", "Art. 1", "1", "Objeto", "uno", "co:ley:5:2000:art:1", [], [("viejo", "desde 01/01/2000")], affects), ("a2", "Art. 2", "2", None, "dos", None, [], [], [])]
    changes = [("Artículo 1", "Modificado", "MODIFICA", True, "Ley 8 de 2010", "88", None, None), ("", "Extraño", "UNKNOWN", False, "Decreto 4 de 2011", None, None, "(x)")]
    toc = [("division", "Titulo I", "t1"), ("division", "Capitulo 1", "c1"), ("articulo", "Art. 1", "a1"), ("articulo", "Art. 2", None)]
    return spark.createDataFrame([("5", {}, articles, changes, None, toc, None, None, None, None, None, None, None, None, None, None)], schemas.PARSED_RULING)


CATALOG = "id long, tipo string, numero string, anio string, canonical_id string, suin_id string, corte string, magistrado_ponente string, scrape_status string"


def stored(spark):
    return spark.createDataFrame(
        [(1, "LEY", "5", "2000", "co:ley:5:2000", "4", None, None, "done"), (2, "LEY", "5", "2000", "co:ley:5:2000", "5", None, None, "done"), (3, "DECRETO", None, None, None, None, None, None, "pending"), (4, "SENTENCIA", "C-1", "2020", None, "9", None, " Ana Ruiz ", "done"), (5, "SENTENCIA", "C-2", "2021", "co:sentencia:cc:plena:c-2:2021", "10", "cc", " ", "error")], CATALOG
    )


def test_nodes_and_outgoing_edges(spark):
    norms = nodes.norm_nodes(stored(spark))
    assert rows(norms.select("id", "suin_id")) == [("co:decreto:?:?", None), ("co:ley:5:2000", "5")]
    parsed = parsed_norm(spark)
    articles = nodes.article_nodes(norms, parsed)
    assert rows(articles.select("id", "titulo", "numero", F.size("versiones"))) == [("co:ley:5:2000:art:1", "Objeto", "1", 1), ("co:ley:5:2000:art:2", "", "2", 0)]
    assert rows(nodes.belongs_edges(articles).select("dst", "rel").distinct()) == [("co:ley:5:2000", "PERTENECE_A")]
    assert rows(nodes.outgoing_edges(norms, parsed).select("src", "dst", "rel", "texto")) == [("co:ley:5:2000", "co:decreto:3:1999", "AFECTA", "Decreto 3 de 1999"), ("co:ley:5:2000", "co:ley:9:1990", "DEROGA_TOTAL", "Ley 9 de 1990")]
    assert nodes.outgoing_edges(norms, parsed.limit(0)).count() == 0
    found = nodes.ruling_nodes(stored(spark), spark.createDataFrame([("9", "x" * 3000, None), ("10", "no", "no")], "suin_id string, resuelve string, hechos string"))
    assert rows(found.select("id", F.length("resuelve"), "hechos")) == [("co:sentencia:cc:C-1:2020", 2000, ""), ("co:sentencia:cc:plena:c-2:2021", None, None)]
    assert rows(nodes.judge_nodes(found)) == [("mag_ana_ruiz", "Magistrado", "Ana Ruiz")]
    assert rows(nodes.judge_edges(found)) == [("mag_ana_ruiz", "co:sentencia:cc:C-1:2020", "FUE_PONENTE_DE")]


def test_document_graph(spark):
    norm = parsed_norm(spark)
    ruling = spark.createDataFrame([("9", {}, [], [], [], [], "cc", None, "Ana: Ruiz", "h", "", "r", [], [], [f"Ley {k} de 2000" for k in range(32)] + ["Ley 1 de 2000", " ", "Sentencia C-1 de 2000"], "")], schemas.PARSED_RULING)
    shown, links = nodes.document_graph(norm.unionByName(ruling), stored(spark))
    of = lambda df, doc, *c: rows(df.where(F.col("suin_id") == doc).select(*c))
    assert of(shown, "5", "id", "group") == sorted([("5", "norma"), ("5#Art._2", "articulo"), ("5#a1", "articulo"), ("5#c1", "capitulo"), ("5#t1", "titulo"), ("77", "afecta"), ("88", "modificacion"), ("Decreto 3 de 1999", "afecta"), ("Decreto 4 de 2011", "modificacion")], key=str)
    assert of(links, "5", "source", "target", "label") == sorted([("5#t1", "5", "CONTIENE"), ("5#c1", "5#t1", "CONTIENE"), ("5#a1", "5#c1", "CONTIENE"), ("5#Art._2", "5#c1", "CONTIENE"), ("88", "5", "MODIFICA"), ("Decreto 4 de 2011", "5", "UNKNOWN"), ("5", "77", "DEROGA_TOTAL"), ("5", "Decreto 3 de 1999", "rara")], key=str)
    groups = {r.group: r.n for r in shown.where("suin_id = '9'").groupBy("group").agg(F.count("*").alias("n")).collect()}
    assert groups == {"norma": 1, "seccion": 2, "citacion": 30, "resumen": 1, "magistrado": 1}
    assert rows(shown.where("group = 'resumen' OR group = 'magistrado'").select("id", "name")) == [("9__mas_citas", "+3 citaciones más"), ("mag_ana_ruiz", "Ana Ruiz")]


def test_graph_validity(spark):
    norms = spark.createDataFrame([("n1", "Vigente"), ("n2", None)], "id string, vigencia string")
    articles = spark.createDataFrame([("n1:1", "n1", False), ("n1:2", "n1", True), ("n2:1", "n2", False)], "id string, norma string, has_versions boolean")
    edges = spark.createDataFrame(
        [("s", "n1:1", "INEXEQUIBLE", "jurisprudencia", None, "Artículo 1", "C-2"), ("s", "n1:1", "INEXEQUIBLE", "jurisprudencia", None, "Artículo 1", "C-1"), ("s", "n2", "DECLARA_INEXEQUIBLE", "resuelve", "INEXEQUIBLE", None, "C-9"), ("s", "n1", "DEROGA_TOTAL", "suin", None, "Artículo 7", "L"), ("s", "n1", "DEROGA_TOTAL", "otro", None, "", "L")],
        "src string, dst string, rel string, source string, tipo string, articulo string, texto string",
    )
    got = rows(validity.graph_reports(norms, articles, edges))
    assert got == sorted([("n1", "norma", "vigente", True, "Vigente"), ("n2", "norma", "desconocido", True, "Estado de vigencia no determinado"), ("n1:1", "articulo", "inexequible", False, "Declarado inexequible por C-1"), ("n1:2", "articulo", "modificado", True, "Vigente con modificaciones"), ("n2:1", "articulo", "inexequible", False, "Declarado inexequible por C-9")], key=str)


def test_article_reports(spark):
    articles = spark.createDataFrame([("d", "a1", "1", False), ("d", "a2", "2", True)], "doc_id string, art_id string, number_normalized string, has_versions boolean")
    touched = spark.createDataFrame([("d", 0, "modification", "Artículo 1", "DEROGA_TOTAL", "L"), ("d", 1, "jurisprudence", "Documento completo", "EXEQUIBLE", "C")], "doc_id string, pos int, kind string, article_affected string, normalized_type string, source_text string")
    norms = spark.createDataFrame([("d", "Vigente")], "doc_id string, vigencia string")
    assert rows(validity.article_reports(articles, touched, norms).select("art_id", "estado")) == [("a1", "derogado"), ("a2", "modificado")]


def test_incoming_edges(spark):
    assert rows(graph.citation_edges(spark.createDataFrame([("a", "Sentencia C-1 de 2000"), ("a", " "), ("a", None), ("a", "nada")], "src string, cita string")).select("dst", "dst_label")) == [("co:sentencia:cc:plena:c-1:2000", "Sentencia")]
    touched = spark.createDataFrame([("d", "modification", "Artículo 1", "MODIFICA", "Ley 8 de 2010"), ("d", "jurisprudence", "Artículo 9", "EXEQUIBLE", "Sentencia C-1 de 2000"), ("d", "modification", "", "raro", "sin norma")], "doc_id string, kind string, article_affected string, normalized_type string, source_text string")
    known = spark.createDataFrame([("d", "co:ley:5:2000")], "doc_id string, canonical_id string")
    articles = spark.createDataFrame([("d", "1", "co:ley:5:2000:art:1")], "doc_id string, number_normalized string, canonical_id string")
    assert rows(graph.affectation_edges(touched, known, articles).select("src", "dst", "rel", "source", "anio")) == [("co:ley:8:2010", "co:ley:5:2000:art:1", "MODIFICA", "suin", "2010"), ("co:sentencia:cc:plena:c-1:2000", "co:ley:5:2000", "EXEQUIBLE", "jurisprudencia", "2000")]
    orders = spark.createDataFrame([("s", "2020", 1, "INEXEQUIBLE", None, None, [("ley", "", "5", "2000", "1", None), ("codigo", "", None, None, None, "civil")]), ("s", "2020", 2, "OTRO", None, None, [])], f"src string, anio string, order_number int, decision_type string, scope string, condicion string, targets array<{schemas.CITATION}>")
    assert rows(graph.decision_edges(orders).select("dst", "rel", "tipo")) == [("co:ley:5:2000", "DECLARA_INEXEQUIBLE", "INEXEQUIBLE"), ("co:ley:5:2000:art:1", "DECLARA_INEXEQUIBLE", "INEXEQUIBLE")]
    merged = graph.merged_nodes(spark.createDataFrame([("a", "Norma", None)], "id string, label string, nombre string"), spark.createDataFrame([("a", "Norma", "A"), ("b", "Norma", "B")], "id string, label string, nombre string"))
    assert rows(merged) == [("a", "Norma", "A", True), ("b", "Norma", "B", False)]


def test_map_rulings(spark):
    md = "Sala de Casación Civil\nMagistrado Ponente: *Juan Paz*\n# I. ANTECEDENTES\nLa Ley 5 de 2000.\n# II. DECISIÓN\nPRIMERO.- Declarar EXEQUIBLE el artículo 1 de la Ley 5 de 2000.\nSegundo. Exhortar."
    docs = spark.createDataFrame([("1", None, "C-1", "2020", None, "", md), ("2", "SENTENCIA", None, None, "ce", "Eva", None)], "suin_id string, tipo string, numero string, anio string, corte string, magistrado_ponente string, md string")
    one, two = rulings.map_rulings(docs).orderBy("suin_id").collect()
    assert (one.tipo, one.corte, one.sala, one.magistrado_ponente) == ("SENTENCIA", "Corte Constitucional", "Civil", "Juan Paz")
    assert [o.decision_type for o in one.orders] == ["EXEQUIBLE", "OTRO"] and one.orders[0].targets[0].numero == "5"
    assert "Ley 5 de 2000" in one.hechos and one.resuelve.startswith("II. DECISIÓN") and len(one.sections) == 3
    assert set(one.citaciones) == {"Artículo 1 de la Ley 5 de 2000", "Ley 5 de 2000"}
    assert (two.sala, two.magistrado_ponente, two.sections, two.orders, two.citaciones, two.hechos) == ("Plena", "Eva", [], [], [], "")


def test_chunks(spark):
    sections = spark.createDataFrame([("s", 0, "I. HECHOS", "ANTECEDENTES", "uno")], "doc_id string, seq int, original_heading string, normalized_section string, text string")
    buckets = spark.createDataFrame([("s", "x", "", ""), ("b", "los hechos", "", "lo resuelto"), ("f", "", "", "")], "doc_id string, hechos string, consideraciones string, resuelve string")
    texts = spark.createDataFrame([("s", "t"), ("b", "t"), ("f", "todo el texto")], "doc_id string, text string")
    known = spark.createDataFrame([(d, f"co:{d}", "C-1", "2020", "cc") for d in "sbf"], "doc_id string, norm_canonical_id string, numero string, anio string, corte string")
    chunks = chunking.chunk_rulings(sections, buckets, texts.join(known, "doc_id").select("doc_id", "text"), known)
    assert rows(chunks.select("canonical_id", "body")) == [("co:b:hechos", "los hechos"), ("co:b:resuelve", "lo resuelto"), ("co:f:texto", "todo el texto"), ("co:s:sec:0:antecedentes", "uno")]
    keyed = chunks.withColumn("doc_id", F.element_at(F.split("canonical_id", ":"), 2))
    assert rows(chunking.api_chunks(keyed).select("chunk_id", "text", "char_count", "derogado")) == [(1, "los hechos", 10, None), (1, "todo el texto", 13, None), (1, "uno", 3, None), (2, "lo resuelto", 11, None)]
    table = lambda *r: spark.createDataFrame(list(r), "uid string, text string, v int")
    assert rows(chunking.upsert_chunks(table(("u", "old", 1), ("w", "kept", 1)), table(("u", "a", 1), ("u", "b", 2)), [F.desc("v")]).select("uid", "text")) == [("u", "b"), ("w", "kept")]


def test_catalog_helpers(spark):
    assert rows(catalog.unmapped_log(parsed_norm(spark).withColumn("jurisprudence", F.col("modifications")))) == [("5", "Extraño", "", "Decreto 4 de 2011", "(x)")] * 2
    raw = spark.createDataFrame([(" a ", "NULL", "")], "x string, y string, z string")
    assert rows(catalog.clean_fields(raw, {"x": "p", "y": "q", "z": "r", "w": "s"}, {"p": "no", "s": "yes"})) == [("a", None, None, "yes")]
    seeds = spark.createDataFrame([("corte_constitucional", "T-1", "2020", None, None), ("csj", "SL 1", "2020", None, None), ("otro", "1", "2020", "e", None), ("otro", "1", "2020", None, None)], "source string, numero string, anio string, external_id string, suin_id string")
    assert rows(catalog.identity_resolve(seeds).select("suin_id", "resolve_status")) == [("SL1-2020", "resolved"), ("e", "resolved"), ("t-1-20", "resolved"), (None, "error")]
    empty = spark.createDataFrame([("LEY", "1", "2020", None, "Ministerio", None, None, None, "7", None, None, None, None)], "tipo string, numero string, anio string, sector string, entidad string, corte string, source string, external_id string, suin_id string, canonical_id string, rama string, cabeza string, entidad_norm string")
    filled = catalog.backfilled(empty).first()
    assert (filled.source, filled.external_id, filled.canonical_id, filled.entidad_norm) == ("suin", "7", "co:ley:1:2020", "ministerio") and filled.rama
    found = spark.createDataFrame([("CÓDIGO civil", 1), ("otro", 2)], "t string, k int")
    assert search.keyword_search(found, "codigo", ["t"], 5, [F.col("k")]).count() == 0
    assert search.keyword_search(found, "codigo", ["t"], 5, [F.col("k")], accents=False).count() == 1
    events = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "event_type string, value double").withColumn("ts", F.timestamp_seconds(F.lit(0)))
    assert rows(incremental.event_windows(events).select("event_type", "n", "total")) == [("a", 2, 3.0)]


def test_more_listings(spark):
    page = lambda html: spark.createDataFrame([(html,)], "html string")
    link = '<a href="/relatoria/media/file/{}">{}</a>'
    html = "<p>Fallo de 2019 " + link.format("A-1.pdf", "ver") + "</p><p>Concepto 2021 " + link.format("B-2.pdf", "ver") + "</p><p>Auto 2018 <a href='/guia/x/docs/c.html'>h</a> " + link.format("D-4.pdf", "nada") + " fin</p>" + link.format("A-1.pdf", "again 1999")
    assert rows(connectors.prosecutor_results(page(html), "html").select("numero", "tipo", "anio"))[:2] == [("A-1", "FALLO DISCIPLINARIO", "2019"), ("B-2", "CONCEPTO", "2021")]
    assert rows(connectors.prosecutor_results(page(html), "html").select("numero", "tipo", "anio"))[2] == ("D-4", "CONCEPTO", "1999")
    items = spark.createDataFrame([(1, "Auto 2", "Auto", "2020", None, "JEP", "x.html"), (0, "Sentencia 1", "Sentencia", "2019", "1", "JEP", "x.html"), (2, "n", "t", "2020", None, "JEP", " ")], "pos int, nombre string, tipo string, year string, numero string, entidad string, link string")
    assert rows(connectors.jep_items(items, mirrors=True).select("tipo", "numero", "anio", "corte")) == [("SENTENCIA", "1", "2019", "jep")]
    names = spark.createDataFrame([("República Dominicana Sentencia",), ("peru y",), ("Otro Estado",), (None,)], "c string")
    assert rows(names.select(connectors.leading_country(F.col("c")))) == sorted([("República Dominicana",), ("Perú",), ("Otro",), (None,)], key=str)
    listing = '<a href="ver_ficha_tecnica.cfm?nId_Ficha=7"> <b>Caso  Uno</b></a><a href="?nId_Ficha=7">x</a><a href="?nId_Ficha=8">'
    assert rows(connectors.iachr_listing(page(listing), "html")) == [("7", "Caso Uno"), ("8", None)]
    bogota = '<a href="Norma1.jsp?i=12">Decreto 5 de 2001 Alcaldía</a><a href="Norma1.jsp?i=12">Decreto 5 de 2001</a>'
    assert rows(connectors.bogota_index(page(bogota), "html").select("tipo", "numero", "anio", "external_id")) == [("DECRETO", "5", "2001", "12")]
    treaty = spark.createDataFrame([("Tratado de Límites", "1999-01-02T00:00", "SI", "Ley 1", None)], "nombretratado string, fechaadopcion string, vigente string, numeroleyaprobatoria string, sentencianumero string")
    got = connectors.treaty_dataset(treaty).first()
    assert (got.numero, got.anio, got.extra["vigencia"]) == ("tratado-de-limites", "1999", "Vigente")
    assert connectors.in_window(spark.createDataFrame([("1999",), ("2005",), (None,)], "anio string"), 2000, 2010).count() == 2


def test_global_links_in_parts(spark, monkeypatch):
    """Large graphs are dealt to parts by their number of edges, a busy node's edges too; no table of nodes is sent whole to a task."""
    pairs = [(f"c{i % 7}", f"p{i % 11}", "AB"[i % 2]) for i in range(300)] + [("c0", f"p{i}", "A") for i in range(200)] + [("x", "y", "A"), ("p1", "c0", "A"), ("c1", "c1", "B"), (None, "p1", "A"), ("c1", None, "A")]
    edges = spark.createDataFrame(pairs, "src string, dst string, rel string")
    known = [f"c{i}" for i in range(5)] + [f"p{i}" for i in range(0, 9, 2)] + ["c0"]
    nodes = spark.createDataFrame([(i,) for i in known], "id string")
    monkeypatch.setattr(graph, "PART_ROWS", 20)
    for ghosts in (True, False):
        want = {(*sorted((a or b, b or a)), r) for a, b, r in pairs if r != "B" and ((a in known or b in known) if ghosts else (a in known and b in known))}
        found = graph.global_links(edges, nodes, ("B",), ghosts)
        assert rows(found) == sorted(want, key=str)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and f", {-(-len(pairs) // 20)})" in plan
