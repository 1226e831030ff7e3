"""Nodes and edges from catalog rows and parsed documents, and the graph around single documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .graph import MOST_CITATIONS, citation_node, toc_parents

#: Letters of a text that a node keeps, of a judge's name and id, of a shown name.
TEXT_MOST, JUDGE_MOST, JUDGE_ID_MOST, NAME_MOST, REFERENCE_MOST = 2000, 60, 40, 50, 30
#: Sections of a ruling that are nodes of its own graph.
RULING_PARTS = ("hechos", "consideraciones", "resuelve")


def norm_id(catalog_tipo: str = "tipo") -> Column:
    """Canonical id of a catalog row, else one put together from type, number and year."""
    made = F.concat_ws(":", F.lit("co"), F.lower(catalog_tipo), F.coalesce("numero", F.lit("?")), F.coalesce("anio", F.lit("?")))
    return F.coalesce("canonical_id", made)


def ruling_id() -> Column:
    made = F.concat_ws(":", F.lit("co:sentencia"), F.coalesce("corte", F.lit("cc")), F.coalesce("numero", F.lit("?")), F.coalesce("anio", F.lit("?")))
    return F.coalesce("canonical_id", made)


def _last(rows: DataFrame, order: str) -> DataFrame:
    """One row an id, the last by ``order``: what repeated merges leave."""
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc(order)))
    return rows.withColumn("_r", rank).where("_r = 1").drop("_r", order)


def norm_nodes(catalog: DataFrame) -> DataFrame:
    """(id, label, tipo, numero, anio, suin_id) of catalog rows (id gives the order) that are no rulings."""
    rows = catalog.where("tipo <> 'SENTENCIA'").withColumn("_order", F.col("id"))
    return _last(rows.select(norm_id().alias("id"), F.lit("Norma").alias("label"), "tipo", "numero", "anio", "suin_id", "_order"), "_order")


def article_nodes(norms: DataFrame, parsed: DataFrame) -> DataFrame:
    """(id, label, norma, titulo, texto, numero, versiones) of the articles of parsed norms.

    norms: id, suin_id. parsed: suin_id, articles. Of articles with one id the last stays.
    """
    rows = parsed.select("suin_id", F.posexplode("articles").alias("_order", "a")).join(norms.select("suin_id", F.col("id").alias("norma")), "suin_id")
    ident = F.coalesce("a.canonical_id", F.concat("norma", F.lit(":art:"), F.coalesce("a.number_normalized", F.lit("?"))))
    blank = lambda c: F.coalesce(c, F.lit(""))
    fields = [blank("a.title").alias("titulo"), blank("a.text").alias("texto"), blank("a.number_normalized").alias("numero"), F.col("a.previous_versions").alias("versiones")]
    return _last(rows.select(ident.alias("id"), F.lit("Articulo").alias("label"), "norma", *fields, "_order"), "_order")


def belongs_edges(articles: DataFrame) -> DataFrame:
    return articles.select(F.col("id").alias("src"), F.col("norma").alias("dst"), F.lit("PERTENECE_A").alias("rel"))


def relation(kind: Column) -> Column:
    """Relation name of an affectation type."""
    return F.when(kind.rlike("^[A-Z_]+$"), kind).otherwise("AFECTA")


def outgoing_edges(norms: DataFrame, parsed: DataFrame) -> DataFrame:
    """(src, dst, rel, source, texto, dst_nombre): what the articles of a norm do to other norms.

    A norm has one edge a relation and target: that of the first article and reference. Targets that
    are not recognised are skipped.
    """
    rows = parsed.select("suin_id", F.posexplode("articles").alias("_a", "a")).select("suin_id", "_a", F.posexplode("a.affects").alias("_k", "x"))
    rows = rows.join(norms.select("suin_id", F.col("id").alias("src")), "suin_id").withColumn("_n", citation_node(F.col("x.target_text"))).where("_n IS NOT NULL")
    first = F.min(F.struct("_a", "_k", F.col("x.target_text").alias("texto"), F.col("_n.nombre").alias("nombre"))).alias("v")
    out = rows.groupBy("src", F.col("_n.id").alias("dst"), relation(F.col("x.normalized_type")).alias("rel")).agg(first)
    return out.select("src", "dst", "rel", F.lit("suin").alias("source"), F.col("v.texto").alias("texto"), F.col("v.nombre").alias("dst_nombre"))


def ruling_nodes(catalog: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    """(id, label, corte, magistrado, numero, anio, suin_id, resuelve, hechos); texts where a parsed ruling is stored."""
    rows = catalog.where("tipo = 'SENTENCIA'").select(F.col("id").alias("_order"), ruling_id().alias("id"), F.lit("Sentencia").alias("label"), "corte", F.col("magistrado_ponente").alias("magistrado"), "numero", "anio", "suin_id", "scrape_status")
    rows = _last(rows, "_order")
    if parsed is None:
        return rows.drop("scrape_status")
    shown = parsed.select("suin_id", *[F.substring(F.coalesce(c, F.lit("")), 1, TEXT_MOST).alias(c) for c in ("resuelve", "hechos")], F.lit("done").alias("scrape_status"))
    return rows.join(shown, ["suin_id", "scrape_status"], "left").select("id", "label", "corte", "magistrado", "numero", "anio", "suin_id", "resuelve", "hechos")


def judge_name(c: Column) -> Column:
    """Shown name; null if blank."""
    return F.nullif(F.substring(F.trim(c), 1, JUDGE_MOST), F.lit(""))


def judge_id(name: Column) -> Column:
    return F.concat(F.lit("mag_"), F.substring(F.regexp_replace(F.lower(name), "[^a-z0-9]", "_"), 1, JUDGE_ID_MOST))


def judge_nodes(rulings: DataFrame) -> DataFrame:
    """(id, label, nombre) of the judges of ruling nodes; of several spellings of an id the greatest stays."""
    rows = rulings.select(judge_name(F.col("magistrado")).alias("nombre")).where("nombre IS NOT NULL")
    return rows.groupBy(judge_id(F.col("nombre")).alias("id")).agg(F.max("nombre").alias("nombre")).select("id", F.lit("Magistrado").alias("label"), "nombre")


def judge_edges(rulings: DataFrame) -> DataFrame:
    rows = rulings.select("id", judge_name(F.col("magistrado")).alias("_n")).where("_n IS NOT NULL")
    return rows.select(judge_id(F.col("_n")).alias("src"), F.col("id").alias("dst"), F.lit("FUE_PONENTE_DE").alias("rel")).distinct()


def _links(rows: DataFrame, doc: str, other: Column, name: Column, group: Column, val: int, label: Column, outward: bool, pos: Column) -> DataFrame:
    """Rows of ``document_graph``: one neighbour each."""
    ends = (F.col(doc), other) if outward else (other, F.col(doc))
    return rows.select(doc, pos.cast("long").alias("pos"), other.alias("id"), name.alias("name"), group.alias("group"), F.lit(val).alias("val"), ends[0].alias("source"), ends[1].alias("target"), label.alias("label")).where("id <> ''")


def document_graph(parsed: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (suin_id, id, name, group, val) and links (suin_id, source, target, label) around each parsed document.

    parsed: as ``PARSED_RULING`` (norms have null ruling columns). catalog: suin_id, tipo, numero,
    anio. A norm with a table of contents shows its divisions and articles, one without it its
    articles, a ruling its parts; then affectations both ways, the first MOST_CITATIONS distinct
    citations with a node for the rest, and the judge. A node keeps the name of its first mention.
    """
    doc = "suin_id"
    rows = parsed.drop("tipo", "numero", "anio").join(catalog.select(doc, "tipo", "numero", "anio"), doc)
    ruling = F.col("tipo") == "SENTENCIA"
    contents = F.coalesce(F.size("toc"), F.lit(0)) > 0
    cut = lambda c: F.substring(c, 1, NAME_MOST)
    word = F.lit
    centre = rows.select(doc, F.lit(-1).cast("long").alias("pos"), F.col(doc).alias("id"), F.concat_ws(" ", "tipo", "numero", F.lit("de"), "anio").alias("name"), word("norma").alias("group"), F.lit(10).alias("val"))
    parts = []
    for k, part in enumerate(RULING_PARTS):
        some = rows.where(ruling & (F.coalesce(F.col(part), F.lit("")) != ""))
        parts.append(_links(some, doc, F.concat(doc, F.lit(f"#{part}")), word(part.title()), word("seccion"), 5, word("CONTIENE"), False, F.lit(k)))
    toc = rows.where(~ruling & contents).select(doc, F.posexplode("toc").alias("pos", "t"))
    anchored = F.coalesce(F.nullif(F.col("t.anchor"), F.lit("")), F.replace("t.text", F.lit(" "), F.lit("_")))
    toc = toc.withColumns({"id": F.concat(doc, F.lit("#"), anchored), "kind": F.when(F.col("t.level") != "division", "article").when(F.lower("t.text").contains("titulo"), "title").otherwise("chapter")})
    toc = toc_parents(toc, doc, "pos", "kind", plain=True)
    up = toc.select(doc, F.col("pos").alias("parent"), F.col("id").alias("_up"))
    toc = toc.join(up, [doc, "parent"], "left")
    group = text.lookup(F.col("kind"), {"article": "articulo", "title": "titulo", "chapter": "capitulo"})
    parts.append(toc.select(doc, F.col("pos").cast("long").alias("pos"), "id", cut(F.col("t.text")).alias("name"), group.alias("group"), F.when(F.col("kind") == "article", 3).otherwise(6).alias("val"), F.col("id").alias("source"), F.coalesce("_up", doc).alias("target"), word("CONTIENE").alias("label")))
    articles = rows.where(~ruling & ~contents).select(doc, F.posexplode("articles").alias("pos", "a"))
    ident = F.coalesce("a.canonical_id", F.concat(doc, F.lit("#art_"), F.coalesce("a.number", F.lit("?"))))
    parts.append(_links(articles, doc, ident, F.concat(F.lit("Art. "), F.coalesce("a.number", F.lit("?"))), word("articulo"), 3, word("PERTENECE_A"), False, F.col("pos")))
    named = lambda ref, words: F.coalesce(F.nullif(ref, F.lit("")), F.substring(words, 1, REFERENCE_MOST))
    for k, (column, kind, val, default) in enumerate((("modifications", "modificacion", 5, "MODIFICA"), ("jurisprudence", "sentencia", 6, "EXEQUIBLE"))):
        found = rows.select(doc, F.posexplode(column).alias("pos", "x"))
        parts.append(_links(found, doc, named(F.col("x.source_suin_id"), F.col("x.source_text")), cut(F.col("x.source_text")), word(kind), val, F.coalesce("x.normalized_type", word(default)), False, F.col("pos") + (1 + 2 * k) * (1 << 32)))
    outgoing = rows.select(doc, F.posexplode("articles").alias("_a", "a")).select(doc, "_a", F.posexplode("a.affects").alias("_k", "x"))
    target = named(F.col("x.target_suin_id"), F.col("x.target_text"))
    outgoing = outgoing.groupBy(doc, target.alias("to"), F.coalesce("x.normalized_type", word("AFECTA")).alias("rel")).agg(F.min(F.struct("_a", "_k", F.col("x.target_text").alias("t"))).alias("v"))
    parts.append(_links(outgoing, doc, F.col("to"), cut(F.col("v.t")), word("afecta"), 5, F.col("rel"), True, F.col("v._a") + 2 * (1 << 32)))
    cited = rows.select(doc, F.array_remove(F.array_distinct(F.transform("citaciones", lambda c: F.trim(c))), "").alias("_c"))
    shown = cited.select(doc, F.posexplode(F.slice("_c", 1, MOST_CITATIONS)).alias("pos", "c"))
    parts.append(_links(shown, doc, F.col("c"), F.col("c"), F.when(F.lower("c").contains("sentencia"), "sentencia_citada").otherwise("citacion"), 4, word("CITA_A"), True, F.col("pos") + 4 * (1 << 32)))
    over = cited.where(F.size("_c") > MOST_CITATIONS).withColumn("rest", F.size("_c") - MOST_CITATIONS)
    parts.append(_links(over, doc, F.concat(doc, F.lit("__mas_citas")), F.concat(F.lit("+"), F.col("rest").cast("string"), F.lit(" citaciones más")), word("resumen"), 6, word("CITA_A"), True, F.lit(5 * (1 << 32))))
    judged = rows.withColumn("_n", judge_name(F.replace("magistrado_ponente", F.lit(":"), F.lit("")))).where("_n IS NOT NULL")
    mag = F.concat(F.lit("mag_"), F.substring(F.lower(F.replace("_n", F.lit(" "), F.lit("_"))), 1, REFERENCE_MOST))
    parts.append(_links(judged, doc, mag, F.col("_n"), word("magistrado"), 5, word("FUE_PONENTE_DE"), False, F.lit(6 * (1 << 32))))
    every = reduce(DataFrame.unionByName, parts)
    nodes = centre.unionByName(every.select(*centre.columns))
    first = F.min(F.struct("pos", "name", "group", "val")).alias("v")
    return nodes.groupBy(doc, "id").agg(first).select(doc, "id", "v.name", "v.group", "v.val"), every.select(doc, "source", "target", "label")
