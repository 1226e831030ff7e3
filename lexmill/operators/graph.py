"""The citation and affectation graph: nodes, edges, ghosts, neighbourhoods and metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.ids import canonical_id

#: Decision type to (relation, affectation type or null).
DECISION_RELATIONS = {
    "EXEQUIBLE": ("DECLARA_EXEQUIBLE", "EXEQUIBLE"),
    "EXEQUIBLE_CONDICIONADA": ("DECLARA_EXEQUIBLE_CONDICIONADA", "EXEQUIBLE_CONDICIONADA"),
    "INEXEQUIBLE": ("DECLARA_INEXEQUIBLE", "INEXEQUIBLE"),
    "INHIBIDA": ("SE_INHIBE", None),
    "ESTARSE_A_LO_RESUELTO": ("ESTARSE_A_LO_RESUELTO", None),
    "NULIDAD": ("DECLARA_NULIDAD", "INEXEQUIBLE"),
}
MOST_CITATIONS = 30
#: Rows of a part of a large graph, and parts that one node's edges are dealt to.
PART_ROWS, SALTS = 1_000_000, 8


def citation_node(c: Column) -> Column:
    """struct(id, nombre) a citation's text points to; null if nothing is recognised. Articles fall on their norm."""
    group = lambda p, k: F.regexp_extract(c, "(?iuU)" + p, k)
    found = lambda p: c.rlike("(?iuU)" + p)

    def norm(kind: str, name: str, pattern: str) -> tuple[Column, Column]:
        number, year = group(pattern, 1), group(pattern, 2)
        return found(pattern), F.struct(F.concat(F.lit(f"co:{kind}:"), F.lower(number), F.lit(":"), year).alias("id"), F.concat(F.lit(name + " "), number, F.lit(" de "), year).alias("nombre"))

    code = r"\b(C|T|SU|A)-?(\d+)\s*(?:de|/)\s*(\d{4})"
    prefix, number, year = F.upper(group(code, 1)), group(code, 2), group(code, 3)
    chamber = F.when(prefix == "T", "revision").otherwise("plena")
    ruling = F.struct(F.concat(F.lit("co:sentencia:cc:"), chamber, F.lit(":"), F.lower(prefix), F.lit("-"), number, F.lit(":"), year).alias("id"), F.concat(F.lit("Sentencia "), prefix, F.lit("-"), number, F.lit(" de "), year).alias("nombre"))
    rules = [
        norm("ley", "Ley", r"art[ií]culo\s+\S+\s+de\s+la\s+ley\s+(\d+)\s+de\s+(\d{4})"),
        norm("decreto", "Decreto", r"art[ií]culo\s+\S+\s+del\s+decreto\s+(?:ley\s+)?(\d+)\s+de\s+(\d{4})"),
        (found(code), ruling),
        norm("decreto", "Decreto", r"\bdecreto\s+(?:ley\s+)?(\d+)\s+de\s+(\d{4})"),
        norm("ley", "Ley", r"\bley\s+(\d+)\s+de\s+(\d{4})"),
        norm("resolucion", "Resolución", r"\bresoluci[oó]n\s+(\d+)\s+de\s+(\d{4})"),
        norm("acto_legislativo", "Acto Legislativo", r"\bacto\s+legislativo\s+(\d+)\s+de\s+(\d{4})"),
        (found(r"constituci[oó]n"), F.struct(F.lit("co:constitucion:1991").alias("id"), F.lit("Constitución Política de 1991").alias("nombre"))),
    ]
    out = None
    for test, value in rules:
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def upsert_edges(edges: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One edge per key: the last by ``order``."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return edges.withColumn("_r", rank).where("_r = 1").drop("_r")


def citation_edges(citations: DataFrame) -> DataFrame:
    """(src, dst, rel, texto, dst_nombre, dst_label) of (src, cita) rows; blank and unknown texts are skipped."""
    rows = citations.where(F.coalesce(F.trim("cita"), F.lit("")) != "").withColumn("n", citation_node(F.col("cita"))).where("n IS NOT NULL")
    label = F.when(F.lower("cita").contains("sentencia"), "Sentencia").otherwise("Norma")
    return rows.select("src", F.col("n.id").alias("dst"), F.lit("CITA_A").alias("rel"), F.col("cita").alias("texto"), F.col("n.nombre").alias("dst_nombre"), label.alias("dst_label")).distinct()


def affectation_edges(affectations: DataFrame, catalog: DataFrame, articles: DataFrame) -> DataFrame:
    """Incoming affectations as edges from their source's node to the article if its number is known, else the norm.

    affectations: doc_id, kind, article_affected, normalized_type, source_text. catalog: doc_id,
    canonical_id. articles: doc_id, number_normalized, canonical_id.
    """
    rel = F.when(F.col("normalized_type").rlike("^[A-Z_]+$"), F.col("normalized_type")).otherwise("AFECTA")
    rows = affectations.withColumn("_n", citation_node(F.col("source_text"))).where("_n IS NOT NULL").withColumn("_num", text.article_number(F.col("article_affected")))
    arts = articles.select("doc_id", F.col("number_normalized").alias("_num"), F.col("canonical_id").alias("_art"))
    rows = rows.join(catalog.select("doc_id", F.col("canonical_id").alias("_norm")), "doc_id").join(arts, ["doc_id", "_num"], "left")
    year = F.nullif(F.regexp_extract("source_text", r"(\d{4})", 1), F.lit(""))
    origin = F.when(F.col("kind") == "jurisprudence", "jurisprudencia").otherwise("suin")
    return rows.select(F.col("_n.id").alias("src"), F.coalesce("_art", "_norm").alias("dst"), rel.alias("rel"), origin.alias("source"), F.col("normalized_type").alias("tipo"), F.col("article_affected").alias("articulo"), year.alias("anio"), F.col("source_text").alias("texto"))


def decision_edges(orders: DataFrame) -> DataFrame:
    """Edges of operative orders to their targets; an article target also links its norm.

    orders: src, anio, order_number, decision_type, scope, condicion, targets.
    """
    rows = orders.withColumn("rel", text.lookup(F.col("decision_type"), {k: v[0] for k, v in DECISION_RELATIONS.items()})).where("rel IS NOT NULL")
    rows = rows.withColumn("tipo", text.lookup(F.col("decision_type"), {k: v[1] for k, v in DECISION_RELATIONS.items() if v[1]}))
    rows = rows.select("*", F.explode("targets").alias("t")).where("t.numero IS NOT NULL AND t.anio IS NOT NULL")
    norm = canonical_id(F.upper("t.type"), F.col("t.numero"), F.col("t.anio"))
    article = F.when(F.col("t.articulo").isNotNull(), F.concat(norm, F.lit(":art:"), F.lower("t.articulo")))
    rows = rows.withColumn("dst", F.explode(F.array_compact(F.array(article, norm))))
    return rows.select("src", "dst", "rel", "tipo", "anio", F.col("order_number").alias("orden"), "scope", "condicion").distinct()


def ghost_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Targets of edges that were never ingested: (id, n_in)."""
    return edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("n_in")).join(nodes.select("id"), "id", "left_anti")


def merged_nodes(nodes: DataFrame, targets: DataFrame) -> DataFrame:
    """Full upsert of nodes (id, label, nombre) with edge targets; ``ingested`` tells real nodes from ghosts."""
    known = nodes.withColumn("ingested", F.lit(True))
    new = targets.groupBy("id").agg(F.min("label").alias("_label"), F.min("nombre").alias("_nombre"))
    out = known.join(new, "id", "full")
    return out.select("id", F.coalesce("label", "_label").alias("label"), F.coalesce("nombre", "_nombre").alias("nombre"), F.coalesce("ingested", F.lit(False)).alias("ingested"))


def neighbourhood(edges: DataFrame, node: str, relation: str | None = None, direction: str = "ambas", limit: int = 50) -> DataFrame:
    """One hop around a node: (direccion, rel, vecino), at most ``limit`` a direction, in a fixed order."""
    if direction not in ("entrante", "saliente", "ambas"):
        raise ValueError(f"unknown direction {direction!r}")
    found = edges if relation is None else edges.where(F.col("rel") == relation)
    ways = [(d, a, b) for d, a, b in (("saliente", "src", "dst"), ("entrante", "dst", "src")) if direction in (d, "ambas")]
    parts = [found.where(F.col(a) == node).select(F.lit(d).alias("direccion"), "rel", F.col(b).alias("vecino")).distinct().orderBy("rel", "vecino").limit(limit) for d, a, b in ways]
    return reduce(DataFrame.unionByName, parts)


def grouped_neighbours(around: DataFrame) -> DataFrame:
    return around.groupBy("direccion", "rel").agg(F.count("*").alias("total"), F.sort_array(F.collect_list("vecino")).alias("vecinos"))


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` of about ``rows`` rows dealt by ``keys`` to parts of PART_ROWS, if that is more parts than tasks run at once."""
    parts = -(-rows // PART_ROWS)
    return df.repartition(parts, *keys) if parts > df.sparkSession.sparkContext.defaultParallelism else df


def global_links(edges: DataFrame, nodes: DataFrame, excluded: tuple[str, ...] = (), ghosts: bool = True, about: int | None = None) -> DataFrame:
    """Distinct undirected links (a, b, rel) between ingested nodes, and to ghosts if wanted.

    ``about`` is how many edges there are, counted if not given: what a task sorts or keeps does not grow with
    them. A node with many edges meets them in SALTS parts.
    """
    about = edges.count() if about is None else about
    rows = (edges.where(~F.col("rel").isin(*excluded)) if excluded else edges).select("src", "dst", "rel")
    large = -(-about // PART_ROWS) > edges.sparkSession.sparkContext.defaultParallelism
    for end, other, flag in (("src", "dst", "_src"), ("dst", "src", "_dst")):
        known = nodes.select(F.col("id").alias(end)).distinct().withColumn(flag, F.lit(True))
        if large:
            rows = spread(rows.withColumn("_salt", F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int")), about, end, "_salt")
            # nodes are sent to no task whole, which small compressed ids would tempt Spark to
            known = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
        rows = rows.join(known, [end, "_salt"] if large else end, "left").drop("_salt")
    rows = rows.where("_src OR _dst" if ghosts else "_src AND _dst")
    return spread(rows.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), "rel"), about, "a", "b", "rel").distinct()


def degrees(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Links per endpoint."""
    return links.select(F.explode(F.array(a, b)).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))


def node_size(ingested: Column, label: Column, degree: Column) -> Column:
    return F.when(~ingested, F.least(4 + degree, F.lit(22))).when(label == "Sentencia", 10).otherwise(8)


def capped_neighbours(edges: DataFrame, node: str, item: str, order: list[Column], most: int = MOST_CITATIONS) -> DataFrame:
    """First ``most`` items of each node and one overflow row with the count of the rest (item null)."""
    rank = Window.partitionBy(node).orderBy(*order)
    ranked = edges.withColumn("pos", F.row_number().over(rank))
    shown = ranked.where(F.col("pos") <= most).select(node, "pos", item, F.lit(0).cast("long").alias("rest"))
    over = edges.groupBy(node).agg((F.count("*") - most).alias("rest")).where("rest > 0")
    return shown.unionByName(over.select(node, F.lit(most + 1).alias("pos"), F.lit(None).cast(dict(edges.dtypes)[item]).alias(item), "rest"))


def toc_parents(toc: DataFrame, doc: str, pos: str, kind: str, plain: bool = False) -> DataFrame:
    """Adds parent (position of the containing entry): chapters belong to the last title, articles to
    the innermost open division. ``kind`` holds title, chapter or article. With ``plain`` a chapter
    that follows a chapter hangs from the root."""
    before = Window.partitionBy(doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    title = F.last(F.when(F.col(kind) == "title", F.col(pos)), ignorenulls=True).over(before)
    chapter = F.last(F.when(F.col(kind) == "chapter", F.col(pos)), ignorenulls=True).over(before)
    open_chapter = F.when(title.isNull() | (chapter > title), chapter)
    of_chapter = F.when(open_chapter.isNull(), title) if plain else title
    return toc.withColumn("parent", F.when(F.col(kind) == "chapter", of_chapter).when(F.col(kind) == "article", F.coalesce(open_chapter, title)))


def integrity(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: nodes, ghosts, isolated, citation_resolution (1 without citations)."""
    touched = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    ghosts = touched.join(nodes.select("id"), "id", "left_anti").agg(F.count("*").alias("ghosts"))
    isolated = nodes.join(touched, "id", "left_anti").agg(F.count("*").alias("isolated"))
    cited = edges.join(nodes.select(F.col("id").alias("dst"), F.lit(1).alias("hit")), "dst", "left").agg(F.count("*").alias("total"), F.count("hit").alias("hits"))
    total = nodes.agg(F.count("*").alias("nodes"))
    out = total.join(F.broadcast(ghosts)).join(F.broadcast(isolated)).join(F.broadcast(cited))  # single rows
    return out.select("nodes", "ghosts", "isolated", F.when(F.col("total") == 0, 1.0).otherwise(F.round(F.col("hits") / F.col("total"), 4)).alias("citation_resolution"))
