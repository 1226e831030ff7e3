"""Validity of norms and articles, and the text in force at a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text, vocab
from .affectations import affects, whole_document


def classify_validity(changes: Column, rulings: Column, norm_validity: Column) -> Column:
    """struct(estado, vigente, motivo), by falling severity.

    ``changes`` is an array of types; ``rulings`` an array of struct(tipo, fuente) in list order:
    the first source of the deciding type is quoted.
    """
    types = F.transform(rulings, lambda r: r["tipo"])
    source = lambda t: F.coalesce(F.get(F.filter(rulings, lambda r: r["tipo"] == t), 0)["fuente"], F.lit(""))
    state = F.lower(F.trim(F.coalesce(norm_validity, F.lit(""))))
    out = lambda e, v, m: F.struct(F.lit(e).alias("estado"), F.lit(v).alias("vigente"), (F.lit(m) if isinstance(m, str) else m).alias("motivo"))
    quoted = lambda words, t: F.trim(F.concat(F.lit(words), source(t)))
    return (
        F.when(F.array_contains(types, "INEXEQUIBLE"), out("inexequible", False, quoted("Declarado inexequible por ", "INEXEQUIBLE")))
        .when(F.array_contains(changes, "DEROGA_TOTAL"), out("derogado", False, "Derogado totalmente"))
        .when(state.startswith("derogad"), out("derogado", False, "Norma derogada"))
        .when(F.array_contains(changes, "SUSPENDE"), out("suspendido", False, "Suspendido"))
        .when(F.array_contains(types, "EXEQUIBLE_CONDICIONADA"), out("exequible_condicionada", True, quoted("Exequible de forma condicionada por ", "EXEQUIBLE_CONDICIONADA")))
        .when(F.arrays_overlap(changes, F.array(*map(F.lit, vocab.REPORT_MODIFYING))), out("modificado", True, "Vigente con modificaciones"))
        .when(state.startswith("vigente"), out("vigente", True, "Vigente"))
        .otherwise(out("desconocido", True, "Estado de vigencia no determinado"))
    )


def version_timeline(versions: DataFrame, current: DataFrame, key: list[str]) -> DataFrame:
    """key, orden, texto, desde, hasta, vigente: earlier versions by start (unknown first), then the current.

    versions: key, pos, text, date_range. current: key, text. The current one starts where the last
    known end is.
    """
    past = versions.withColumn("_r", text.date_range(F.col("date_range"))).select(*key, "pos", F.col("text").alias("texto"), "_r.desde", "_r.hasta")
    ends = past.groupBy(*key).agg(F.max("hasta").alias("desde"))
    now = current.select(*key, F.col("text").alias("texto")).join(ends, key, "left").select(*key, F.lit(None).cast("int").alias("pos"), "texto", "desde", F.lit(None).cast("date").alias("hasta"), F.lit(True).alias("vigente"))
    both = past.withColumn("vigente", F.lit(False)).unionByName(now)
    order = Window.partitionBy(*key).orderBy("vigente", F.col("desde").asc_nulls_first(), "pos")
    return both.withColumn("orden", F.row_number().over(order)).select(*key, "orden", "texto", "desde", "hasta", "vigente")


def text_as_of(timeline: DataFrame, key: list[str], at: Column | None) -> DataFrame:
    """The version in force at a date: the first one whose closed interval holds it, else the current.

    Without a date it is the current one. One pass: the least order among the versions that hold.
    """
    holds = F.lit(False) if at is None else (F.col("desde").isNull() | (at >= F.col("desde"))) & (F.col("hasta").isNull() | (at <= F.col("hasta")))
    rank = F.when(F.coalesce(holds, F.lit(False)), F.col("orden")).otherwise(F.when(F.col("vigente"), F.lit(1 << 30)))
    return timeline.groupBy(*key).agg(F.min_by(F.struct("texto", "desde", "hasta", "vigente"), rank).alias("v")).select(*key, "v.*")


#: A span of days is halved so often; day numbers count from NIL.
LEVELS, NIL = 18, -200_000


def _nodes_of_day(day: Column) -> Column:
    """The nodes of the tree over days that hold a day: (level, number), the day first."""
    return F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda k: F.struct(k.alias("level"), F.floor(day / F.pow(F.lit(2), k)).cast("int").alias("number")))


def _nodes_of_span(first: Column, last: Column) -> Column:
    """The fewest nodes that make up the days ``first`` to ``last``: at most two a level."""
    start = F.struct(first.alias("a"), last.alias("b"), F.array().cast("array<struct<level:int,number:int>>").alias("out"))

    def step(s: Column, k: Column) -> Column:
        node = lambda n: F.array(F.struct(k.alias("level"), n.alias("number")))
        none = F.array().cast("array<struct<level:int,number:int>>")
        open_ = s["a"] <= s["b"]
        left = open_ & (s["a"] % 2 == 1)
        right = open_ & (s["b"] % 2 == 0) & ~(left & (s["a"] == s["b"]))
        out = F.concat(s["out"], F.when(left, node(s["a"])).otherwise(none), F.when(right, node(s["b"])).otherwise(none))
        a, b = F.when(left, s["a"] + 1).otherwise(s["a"]), F.when(right, s["b"] - 1).otherwise(s["b"])
        # what is empty stays so: its ends go on as 1 and 0
        return F.when(a <= b, F.struct(F.floor(a / 2).cast("int").alias("a"), F.floor(b / 2).cast("int").alias("b"), out.alias("out"))).otherwise(F.struct(F.lit(1).alias("a"), F.lit(0).alias("b"), out.alias("out")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS)), start, step, lambda s: s["out"])


def texts_as_of(timeline: DataFrame, key: list[str], requests: DataFrame, at: str = "at") -> DataFrame:
    """key, at, texto, desde, hasta, vigente: for each distinct (key, date) asked for what ``text_as_of`` gives.

    Versions hold over spans of days, which are cut into nodes of a tree of halved spans; a day meets the
    nodes that hold it, and one more for the current version. Of the versions of a key on one node only
    the first counts, so a date meets at most one row a node, however many versions a key has, and
    most dates of one key meet on nodes of their own. A null date asks for the current version; keys
    without versions have no row.
    """
    day = lambda c: (F.unix_date(c) - NIL).cast("int")
    rows = timeline.withColumns({"_a": F.coalesce(day(F.col("desde")), F.lit(0)), "_b": F.coalesce(day(F.col("hasta")), F.lit((1 << LEVELS) - 1))})
    version = lambda rank: F.struct(rank.alias("k"), "texto", "desde", "hasta", "vigente").alias("_v")
    current = F.struct(F.lit(-1).alias("level"), F.lit(0).alias("number"))
    held = rows.where("_a <= _b").select(*key, F.explode(_nodes_of_span(F.col("_a"), F.col("_b"))).alias("_n"), version(F.col("orden")))
    held = held.unionByName(timeline.where("vigente").select(*key, current.alias("_n"), version(F.col("orden") + (1 << 30))))
    held = held.groupBy(*key, "_n").agg(F.min_by("_v", F.col("_v.k")).alias("_v"))
    asked = requests.select(*key, F.col(at).cast("date").alias("at")).distinct()
    nodes = F.when(F.col("at").isNull(), F.array(current)).otherwise(F.array_append(_nodes_of_day(day(F.col("at"))), current))
    met = asked.select(*key, "at", F.explode(nodes).alias("_n")).join(held, [*key, "_n"])
    return met.groupBy(*key, "at").agg(F.min_by("_v", F.col("_v.k")).alias("_v")).select(*key, "at", "_v.texto", "_v.desde", "_v.hasta", "_v.vigente")


def article_reports(articles: DataFrame, affectations: DataFrame, norms: DataFrame) -> DataFrame:
    """doc_id, art_id, estado, vigente, motivo of every article.

    articles: doc_id, art_id, number_normalized, has_versions. affectations: doc_id, pos, kind
    (``modification`` or ``jurisprudence``), article_affected, normalized_type, source_text.
    norms: doc_id, vigencia. The document stays the join key; the article test is a residual.
    """
    joined = articles.join(affectations, "doc_id", "left").where(F.col("kind").isNull() | affects(F.col("article_affected"), F.col("number_normalized")))
    return _reports(articles, joined, ["doc_id", "art_id"], norms, articles.select("doc_id", "art_id", "has_versions"))


def norm_reports(norms: DataFrame, affectations: DataFrame) -> DataFrame:
    """doc_id, estado, vigente, motivo of every norm, by what falls on the whole document."""
    return _reports(norms, affectations.where(whole_document(F.col("article_affected"))), ["doc_id"], norms, None)


def _reports(base: DataFrame, touching: DataFrame, key: list[str], norms: DataFrame, versions: DataFrame | None) -> DataFrame:
    changes = F.collect_set(F.when(F.col("kind") == "modification", F.coalesce("normalized_type", F.lit(vocab.UNKNOWN_AFFECTATION))))
    rulings = F.sort_array(F.collect_list(F.when(F.col("kind") == "jurisprudence", F.struct("pos", F.col("normalized_type").alias("tipo"), F.col("source_text").alias("fuente")))))
    found = touching.groupBy(*key).agg(changes.alias("_c"), rulings.alias("_j"))
    none = F.array().cast("array<string>")
    empty = F.array().cast("array<struct<pos:int,tipo:string,fuente:string>>")
    out = base.select(*key).distinct().join(found, key, "left").join(norms.select("doc_id", "vigencia"), "doc_id")
    out = out.withColumn("_r", classify_validity(F.coalesce("_c", none), F.coalesce(F.col("_j"), empty), F.col("vigencia"))).select(*key, "_r.*")
    if versions is None:
        return out
    out = out.join(versions, key)
    changed = F.col("estado").isin("vigente", "desconocido") & F.col("has_versions")
    return out.withColumn("motivo", F.when(changed, "Vigente con modificaciones").otherwise(F.col("motivo"))).withColumn("estado", F.when(changed, "modificado").otherwise(F.col("estado"))).drop("has_versions")


#: Origins of edges that decide validity, and those that are rulings.
EDGE_SOURCES, RULING_SOURCES = ("suin", "jurisprudencia", "resuelve"), ("jurisprudencia", "resuelve")


def graph_reports(norms: DataFrame, articles: DataFrame, edges: DataFrame) -> DataFrame:
    """id, nivel, estado, vigente, motivo of norms and articles, from the edges that come in.

    norms: id, vigencia. articles: id, norma, has_versions. edges: src, dst, rel, source, tipo,
    articulo, texto. An article takes its own edges and those on its whole norm. A type is ``tipo``,
    else the relation; on norms it is the relation. Edges have no order: of several sources of a type
    the least text is quoted, the article's own first. Edges are brought down to one row a target,
    type and origin before anything is joined.
    """
    ruled = F.col("source").isin(*RULING_SOURCES)
    known = edges.where(F.col("source").isin(*EDGE_SOURCES))
    few = known.groupBy("dst", whole_document(F.col("articulo")).alias("whole"), ruled.alias("ruled"), "rel", F.coalesce("tipo", "rel").alias("tipo")).agg(F.min(F.coalesce("texto", F.lit(""))).alias("fuente"))
    none, empty = F.array().cast("array<string>"), F.array().cast("array<struct<fuente:string,tipo:string>>")

    def summed(rows: DataFrame, kind: str, changes: str, rulings: str) -> DataFrame:
        own = F.collect_set(F.when(~F.col("ruled"), F.col(kind))).alias(changes)
        said = F.sort_array(F.collect_set(F.when(F.col("ruled"), F.struct("fuente", F.col(kind).alias("tipo"))))).alias(rulings)
        return rows.groupBy("dst").agg(own, said)

    def judged(rows: DataFrame, changes: Column, rulings: Column) -> DataFrame:
        return rows.withColumn("_r", classify_validity(changes, rulings, F.col("vigencia")))

    whole = few.where("whole")
    of_norm = summed(whole, "rel", "_c", "_j").withColumnRenamed("dst", "id")
    top = judged(norms.select("id", "vigencia").join(of_norm, "id", "left"), F.coalesce("_c", none), F.coalesce("_j", empty)).select("id", F.lit("norma").alias("nivel"), "_r.*")
    falls = summed(whole, "tipo", "_nc", "_nj").withColumnRenamed("dst", "norma")
    own = summed(few, "tipo", "_c", "_j").withColumnRenamed("dst", "id")
    rows = articles.select("id", "norma", "has_versions").join(norms.select(F.col("id").alias("norma"), "vigencia"), "norma").join(falls, "norma", "left").join(own, "id", "left")
    rows = judged(rows, F.array_union(F.coalesce("_c", none), F.coalesce("_nc", none)), F.concat(F.coalesce("_j", empty), F.coalesce("_nj", empty)))
    changed = F.col("_r.estado").isin("vigente", "desconocido") & F.coalesce("has_versions", F.lit(False))
    state = F.when(changed, "modificado").otherwise(F.col("_r.estado")).alias("estado")
    why = F.when(changed, "Vigente con modificaciones").otherwise(F.col("_r.motivo")).alias("motivo")
    return top.unionByName(rows.select("id", F.lit("articulo").alias("nivel"), state, "_r.vigente", why))
