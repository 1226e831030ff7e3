"""Retrieval chunks of norms and rulings: clean-boundary text splitting and validity flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text, vocab
from ..functions.ids import canonical_id, chunk_uid
from . import sections as S
from .affectations import index_key
from .catalog import replace_by_key

TRIM = r"^\s+|\s+$"
PARAGRAPH = r"\n\s*\n"


def _trim(c: Column) -> Column:
    return F.regexp_replace(c, TRIM, "")


def hard_windows(c: Column, most: int) -> Column:
    """A string without any boundary in pieces of ``most`` characters."""
    starts = F.sequence(F.lit(0), F.floor((F.length(c) - 1) / most).cast("int"))
    return F.filter(F.transform(starts, lambda i: _trim(F.substring(c, i * most + 1, F.lit(most)))), lambda p: p != "")


def pack_sentences(block: Column, most: int) -> Column:
    """Sentences packed up to ``most`` characters; a longer sentence stands alone, cut hard."""
    sentences = F.filter(F.transform(F.split(block, vocab.SENTENCE_END), _trim), lambda s: s != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("buf"))

    def step(acc: Column, s: Column) -> Column:
        flushed = F.when(acc["buf"] != "", F.array_append(acc["done"], acc["buf"])).otherwise(acc["done"])
        long_ = F.struct(F.concat(flushed, hard_windows(s, most)).alias("done"), F.lit("").alias("buf"))
        full = (acc["buf"] != "") & (F.length(acc["buf"]) + 1 + F.length(s) > most)
        joined = F.when(acc["buf"] == "", s).otherwise(F.concat(acc["buf"], F.lit(" "), s))
        return F.when(F.length(s) > most, long_).when(full, F.struct(flushed.alias("done"), s.alias("buf"))).otherwise(F.struct(acc["done"].alias("done"), joined.alias("buf")))

    return F.aggregate(sentences, start, step, lambda acc: F.when(acc["buf"] != "", F.array_append(acc["done"], acc["buf"])).otherwise(acc["done"]))


def pack_paragraphs(c: Column, most: int = vocab.CHUNK_CHARS) -> Column:
    """Whole paragraphs packed greedily; each counts its length and two, and so does the next one's fit.

    A paragraph over ``most`` flushes what is packed and is packed by sentences instead.
    """
    blocks = F.filter(F.transform(F.split(c, PARAGRAPH), _trim), lambda b: b != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("buf"), F.lit(0).alias("size"))

    def step(acc: Column, b: Column) -> Column:
        flushed = F.when(acc["size"] > 0, F.array_append(acc["done"], acc["buf"])).otherwise(acc["done"])
        alone = F.struct(F.concat(flushed, pack_sentences(b, most)).alias("done"), F.lit("").alias("buf"), F.lit(0).alias("size"))
        fresh = F.struct(flushed.alias("done"), b.alias("buf"), (F.length(b) + 2).alias("size"))
        more = F.struct(acc["done"].alias("done"), F.when(acc["size"] > 0, F.concat(acc["buf"], F.lit("\n\n"), b)).otherwise(b).alias("buf"), (acc["size"] + F.length(b) + 2).alias("size"))
        return F.when(F.length(b) > most, alone).when((acc["size"] > 0) & (acc["size"] + 2 + F.length(b) > most), fresh).otherwise(more)

    return F.aggregate(blocks, start, step, lambda acc: F.when(acc["size"] > 0, F.array_append(acc["done"], acc["buf"])).otherwise(acc["done"]))


def sentence_overlap(pieces: Column, overlap: int = vocab.CHUNK_OVERLAP) -> Column:
    """Each later piece begins with the last sentence of the original piece before it, if short enough.

    One pass carries that sentence along, so that ``pieces`` is made once.
    """
    last = lambda p: _trim(F.element_at(F.filter(F.split(p, vocab.SENTENCE_END), lambda s: F.trim(s) != ""), -1))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("tail"))

    def step(acc: Column, p: Column) -> Column:
        fits = (F.length(acc["tail"]) > 0) & (F.length(acc["tail"]) <= overlap)
        whole = F.when(fits, F.concat(acc["tail"], F.lit("\n\n"), p)).otherwise(p)
        return F.struct(F.array_append(acc["done"], whole).alias("done"), last(p).alias("tail"))

    return F.aggregate(pieces, start, step, lambda acc: acc["done"])


def split_text(c: Column, most: int = vocab.CHUNK_CHARS, overlap: int = vocab.CHUNK_OVERLAP) -> Column:
    """Pieces of a text: none if blank, the text itself if it fits, else packed paragraphs with overlap."""
    whole = _trim(F.coalesce(c, F.lit("")))
    pieces = pack_paragraphs(whole, most)
    out = F.when(whole == "", F.array().cast("array<string>")).when(F.length(whole) <= most, F.array(whole))
    return out.otherwise(sentence_overlap(pieces, overlap) if overlap > 0 else pieces)


def chunk_validity(types: Column, norm_validity: Column) -> Column:
    """struct(estado_vigencia, derogado, derogado_parcial, modificado) of an array of affectation types."""
    has = lambda names: F.coalesce(F.arrays_overlap(types, F.array(*map(F.lit, names))), F.lit(False))
    state = F.lower(F.trim(F.coalesce(norm_validity, F.lit(""))))
    repealed, partly, changed = has(["DEROGA_TOTAL"]), has(["DEROGA_PARCIAL"]), has(vocab.CHUNK_MODIFYING)
    gone = repealed | state.startswith("derogad")
    estado = F.when(gone, "derogado").when(partly | changed, "modificado").when(state.startswith("vigente"), "vigente").otherwise("desconocido")
    return F.struct(estado.alias("estado_vigencia"), gone.alias("derogado"), partly.alias("derogado_parcial"), changed.alias("modificado"))


def _pieces(df: DataFrame, most: int, overlap: int) -> DataFrame:
    """One row per piece of ``body``: chunk_index, n_chunks, piece."""
    out = df.withColumn("_p", split_text(F.col("body"), most, overlap)).withColumn("n_chunks", F.size("_p"))
    return out.select("*", F.posexplode("_p").alias("chunk_index", "piece")).drop("_p", "body").withColumnRenamed("piece", "body")


def _numbered(label: Column) -> Column:
    return F.concat(label, F.when(F.col("n_chunks") > 1, F.concat(F.lit(" ("), (F.col("chunk_index") + 1).cast("string"), F.lit("/"), F.col("n_chunks").cast("string"), F.lit(")"))).otherwise(""))


def chunk_norms(articles: DataFrame, affectations: DataFrame, catalog: DataFrame, most: int = vocab.CHUNK_CHARS, overlap: int = vocab.CHUNK_OVERLAP) -> DataFrame:
    """Chunks of article texts with headers, deterministic ids and validity flags.

    articles: doc_id, pos, art_id, number, number_normalized, title, text, canonical_id.
    affectations: doc_id, article_affected, normalized_type (those on the whole document fall on every article).
    catalog: doc_id, tipo, numero, anio, corte, vigencia. The first article of an id stays.
    """
    art = articles.withColumn("body", text.strip_noise(_trim(F.coalesce("text", F.lit(""))))).where("body <> ''")
    key = F.coalesce("canonical_id", "art_id", "number")
    first = F.row_number().over(Window.partitionBy("doc_id", key).orderBy("pos"))
    art = art.withColumn("_r", first).where("_r = 1").drop("_r", "text")
    touched = affectations.withColumn("_k", index_key(F.col("article_affected"))).groupBy("doc_id", "_k").agg(F.collect_set("normalized_type").alias("_t"))
    whole = touched.where("_k = '*'").select("doc_id", F.col("_t").alias("_whole"))
    own = touched.where("_k <> '*'").withColumnRenamed("_k", "number_normalized").withColumnRenamed("_t", "_own")
    rows = art.join(catalog, "doc_id").join(whole, "doc_id", "left").join(own, ["doc_id", "number_normalized"], "left")
    none = F.array().cast("array<string>")
    rows = rows.withColumn("_v", chunk_validity(F.array_union(F.coalesce("_whole", none), F.coalesce("_own", none)), F.col("vigencia")))
    norm = canonical_id(F.col("tipo"), F.col("numero"), F.col("anio"))
    ident = F.coalesce("canonical_id", F.when(F.col("number_normalized").isNotNull(), canonical_id(F.col("tipo"), F.col("numero"), F.col("anio"), art=F.col("number_normalized"))), F.concat(norm, F.lit(":art:"), "number"))
    label = text.article_label(F.col("number"), F.col("number_normalized"))
    titled = F.when(F.coalesce(F.trim("title"), F.lit("")) != "", F.concat(F.lit(" — "), F.trim("title"))).otherwise("")
    header = F.concat(text.norm_label(F.col("tipo"), F.col("numero"), F.col("anio"), F.col("corte")), F.lit(" · Artículo "), label, titled, F.lit(":"))
    rows = rows.withColumns({"norm_canonical_id": norm, "canonical_id": ident, "_label": label, "_header": header})
    rows = _pieces(rows, most, overlap)
    seed = F.when(F.coalesce("art_id", F.lit("")) != "", F.concat("canonical_id", F.lit("#"), "art_id")).otherwise(F.col("canonical_id"))
    return rows.select(chunk_uid(seed, F.col("chunk_index")).alias("uid"), "doc_id", "canonical_id", "norm_canonical_id", _numbered(F.concat(F.lit("Artículo "), "_label")).alias("section"), "title", F.concat("_header", F.lit("\n\n"), "body").alias("text"), "body", "chunk_index", "n_chunks", "_v.*")


def chunk_sections(sections: DataFrame, rulings: DataFrame, most: int = vocab.CHUNK_CHARS, overlap: int = vocab.CHUNK_OVERLAP) -> DataFrame:
    """Chunks of ruling sections. rulings: doc_id, norm_canonical_id, numero, anio, corte."""
    rows = sections.withColumn("body", text.strip_noise(F.coalesce("text", F.lit("")))).where("body <> ''").drop("text").join(rulings, "doc_id")
    nice = F.when(F.col("original_heading") != "", F.col("original_heading")).otherwise(F.initcap(F.replace("normalized_section", F.lit("_"), F.lit(" "))))
    ident = F.concat("norm_canonical_id", F.lit(":sec:"), F.col("seq").cast("string"), F.lit(":"), F.lower("normalized_section"))
    rows = rows.withColumns({"canonical_id": ident, "title": nice, "content_type": S.content_type(F.col("normalized_section"))})
    return _labelled(_pieces(rows, most, overlap), ["normalized_section", "content_type"])


def chunk_flat(texts: DataFrame, most: int = vocab.CHUNK_CHARS, overlap: int = vocab.CHUNK_OVERLAP) -> DataFrame:
    """Fallback for documents without structure. texts: doc_id, norm_canonical_id, tipo, numero, anio, corte, text."""
    rows = texts.withColumn("body", text.strip_noise(F.coalesce("text", F.lit("")))).where("body <> ''").drop("text")
    rows = rows.withColumns({"canonical_id": F.concat("norm_canonical_id", F.lit(":texto")), "title": F.lit("Texto completo"), "normalized_section": F.lit("FULL_TEXT"), "content_type": F.lit("FULL_TEXT")})
    return _labelled(_pieces(rows, most, overlap), ["normalized_section", "content_type"])


def _labelled(rows: DataFrame, more: list[str]) -> DataFrame:
    tipo = F.col("tipo") if "tipo" in rows.columns else F.lit("SENTENCIA")
    section = _numbered(F.col("title"))
    header = F.concat(text.norm_label(tipo, F.col("numero"), F.col("anio"), F.col("corte")), F.lit(" · "), section, F.lit(":"))
    return rows.select(chunk_uid(F.col("canonical_id"), F.col("chunk_index")).alias("uid"), "doc_id", "canonical_id", "norm_canonical_id", section.alias("section"), "title", F.concat(header, F.lit("\n\n"), "body").alias("text"), "body", "chunk_index", "n_chunks", *more)


def chunk_rulings(sections: DataFrame, buckets: DataFrame, texts: DataFrame, rulings: DataFrame, most: int = vocab.CHUNK_CHARS, overlap: int = vocab.CHUNK_OVERLAP) -> DataFrame:
    """Section chunks; for rulings without any, chunks of the three buckets; else of the flat text."""
    by_section = chunk_sections(sections, rulings, most, overlap)
    left = rulings.join(sections.select("doc_id").distinct(), "doc_id", "left_anti")
    kinds = [("hechos", "Hechos", "ANTECEDENTES", "NARRATIVE"), ("consideraciones", "Consideraciones", "CONSIDERACIONES", "REASONING"), ("resuelve", "Resuelve", "PARTE_RESOLUTIVA", "OPERATIVE_ORDERS")]
    legs = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(t).alias("title"), F.lit(n).alias("normalized_section"), F.lit(c).alias("content_type"), text.strip_noise(F.coalesce(k, F.lit(""))).alias("body")) for k, t, n, c in kinds])
    rows = buckets.join(left, "doc_id").select("doc_id", "norm_canonical_id", "numero", "anio", "corte", F.explode(legs).alias("x")).select("*", "x.*").drop("x").where("body <> ''")
    rows = rows.withColumn("canonical_id", F.concat("norm_canonical_id", F.lit(":"), "k"))
    by_bucket = _labelled(_pieces(rows, most, overlap), ["normalized_section", "content_type"])
    flat = texts.join(left.join(rows.select("doc_id").distinct(), "doc_id", "left_anti"), "doc_id")
    return by_section.unionByName(by_bucket).unionByName(chunk_flat(flat.withColumn("tipo", F.lit("SENTENCIA")), most, overlap))


#: Columns of the interface's chunk shape that a chunk may lack.
API_PAYLOAD = {"tipo": "string", "numero": "string", "anio": "string", "corte": "string", "magistrado": "string", "estado_vigencia": "string", "derogado": "boolean", "modificado": "boolean", "afectaciones": "array<string>", "normalized_section": "string", "content_type": "string"}


def api_chunks(chunks: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Chunks as the interface lists them: numbered from 1 in each document, with their length; payload columns that are missing are null."""
    number = F.row_number().over(Window.partitionBy(doc).orderBy("canonical_id", "chunk_index", "uid"))
    have = set(chunks.columns)
    payload = [F.col(c) if c in have else F.lit(None).cast(kind).alias(c) for c, kind in API_PAYLOAD.items()]
    return chunks.select(doc, number.alias("chunk_id"), "uid", "section", "canonical_id", F.coalesce("title", F.lit("")).alias("title"), F.col("body").alias("text"), F.length("body").alias("char_count"), "chunk_index", "n_chunks", *payload)


def upsert_chunks(stored: DataFrame, new: DataFrame, order: list[Column]) -> DataFrame:
    """Stored chunks after an upsert by uid; of new chunks with one uid the first by ``order`` counts."""
    return replace_by_key(stored, new, ["uid"], order)
