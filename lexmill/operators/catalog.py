"""Catalog operators: uniqueness, upserts, work queues, pages and counters.

All are DataFrame to DataFrame. "First wins" needs an order: callers name the columns that give it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.ids import canonical_id, source_of
from .taxonomy import classified

LEGISLATION_KEY = ("tipo", "numero", "anio", "entidad")
RULING_KEY = ("canonical_id", "source")


def keep_first(df: DataFrame, keys: list[str], order: list[Column], nulls_distinct: bool = False) -> DataFrame:
    """First row of each key by ``order``; with ``nulls_distinct`` a key with a null never repeats."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]) if nulls_distinct else F.lit(True)
    ranked = df.withColumn("_whole", whole)
    rank = F.row_number().over(Window.partitionBy("_whole", *keys).orderBy(*order))
    return ranked.withColumn("_rank", rank).where(~F.col("_whole") | (F.col("_rank") == 1)).drop("_whole", "_rank")


def insert_ignore(existing: DataFrame, new: DataFrame, order: list[Column], nulls_distinct: bool = True) -> DataFrame:
    """Rows of ``new`` that an insert-or-ignore adds: unique legislation keys, then unique ruling ids."""
    fresh = keep_first(new, list(LEGISLATION_KEY), order, nulls_distinct)
    ruling = (F.col("tipo") == "SENTENCIA") & F.col("canonical_id").isNotNull()
    fresh = keep_first(fresh.where(ruling), list(RULING_KEY), order, True).unionByName(fresh.where(~F.coalesce(ruling, F.lit(False))))
    on = [fresh[k] == existing[k] if nulls_distinct else fresh[k].eqNullSafe(existing[k]) for k in LEGISLATION_KEY]
    fresh = fresh.join(existing, on, "left_anti")
    rulings = existing.where("tipo = 'SENTENCIA' AND canonical_id IS NOT NULL")
    return fresh.join(rulings, [fresh["tipo"] == "SENTENCIA"] + [fresh[k] == rulings[k] for k in RULING_KEY], "left_anti")


def replace_by_key(existing: DataFrame, new: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Table after insert-or-replace: for each key the last of ``new`` by ``order``, else the old row."""
    last = keep_first(new, keys, order)
    return existing.join(last.select(keys), keys, "left_anti").unionByName(last, allowMissingColumns=True)


def catalog_page(df: DataFrame, equal: dict[str, str] | None = None, vigencia: str | None = None, search: str | None = None, search_in: tuple[str, ...] = ("tipo", "numero", "anio", "entidad", "materia"), limit: int = 50, offset: int = 0, tie: str = "id") -> DataFrame:
    """A page of the filtered catalog, newest year first; ``total`` counts all filtered rows."""
    found = filter_catalog(df, equal, vigencia, search, search_in)
    total = found.agg(F.count("*").alias("total"))
    page = found.orderBy(F.desc("anio"), F.desc("numero"), tie).offset(offset).limit(limit)
    return page.join(F.broadcast(total))  # one row


def filter_catalog(df: DataFrame, equal: dict[str, str] | None = None, vigencia: str | None = None, search: str | None = None, search_in: tuple[str, ...] = ()) -> DataFrame:
    for column, value in (equal or {}).items():
        df = df.where(F.col(column) == value)
    if vigencia:
        df = df.where(F.lower("vigencia").contains(vigencia.lower()))
    if search:
        df = df.where(reduce(lambda a, b: a | b, [F.coalesce(F.lower(c).contains(search.lower()), F.lit(False)) for c in search_in]))
    return df


def pending_work(df: DataFrame, tipo: str | None = None, source: str | None = None, limit: int | None = None) -> DataFrame:
    """Resolved rows that wait for capture and have an id, newest year first."""
    out = df.where((F.col("resolve_status") == "resolved") & (F.col("scrape_status") == "pending") & F.coalesce("external_id", "suin_id").isNotNull())
    out = filter_catalog(out, {k: v for k, v in (("tipo", tipo), ("source", source)) if v})
    out = out.orderBy(F.desc("anio"), "numero", "id")
    return out.limit(limit) if limit else out


def unresolved_work(df: DataFrame, tipo: str | None = None, source: str | None = None) -> DataFrame:
    return filter_catalog(df.where(F.col("resolve_status") == "pending"), {k: v for k, v in (("tipo", tipo), ("source", source)) if v})


def requeue_errors(df: DataFrame, max_attempts: int = 3, tipo: str | None = None, source: str | None = None) -> DataFrame:
    """Errors under the attempt cap wait again; ``requeued`` tells which rows changed."""
    again = (F.col("scrape_status") == "error") & (F.coalesce("scrape_attempts", F.lit(0)) < max_attempts)
    for column, value in (("tipo", tipo), ("source", source)):
        if value:
            again &= F.col(column) == value
    again = F.coalesce(again, F.lit(False))
    return df.withColumn("requeued", again).withColumn("scrape_status", F.when(again, "pending").otherwise(F.col("scrape_status")))


def update_scrape(df: DataFrame, results: DataFrame) -> DataFrame:
    """Catalog after capture ``results`` (suin_id, source, status, vigencia): attempts grow on errors only,
    validity is compared after trimming and case folding, a known validity is not overwritten by null."""
    new = results.select("suin_id", "source", F.col("status").alias("_status"), F.col("vigencia").alias("_vigencia"))
    out = df.join(new, ["suin_id", "source"], "left")
    found = F.coalesce("_vigencia", "suin_vigencia")
    match = F.lower(F.trim("vigencia")) == F.lower(F.trim("_vigencia"))
    out = out.withColumn("scrape_attempts", F.coalesce("scrape_attempts", F.lit(0)) + F.coalesce((F.col("_status") == "error").cast("int"), F.lit(0)))
    out = out.withColumn("vigencia_match", F.coalesce(match, F.col("vigencia_match"))).withColumn("suin_vigencia", found)
    return out.withColumn("scrape_status", F.coalesce("_status", "scrape_status")).drop("_status", "_vigencia").select(*df.columns)


def validity_mismatches(df: DataFrame) -> DataFrame:
    """Rows whose catalog validity differs from the captured one."""
    return df.where(F.lower(F.trim("vigencia")) != F.lower(F.trim("suin_vigencia"))).select("suin_id", F.col("vigencia").alias("catalog_vigencia"), "suin_vigencia")


def resolve_by_index(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Catalog rows with the ids an index lists for (tipo, numero, anio): one resolves, more are
    ambiguous, none is not found, a missing key is an error. ``index`` has tipo, numero, anio, doc_id."""
    keys = ["tipo", "numero", "anio"]
    listed = index.groupBy(*keys).agg(F.sort_array(F.collect_set("doc_id")).alias("_ids"))
    out = rows.join(listed, keys, "left")
    hits = F.coalesce(F.size("_ids"), F.lit(0))
    missing = F.coalesce(F.trim("numero"), F.lit("")).eqNullSafe("") | F.coalesce(F.trim("anio"), F.lit("")).eqNullSafe("")
    status = F.when(missing, "error").when(hits == 1, "resolved").when(hits > 1, "ambiguous").otherwise("not_found")
    note = F.when(hits > 1, F.concat_ws(",", F.transform("_ids", lambda x: x.cast("string"))))
    return out.withColumn("resolve_status", status).withColumn("resolved_id", F.when((hits == 1) & ~missing, F.col("_ids")[0])).withColumn("resolve_note", F.when(~missing, note)).drop("_ids")


def identity_resolve(df: DataFrame) -> DataFrame:
    """Court and portal ids that follow from number and year."""
    number = F.upper(F.regexp_replace("numero", r"\s+", ""))
    short = F.concat(F.lower("numero"), F.lit("-"), F.substring("anio", -2, 2))
    ident = F.when(F.col("source") == "corte_constitucional", short).when(F.col("source") == "csj", F.concat(number, F.lit("-"), "anio")).when(F.col("source") == "consejo_estado", F.concat(F.lit("CE-"), "numero", F.lit("-"), "anio")).otherwise(F.col("external_id"))
    return df.withColumn("suin_id", F.coalesce("suin_id", ident)).withColumn("resolve_status", F.when(F.col("suin_id").isNotNull(), "resolved").otherwise("error"))


def backfilled(df: DataFrame, force: bool = False) -> DataFrame:
    """Source, ids and taxonomy where they are missing (taxonomy everywhere if forced)."""
    out = df.withColumn("source", F.coalesce("source", source_of(F.col("tipo"), F.col("corte"))))
    out = out.withColumn("external_id", F.coalesce("external_id", "suin_id")).withColumn("canonical_id", F.coalesce("canonical_id", canonical_id(F.col("tipo"), F.col("numero"), F.coalesce("anio", F.lit("")))))
    place = classified(F.col("tipo"), F.col("sector"), F.col("entidad"), F.col("corte"))
    out = out.withColumn("_place", place)
    keep = F.lit(not force) & F.col("rama").isNotNull()
    out = out.withColumn("cabeza", F.when(keep, F.col("cabeza")).otherwise(F.col("_place.cabeza")))
    out = out.withColumn("entidad_norm", F.when(keep, F.col("entidad_norm")).otherwise(F.coalesce(F.nullif(text.fold(F.col("entidad")), F.lit("")), F.lit("sin-entidad"))))
    return out.withColumn("rama", F.when(keep, F.col("rama")).otherwise(F.col("_place.rama"))).drop("_place").select(*df.columns)


def changed_content(captures: DataFrame, known: DataFrame, key: str, content: str) -> DataFrame:
    """Captures whose content hash is not known for their key."""
    hashed = captures.withColumn("content_hash", F.sha2(F.col(content).cast("binary"), 256))
    return hashed.join(known.select(key, "content_hash"), [key, "content_hash"], "left_anti")


def latest_capture(log: DataFrame, keys: list[str], by: list[Column]) -> DataFrame:
    return keep_first(log, keys, by)


def status_cube(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def dashboard(df: DataFrame) -> DataFrame:
    """All dashboard counters in one pass: (facet, value, n)."""
    facets = F.array(*[F.struct(F.lit(name).alias("facet"), value.alias("value")) for name, value in (("total", F.lit("all")), ("tipo", F.col("tipo")), ("scrape_status", F.col("scrape_status")), ("resolve_status", F.col("resolve_status")), ("with_id", F.when(F.col("suin_id").isNotNull(), "yes").otherwise("no")), ("validity_match", F.when(F.col("vigencia_match"), "match").when(~F.col("vigencia_match"), "mismatch").otherwise("unknown")))])
    return df.select(F.explode(facets).alias("f")).groupBy("f.facet", "f.value").agg(F.count("*").alias("n"))


def percentages(df: DataFrame, by: str) -> DataFrame:
    """Count and percent of each value; the window runs over one row a value."""
    counted = df.groupBy(by).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("total"))
    return counted.join(F.broadcast(total)).select(by, "n", F.round(F.col("n") * 100.0 / F.greatest("total", F.lit(1)), 4).alias("percent"))


def distinct_types(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def clean_fields(raw: DataFrame, mapping: dict[str, str], defaults: dict[str, str] | None = None) -> DataFrame:
    """Renamed source fields: trimmed, blank and "NULL" to null; defaults only for absent fields."""
    fields = [F.when(F.upper(F.trim(F.col(src))) != "NULL", text.blank_to_null(F.col(src))).alias(dst) for src, dst in mapping.items() if src in raw.columns]
    present = {dst for src, dst in mapping.items() if src in raw.columns}
    return raw.select(*fields, *[F.lit(v).alias(k) for k, v in (defaults or {}).items() if k not in present])


def unmapped_log(parsed: DataFrame) -> DataFrame:
    """suin_id, raw_type, article_affected, source_text, context of affectations whose type is not known, one row each."""
    both = F.concat(*[F.coalesce(F.col(c), F.array().cast(parsed.schema[c].dataType)) for c in ("modifications", "jurisprudence")])
    rows = parsed.select("suin_id", F.explode(both).alias("x")).where("NOT x.mapped")
    return rows.select("suin_id", "x.raw_type", "x.article_affected", "x.source_text", "x.context")
