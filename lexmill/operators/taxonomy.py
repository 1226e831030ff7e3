"""Branch, head and issuer of documents, and the library rollup over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text, vocab


def issuer_name(entidad: Column) -> Column:
    """Display name of an issuer; the legislature's and the presidency's many names are one each."""
    key = text.fold(entidad)
    name = F.when(key.rlike(vocab.LEGISLATURE_NAMES), "Congreso de la República").when(key.rlike(vocab.PRESIDENCY_NAMES), "Presidencia de la República").otherwise(text.display(entidad))
    return F.when(F.coalesce(entidad, F.lit("")) == "", "Sin entidad").otherwise(name)


def _place(rama: str | None, cabeza: str | None) -> Column:
    return F.struct(F.lit(rama).cast("string").alias("rama"), F.lit(cabeza).cast("string").alias("cabeza"))


def issuer_place(entidad: Column) -> Column:
    """struct(rama, cabeza) by the issuer's name; rama null if it does not tell."""
    key, out = text.fold(entidad), _place(None, None)
    for pattern, rama, cabeza in reversed(vocab.ISSUER_RULES):
        out = F.when(key.rlike(pattern), _place(rama, cabeza)).otherwise(out)
    return out


def sector_place(sector: Column) -> Column:
    """struct(rama, cabeza) of an administrative sector; rama null if unknown."""
    key, out = text.fold(sector), _place(None, None)
    executive = text.lookup(key, vocab.EXECUTIVE_SECTORS)
    out = F.when(executive.isNotNull(), F.struct(F.lit(vocab.EXECUTIVE).alias("rama"), executive.alias("cabeza"))).otherwise(out)
    for name, (rama, cabeza) in vocab.SPECIAL_SECTORS.items():
        out = F.when(key == name, _place(rama, cabeza)).otherwise(out)
    return out


def classified(tipo: Column, sector: Column, entidad: Column, corte: Column) -> Column:
    """struct(rama, cabeza, entidad): international type, then court, then issuer, then sector."""
    kind, court = F.upper(F.coalesce(tipo, F.lit(""))), F.lower(F.coalesce(corte, F.lit("")))
    name, issuer, area = issuer_name(entidad), issuer_place(entidad), sector_place(sector)
    whole = lambda rama, cabeza, ent: F.struct(rama.alias("rama"), cabeza.alias("cabeza"), ent.alias("entidad"))
    head = F.coalesce(text.lookup(court, {k: v[1] for k, v in vocab.COURTS.items()}), F.lit("Rama Judicial"))
    ruling = whole(F.coalesce(text.lookup(court, {k: v[0] for k, v in vocab.COURTS.items()}), F.lit(vocab.JUDICIAL)), head, head)
    treaty = whole(F.lit(vocab.INTERNATIONAL), F.when(kind.contains("CAN"), "Comunidad Andina").otherwise("Tratados y derecho internacional"), name)
    own_sector = F.when(area["rama"] == vocab.EXECUTIVE, area["cabeza"])
    executive = whole(F.lit(vocab.EXECUTIVE), F.coalesce(issuer["cabeza"], own_sector, F.lit("Otras entidades ejecutivas")), name)
    by_issuer = whole(issuer["rama"], F.coalesce(issuer["cabeza"], issuer["rama"]), name)
    by_sector = whole(F.coalesce(area["rama"], F.lit(vocab.OTHER)), F.coalesce(area["cabeza"], F.lit(vocab.OTHER)), name)
    return (
        F.when(kind.isin("TRATADO", "DECISION CAN", "DECISION_CAN"), treaty)
        .when(kind.isin("SENTENCIA", "AUTO", "OPINION CONSULTIVA"), ruling)
        .when(issuer["rama"] == vocab.EXECUTIVE, executive)
        .when(issuer["rama"].isNotNull(), by_issuer)
        .otherwise(by_sector)
    )


def library_rollup(placed: DataFrame) -> DataFrame:
    """Totals of every branch, head and issuer: (nivel, rama, cabeza, entidad_key, nombre, total).

    ``placed`` has rama, cabeza, entidad. Issuers group by folded name and show the spelling with
    most accents, then the most frequent, then the first in code point order. Spellings are counted
    first, so the rollup runs over distinct names.
    """
    key = F.coalesce(F.nullif(text.fold(F.col("entidad")), F.lit("")), F.lit("sin-entidad"))
    spelled = placed.groupBy("rama", "cabeza", "entidad").agg(F.count("*").alias("n")).withColumn("entidad_key", key)
    rank = Window.partitionBy("rama", "cabeza", "entidad_key").orderBy(F.desc(text.accent_score(F.col("entidad"))), F.desc("n"), "entidad")
    best = spelled.withColumn("_r", F.row_number().over(rank)).withColumn("_best", F.when(F.col("_r") == 1, F.col("entidad")))
    out = best.rollup("rama", "cabeza", "entidad_key").agg(F.sum("n").alias("total"), F.max("_best").alias("_name"), F.grouping_id().alias("_g"))
    level = F.when(F.col("_g") == 7, 0).when(F.col("_g") == 3, 1).when(F.col("_g") == 1, 2).otherwise(3)
    name = F.when(level == 3, text.title_case(F.col("_name"))).when(level == 2, F.col("cabeza")).when(level == 1, F.col("rama")).otherwise("Biblioteca")
    return out.select(level.alias("nivel"), "rama", "cabeza", "entidad_key", name.alias("nombre"), "total")


def library_filter(rollup: DataFrame, query: str) -> DataFrame:
    """Rows of ``library_rollup`` that a search for ``query`` shows, accents and case aside.

    What matches by name brings all that is below it and the nodes above it; the whole library's row
    stays, with its total. A blank query shows everything.
    """
    wanted = query.strip()
    if not wanted:
        return rollup
    bare = lambda c: F.lower(text.strip_accents(c))
    hit = F.coalesce(F.contains(bare(F.col("nombre")), bare(F.lit(wanted))), F.lit(False))
    rows = rollup.withColumn("_hit", hit)
    at = lambda n: F.max(F.when(F.col("nivel") == n, F.col("_hit")).otherwise(F.lit(False)))
    heads = rows.where("nivel >= 2").groupBy(F.col("rama").alias("_r"), F.col("cabeza").alias("_c")).agg(at(2).alias("_head"), at(3).alias("_below"))
    branches = rows.where("nivel >= 1").groupBy(F.col("rama").alias("_q")).agg(at(1).alias("_branch"), F.max("_hit").alias("_any"))
    out = rows.join(branches, rows["rama"].eqNullSafe(branches["_q"]) & (rows["nivel"] >= 1), "left")
    out = out.join(heads, out["rama"].eqNullSafe(heads["_r"]) & out["cabeza"].eqNullSafe(heads["_c"]) & (out["nivel"] >= 2), "left")
    level = F.col("nivel")
    shown = (level == 0) | ((level == 1) & F.col("_any")) | ((level == 2) & (F.col("_branch") | F.col("_head") | F.col("_below"))) | ((level == 3) & (F.col("_branch") | F.col("_head") | F.col("_hit")))
    return out.where(shown).select(*rollup.columns)


def library_order(rollup: DataFrame) -> DataFrame:
    """Presentation order: branches as fixed, heads and issuers by falling total, then by name."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, vocab.BRANCHES)), F.col("rama")), F.lit(0)), F.lit(len(vocab.BRANCHES) + 1))
    heads = rollup.where("nivel = 2").select("rama", "cabeza", F.col("total").alias("_head"))
    out = rollup.join(heads, ["rama", "cabeza"], "left")
    return out.orderBy(place, "rama", F.desc_nulls_first("_head"), F.col("cabeza").asc_nulls_first(), "nivel", F.desc("total"), "nombre").drop("_head")
