"""Descriptive statistics over rulings and their outcomes, and the source coverage map."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FACETS = ("corte", "materia", "magistrado_ponente", "anio")


def lenient_int(c: Column) -> Column:
    """Leading integer of a text, 0 without one."""
    return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(c, r"^\s*([+-]?\d{1,9})", 1), F.lit("")), F.lit("S999999999")).cast("int"), F.lit(0))


def filtered_rulings(df: DataFrame, corte: str | None = None, materia: str | None = None, magistrado: str | None = None, since: int | None = None, until: int | None = None) -> DataFrame:
    for column, value in (("materia", materia), ("magistrado_ponente", magistrado)):
        if value:
            df = df.where(F.lower(column).contains(value.lower()))
    if corte:
        df = df.where(F.col("corte") == corte)
    year = lenient_int(F.col("anio"))
    return df.where((year >= since) if since is not None else F.lit(True)).where((year <= until) if until is not None else F.lit(True))


def facets(rulings: DataFrame, columns: tuple[str, ...] = FACETS, top: int = 10, newest_first: tuple[str, ...] = ("anio",)) -> DataFrame:
    """(facet, value, n, pos): top values of each column in one pass; null and blank stay out.

    Counts fall, ties by value; columns in ``newest_first`` are ordered by value instead.
    """
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")
    counted = rulings.select(each).select("x.*").where(F.coalesce(F.trim("value"), F.lit("")) != "").groupBy("facet", "value").agg(F.count("*").alias("n"))
    by_value = F.col("facet").isin(*newest_first) if newest_first else F.lit(False)
    rank = Window.partitionBy("facet").orderBy(F.desc(F.when(by_value, F.col("value"))), F.desc("n"), "value")
    return counted.withColumn("pos", F.row_number().over(rank)).where(F.col("pos") <= top)


def totals(rulings: DataFrame, has_text: Column) -> DataFrame:
    return rulings.agg(F.count("*").alias("n"), F.count_if(has_text).alias("n_with_text"))


def outcome_counts(edges: DataFrame, relations: list[str], merged: bool = False) -> DataFrame:
    """Edges per outcome; merged folds ``DECLARA_X`` into ``X``."""
    rel = F.regexp_replace("rel", "^DECLARA_", "") if merged else F.col("rel")
    return edges.where(F.col("rel").isin(relations)).groupBy(rel.alias("outcome")).agg(F.count("*").alias("n"))


def coverage_map(sources: DataFrame, ingested: DataFrame) -> DataFrame:
    """Per layer: sources, volumes by quality, ingested rows, connectors in place.

    sources: key, capa, estado, volumen, calidad. ingested: key, n.
    """
    rows = sources.join(ingested, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    measured = F.when(F.col("calidad") == "medido", F.col("volumen")).otherwise(0)
    estimated = F.when(F.col("calidad") == "estimado", F.col("volumen")).otherwise(0)
    return rows.groupBy("capa").agg(F.count("*").alias("fuentes"), F.sum(measured).alias("medido"), F.sum(estimated).alias("estimado"), F.sum("n").alias("ingerido"), F.count_if(F.col("estado").isin("operativo", "parcial")).alias("conectores"))


def union_of(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
