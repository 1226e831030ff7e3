"""Rulings as one parsed row: court, chamber, judge, sections, orders and citations from markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import orders, sections
from .citations import as_text, citations, citations_each

#: How a chamber and a judge are named, and what stands where nothing is.
CHAMBER = r"(?iu)Sala\s+(?:de\s+)?(?:Casaci[oó]n\s+)?(Plena|Civil|Penal|Laboral|Primera|Segunda|Tercera|Cuarta|Quinta|Revisi[oó]n|Consulta)"
JUDGE = r"(?iu)(?:Magistrad[oa]\s+Ponente|M\.P\.|Consejero\s+Ponente)\s*[:\-]?\s*([^\n]+)"
COURT, CHAMBER_DEFAULT = "Corte Constitucional", "Plena"


def map_rulings(docs: DataFrame, md: str = "md") -> DataFrame:
    """suin_id, tipo, numero, anio, corte, sala, magistrado_ponente, hechos, consideraciones, resuelve, sections, orders, citaciones, raw_text.

    docs: suin_id (once each), tipo, numero, anio, corte, magistrado_ponente and the markdown. A judge
    of the catalog stands; else the text names one, or it is null. Blank texts have empty lists. A ruling is
    read in its own row: nothing is exchanged, joined or sorted.
    """
    doc = "suin_id"
    body = F.coalesce(F.col(md), F.lit(""))
    named = F.nullif(F.trim(F.regexp_replace(F.regexp_extract(body, JUDGE, 1), r"[*_]", "")), F.lit(""))
    judge = F.coalesce(F.nullif(F.col("magistrado_ponente"), F.lit("")), named)
    chamber = F.coalesce(F.nullif(F.regexp_extract(body, CHAMBER, 1), F.lit("")), F.lit(CHAMBER_DEFAULT))
    base = docs.select(doc, F.coalesce("tipo", F.lit("SENTENCIA")).alias("tipo"), F.coalesce("numero", F.lit("")).alias("numero"), F.coalesce("anio", F.lit("")).alias("anio"), F.coalesce("corte", F.lit(COURT)).alias("corte"), chamber.alias("sala"), judge.alias("magistrado_ponente"), citations(body).alias("_c"), body.alias("raw_text"))
    base = base.withColumn("citaciones", F.transform("_c", as_text)).drop("_c")
    out = base.withColumn("sections", sections.sections_of(F.col("raw_text")))
    out = out.withColumns(sections.buckets_of(F.col("sections")))
    out = out.withColumn("_o", orders.orders_of(F.col("resuelve")))
    out = out.withColumn("_t", citations_each(F.transform("_o", lambda o: o["text"])))
    decided = F.transform("_o", lambda o, k: F.struct(*[o[c].alias(c) for c in ("order_number", "ordinal_label", "decision_type", "text", "scope", "condicion")], F.get("_t", k).alias("targets")))
    return out.select(doc, "tipo", "numero", "anio", "corte", "sala", "magistrado_ponente", "hechos", "consideraciones", "resuelve", "sections", decided.alias("orders"), "citaciones", "raw_text")
