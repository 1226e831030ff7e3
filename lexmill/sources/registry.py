"""The declared sources as a small table, with their filters and volumes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "key string, capa string, modo string, estado string, corte string, tipos array<string>, volumen long, calidad string"

# --- fixed values: key, layer, mode, state, court, types, volume, quality of the volume -----------------
SOURCES = [
    ("suin", "A", "catalogo", "operativo", None, ["ley", "decreto", "acto_legislativo", "resolucion", "codigo", "circular", "constitucion"], 15715, "medido"),
    ("diario_oficial", "A", "crawl", "andamiaje", None, ["ley", "decreto", "resolucion"], 53526, "estimado"),
    ("corte_constitucional", "B", "catalogo", "parcial", "cc", ["sentencia"], 29310, "medido"),
    ("csj", "B", "crawl", "parcial", "csj", ["sentencia"], 321880, "medido"),
    ("consejo_estado", "B", "crawl", "parcial", "ce", ["sentencia"], 103351, "medido"),
    ("jep", "B", "crawl", "parcial", "jep", ["sentencia", "auto", "acuerdo", "resolucion"], 5000, "estimado"),
    ("tratados", "A", "catalogo", "parcial", None, ["tratado"], 1261, "medido"),
    ("corte_idh", "B", "crawl", "parcial", "idh", ["sentencia", "opinion_consultiva"], 60, "estimado"),
    ("creg", "A", "crawl", "parcial", None, ["resolucion", "circular"], 4888, "medido"),
    ("crc", "A", "crawl", "parcial", None, ["resolucion", "circular"], 2170, "medido"),
    ("cra", "A", "crawl", "parcial", None, ["resolucion", "circular"], 3323, "medido"),
    ("banco_republica", "A", "crawl", "parcial", None, ["resolucion", "circular"], 1500, "estimado"),
    ("organos_control", "C", "crawl", "parcial", None, ["concepto", "fallo_disciplinario", "circular"], 31835, "estimado"),
    ("cne", "B", "crawl", "parcial", None, ["resolucion", "concepto"], 3000, "estimado"),
    ("can", "A", "crawl", "parcial", "can", ["decision_can", "sentencia"], 1200, "estimado"),
    ("dian", "C", "crawl", "parcial", None, ["concepto", "resolucion", "circular"], 26171, "medido"),
    ("superintendencias", "C", "crawl", "andamiaje", None, ["circular_externa", "concepto"], 10000, "estimado"),
    ("funcion_publica", "C", "crawl", "parcial", None, ["concepto", "decreto"], 8000, "estimado"),
    ("regimen_bogota", "D", "crawl", "parcial", None, ["decreto", "acuerdo", "resolucion"], 30000, "estimado"),
    ("gaceta_congreso", "D", "crawl", "andamiaje", None, ["proyecto_ley", "exposicion_motivos"], 8000, "estimado"),
]


def sources(spark: SparkSession, capa: str | None = None, estado: str | None = None, pending: bool | None = None) -> DataFrame:
    """Declared sources, by layer, state, or whether a connector is still missing."""
    out = spark.createDataFrame(SOURCES, SCHEMA)
    for column, value in (("capa", capa), ("estado", estado)):
        if value is not None:
            out = out.where(F.col(column) == value)
    if pending is not None:
        waits = F.col("estado") == "pendiente"
        out = out.where(waits if pending else ~waits)
    return out


def with_measured(declared: DataFrame, measured: DataFrame) -> DataFrame:
    """Volumes with new measurements (key, volumen) in place of estimates; unknown ones say so."""
    new = measured.select("key", F.col("volumen").alias("_v"))
    out = declared.join(new, "key", "left")
    quality = F.when(F.col("_v").isNotNull(), "medido").when(F.col("volumen").isNotNull(), F.col("calidad")).otherwise("desconocido")
    return out.withColumn("calidad", quality).withColumn("volumen", F.coalesce("_v", "volumen")).drop("_v")
