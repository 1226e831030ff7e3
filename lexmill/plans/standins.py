"""Legal-domain views of the driver's star schema, for running operators on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Expressions that mean the same in Spark and DuckDB; {s} is the string type's name.
_CATALOG = {
    "id": "o_orderkey",
    "tipo": "CASE o_orderstatus WHEN 'F' THEN 'LEY' WHEN 'O' THEN 'DECRETO' ELSE 'SENTENCIA' END",
    "numero": "CAST(o_orderkey % 997 AS {s})",
    "anio": "CAST(year(o_orderdate) AS {s})",
    "sector": "o_orderpriority",
    "entidad": "c_name",
    "materia": "c_mktsegment",
    "corte": "CASE WHEN o_orderstatus = 'P' THEN CASE o_custkey % 3 WHEN 0 THEN 'cc' WHEN 1 THEN 'csj' ELSE 'ce' END END",
    "magistrado_ponente": "CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE concat('M', CAST(o_custkey % 40 AS {s})) END",
    "vigencia": "CASE o_orderkey % 4 WHEN 0 THEN 'Vigente' WHEN 1 THEN 'Derogada' WHEN 2 THEN ' vigente ' END",
    "suin_vigencia": "CASE o_orderkey % 3 WHEN 0 THEN 'VIGENTE' WHEN 1 THEN 'derogada' END",
    "vigencia_match": "CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END",
    "suin_id": "CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderkey AS {s}) END",
    "external_id": "CASE WHEN o_orderkey % 8 = 0 THEN concat('x', CAST(o_orderkey AS {s})) END",
    "canonical_id": "CASE WHEN o_orderstatus = 'P' THEN concat('co:sentencia:', CAST(o_orderkey % 997 AS {s}), ':', CAST(year(o_orderdate) AS {s})) END",
    "source": "CASE WHEN o_orderstatus = 'P' THEN 'corte_constitucional' ELSE 'suin' END",
    "scrape_status": "CASE o_orderkey % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'error' WHEN 2 THEN 'needs_ocr' ELSE 'done' END",
    "resolve_status": "CASE o_orderkey % 7 WHEN 0 THEN 'pending' WHEN 1 THEN 'ambiguous' ELSE 'resolved' END",
    "scrape_attempts": "CAST(o_orderkey % 4 AS INT)",
}
_TEXT = (
    "concat('Visto el artículo ', CAST(o_orderkey % 90 + 1 AS {s}), ' de la Ley ', CAST(o_orderkey % 500 AS {s}), ' de ', CAST(year(o_orderdate) AS {s}), "
    "', la ley ', CAST(o_custkey % 700 AS {s}), ' de 1993, el Decreto ', CAST(o_orderkey % 300 AS {s}), ' de ', CAST(year(o_orderdate) AS {s}), "
    "' y la Sentencia C-', CAST(o_custkey % 800 AS {s}), ' de ', CAST(year(o_orderdate) AS {s}), '; artículo 29 de la Constitución y el Código Civil.')"
)
_RULING = (
    "concat('Visto.', chr(10), 'PRIMERO.- Declarar EXEQUIBLE el artículo ', CAST(o_orderkey % 90 + 1 AS {s}), ' de la Ley ', CAST(o_orderkey % 500 AS {s}), ' de ', CAST(year(o_orderdate) AS {s}), "
    "', por los cargos analizados.', chr(10), 'Segundo: Declarar INEXEQUIBLE el resto.', chr(10), '3. Exhortar al Congreso.')"
)


def _selected(columns: dict[str, str], kind: str) -> list[str]:
    return [f"{e.format(s=kind)} AS {n}" for n, e in columns.items()]


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and customers as catalog rows."""
    orders, customer = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer"))
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).selectExpr(*_selected(_CATALOG, "STRING"))


CATALOG = f"catalog AS (SELECT {', '.join(_selected(_CATALOG, 'VARCHAR'))} FROM orders JOIN customer ON o_custkey = c_custkey)"


def legal_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as citing texts and operative parts: id, anio, texto, resuelve."""
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(*_selected({"id": "o_orderkey", "anio": "CAST(year(o_orderdate) AS {s})", "texto": _TEXT, "resuelve": _RULING}, "STRING"))


LEGAL_TEXTS = f"legal_texts AS (SELECT {', '.join(_selected({'id': 'o_orderkey', 'anio': 'CAST(year(o_orderdate) AS {s})', 'texto': _TEXT, 'resuelve': _RULING}, 'VARCHAR'))} FROM orders)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
