"""Explicit schemas of the stored tables; nothing is inferred."""

CATALOG = (
    "id LONG, tipo STRING, numero STRING, anio STRING, sector STRING, subtipo STRING, vigencia STRING, entidad STRING, materia STRING, articulos STRING, corte STRING, "
    "magistrado_ponente STRING, source STRING, external_id STRING, source_url STRING, canonical_id STRING, suin_id STRING, resolve_status STRING, resolve_note STRING, "
    "scrape_status STRING, suin_vigencia STRING, vigencia_match BOOLEAN, rama STRING, cabeza STRING, entidad_norm STRING, scrape_attempts INT, created_at TIMESTAMP, updated_at TIMESTAMP"
)
CAPTURE_LOG = (
    "suin_id STRING, source STRING, source_url STRING, content_hash STRING, capture_ts TIMESTAMP, http_status INT, raw_path STRING, parse_status STRING, parse_error STRING, "
    "articles_count INT, modifications_count INT, jurisprudence_count INT, scraper_version STRING, created_at TIMESTAMP"
)
AFFECTATION = "STRUCT<article_affected STRING, raw_type STRING, normalized_type STRING, mapped BOOLEAN, source_text STRING, source_suin_id STRING, source_anchor STRING, context STRING>"
OUTGOING = "STRUCT<normalized_type STRING, raw_type STRING, mapped BOOLEAN, target_text STRING, target_suin_id STRING, target_anchor STRING, context STRING>"
VERSION = "STRUCT<text STRING, date_range STRING>"
ARTICLE = f"STRUCT<art_id STRING, number STRING, number_normalized STRING, title STRING, text STRING, canonical_id STRING, notes ARRAY<STRING>, previous_versions ARRAY<{VERSION}>, affects ARRAY<{OUTGOING}>>"
TOC = "STRUCT<level STRING, text STRING, anchor STRING>"
PARSED_NORM = f"suin_id STRING, metadata MAP<STRING,STRING>, articles ARRAY<{ARTICLE}>, modifications ARRAY<{AFFECTATION}>, jurisprudence ARRAY<{AFFECTATION}>, toc ARRAY<{TOC}>"
CITATION = "STRUCT<type STRING, raw STRING, numero STRING, anio STRING, articulo STRING, nombre STRING>"
SECTION = "STRUCT<seq INT, level INT, original_heading STRING, normalized_section STRING, text STRING, parent_seq INT>"
ORDER = f"STRUCT<order_number INT, ordinal_label STRING, decision_type STRING, text STRING, scope STRING, condicion STRING, targets ARRAY<{CITATION}>>"
PARSED_RULING = PARSED_NORM + (
    f", corte STRING, sala STRING, magistrado_ponente STRING, hechos STRING, consideraciones STRING, resuelve STRING, sections ARRAY<{SECTION}>, orders ARRAY<{ORDER}>, citaciones ARRAY<STRING>, raw_text STRING"
)
CAPTURE_METADATA = (
    "suin_id STRING, source STRING, source_url STRING, content_hash_sha256 STRING, capture_timestamp STRING, http_status INT, content_length LONG, raw_filename STRING, scraper_version STRING, "
    "catalog_match STRUCT<tipo STRING, numero STRING, anio STRING, corte STRING, magistrado_ponente STRING>"
)
SEED = "tipo STRING, numero STRING, source STRING, anio STRING, canonical_id STRING, external_id STRING, source_url STRING, corte STRING, magistrado_ponente STRING, subtipo STRING, extra MAP<STRING,STRING>"
