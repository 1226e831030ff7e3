"""Canonical identifiers and deterministic keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab
from .text import lookup

GRAMMAR = r"^co:([a-z_]+):(?:([a-z_]+):([a-z0-9_]+):)?([a-z0-9_-]+):(\d{4})(?::art:((?:trans:\d+|\d+[a-z]?))(?::par:(\d+))?)?$"
PARTS = ("tipo", "corte", "sala", "numero", "anio", "art", "par")


def type_code(tipo: Column) -> Column:
    return F.coalesce(lookup(tipo, vocab.DOCUMENT_TYPES), F.replace(F.lower(tipo), F.lit(" "), F.lit("_")))


def canonical_id(tipo: Column, numero: Column, anio: Column, corte: Column | None = None, sala: Column | None = None, art: Column | None = None, par: Column | None = None) -> Column:
    """``co:type[:court:chamber]:number:year[:art:n[:par:n]]``; court and chamber only together."""
    none = F.lit(None).cast("string")
    corte, sala, art, par = (none if c is None else c for c in (corte, sala, art, par))
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    court = F.when(filled(corte) & filled(sala), F.concat(F.lit(":"), F.lower(corte), F.lit(":"), F.lower(sala))).otherwise("")
    paragraph = F.when(par.isNotNull(), F.concat(F.lit(":par:"), F.lower(par))).otherwise("")
    article = F.when(art.isNotNull(), F.concat(F.lit(":art:"), F.lower(art), paragraph)).otherwise("")
    return F.concat(F.lit("co:"), type_code(tipo), court, F.lit(":"), F.lower(numero), F.lit(":"), anio, article)


def is_canonical(c: Column) -> Column:
    return c.rlike(GRAMMAR)


def parse_canonical(c: Column) -> Column:
    """struct of PARTS; null where the text does not follow the grammar."""
    fields = [F.nullif(F.regexp_extract(c, GRAMMAR, k + 1), F.lit("")).alias(name) for k, name in enumerate(PARTS)]
    return F.when(is_canonical(c), F.struct(*fields))


def uuid5(namespace: str, name: Column) -> Column:
    """Version-5 UUID of a name, by SHA-1 in the JVM."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    part = lambda i, n: F.substring(h, i, n)
    variant = F.lower(F.hex(F.conv(part(17, 2), 16, 10).cast("int").bitwiseAND(F.lit(63)).bitwiseOR(F.lit(128))))
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(19, 2), F.lit("-"), part(21, 12))


def chunk_uid(canonical: Column, index: Column) -> Column:
    return uuid5(vocab.CHUNK_NAMESPACE, F.concat(canonical, F.lit("#chunk"), index.cast("string")))


def source_of(tipo: Column, corte: Column) -> Column:
    """Cache source inferred from type and court."""
    court = F.lower(F.coalesce(corte, F.lit("cc")))
    ruling = F.when(court == "csj", "csj").when(court == "ce", "consejo_estado").otherwise("corte_constitucional")
    return F.when(tipo == "SENTENCIA", ruling).otherwise("suin")
