"""Citations of norms and rulings in text.

Every family's pattern begins with one of a few words. One pass finds where those words stand, and a
family's pattern is tried there only; spans are kept in order, so that whether a span is taken is told
from its neighbours.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..schemas import CITATION

FIELDS = ("type", "raw", "numero", "anio", "articulo", "nombre")
#: Words that families begin with, as their patterns write them.
CUES = ("art[ií]culo", "ley", "decreto", "sentencia", "resoluci[oó]n", "acto", "c[oó]digo")
_CUE = re.compile(r"\b(?:" + "|".join(f"({c})" for c in CUES) + ")", re.IGNORECASE)
_FAMILIES = [(kind, re.compile(pattern, re.IGNORECASE), groups, next(k for k, c in enumerate(CUES) if pattern.split(r"\b", 1)[1].startswith(c))) for kind, pattern, groups in vocab.CITATION_FAMILIES]


def find_citations(text: str | None) -> list[tuple]:
    """Citations (FIELDS) in order of family, then place; a span taken by an earlier family counts once."""
    places: list[list[int]] = [[] for _ in CUES]
    for m in _CUE.finditer(text or ""):
        places[m.lastindex - 1].append(m.start())
    starts: list[int] = []
    ends: list[int] = []
    out: dict[tuple, str] = {}
    for kind, pattern, groups, cue in _FAMILIES:
        after = 0
        for place in places[cue]:
            if place < after:
                continue
            m = pattern.match(text, place)
            if m is None:
                continue
            start, after = m.span()
            at = bisect_left(starts, after)  # taken spans do not overlap: the last one before the end tells
            if at and ends[at - 1] > start:
                continue
            starts.insert(at, start)
            ends.insert(at, after)
            found = dict(zip(groups, m.groups()))
            if "prefijo" in found:
                found["numero"] = f"{found['prefijo'].upper()}-{found['numero']}"
            if "nombre" in found:
                found["nombre"] = found["nombre"].strip().lower()
            out.setdefault((kind, *(found.get(f) for f in FIELDS[2:])), m.group(0))
    return [(key[0], raw, *key[1:]) for key, raw in out.items()]


def _find_all(texts: pa.Array) -> pa.Array:
    found = [find_citations(t) for t in texts.to_pylist()]
    offsets = [0]
    for f in found:
        offsets.append(offsets[-1] + len(f))
    columns = list(zip(*(c for f in found for c in f))) or [()] * len(FIELDS)
    rows = pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], FIELDS)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)


def citations(text: Column) -> Column:
    """All families with span suppression: needs match positions, so it runs over Arrow arrays."""
    return F.arrow_udf(_find_all, f"array<{CITATION}>")(text)


def _find_each(lists: pa.Array) -> pa.Array:
    ends = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).cumsum()
    return pa.ListArray.from_arrays(pa.array([0, *ends.tolist()], pa.int32()), _find_all(lists.flatten()))


def citations_each(texts: Column) -> Column:
    """``citations`` of each text of an array."""
    return F.arrow_udf(_find_each, f"array<array<{CITATION}>>")(texts)


def family(text: Column, kind: str, with_article: bool = False) -> Column:
    """Distinct ``number:year`` of one family, in the JVM, without span suppression."""
    pattern, groups = next((p, g) for k, p, g in vocab.CITATION_FAMILIES if k == kind and ("articulo" in g) == with_article)
    part = lambda name: F.regexp_extract_all(text, F.lit("(?iuU)" + pattern), groups.index(name) + 1)
    names = [g for g in ("prefijo", "articulo", "numero", "anio") if g in groups]
    out = part(names[0])
    for name in names[1:]:
        out = F.zip_with(out, part(name), lambda a, b: F.concat(a, F.lit(":"), b))
    return F.array_distinct(out)


def cited(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row per citation: ``keep``, position and the citation's fields."""
    return df.select(*keep, F.posexplode(citations(F.col(text))).alias("pos", "c")).select(*keep, "pos", "c.*")


def as_text(c: Column) -> Column:
    """A citation struct in words."""
    year = F.coalesce(c["anio"], F.lit("?"))
    plain = lambda name: F.concat(F.lit(f"{name} "), c["numero"], F.lit(" de "), year)
    article = lambda name, of: F.when(c["articulo"].isNotNull(), F.concat(F.lit("Artículo "), c["articulo"], F.lit(f" {of} "), plain(name))).otherwise(plain(name))
    return (
        F.when(c["type"] == "ley", article("Ley", "de la"))
        .when(c["type"] == "decreto", article("Decreto", "del"))
        .when(c["type"] == "sentencia", plain("Sentencia"))
        .when(c["type"] == "resolucion", plain("Resolución"))
        .when(c["type"] == "acto_legislativo", plain("Acto Legislativo"))
        .when(c["type"] == "constitucion", F.concat(F.lit("Artículo "), F.coalesce(c["articulo"], F.lit("?")), F.lit(" de la Constitución")))
        .when(c["type"] == "codigo", F.concat(F.lit("Código "), F.initcap(F.coalesce(c["nombre"], F.lit("?")))))
        .otherwise(c["raw"])
    )
