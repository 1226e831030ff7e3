"""Text functions as column expressions; nothing here leaves the JVM but ``html_text``."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab

SPACE = r"(?U)\s+"


def _bases() -> tuple[str, str]:
    """Accented letters of the Latin blocks, and the letters they decompose to."""
    pairs = {}
    for point in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        bare = "".join(c for c in unicodedata.normalize("NFKD", chr(point)) if not unicodedata.combining(c))
        if len(bare) == 1 and bare != chr(point):
            pairs[chr(point)] = bare
    return "".join(pairs), "".join(pairs.values())


ACCENTED, BARE = _bases()


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACE, " "))


def strip_accents(c: Column) -> Column:
    """Letters without their accents, whether composed or followed by combining marks."""
    return F.regexp_replace(F.translate(c, ACCENTED, BARE), r"\p{Mn}", "")


def repair_text(c: Column) -> Column:
    """UTF-8 that was read as Latin-1, read right; other text unchanged."""
    again = F.try_validate_utf8(F.encode(c, "ISO-8859-1").cast("string"))
    return F.when(c.rlike("[ÃÂ]") & c.rlike(r"^[\x{00}-\x{ff}]*$"), F.coalesce(again, c)).otherwise(c)


def fold(c: Column) -> Column:
    """Comparison key: repaired, no accents, other than letters and digits one space, lower case."""
    bare = strip_accents(repair_text(F.coalesce(c, F.lit(""))))
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(bare, "[^a-zA-Z0-9 ]", " "), " +", " ")))


def display(c: Column) -> Column:
    return collapse(repair_text(F.coalesce(c, F.lit(""))))


def title_case(c: Column) -> Column:
    """Spanish title case of names that are all upper or all lower case; others as they are."""
    name = display(c)
    letters = F.regexp_replace(name, r"[^\p{L}]", "")
    one_case = (letters != "") & ((letters == F.upper(letters)) | (letters == F.lower(letters)))

    def cased(word: Column, i: Column) -> Column:
        low = F.lower(word)
        first = F.concat(F.upper(F.substring(low, 1, 1)), F.substring(low, 2, 1_000_000))
        return F.when(low.isin(vocab.UPPER_WORDS), F.upper(word)).when((i > 0) & low.isin(vocab.LOWER_WORDS), low).otherwise(first)

    return F.when(one_case, F.array_join(F.transform(F.split(name, " "), cased), " ")).otherwise(name)


def accent_score(c: Column) -> Column:
    """Number of accented letters."""
    return F.length(c) - F.length(F.translate(c, ACCENTED, ""))


def slug(c: Column, most: int = 60) -> Column:
    bare = F.regexp_replace(F.lower(strip_accents(c)), "[^a-z0-9]+", "-")
    return F.substring(F.regexp_replace(bare, "^-+|-+$", ""), 1, most)


def strip_noise(c: Column) -> Column:
    """Text without portal labels, trailing blanks and runs of empty lines."""
    out = F.regexp_replace(c, "(?iu)" + vocab.INTERFACE_NOISE, "")
    out = F.regexp_replace(out, r"[ \t]+\n", "\n")
    return F.regexp_replace(F.regexp_replace(out, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")


def article_number(c: Column) -> Column:
    """``5``, ``5a``, ``trans:1`` of the first article named; null without one."""
    part = lambda k: F.regexp_extract(c, "(?iuU)" + vocab.ARTICLE_NUMBER, k)
    plain = F.when(part(1) != "", F.concat(F.lit("trans:"), part(2))).otherwise(F.concat(part(2), F.lower(part(3))))
    return F.when(part(2) != "", plain)


def article_label(number: Column, normalised: Column) -> Column:
    """Clean article number for display."""
    bare = F.trim(F.regexp_replace(F.coalesce(number, F.lit("")), r"(?iuU)^\s*art[ií]culo\s+", ""))
    bare = F.trim(F.regexp_replace(bare, "[°ºo.]+$", ""))
    trans = F.concat(F.lit("Transitorio "), F.regexp_replace(normalised, "^trans:", ""))
    named = F.when(normalised.startswith("trans:"), trans).when(normalised.rlike(r"\p{L}$"), F.upper(normalised)).otherwise(normalised)
    return F.when(F.coalesce(normalised, F.lit("")) != "", named).otherwise(F.coalesce(F.nullif(bare, F.lit("")), F.nullif(number, F.lit("")), F.lit("?")))


def type_label(tipo: Column) -> Column:
    low = F.concat(F.upper(F.substring(tipo, 1, 1)), F.lower(F.substring(tipo, 2, 1_000)))
    return F.when(F.coalesce(tipo, F.lit("")) == "", F.lit("Norma")).when((tipo == F.upper(tipo)) & tipo.rlike(r"\p{L}"), low).otherwise(tipo)


def norm_label(tipo: Column, numero: Column, anio: Column, corte: Column) -> Column:
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    ruling = F.concat(F.lit("Sentencia "), blank(numero), F.lit(" de "), blank(anio))
    court = F.when(blank(corte) != "", F.concat(F.lit(" ("), F.upper(corte), F.lit(")"))).otherwise("")
    return F.when(tipo == "SENTENCIA", F.concat(ruling, court)).otherwise(F.trim(F.concat(type_label(tipo), F.lit(" "), blank(numero), F.lit(" de "), blank(anio))))


def first_rule(c: Column, rules: list[tuple[str, str]], flags: str = "(?isU)") -> Column:
    """Name of the first rule whose pattern is found; null if none."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(rules):
        out = F.when(c.rlike(flags + pattern), F.lit(name)).otherwise(out)
    return out


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(c), f), 0)


def stripped(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def lookup(c: Column, table: dict[str, str]) -> Column:
    """Value of a small fixed table; null if the key is not in it."""
    pairs = reduce(list.__add__, [[F.lit(k), F.lit(v)] for k, v in table.items()])
    return F.try_element_at(F.create_map(*pairs), c)


def token_estimate(c: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(c) / 4).cast("int"))


def html_entities(c: Column) -> Column:
    """The entities that markup itself needs, and the no-break space."""
    for name, value in (("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("amp", "&")):
        c = F.replace(c, F.lit(f"&{name};"), F.lit(value))
    return c


def strip_tags(c: Column) -> Column:
    """A fragment's text: tags to spaces, entities, single spaces."""
    return collapse(html_entities(F.regexp_replace(c, "(?s)<[^>]*>", " ")))


def parse_date(c: Column) -> Column:
    """First D/M/Y in a text; null if there is none or it is no date."""
    found = F.regexp_extract(c, r"(\d{1,2}/\d{1,2}/\d{4})", 1)
    return F.to_date(F.try_to_timestamp(F.nullif(found, F.lit("")), F.lit("d/M/yyyy")))


def any_date(c: Column) -> Column:
    """D/M/Y anywhere, else a whole ISO date."""
    iso = F.when(F.trim(c).rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.to_date(F.try_to_timestamp(F.trim(c), F.lit("yyyy-M-d"))))
    return F.coalesce(parse_date(c), iso)


def date_range(c: Column) -> Column:
    """struct(desde, hasta): first and last valid D/M/Y; one date leaves the end open."""
    found = F.regexp_extract_all(c, F.lit(r"(\d{1,2}/\d{1,2}/\d{4})"), 1)
    dates = F.filter(F.transform(found, lambda d: F.to_date(F.try_to_timestamp(d, F.lit("d/M/yyyy")))), lambda d: d.isNotNull())
    return F.struct(F.get(dates, 0).alias("desde"), F.when(F.size(dates) > 1, F.element_at(dates, -1)).alias("hasta"))
