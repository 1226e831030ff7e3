"""Normalised affectation types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text, vocab


def normalised(raw: Column, longest: bool = False) -> Column:
    """struct(tipo, mapped): exact form, else the first form that starts the text, else UNKNOWN.

    With ``longest`` the longest form that starts the text wins instead of the first declared.
    """
    key = text.collapse(F.lower(raw))
    forms = sorted(vocab.AFFECTATIONS, key=len, reverse=True) if longest else list(vocab.AFFECTATIONS)
    by_prefix = F.lit(None).cast("string")
    for form in reversed(forms):
        by_prefix = F.when(key.startswith(form), F.lit(vocab.AFFECTATIONS[form])).otherwise(by_prefix)
    found = F.coalesce(text.lookup(key, vocab.AFFECTATIONS), by_prefix)
    return F.struct(F.coalesce(found, F.lit(vocab.UNKNOWN_AFFECTATION)).alias("tipo"), found.isNotNull().alias("mapped"))


def whole_document(article: Column) -> Column:
    """Whether an affected-article text means the whole norm."""
    low = F.lower(F.trim(F.coalesce(article, F.lit(""))))
    return (low == "") | low.rlike("|".join(vocab.WHOLE_DOCUMENT))


def affects(article: Column, number: Column) -> Column:
    """Whether an affectation falls on the article of that number."""
    return whole_document(article) | F.coalesce((text.article_number(article) == number) & (number != ""), F.lit(False))


def index_key(article: Column) -> Column:
    """``*`` for whole documents, else the normalised number, else the lower-case text."""
    return F.when(whole_document(article), "*").otherwise(F.coalesce(text.article_number(article), F.lower(F.trim(article))))
