"""Operative orders of rulings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, vocab
from .citations import citations

_WORDS = "|".join(sorted(vocab.ORDINALS, key=len, reverse=True))


def _accented(words: str) -> str:
    """The words with any vowel accented or not."""
    for bare, both in (("a", "[aá]"), ("e", "[eé]"), ("i", "[ií]"), ("o", "[oó]"), ("u", "[uú]")):
        words = words.replace(bare, both)
    return words


NUMERAL = r"^\s*\**\s*(" + _accented(_WORDS) + r"|[0-9]{1,2})\s*\**\s*[\.\)\:\-]"
NUMERAL_PLAIN = r"^\s*\**\s*(" + _WORDS + r"|[0-9]{1,2})\s*\**\s*[\.\)\:\-]"


def classify_decision(c: Column) -> Column:
    return _decision(_folded(c))


def _folded(c: Column) -> Column:
    return F.lower(text.strip_accents(F.coalesce(c, F.lit(""))))


def _decision(folded: Column) -> Column:
    """Decision type of a folded text; most texts fail the one pattern that any rule needs."""
    some = folded.rlike("(?U)" + "|".join(f"(?:{pattern})" for _, pattern in vocab.DECISION_RULES))
    return F.when(some, text.first_rule(folded, vocab.DECISION_RULES, "(?U)")).otherwise(F.lit(vocab.OTHER_DECISION))


def _numerals(operative: Column, numeral: str) -> Column:
    """Texts of the numerals, in order."""
    parts = F.split(text.stripped(F.coalesce(operative, F.lit(""))), f"(?imu)(?={numeral})")
    return F.filter(parts, lambda p: p.rlike("(?iu)" + numeral))


def _named(body: Column, numeral: str) -> tuple[Column, Column]:
    """Number and label of an order's text."""
    label = F.regexp_extract(body, "(?imu)" + numeral, 1)
    key = F.lower(text.strip_accents(label))
    number = F.coalesce(text.lookup(key, {k: str(v) for k, v in vocab.ORDINALS.items()}), key).cast("int")
    return number, F.when(label.rlike("^[0-9]"), label).otherwise(F.concat(F.upper(F.substring(label, 1, 1)), F.lower(F.substring(label, 2, 100))))


def _scope(body: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(body, "(?iuU)" + vocab.SCOPE_PATTERN, 0)), F.lit(""))


def _condition(body: Column, decision: Column) -> Column:
    found = F.substring(F.trim(F.regexp_extract(body, "(?isuU)" + vocab.CONDITION_PATTERN, 1)), 1, vocab.CONDITION_MOST)
    return F.when(decision == "EXEQUIBLE_CONDICIONADA", F.nullif(found, F.lit("")))


def orders_of(operative: Column, plain: bool = False) -> Column:
    """Array of struct(order_number, ordinal_label, decision_type, text, scope, condicion) of one text's numerals."""
    numeral = NUMERAL_PLAIN if plain else NUMERAL

    def order(body: Column) -> Column:
        number, shown = _named(body, numeral)
        decided = text.bound(_folded(body), _decision)
        return text.bound(decided, lambda d: F.struct(number.alias("order_number"), shown.alias("ordinal_label"), d.alias("decision_type"), body.alias("text"), _scope(body).alias("scope"), _condition(body, d).alias("condicion")))

    return F.transform(F.transform(_numerals(operative, numeral), text.stripped), order)


def split_orders(df: DataFrame, keep: list[str], operative: str, plain: bool = False, with_targets: bool = True) -> DataFrame:
    """One row per numeral: keep, pos, order_number, ordinal_label, decision_type, text, scope, condicion, targets.

    A numeral is an ordinal word or one or two digits at the start of a line; what stands before the
    first one is dropped. With ``plain`` accented ordinals start no order.
    """
    numeral = NUMERAL_PLAIN if plain else NUMERAL
    out = df.select(*keep, F.posexplode(_numerals(F.col(operative), numeral)).alias("pos", "_b")).withColumn("text", text.stripped(F.col("_b"))).drop("_b")
    number, shown = _named(F.col("text"), numeral)
    out = out.withColumn("order_number", number).withColumn("ordinal_label", shown).withColumn("decision_type", classify_decision(F.col("text")))
    out = out.withColumn("scope", _scope(F.col("text"))).withColumn("condicion", _condition(F.col("text"), F.col("decision_type")))
    return out.withColumn("targets", citations(F.col("text"))) if with_targets else out
