"""Ruling sections from headings: classes, parents and inheritance.

A text's sections are one array in its own row (``sections_of``), so nothing is exchanged or sorted;
headings that are rows already inherit by windows (``inherit``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text, vocab

ENUMERATION = r"(?iu)^\s*(?:[*_#]+\s*)?(?:[IVXLCDM]+|[0-9]+(?:\.[0-9]+)*|[A-Za-z])(?:[\.\)\-º°]+\s*|\s+)"
HEADING = r"^(#{1,6})\s+(.*\S)\s*$"
DEEPEST = 6


def clean_heading(c: Column) -> Column:
    bare = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "[*_`]+", ""))
    return F.trim(F.regexp_replace(F.trim(F.regexp_replace(bare, ENUMERATION, "")), r"[.:;\-]+$", ""))


def classify_heading(c: Column) -> Column:
    """Section class of a heading; null if no rule matches."""
    return text.first_rule(F.lower(clean_heading(c)), vocab.SECTION_RULES)


def inherit(heads: DataFrame, doc: str, level: str = "level", seq: str = "seq", own: str = "own") -> DataFrame:
    """Adds parent_seq and normalized_section to headings (doc, seq, level, own class or null).

    The parent is the latest shallower heading. A heading without a class takes its parent's, which
    may itself be inherited; so classes are settled level by level, shallowest first. Every document
    is sorted once; the windows share that order.
    """
    order = Window.partitionBy(doc).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    out = heads.withColumn("_class", F.when(F.col(level) == 1, F.coalesce(own, F.lit(vocab.OTHER_SECTION))))
    # within the prefix, a heading is on the path unless one at most as deep follows it
    latest = lambda k: F.last(F.when(F.col(level) == k, F.struct(seq, "_class")), ignorenulls=True).over(order)
    for k in range(1, DEEPEST + 1):
        if k > 1:
            above = F.coalesce(*[F.when(F.col(f"_at{j}")[seq] == F.greatest(*[F.coalesce(F.col(f"_at{i}")[seq], F.lit(-1)) for i in range(1, k)], F.lit(-1)), F.col(f"_at{j}")["_class"]) for j in range(1, k)])
            out = out.withColumn("_class", F.when(F.col(level) == k, F.coalesce(own, above, F.lit(vocab.OTHER_SECTION))).otherwise(F.col("_class")))
        out = out.withColumn(f"_at{k}", latest(k))
    shallower = [F.when(F.col(level) > j, F.col(f"_at{j}")[seq]) for j in range(1, DEEPEST + 1)]
    out = out.withColumn("parent_seq", F.greatest(*shallower)).withColumn("normalized_section", F.col("_class"))
    return out.drop("_class", *[f"_at{k}" for k in range(1, DEEPEST + 1)])


SECTION = ("seq", "level", "original_heading", "normalized_section", "text", "parent_seq")


def _inherited(heads: Column) -> Column:
    """struct(parent_seq, normalized_section) of each of a text's headings (seq, level, own): what ``inherit`` gives.

    Kept along the way: the latest heading and those it lies in, one a level at most.
    """

    def step(done: Column, h: Column) -> Column:
        def placed(path: Column) -> Column:
            above = F.get(path, F.size(path) - 1)
            own = F.coalesce(h["own"], above["class"], F.lit(vocab.OTHER_SECTION))
            return text.bound(own, lambda c: F.struct(F.concat(path, F.array(F.struct(h["seq"].alias("seq"), h["level"].alias("level"), c.alias("class")))).alias("path"), F.concat(done["out"], F.array(F.struct(above["seq"].alias("parent_seq"), c.alias("normalized_section")))).alias("out")))

        return text.bound(F.filter(done["path"], lambda x: x["level"] < h["level"]), placed)

    none = F.struct(F.array().cast("array<struct<seq:int,level:int,class:string>>").alias("path"), F.array().cast("array<struct<parent_seq:int,normalized_section:string>>").alias("out"))
    return F.aggregate(heads, none, step, lambda done: done["out"])


def sections_of(md: Column) -> Column:
    """Array of struct(SECTION) of ruling markdown, in order; what stands before the first heading is a preamble if not blank."""

    def row(seq, level, heading, section, body, parent):
        return F.struct(*[c.alias(n) for n, c in zip(SECTION, (seq, level, heading, section, body, parent))])

    def listed(w: Column) -> Column:
        heads, lines, before = w["heads"], w["lines"], (w["preamble"] != "").cast("int")
        heading = lambda h: F.trim(F.regexp_extract(h["line"], HEADING, 2))
        own = lambda h: text.bound(F.lower(clean_heading(heading(h))), lambda c: text.first_rule(c, vocab.SECTION_RULES))
        after = lambda k: F.coalesce(F.get(heads, k + 1)["at"], F.size(lines))
        placed = _inherited(F.transform(heads, lambda h, k: F.struct((before + k).alias("seq"), h["level"].alias("level"), own(h).alias("own"))))
        body = lambda h, k: text.stripped(F.array_join(F.slice(lines, h["at"] + 2, after(k) - h["at"] - 1), "\n"))
        first = row(F.lit(0), F.lit(0), F.lit(""), F.lit(vocab.PREAMBLE), w["preamble"], F.lit(None).cast("int"))
        rest = text.bound(placed, lambda p: F.transform(heads, lambda h, k: row(before + k, h["level"], heading(h), F.get(p, k)["normalized_section"], body(h, k), F.get(p, k)["parent_seq"])))
        return F.concat(F.filter(F.array(first), lambda x: x["text"] != ""), rest)

    def cut(lines: Column) -> Column:
        heads = F.filter(F.transform(lines, lambda s, i: F.struct(i.alias("at"), F.length(F.regexp_extract(s, HEADING, 1)).alias("level"), s.alias("line"))), lambda h: h["level"] > 0)
        return text.bound(heads, lambda h: F.struct(h.alias("heads"), lines.alias("lines"), text.stripped(F.array_join(F.slice(lines, F.lit(1), F.coalesce(F.get(h, 0)["at"], F.size(lines))), "\n")).alias("preamble")))

    lines = F.split(text.stripped(F.coalesce(md, F.lit(""))), r"\r?\n")
    return text.bound(text.bound(lines, cut), listed)


def split_sections(docs: DataFrame, doc: str, md: str) -> DataFrame:
    """(doc, seq, level, original_heading, normalized_section, text, parent_seq) of ruling markdown.

    Text before the first heading is a preamble section if not blank. Blank documents have none.
    """
    return docs.select(doc, F.explode(sections_of(F.col(md))).alias("_s")).select(doc, *[F.col(f"_s.{c}").alias(c) for c in SECTION])


def content_type(section: Column) -> Column:
    return F.coalesce(text.lookup(section, vocab.CONTENT_TYPES), F.lit(vocab.DEFAULT_CONTENT))


def is_separate_opinion(section: Column) -> Column:
    return section.isin(vocab.SEPARATE_OPINIONS)


#: Families of sections that older readers know, in order.
FAMILIES = {"hechos": vocab.FACTS_SECTIONS, "consideraciones": vocab.REASONING_SECTIONS, "resuelve": [vocab.OPERATIVE_SECTION]}


def _block(heading: Column, body: Column) -> Column:
    return F.when(heading != "", F.concat(heading, F.lit("\n\n"), body)).otherwise(body)


def buckets_of(sections: Column) -> dict[str, Column]:
    """Section texts by family of one text's array, in order; separate opinions stay out."""

    def joined(names: list[str]) -> Column:
        own = F.filter(sections, lambda s: (s["text"] != "") & s["normalized_section"].isin(names))
        return F.array_join(F.transform(own, lambda s: _block(s["original_heading"], s["text"])), "\n\n")

    return {k: joined(names) for k, names in FAMILIES.items()}


def legacy_buckets(sections: DataFrame, doc: str) -> DataFrame:
    """(doc, hechos, consideraciones, resuelve): section texts by family, in order; separate opinions stay out."""

    def joined(names: list[str]) -> Column:
        own = F.sort_array(F.collect_list(F.when((F.col("text") != "") & F.col("normalized_section").isin(names), F.struct("seq", _block(F.col("original_heading"), F.col("text")).alias("b")))))
        return F.array_join(F.transform(own, lambda x: x["b"]), "\n\n")

    return sections.groupBy(doc).agg(*[joined(names).alias(k) for k, names in FAMILIES.items()])
