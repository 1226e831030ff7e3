"""Secret scans with a random forest that removes false positives; DataFrame functions only.

What is a word, and which letter follows which, is learnt from the corpus itself: words of letters only
that at least ``common`` documents hold, and how often each letter follows each in them. A candidate's
dictionary coverage is the share of its letters in parts that are such words, and its transition score
the mean log probability of its letter pairs.

Detectors find candidate tokens in whole texts: runs of SHAPE, the formats of RULES, and words of
SHORTEST and more characters after a credential's name. A candidate is described by its length, its
character transitions, how much of it common words cover, its path and the words around it; a
random forest trained on labelled findings then says how likely it is a secret.

Labelled findings come as a table (doc_id, at, label) or, without one, from formats that decide by
themselves: key formats with fixed prefixes and values assigned to a credential's name are secrets;
addresses, links, numbers, placeholders and values of little entropy are not. The columns that decide
there are hidden from the forest, which learns what such values and their surroundings look like. At most ``train_rows`` labelled
findings (by hash order, a documented bound) fit the forest; everything is scanned and scored.

Defined results: null and empty texts have no findings; a null path is an empty one; repeated rows
give findings each; if labels of one kind only exist, the score is the detectors' own label (0.5
where undecided); without common words nothing is covered; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import staged

TRAIN_ROWS = 20_000
SHORTEST = 8
#: A run of twelve and more key characters with a digit; each run is looked at once.
SHAPE = r"(?<![A-Za-z0-9+/=_\-])(?=[A-Za-z0-9+/=_\-]{12})[A-Za-z+/=_\-]*+[0-9]"
RULES = {
    "cloud_key": r"^(AKIA|ASIA)[A-Z0-9]{16}$",
    "prefixed_token": r"^(gh[pousr]_|xox[abprs]-|sk-|pk_live_|sk_live_|glpat-)[A-Za-z0-9_\-]{12,}$",
    "web_token": r"^eyJ[A-Za-z0-9_\-]{6,}\.eyJ[A-Za-z0-9_\-]{6,}",
    "assigned": r"(?i)^(pass(word|wd)?|secret|token|api_?key|access_?key|auth)[=:].{8,}$",
    "hex": r"^[0-9a-fA-F]{16,}$",
}
NAMES = r"(?i)^[^A-Za-z]*(pass(word|wd)?|secret|token|api_?key|access_?key|auth|bearer|credential)s?[^A-Za-z]*$"
#: What a document has if any word of it can be a candidate: SHAPE, a rule's format or a credential's name.
FORMATS = SHAPE + "|" + "|".join(RULES[k].strip("^$") for k in ("cloud_key", "prefixed_token", "web_token", "hex")) + r"|(?i:(pass(word|wd)?|secret|token|api_?key|access_?key|auth)[=:].{8})"
ANYWHERE = FORMATS + r"|(?i:(?<![A-Za-z])(pass(word|wd)?|secret|token|api_?key|access_?key|auth|bearer|credential)s?(?![A-Za-z]))"
NOT_SECRET = r"(?i)(@|^https?:|^www\.|example|placeholder|changeme|x{6,}|(.)\2{5,}|^[0-9.:,/+\-]+$)"
#: Documents that hold a word of the dictionary, at least.
COMMON = 3
#: A word of the corpus: letters between blanks, with closing punctuation; the parts of a candidate that may be words.
CORPUS_WORD = r"(?<!\S)([a-z]{3,24})(?=[.,;:!?]?(?:\s|$))"
PART = r"[A-Z]?[a-z]{2,}|[A-Z]{3,}(?![a-z])"
BROADCAST_WORDS = 100_000
#: Classes of characters; the share of each transition between two of them is a feature.
CLASSES = {"lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "other": "[^A-Za-z0-9]"}
TRANSITIONS = {f"{a}_{b}": f"{x}(?={y})" for a, x in CLASSES.items() for b, y in CLASSES.items()}
#: Neighbouring words by the hash of their letters, in so many columns a side.
NEIGHBOURS = 12
#: What the forest sees. The columns that label findings by rule are not among them.
FEATURES = [
    *("length", "digits", "uppers", "vowels", "pairs", "dictionary", "hexadecimal", "path_test", "before_length", "after_length", "before_letters"),
    *TRANSITIONS,
    *(f"{side}_{k}" for side in ("before", "after") for k in range(NEIGHBOURS)),
]


def _rate(pattern: str, text: Column) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def _word(at: Column) -> Column:
    """A document's word at a place; empty beyond its ends."""
    return F.coalesce(F.get("words", at), F.lit(""))


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """doc_id, at (place of the word), word, value, rule, before, before2, after, path of every candidate."""
    some = docs.where(F.col("text").rlike(ANYWHERE)).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), F.split("text", r"\s+").alias("words"))
    # places are chosen inside the array: exploding first would copy all words of a document for each of them
    may = lambda i: (F.length(_word(i)) >= SHORTEST) & (_word(i).rlike(FORMATS) | _word(i - 1).rlike(NAMES) | _word(i - 2).rlike(NAMES))
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), may)
    word = some.select("doc_id", "path", "words", F.explode(places).alias("at")).withColumn("word", _word(F.col("at")))
    near = lambda k: _word(F.col("at") + k)
    trimmed = F.regexp_replace("word", r"""^[\"'`(\[{<,;]+|[\"'`)\]}>,;.!?%]+$""", "")
    format_ = reduce(lambda a, b: a | b, [trimmed.rlike(x) for x in RULES.values()])
    word = word.where(F.col("word").rlike(SHAPE) | near(-1).rlike(NAMES) | near(-2).rlike(NAMES) | format_)
    value = F.regexp_replace(trimmed, r"""(?i)^[a-z_\-]+[=:][\"'`]?(?=.{8,})""", "")
    rule = F.lit("generic")
    for name, pattern in reversed(RULES.items()):
        rule = F.when(F.col("token").rlike(pattern), F.lit(name)).otherwise(rule)
    out = word.select("doc_id", "path", "at", near(-1).alias("before"), near(-2).alias("before2"), near(1).alias("after"), trimmed.alias("token"), value.alias("value"))
    return out.where(F.length("value") >= SHORTEST).withColumn("rule", rule)


def _bucket(side: str) -> Column:
    """Which of NEIGHBOURS columns the letters of a neighbouring word belong to; none if it has no letter."""
    letters = F.lower(F.regexp_replace(F.col(side), r"[^\p{L}]", ""))
    return F.when(letters != "", F.pmod(F.xxhash64(letters), F.lit(NEIGHBOURS))).otherwise(-1)


#: Score of a letter pair that no word has, and of a value without letter pairs.
UNKNOWN_PAIR = -8.0


def corpus_words(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """(word, df): words of letters that at least ``common`` documents hold."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(CORPUS_WORD), 1))
    return docs.where("text IS NOT NULL").select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("df")).where(F.col("df") >= common)


def pair_scores(words: DataFrame) -> DataFrame:
    """One row: ``scores``, a map of at most 676 letter pairs to the log probability of the second letter after the first."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2)))
    counted = words.select(F.explode(pairs).alias("pair"), "df").groupBy("pair").agg(F.sum("df").alias("n"))
    after = counted.groupBy(F.substring("pair", 1, 1).alias("a")).agg(F.sum("n").alias("all"))
    scored = counted.join(F.broadcast(after), F.substring("pair", 1, 1) == F.col("a")).select("pair", F.log((F.col("n") + 1) / (F.col("all") + 26)).alias("s"))
    return scored.agg(F.map_from_entries(F.collect_list(F.struct("pair", "s"))).alias("scores"))


def with_words(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds ``covered`` (letters of a value in parts that are words) and ``pair_score``."""
    letters = F.regexp_replace(F.lower("value"), "[^a-z]+", " ")
    pairs = F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.length(letters) - 1, F.lit(1))), lambda i: F.substring(letters, i, F.lit(2))), lambda p: p.rlike("^[a-z]{2}$"))
    values = staged(found.select("value").distinct().select("value", F.transform(F.regexp_extract_all("value", F.lit(PART), 0), F.lower).alias("parts"), pairs.alias("pairs")), "values")
    small = F.broadcast(words) if words.limit(BROADCAST_WORDS + 1).count() <= BROADCAST_WORDS else words
    covered = values.select("value", F.explode("parts").alias("word")).join(small, "word", "left_semi").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))
    mean = F.aggregate("pairs", F.lit(0.0), lambda t, p: t + F.coalesce(F.element_at("scores", p), F.lit(UNKNOWN_PAIR))) / F.size("pairs")
    scored = values.join(F.broadcast(pair_scores(words))).select("value", F.when(F.size("pairs") > 0, mean).alias("pair_score"))  # one row
    told = staged(scored.join(covered, "value", "left"), "told")
    if told.limit(BROADCAST_WORDS + 1).count() <= BROADCAST_WORDS:
        return found.join(F.broadcast(told), "value", "left")
    return found.join(told, "value", "left")


def described(found: DataFrame) -> DataFrame:
    """Adds the FEATURES columns and those of ``rule_labels``, all doubles; ``found`` has been ``with_words``."""
    v = F.col("value")
    entropy = F.expr("-aggregate(transform(array_distinct(split(value, '')), c -> (length(value) - length(replace(value, c, ''))) / length(value)), 0D, (s, p) -> s + if(p > 0, p * log2(p), 0D))")
    columns = {
        "length": F.length(v),
        "entropy": entropy,
        "digits": _rate(r"[0-9]", v),
        "uppers": _rate(r"[A-Z]", v),
        "vowels": _rate(r"(?i)[aeiou]", v),
        **{name: _rate(pattern, v) for name, pattern in TRANSITIONS.items()},
        "pairs": F.coalesce("pair_score", F.lit(UNKNOWN_PAIR)),
        "dictionary": F.coalesce("covered", F.lit(0)) / F.greatest(F.length(v), F.lit(1)),
        "hexadecimal": v.rlike(r"^[0-9a-fA-F]+$"),
        "at_sign": F.col("token").contains("@"),
        "fixed_prefix": F.col("rule").isin("cloud_key", "prefixed_token", "web_token"),
        "named_before": F.col("before").rlike(NAMES) | F.col("before2").rlike(NAMES),
        "assigns_before": F.col("before").rlike(r"^[=:]+$|[=:]$"),
        "assigned": F.col("rule") == "assigned",
        "path_test": F.col("path").rlike(r"(?i)test|example|sample|mock|docs?/"),
        "before_length": F.length("before"),
        "after_length": F.length("after"),
        "before_letters": _rate(r"\p{L}", F.col("before")),
        **{f"{side}_{k}": _bucket(side) == k for side in ("before", "after") for k in range(NEIGHBOURS)},
    }
    return found.withColumns({k: c.cast("double") for k, c in columns.items()})


def rule_labels(found: DataFrame) -> Column:
    """1.0, 0.0 or null (undecided) by formats that decide alone."""
    named = (F.col("named_before") > 0) & ((F.col("assigns_before") > 0) | F.col("before").rlike(r"[=:]$"))
    placeholder = F.col("token").rlike(NOT_SECRET)
    return F.when(placeholder, 0.0).when((F.col("fixed_prefix") > 0) | (F.col("assigned") > 0) | named, 1.0).when(F.col("entropy") < 2.5, 0.0)


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None, path: str = "source", train_rows: int = TRAIN_ROWS, trees: int = 20, threshold: float = 0.5, seed: int = 5, common: int = COMMON) -> DataFrame:
    """One row per finding: doc_id, at, rule, shown (masked), value_sha256, score, kept."""
    words = staged(corpus_words(docs, common), "words")
    found = described(with_words(staged(candidates(docs, path), "candidates"), words))
    if labelled is None:
        found = found.withColumn("label", rule_labels(found))
    else:
        marks = labelled.select(F.col("doc_id").alias("_d"), F.col("at").alias("_a"), F.col("label").cast("double").alias("label")).dropDuplicates(["_d", "_a"])
        found = found.join(marks, (F.col("doc_id") == F.col("_d")) & (F.col("at") == F.col("_a")), "left").drop("_d", "_a")
    found = staged(found, "findings")
    order = F.xxhash64(F.lit(seed), "doc_id", "at", "value")
    train = found.where("label IS NOT NULL").withColumn("_order", order).orderBy("_order", "value", *FEATURES).limit(train_rows).select("label", *FEATURES)
    train = staged(train.coalesce(1), "labelled")
    kinds = train.select("label").distinct().count()
    if kinds > 1:
        from pyspark.ml.classification import RandomForestClassifier
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.functions import vector_to_array

        vector = VectorAssembler(inputCols=FEATURES, outputCol="_x")
        forest = RandomForestClassifier(labelCol="label", featuresCol="_x", numTrees=trees, maxDepth=6, seed=seed).fit(vector.transform(train))
        scored = forest.transform(vector.transform(found)).withColumn("score", vector_to_array("probability")[1])
    else:
        scored = found.withColumn("score", F.coalesce("label", F.lit(0.5)))
    shown = F.concat(F.substring("value", 1, 4), F.lit("***"))
    return scored.select("doc_id", "at", "rule", shown.alias("shown"), F.sha2("value", 256).alias("value_sha256"), "score", (F.col("score") >= threshold).alias("kept"))
