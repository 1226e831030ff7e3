"""Language identification with hyperdimensional profiles.

Every letter has a random ±1 vector (drawn from its code point). An n-gram's vector binds the
vectors of its letters, each permuted by its place, by elementwise product. A text's vector bundles
(sums) the vectors of its n-grams; a language's prototype bundles those of its training texts, each
scaled to about the same length, so that no long text decides alone. A text gets the language whose
prototype has the largest cosine with it.

Bundling is linear, so a task first counts n-grams (sparse) and binds each distinct one once.
Training adds up prototypes of ``dims`` whole numbers per language and task; nothing grows with the
corpus but those sums.

Defined results: text that is null or has no letter gives ``und`` with score 0; so does any text if
nothing could be learned; equal cosines go to the smaller language code; null languages are not
learned from; repeated rows count each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import MEMORIES, free_names, only

DIMS = 1024
GRAM = 3
SEED = 7
SPAN = 1 << 20
UNIT = 1 << 20
CACHE_GRAMS = 40_000
MAX_LANGUAGES = 10_000
UNDETERMINED = "und"
BITS = 21
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((0xD800 > c or c > 0xDFFF for c in range(0x110000)), bool, 0x110000)
        _letters &= np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes of a whole text and their counts; empty without letters.

    Lower case; every run of other characters is one space; a space before and after. Codes are
    counted span by span, so that memory does not grow with a multiple of a very long text.
    """
    codes, counts, tail = [], [], np.zeros(1, dtype=np.int64)
    text = text or ""
    for at in range(0, max(len(text), 1), SPAN):
        points = np.frombuffer(text[at : at + SPAN].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        points = np.where(_letter_table()[points], points, 0)
        run = np.concatenate([tail, points, [0] if at + SPAN >= len(text) else []]).astype(np.int64)
        run = run[np.concatenate([[True], (run[1:] != 0) | (run[:-1] != 0)])]
        if len(run) >= GRAM:
            gram = np.zeros(len(run) - GRAM + 1, dtype=np.int64)
            for k in range(GRAM):
                gram = (gram << BITS) | run[k : len(run) - GRAM + 1 + k]
            gram, n = np.unique(gram, return_counts=True)
            codes.append(gram)
            counts.append(n)
        tail = run[-(GRAM - 1) :]
    if not codes:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if len(codes) == 1:
        return codes[0], counts[0]
    merged, where = np.unique(np.concatenate(codes), return_inverse=True)
    return merged, np.bincount(where, np.concatenate(counts)).astype(np.int64)


class GramVectors:
    """Bound n-gram vectors, kept for up to CACHE_GRAMS n-grams."""

    def __init__(self, dims: int):
        self.dims, self.letters, self.place = dims, {}, {}
        self.rows = np.empty((1024, dims), dtype=np.int8)

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            if len(self.letters) > 20_000:
                self.letters.clear()
            self.letters[point] = np.random.default_rng([SEED, point]).integers(0, 2, self.dims, dtype=np.int8) * 2 - 1
        return self.letters[point]

    def bind(self, code: int) -> np.ndarray:
        out = np.ones(self.dims, dtype=np.int8)
        for k in range(GRAM):
            out *= np.roll(self.letter((code >> (BITS * (GRAM - 1 - k))) & ((1 << BITS) - 1)), GRAM - 1 - k)
        return out

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the bound vectors times their counts; any number of n-grams."""
        total = np.zeros(self.dims)
        for at in range(0, len(codes), 2048):
            part, n = codes[at : at + 2048].tolist(), counts[at : at + 2048]
            if len(self.place) + len(part) > CACHE_GRAMS:
                self.place.clear()
            index = []
            for code in part:
                if (i := self.place.get(code)) is None:
                    i = self.place[code] = len(self.place)
                    if i >= len(self.rows):
                        self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
                    self.rows[i] = self.bind(code)
                index.append(i)
            total += n.astype(np.float32) @ self.rows[index].astype(np.float32)
        return total


_vectors: dict[int, GramVectors] = {}
MEMORIES["langid"] = _vectors.clear


def _gram_vectors(dims: int) -> GramVectors:
    return _vectors.setdefault(dims, GramVectors(dims))


def learn_prototypes(labelled: DataFrame, dims: int = DIMS) -> dict[str, np.ndarray]:
    """Language prototypes from the text and lang of ``labelled``; at most MAX_LANGUAGES languages."""

    def task(batches):
        only("langid")
        held: dict[str, tuple[list, list]] = {}
        sums: dict[str, np.ndarray] = {}

        def flush(lang):
            codes, counts = map(np.concatenate, held.pop(lang))
            codes, where = np.unique(codes, return_inverse=True)
            vector = _gram_vectors(dims).bundle(codes, np.bincount(where, counts))
            sums[lang] = sums.get(lang, 0) + vector

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                codes, counts = gram_counts(text.as_py())
                if len(codes):
                    a, b = held.setdefault(lang, ([], []))
                    a.append(codes)
                    b.append(counts / np.sqrt((counts.astype(float) ** 2).sum()))
                    if len(a) >= 512:
                        flush(lang)
        for lang in list(held):
            flush(lang)
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang] * dims, "at": pa.array(range(dims), pa.int32()), "x": np.rint(vector * UNIT).astype(np.int64)})

    parts = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang").mapInArrow(task, "lang string, at int, x long")
    rows = parts.groupBy("lang", "at").agg(F.sum("x").alias("x")).limit(MAX_LANGUAGES * dims + 1).toPandas()
    if len(rows) > MAX_LANGUAGES * dims:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {lang: part.sort_values("at")["x"].to_numpy(np.float64) for lang, part in rows.groupby("lang")}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: list[str], dims: int = DIMS, result: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The ``keep`` columns of docs and, named as ``result`` says, language and cosine (0 to 1) of every whole text."""
    names = sorted(prototypes)
    profile = np.array([prototypes[n] / max(np.linalg.norm(prototypes[n]), 1e-300) for n in names]).reshape(len(names), dims)

    def task(batches):
        only("langid")
        vectors = _gram_vectors(dims)
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(batch.num_columns - 1):
                codes, counts = gram_counts(text.as_py())
                lang, score = UNDETERMINED, 0.0
                if len(codes) and names:
                    bundle = vectors.bundle(codes, counts)
                    cosine = profile @ bundle / max(np.linalg.norm(bundle), 1e-300)
                    best = int(np.argmax(cosine))
                    lang, score = names[best], float(min(1.0, max(0.0, cosine[best])))
                langs.append(lang)
                scores.append(score)
            out = [batch.column(i) for i in range(len(keep))] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(out, names=[*keep, *result])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    return docs.select(*keep, F.col("text").alias(*free_names(docs, "text"))).mapInArrow(task, ", ".join([*fields, f"`{result[0]}` string", f"`{result[1]}` double"]))


def remainder(doc_id: Column, n: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def language_id(docs: DataFrame, dims: int = DIMS) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from three of four crc32 remainders of doc_id."""
    prototypes = learn_prototypes(docs.where(~(F.coalesce(remainder(F.col("doc_id"), 4), F.lit(0)) == 2)), dims)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "text")
    return identify(keyed, prototypes, ["doc_id", "held_out"], dims)


#: Cosines of texts without any n-gram of a language lie about 0 with a deviation of 1 / sqrt(DIMS).
CHANCE = 4


def keep_identified(docs: DataFrame, languages: set[str] | None = None, least: float | None = None, dims: int = DIMS) -> DataFrame:
    """Documents whose predicted language is known (and in ``languages``) with a cosine of at least ``least``.

    By default that is CHANCE deviations of what unrelated letters give by chance. ``und`` documents go.
    The lang column is left as it is; all columns of docs are returned. Rows are judged one by one, so
    repeated rows and ties share a fate.
    """
    least = CHANCE / dims**0.5 if least is None else least
    prototypes = learn_prototypes(docs, dims)
    lang, score = free_names(docs, "lang_pred", "lang_score")
    judged = identify(docs, prototypes, docs.columns, dims, (lang, score))
    good = (F.col(lang) != UNDETERMINED) & (F.col(score) >= least)
    if languages is not None:
        good &= F.col(lang).isin(sorted(languages))
    return judged.where(good).select(*docs.columns)
