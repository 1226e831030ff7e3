"""A stored inverted index in segments: posting blocks with their maxima, and ranked search that skips blocks.

A batch of documents becomes a segment. Its documents are dealt to slices by the hash of their id and
numbered in order of the id; the postings of a term in a slice are cut into blocks of BLOCK postings, and
a block keeps the most occurrences and the least length of its documents, which bound what any of them
can score under any statistics. A segment is written once, sorted by term, with its terms' document
counts and its totals; a manifest names the segments, so document frequencies and lengths follow each
batch without touching older ones.

``search`` reads the blocks of the asked terms only. A task gets one slice and a bounded number of
queries; for each it cuts the slice at block borders into ranges, adds up the bounds of the blocks over a
range, opens ranges with falling bounds, and ends when the next bound is below the kth score so far. How
many blocks a query met and how many were opened is reported.

Defined results: null texts are documents of length 0; rows with one id are documents each; of equal
rounded scores the smaller id is first; terms that no document holds add nothing; without documents there
are no rows.
"""

from __future__ import annotations

import json
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.folders import stored
from ..sources.keyed_store import Conflict, Files
from .search import B, BROADCAST_TERMS, K1, asked_terms, tokens, top_per_query

BLOCK = 128
SLICE_DOCS = 65_536
QUERY_ROWS = 1_024


def gain(tf, dl, mean, k1: float = K1, b: float = B):
    """What a term's occurrences are worth before its weight; grows with tf, falls with dl."""
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / mean))


def best_of_slice(lists: list[tuple], opened, count: int, k: int, digits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(numbers, scores, blocks opened) of the k best documents of a slice of ``count`` documents.

    lists: for each term its weight, the first and last document and the bound of its blocks, and their places;
    opened(places, weight) gives (documents, gains) of blocks. Scores are rounded to ``digits``.
    """
    slack = 10.0**-digits
    cuts = np.unique(np.concatenate([np.concatenate([first, last + 1]) for _, first, last, _, _ in lists]))
    starts = cuts[:-1]
    bound, cover = np.zeros(len(starts)), []
    for weight, first, last, most, _ in lists:
        at = np.searchsorted(first, starts, side="right") - 1
        at[(at >= 0) & (starts > last[at])] = -1
        cover.append(at)
        bound += np.where(at >= 0, weight * most[at], 0.0)
    order = np.argsort(-bound, kind="stable")
    order = order[bound[order] > 0]
    total, met, used = np.zeros(count), np.zeros(0, dtype=np.int64), [np.zeros(len(first), dtype=bool) for _, first, *_ in lists]
    scores, done, step = np.zeros(0), 0, 8
    while done < len(order):
        if len(scores) == k and bound[order[done]] < scores[-1] - slack:
            break
        some = np.sort(order[done : done + step])
        done, step = done + step, 2 * step
        chosen = np.zeros(len(starts), dtype=bool)
        chosen[some] = True
        new = []
        for (weight, _, _, _, places), at, seen in zip(lists, cover, used):
            blocks = np.unique(at[some])
            blocks = blocks[blocks >= 0]
            if not len(blocks):
                continue
            seen[blocks] = True
            docs, worth = opened(places[blocks], weight)
            inside = chosen[np.searchsorted(starts, docs, side="right") - 1]
            total[docs[inside]] += worth[inside]  # a document is once in a list
            new.append(docs[inside])
        met = np.unique(np.concatenate([met, *new]))
        value = np.round(total[met], digits)
        best = np.lexsort((met, -value))[:k]
        met, scores = np.sort(met[best]), np.sort(value[best])[::-1]
    value = np.round(total[met], digits)
    keep = np.lexsort((met, -value))
    return met[keep], value[keep], int(sum(s.sum() for s in used))


class StoredIndex:
    """Segments of an inverted index below ``path``."""

    def __init__(self, spark: SparkSession, path: str, doc: str = "doc_id"):
        self.spark, self.files, self.doc = spark, Files(spark, path), doc

    def segments(self) -> list[str]:
        known = [n for n in self.files.names("manifest") if re.fullmatch(r"\d{12}\.json", n)]
        return json.loads(self.files.read(f"manifest/{known[-1]}"))["segments"] if known else []

    def _table(self, kind: str, segments: list[str]) -> DataFrame:
        read = self.spark.read.option("basePath", str(self.files.path("").toString()))
        return read.parquet(*[str(self.files.path(f"segment={s}/{kind}").toString()) for s in segments])

    def add(self, docs: DataFrame, body: str) -> str:
        """Indexes a batch of new documents as a segment; an earlier one is not read."""
        name = uuid.uuid4().hex
        out = lambda kind: str(self.files.path(f"segment={name}/{kind}").toString())
        slices = max(1, -(-docs.count() // SLICE_DOCS))
        dealt = docs.select(F.col(self.doc).alias("doc"), F.col(body).alias("body")).repartition(slices, F.xxhash64("doc")).sortWithinPartitions("doc", F.xxhash64("body"))
        number = F.monotonically_increasing_id()
        words = stored(dealt.select("doc", F.shiftright(number, 33).cast("int").alias("slice"), number.bitwiseAND((1 << 33) - 1).cast("int").alias("ord"), F.sort_array(tokens(F.col("body"))).alias("w")), "words")
        words = words.withColumn("dl", F.size("w"))
        words.groupBy("slice").agg(F.count("*").alias("docs"), F.sum("dl").alias("total")).write.parquet(out("stats"))
        words.select("slice", "ord", "doc").repartition("slice").write.parquet(out("docs"))
        # a row is a document: its sorted words are counted there, from where each term starts to where the next one does
        start = F.filter(F.sequence(F.lit(0), F.col("dl") - 1), lambda i: (i == 0) | (F.get("w", i) != F.get("w", i - 1)))
        runs = words.where("dl > 0").withColumn("at", start)
        spans = F.arrays_zip(F.col("at"), F.concat(F.slice("at", 2, F.size("at")), F.array("dl")).alias("end"))
        counted = F.transform(spans, lambda r: F.struct(F.get("w", r["at"]).alias("term"), (r["end"] - r["at"]).alias("tf")))
        held = runs.select("slice", "ord", "dl", F.explode(counted).alias("r")).select("slice", "ord", "dl", "r.term", "r.tf")
        place = F.row_number().over(Window.partitionBy("slice", "term").orderBy("ord")) - 1
        blocks = held.withColumn("block", (place / BLOCK).cast("int")).groupBy("slice", "term", "block")
        postings = F.sort_array(F.collect_list(F.struct("ord", "tf", "dl"))).alias("p")
        blocks = blocks.agg(F.min("ord").alias("first"), F.max("ord").alias("last"), F.max("tf").alias("most"), F.min("dl").alias("least"), postings)
        blocks = blocks.select("term", "slice", "block", "first", "last", "most", "least", *[F.col(f"p.{c}").alias(f"{c}s") for c in ("ord", "tf", "dl")])
        blocks.repartitionByRange("term", "slice").sortWithinPartitions("term", "slice", "block").write.parquet(out("blocks"))
        counts = self._table("blocks", [name]).groupBy("term").agg(F.sum(F.size("ords")).alias("df"))
        counts.repartitionByRange("term").sortWithinPartitions("term").write.parquet(out("terms"))
        while True:
            known = [n for n in self.files.names("manifest") if re.fullmatch(r"\d{12}\.json", n)]
            version = int(known[-1][:12]) + 1 if known else 1
            try:
                self.files.create(f"manifest/{version:012d}.json", json.dumps({"segments": [*self.segments(), name]}))
                return name
            except Conflict:  # another batch was first
                continue

    def frequencies(self, segments: list[str] | None = None) -> DataFrame:
        """(term, df) over all segments."""
        return self._table("terms", segments or self.segments()).groupBy("term").agg(F.sum("df").alias("df"))

    def search(self, queries: DataFrame, query: str, asked: str, k: int = 20, k1: float = K1, b: float = B, digits: int = 9) -> tuple[DataFrame, DataFrame]:
        """(query, doc, score, rank) of the k best, and the work: (query, blocks, opened)."""
        segments, kind = self.segments(), dict(queries.dtypes)[query]
        if not segments:
            raise ValueError("the index has no segment")
        terms = stored(asked_terms(queries, query, asked).withColumnRenamed(query, "q"), "asked")
        wanted = terms.select("term").distinct()
        wanted = F.broadcast(wanted) if wanted.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS else wanted
        shape = self._table("stats", segments).agg(F.sum("docs").alias("n"), F.sum("total").alias("total")).first()
        n, mean = shape.n, max(shape.total or 0, 1) / shape.n
        df = self.frequencies(segments).join(wanted, "term")
        weight: Column = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
        weighted = terms.join(df.select("term", weight.alias("weight")), "term")
        count = -(-terms.select("q").distinct().count() // QUERY_ROWS)
        weighted = stored(weighted.withColumn("qb", F.pmod(F.xxhash64("q"), F.lit(max(1, count))).cast("int")), "weighted")
        needed = stored(weighted.select("qb", "term").distinct(), "needed")
        blocks = self._table("blocks", segments).join(wanted, "term", "left_semi")
        blocks = blocks.join(F.broadcast(needed) if needed.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS else needed, "term")
        sizes = self._table("stats", segments).select("segment", "slice", "docs")  # a row a slice
        met = stored(blocks.select("segment", "slice", "qb", "term").distinct(), "met").join(sizes, ["segment", "slice"])
        left = weighted.join(met, ["qb", "term"]).select("segment", "slice", "qb", "docs", "q", "term", "weight")  # a query goes to slices that hold its terms

        def task(questions: pa.Table, held: pa.Table) -> pa.Table:
            empty = questions.slice(0, 0)
            columns = lambda q, seg, sl, o, s, met, op: pa.table({"q": q, "segment": seg, "slice": sl, "ord": o, "score": s, "blocks": met, "opened": op})
            none = pa.array([], pa.int64())
            if not questions.num_rows or not held.num_rows:
                return columns(empty.column("q"), empty.column("segment"), pa.array([], pa.int32()), pa.array([], pa.int32()), pa.array([], pa.float64()), none, none)
            order = pa.compute.sort_indices(held, sort_keys=[("term", "ascending"), ("block", "ascending")])
            held = held.take(order)
            first, last, most, least = (held.column(c).to_numpy() for c in ("first", "last", "most", "least"))
            bound = gain(most.astype(np.float64), least, mean, k1, b)
            lists = [held.column(c).combine_chunks() for c in ("ords", "tfs", "dls")]
            flat = [x.flatten().to_numpy(zero_copy_only=False) for x in lists]
            ends = np.concatenate([[0], np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False))])
            names = held.column("term").to_numpy(zero_copy_only=False)
            begin = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
            places = {names[i]: np.arange(i, j) for i, j in zip(begin, np.r_[begin[1:], len(names)])}

            def opened(chosen: np.ndarray, weight: float):
                at = np.concatenate([np.arange(ends[c], ends[c + 1]) for c in chosen])
                return flat[0][at].astype(np.int64), weight * gain(flat[1][at].astype(np.float64), flat[2][at], mean, k1, b)

            asks: dict[int, list] = {}
            codes = pa.compute.dictionary_encode(questions.column("q").combine_chunks(), null_encoding="encode")
            for q, t, w in zip(codes.indices.to_pylist(), questions.column("term").to_pylist(), questions.column("weight").to_pylist()):
                if t in places:
                    p = places[t]
                    asks.setdefault(q, []).append((w, first[p], last[p], bound[p], p))
            out = []
            for q, lists_ in asks.items():
                docs, scores, used = best_of_slice(lists_, opened, questions.column("docs")[0].as_py(), k, digits)
                out.append((q, docs, scores, sum(len(x[4]) for x in lists_), used))
            size = [len(d) + 1 for _, d, *_ in out]
            whose = np.repeat(np.array([q for q, *_ in out], dtype=np.int64), size)
            total = int(sum(size))
            score = np.concatenate([np.r_[s, np.nan] for _, _, s, _, _ in out]) if out else np.zeros(0)
            work = np.isnan(score)
            spread = lambda values: pa.array(np.repeat(np.array(values, dtype=np.int64), size), mask=~work)
            numbers = np.concatenate([np.r_[d, 0] for _, d, *_ in out]).astype(np.int32) if out else np.zeros(0, dtype=np.int32)
            same = lambda c, t: pa.array([questions.column(c)[0].as_py()] * total, t)
            return columns(codes.dictionary.take(pa.array(whose)), same("segment", pa.string()), same("slice", pa.int32()), pa.array(numbers, mask=work), pa.array(score, mask=work), spread([m for *_, m, _ in out]), spread([u for *_, u in out]))

        on = ("segment", "slice", "qb")
        found = left.groupBy(*on).cogroup(blocks.groupBy(*on)).applyInArrow(task, f"q {kind}, segment string, slice int, ord int, score double, blocks long, opened long")
        found = stored(found, "found")
        work = found.where("score IS NULL").groupBy(F.col("q").alias(query)).agg(F.sum("blocks").alias("blocks"), F.sum("opened").alias("opened"))
        hits = found.where("score IS NOT NULL").select("q", "segment", "slice", "ord", "score")
        hits = hits.join(self._table("docs", segments), ["segment", "slice", "ord"]).select(F.col("q").alias(query), F.col("doc").alias(self.doc), "score")
        return top_per_query(hits, query, self.doc, k), work
