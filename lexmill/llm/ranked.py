"""Ranked lexical search by Fagin's threshold algorithm.

One pass over the texts makes a forward index: of every document its number of terms and, of the
terms that are asked for, how often it holds them. It is written once; statistics (documents, their
terms, documents a term) come from it by aggregation. The weights go to every task, whose part of the
forward index is cut into shards of at most SHARD_POSTINGS postings. A shard gets one list a term, sorted
by impact. For each query its lists are read round-robin, STEP postings of each in a turn; every
document met gets its whole score at once by random access to the shard's forward index; the search of
a shard ends when the sum of the impacts last read, the threshold, falls strictly below the kth score
so far. That score is carried from shard to shard of a task. The best of the tasks are merged in two
rounds, so that no task gets all of a query's rows.

Queries are dealt to blocks of about BLOCK_TERMS terms, and each block takes a pass of its own over the
texts, so what a task or the driver holds is bounded however many queries there are.

Terms are the maximal runs of digits, letters and characters beyond ASCII; only A-Z are lower-cased. All
numbers are 64-bit integers apart from a term's weight, which is the floor of a double.

Defined results: null texts have no terms; documents without terms do not count; rows with one
doc_id are documents each; a null doc_id comes last among equal scores; a query without known terms has
no rows; queries with one item_id share a ranking, of the terms of all of them; a null item_id is a
query like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import partitions, staged

BEST = 50
STEP = 64
BLOCK_TERMS = 200_000
SHARD_POSTINGS = 2_000_000
#: Bytes of terms, A-Z lower-cased; all others end a term. UTF-8 continues characters beyond ASCII with such bytes only.
_FOLD = bytes((b | 32 if 65 <= b <= 90 else b) if (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _text(column) -> pa.Array:
    x = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return x.cast(pa.large_binary())


def query_terms(queries: DataFrame, item: str, body: str) -> DataFrame:
    """(item, term) of every query, each once; terms are UTF-8 bytes."""

    def task(batches):
        for batch in batches:
            texts = _text(batch.column(1))
            found = [sorted(set(terms_of(t.as_py()))) if t.is_valid else [] for t in texts]
            rows = np.repeat(np.arange(len(found)), np.array([len(f) for f in found], dtype=np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array([t for f in found for t in f], pa.binary())], names=["item", "term"])

    kind = queries.schema[item].dataType.simpleString()
    return queries.select(item, F.col(body).cast("string")).mapInArrow(task, f"item {kind}, term binary").distinct()


def _forward(numbers: dict[bytes, int]):
    """Task: doc, n and the numbers and counts of asked terms of every document with a term."""

    def task(batches):
        get = numbers.get
        for batch in batches:
            texts = _text(batch.column(1))
            kept, sizes, ends, terms, counts = [], [], [0], [], []
            for row in range(batch.num_rows):
                words = terms_of(texts[row].as_py()) if texts[row].is_valid else []
                if not words:
                    continue
                held = Counter(map(get, words))
                held.pop(None, None)
                order = sorted(held)
                terms += order
                counts += [held[t] for t in order]
                kept.append(row)
                sizes.append(len(words))
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind)) for x, kind in ((terms, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()), *lists], names=["doc", "n", "terms", "counts"])

    return task


class Shard:
    """Forward index and impact-sorted lists of some documents."""

    def __init__(self, docs: np.ndarray, starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray, known: int):
        """starts: documents' places in terms and impacts, one more than documents; terms rise within a document."""
        self.docs, self.known = docs, known
        owner = np.repeat(np.arange(len(docs), dtype=np.int64), np.diff(starts))
        self.key, self.impact = owner * known + terms, impacts  # sorted: random access by search
        order = np.lexsort((owner, -impacts, terms))
        self.by_impact, self.owner = impacts[order], owner[order]
        self.lists = np.searchsorted(terms[order], np.arange(known + 1))
        self.read = 0

    def scores(self, docs: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Whole scores of documents, by random access."""
        total = np.zeros(len(docs), dtype=np.int64)
        for t in query:
            want = docs * self.known + t
            at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            total += np.where(self.key[at] == want, self.impact[at], 0)
        return total

    def best(self, query: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(places of documents, scores): holds all of the k best that score ``least`` or more; 0 scores never."""
        begin, end = self.lists[query], self.lists[query + 1]
        query, begin, end = query[end > begin], begin[end > begin], end[end > begin]
        seen = np.zeros(len(self.docs), dtype=bool)
        docs, scores, depth = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 0
        while len(query) and (begin + depth < end).any():
            turn = [self.owner[b + depth : min(b + depth + STEP, e)] for b, e in zip(begin, end) if b + depth < e]
            depth += STEP
            self.read += sum(map(len, turn))
            new = np.unique(np.concatenate(turn))
            new = new[~seen[new]]
            seen[new] = True
            docs, scores = np.concatenate([docs, new]), np.concatenate([scores, self.scores(new, query)])
            last = begin + depth - 1
            threshold = int(self.by_impact[last[last < end]].sum()) if (last < end).any() else 0
            if len(scores) >= k:
                kth = int(np.partition(scores, len(scores) - k)[len(scores) - k])
                least = max(least, kth)
                near = scores >= kth  # ties stay until ids decide
                docs, scores = docs[near], scores[near]
            if threshold < least:
                break
        keep = scores >= max(least, 1)
        return docs[keep], scores[keep]


def _first(score: np.ndarray, ident: np.ndarray, missing: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ident, missing, -score))[:k]


def _search(queries: list[np.ndarray], weights: np.ndarray, documents: int, length: int, k: int):
    """Task: number of the query, doc and score of the k best of a part of the forward index."""

    def shards(batches):
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                held.append(some)
                size += len(some.column(2).flatten())
                if size >= SHARD_POSTINGS:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def task(batches):
        none = np.zeros(0, dtype=np.int64)
        best = [(none, none, none.astype(bool))] * len(queries)
        for held in shards(batches):
            rows = pa.Table.from_batches(held)
            ids = rows.column("doc").combine_chunks()
            missing, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
            lists = rows.column("terms").combine_chunks()
            terms = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            counts = rows.column("counts").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            m = 50 + 50 * rows.column("n").to_numpy() * documents // length
            impacts = weights[terms] * (1_000_000_000 * counts // (1000 * counts + 20 * np.repeat(m, np.diff(starts))))
            some = impacts > 0
            starts = np.concatenate([[0], np.cumsum(some)])[starts]
            if not some.any():
                continue
            shard = Shard(ids, starts, terms[some], impacts[some], len(weights))
            for q, query in enumerate(queries):
                score, ident, absent = best[q]
                docs, new = shard.best(query, k, int(score.min()) if len(score) == k else 1)
                if len(docs):
                    score, ident, absent = np.concatenate([score, new]), np.concatenate([ident, ids[docs]]), np.concatenate([absent, missing[docs]])
                    keep = _first(score, ident, absent, k)
                    best[q] = score[keep], ident[keep], absent[keep]
        number = np.repeat(np.arange(len(queries)), np.array([len(b[0]) for b in best], dtype=np.int64))
        if len(number):
            score, ident, absent = (np.concatenate([b[p] for b in best]) for p in range(3))
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), pa.array(ident, pa.int64(), mask=absent), pa.array(score, pa.int64())], names=["query", "doc", "score"])

    return task


def _blocks(asked: DataFrame, most: int):
    """Lists of (item, terms) whose terms come to about ``most`` each; one list at a time is on the driver."""
    per = asked.groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    total = asked.count()
    blocks = max(1, -(-total // most))
    per = staged(per.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks))), "asked")
    for b in range(blocks):
        yield [(r["item"], r.terms) for r in per.where(F.col("block") == b).collect()]


def search_ranked(docs: DataFrame, queries: DataFrame, doc: str = "doc_id", body: str = "text", item: str = "item_id", asked: str = "text", k: int = BEST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every query, equal scores by doc_id."""
    spark, out = docs.sparkSession, None
    kind = queries.schema[item].dataType.simpleString()
    wanted = staged(query_terms(queries, item, asked), "asked-terms")
    for rows in _blocks(wanted, block_terms):
        words = sorted({t for _, terms in rows for t in terms})
        numbers = {bytes(t): i for i, t in enumerate(words)}
        lists = [np.array([numbers[bytes(t)] for t in terms], dtype=np.int64) for _, terms in rows]
        known = spark.sparkContext.broadcast(numbers)  # at most a block's terms
        forward = docs.select(F.col(doc).cast("long"), F.col(body).cast("string")).mapInArrow(lambda batches, known=known: _forward(known.value)(batches), "doc long, n long, terms array<int>, counts array<long>")
        forward = staged(forward, "forward")
        shape = forward.agg(F.count("*").alias("n"), F.sum("n").alias("length")).first()
        df = np.zeros(len(words), dtype=np.int64)
        for r in forward.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most a block's terms
            df[r.t] = r["count"]
        weights = np.floor(1000 * np.log((2.0 * shape.n + 2) / (2.0 * df + 1))).astype(np.int64)
        task = _search(lists, weights, shape.n, shape.length or 1, k)
        found = forward.mapInArrow(task, "query int, doc long, score long")
        order = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc")))
        found = found.withColumn("part", F.pmod(F.xxhash64("doc"), F.lit(partitions(spark)))).withColumn("rank", order("query", "part")).where(F.col("rank") <= k)
        found = found.withColumn("rank", order("query")).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item_) for i, (item_, _) in enumerate(rows)], f"query int, item {kind}")
        part = staged(found.join(F.broadcast(names), "query").select(F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), "score"), "ranked")
        out = part if out is None else out.unionByName(part)
    return out
