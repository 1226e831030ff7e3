"""Hard negatives of anchors by norm-bucketed search.

Components become whole numbers (floor of ``scale`` times each), so scores are exact. Candidates are
sorted by label and norm and packed to buckets of about BUCKET_ROWS rows, each with its greatest norm.
By Cauchy-Schwarz no row of a bucket scores more than the anchor's norm times that norm:

1. An anchor's positives, the first ``positives`` other rows of its label, are searched in buckets
   with its label; a bucket whose bound is under the running kth score is passed over.
2. Each positive sets a window of scores. Anchors are sorted by the norm that their lowest window
   limit asks of a candidate, and a block of them meets the buckets of at least that norm only; in a
   block's task, buckets come with falling norms and are passed over, anchor by anchor, whose bound is
   under the windows' lower limits or running kth scores.

Blocks of at most ANCHOR_ROWS anchors meet lanes (buckets of about LANE_BYTES, drawn by hash, so that
each has all norms) in a task, which returns the best of each window; the best of all lanes are
merged. No pair leaves a task but those, whatever a label's or a vector's share of the rows.

Defined results: rows with a null id, a null label, a null or empty vector or a null or non-finite
component take no part, nor do rows whose squared norm in whole numbers is 2^50 or more (their scores
would not be exact); vectors of different lengths are not compared; equal rows count once; rows that
share an anchor's id are never its positives; rows that share an id but differ are anchors and
candidates of their own; a window with its upper limit below the lower one is empty, as under
negative scores; an anchor without positives or negatives has no rows, an empty table none; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import partitions, staged

BUCKET_ROWS = 1024
ANCHOR_ROWS = 2048
LANE_BYTES = 1 << 26
BROADCAST_BLOCKS = 100_000
MOST_SQUARE = 2.0**50
NEVER = np.int64(2**62)


def whole_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, dims, square (of the norm), x (whole numbers), key of the rows that take part, each once."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.when(finite, F.transform("embedding", lambda c: F.floor(scale * c.cast("double")).cast("double"))).alias("f"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND size(f) > 0")
    rows = rows.withColumn("square", F.aggregate("f", F.lit(0.0), lambda s, c: s + c * c)).where(F.col("square") < MOST_SQUARE)
    rows = rows.select("vec_id", "label", F.size("f").alias("dims"), "square", F.transform("f", lambda c: c.cast("int")).alias("x"))
    return rows.distinct().withColumn("key", F.xxhash64("vec_id", "label", "x"))


def _matrix(column) -> np.ndarray:
    x = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _pack(batches):
    """Runs of sorted rows as one row a bucket; a new length, or a new label in a bucket that is a quarter full, begins another."""
    held, size = [], 0

    def bucket():
        rows = pa.Table.from_batches(held)
        ids, labels, x = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), _matrix(rows.column("x"))
        order = np.argsort(ids, kind="stable")  # of equal scores the smaller id is first
        small = x.astype(np.int16) if np.abs(x).max() < 2**15 else x
        out = [pa.array([x.shape[1]], pa.int32()), pa.array([float(np.sqrt(rows.column("square").to_numpy().max()))]), pa.array([np.unique(labels).tolist()], pa.list_(pa.int64()))]
        out += [pa.array([a[order].tobytes()], pa.binary()) for a in (ids, labels, small)]
        return pa.RecordBatch.from_arrays(out, names=["dims", "top", "labels", "ids", "marks", "data"])

    last = None
    for batch in batches:
        dims, labels = batch.column("dims").to_numpy(), batch.column("label").to_numpy()
        cuts = np.flatnonzero((np.diff(dims) != 0) | (np.diff(labels) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            while a < b:
                here = (dims[a], labels[a])
                if size and (size >= BUCKET_ROWS or here[0] != last[0] or (here != last and size >= BUCKET_ROWS // 4)):
                    yield bucket()
                    held, size = [], 0
                n = min(b - a, BUCKET_ROWS - size)
                held.append(batch.slice(a, n))
                size, a, last = size + n, a + n, here
    if size:
        yield bucket()


def buckets_of(rows: DataFrame) -> DataFrame:
    """Packed buckets of candidates with their number, and the lane each belongs to."""
    spark = rows.sparkSession
    ordered = rows.repartitionByRange(partitions(spark), "dims", "label", F.desc("square"), "vec_id").sortWithinPartitions("dims", "label", F.desc("square"), "vec_id", "key")
    packed = ordered.select("dims", "label", "vec_id", "square", "x").mapInArrow(_pack, "dims int, top double, labels array<long>, ids binary, marks binary, data binary")
    packed = staged(packed.withColumn("bucket", F.monotonically_increasing_id()), "buckets")  # written once: the numbers stay
    size = packed.agg(F.count("*").alias("n"), F.sum(F.length("data")).alias("bytes")).first()
    lanes = max(1, -(-(size["bytes"] or 0) // LANE_BYTES), min(partitions(spark), size.n))
    return packed.withColumn("lane", F.pmod(F.xxhash64("bucket"), F.lit(lanes)).cast("int"))


def _first(owner: np.ndarray, score: np.ndarray, ident: np.ndarray, count: int):
    """Places of each owner's ``count`` highest scores, smaller ids first among equals."""
    order = np.lexsort((ident, -score, owner))
    begin = np.flatnonzero(np.r_[True, np.diff(owner[order]) != 0]) if len(order) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.r_[begin, len(order)]))
    return order[rank < count]


def _thinned(score: np.ndarray, hit: np.ndarray, count: int) -> np.ndarray:
    """``hit`` with at most ``count`` of the highest scores a row; columns are sorted by id."""
    full = np.flatnonzero(hit.sum(axis=1) > count)
    if len(full):
        s = np.where(hit[full], score[full], -np.inf)
        least = np.partition(s, s.shape[1] - count, axis=1)[:, s.shape[1] - count][:, None]
        above, ties = s > least, s == least
        hit[full] = above | (ties & (np.cumsum(ties, axis=1) <= count - above.sum(axis=1, keepdims=True)))
    return hit


def best_in_windows(ids, labels, x, low, high, lane, count: int, same: bool):
    """(owner, score, id) of each window's best among the lane's buckets; owner is anchor * windows + window.

    low, high: (anchors, windows) whole numbers. lane: (top, ids, labels, x) of buckets, norms falling.
    """
    a, w = low.shape
    x = x.astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    cut = np.where(low > high, NEVER, low)
    owner, score, found = (np.zeros(0, dtype=np.int64) for _ in range(3))
    for top, c_ids, c_labels, c in lane:
        meets = np.flatnonzero(norm * top * (1 + 1e-9) >= cut.min(axis=1))
        new = []
        for at in range(0, len(meets), 256):
            some = meets[at : at + 256]
            s = x[some] @ c.T  # sums stay below 2^50: exact
            fits = (labels[some][:, None] == c_labels[None]) == same
            if same:
                fits &= ids[some][:, None] != c_ids[None]
            for j in range(w):
                hit = _thinned(s, fits & (s >= cut[some, j][:, None]) & (s <= high[some, j][:, None]), count)
                i, k = np.nonzero(hit)
                new.append((some[i] * w + j, s[i, k].astype(np.int64), c_ids[k]))
        if any(len(n[0]) for n in new):
            owner, score, found = (np.concatenate([old, *(n[p] for n in new)]) for p, old in enumerate((owner, score, found)))
            keep = _first(owner, score, found, count)
            owner, score, found = owner[keep], score[keep], found[keep]
            full = np.flatnonzero(np.bincount(owner, minlength=a * w) == count)
            kth = np.flatnonzero(np.r_[np.diff(owner) != 0, True])  # each owner's last
            kth = kth[np.isin(owner[kth], full)]
            cut.reshape(-1)[owner[kth]] = np.maximum(cut.reshape(-1)[owner[kth]], score[kth])
    return owner, score, found


def _lane(table: pa.Table):
    """Buckets of a lane with falling norms."""
    for k in np.argsort(-table.column("top").to_numpy(), kind="stable"):
        ids = np.frombuffer(table.column("ids")[k].as_py(), dtype=np.int64)
        data, dims = table.column("data")[k].as_py(), table.column("dims")[k].as_py()
        kind = np.int16 if len(data) == 2 * dims * len(ids) else np.int32
        yield table.column("top")[k].as_py(), ids, np.frombuffer(table.column("marks")[k].as_py(), dtype=np.int64), np.frombuffer(data, dtype=kind).reshape(len(ids), dims).astype(np.float64)


def _task(count: int, same: bool):
    """Function of one (block, lane) group: key of the anchor, window, id and score."""

    def task(anchors: pa.Table, lane: pa.Table) -> pa.Table:
        if not anchors.num_rows or not lane.num_rows:
            empty = np.zeros(0, dtype=np.int64)
            return pa.table({"key": empty, "window": empty, "id": empty, "score": empty})
        low, high = (_matrix(anchors.column(c)) for c in ("low", "high"))
        owner, score, found = best_in_windows(anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy(), _matrix(anchors.column("x")), low.copy(), high, _lane(lane), count, same)
        anchor, window = np.divmod(owner, low.shape[1])
        return pa.table({"key": anchors.column("key").to_numpy()[anchor], "window": window, "id": found, "score": score})

    return task


def _blocks(anchors: DataFrame, *order: Column | str) -> DataFrame:
    """Anchors with a block number: at most ANCHOR_ROWS neighbours in the order, of one length."""
    ranged = anchors.repartitionByRange(max(1, partitions(anchors.sparkSession) // 4), "dims", *order).sortWithinPartitions("dims", *order)
    number = F.monotonically_increasing_id()
    return staged(ranged.withColumn("block", F.struct((number / ANCHOR_ROWS).cast("long").alias("b"), "dims")), "blocks")  # written once: the numbers stay


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_BLOCKS + 1).count() <= BROADCAST_BLOCKS else df


def _search(blocks: DataFrame, met: DataFrame, count: int, same: bool) -> DataFrame:
    """Best ``count`` a window: key, window, id, score, rank. met: packed buckets with the block that each meets."""
    lanes = staged(met.select("block", "lane").distinct(), "pairs")
    left = blocks.join(lanes, "block").select("block", "lane", "key", "vec_id", "label", "x", "low", "high")
    right = met.select("block", "lane", "dims", "top", "ids", "marks", "data")
    found = left.groupBy("block", "lane").cogroup(right.groupBy("block", "lane")).applyInArrow(_task(count, same), "key long, window long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("key", "window").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= count)


def mine_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows where ``anchor`` (over vec_id, label).

    A window holds the scores between ``least`` and ``most`` hundredths of the positive's.
    """
    rows = staged(whole_vectors(vectors, scale), "whole")
    packed = buckets_of(rows)
    limit = lambda v, n=1: F.array_repeat(F.lit(int(v)).cast("long"), n)
    first = _blocks(rows.where(anchor).withColumn("low", limit(-NEVER)).withColumn("high", limit(NEVER)), "label", "key")
    shared = packed.select("bucket", "dims", F.explode("labels").alias("label")).join(_small(first.select("block", "dims", "label").distinct()), ["dims", "label"])
    meets = shared.groupBy("bucket").agg(F.collect_set("block").alias("blocks"))
    found = _search(first, packed.join(meets, "bucket").withColumn("block", F.explode("blocks")), positives, True)
    lists = found.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("found"))
    # 100 * negative is between least and most times the positive's score, in whole numbers
    hundredths = lambda p, n: (p["score"] * n).cast("decimal(20,0)") / 100
    padded = lambda a, v: F.concat(a, F.array_repeat(F.lit(int(v)), positives - F.size("found")))
    wanted = rows.where(anchor).join(lists, "key")
    wanted = wanted.withColumn("low", padded(F.transform("found", lambda p: F.ceil(hundredths(p, least)).cast("long")), NEVER))
    wanted = wanted.withColumn("high", padded(F.transform("found", lambda p: F.floor(hundredths(p, most)).cast("long")), -NEVER))
    need = F.array_min(F.zip_with("low", "high", lambda lo, hi: F.when(lo <= hi, lo).otherwise(F.lit(int(NEVER))))) / F.greatest(F.sqrt("square"), F.lit(1e-300))
    second = _blocks(wanted.withColumn("need", need), "need", "key")
    asks = _small(staged(second.groupBy("block", "dims").agg(F.min("need").alias("need")), "needs"))
    met = packed.join(asks, (packed["dims"] == asks["dims"]) & (packed["top"] * (1 + 1e-9) >= asks["need"])).drop(asks["dims"])
    best = _search(second, met, negatives, False)
    facts = second.select("key", F.col("vec_id").alias("anchor_id"), F.posexplode("found").alias("window", "p")).select("key", F.col("window").cast("long").alias("window"), "anchor_id", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    out = best.join(facts, ["key", "window"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
