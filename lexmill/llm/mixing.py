"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

A keyed hash lays every source's documents on a permuted axis. The axis is cut into equal blocks; a
source's target becomes whole passes over its blocks plus a prefix of one more pass, found by radix
selection on word sums (no sort, no window over documents). The integer block quotas of all sources
are split between halves of the output shards, again and again, by multivariate hypergeometric
draws, so that each shard knows how many blocks of each source it holds. Shard k then takes the next
blocks of each source's permuted sequence, which are disjoint by construction; documents join their
blocks, which says what is taken, and each shard orders its documents by a local key.

Only one row per source (``source`` is a dimension; documented bound ``MAX_SOURCES``) and the top of
the tree pass the driver; tasks split the rest, and no array grows with the number of shards.

Defined results: null text has size 0; a null source is a source of its own, last in order; sources
without words have target 0; an empty table gives no rows; rows that repeat a doc_id are mixed each
for itself; columns that clash with the result's names are ignored by ``mix_sizes`` and kept by
``mix_documents`` (helper columns take free names).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import free_names, staged

WORD = r"[^\x20\x09-\x0D]+"
MAX_SOURCES = 1_000_000
BLOCK_WORDS = 65_536
SHARD_WORDS = 8_000_000
SUBTREES = 1024
AXIS_BITS, LEVEL_BITS, LEVELS = 60, 12, 3


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def axis_position(seed: int, *columns: str) -> Column:
    """Place on the permuted axis: 60 bits of a keyed hash."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in columns]).bitwiseAND(F.lit((1 << AXIS_BITS) - 1))


def fill_targets(sizes: list[int], weights: list[float], share: float, cap: float) -> list[float]:
    """Share ``share`` times the total by weight; what exceeds ``cap`` times a size is reshared."""
    target, free, left = [0.0] * len(sizes), [i for i, n in enumerate(sizes)], share * sum(sizes)
    while free:
        unit = left / sum(weights[i] for i in free)
        over = [i for i in free if unit * weights[i] > cap * sizes[i]]
        if not over:
            for i in free:
                target[i] = unit * weights[i]
            break
        for i in over:
            target[i] = float(cap * sizes[i])
            left -= target[i]
        free = [i for i in free if i not in set(over)]
    return target


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources) block counts: the tree of multivariate hypergeometric draws; columns sum to quotas."""
    if shards <= 1:
        return quotas.reshape(1, -1)
    left, total = shards // 2, int(quotas.sum())
    drawn = rng.multivariate_hypergeometric(quotas, total * left // shards, method="marginals") if total else quotas * 0
    return np.vstack([split_quotas(drawn, left, rng), split_quotas(quotas - drawn, shards - left, rng)])


def _boundaries(docs: DataFrame, need: DataFrame) -> DataFrame:
    """For each source, the 36-bit axis prefix at which the words before it reach ``need``."""
    state = need.select("source", F.lit(0).cast("long").alias("prefix"), "need")
    for level in range(1, LEVELS + 1):
        low = AXIS_BITS - LEVEL_BITS * level
        at = state.select(F.col("source").alias("s"), "prefix", "need")
        bins = (
            docs.join(at, docs["source"].eqNullSafe(at["s"]))
            .where(F.shiftright("axis", low + LEVEL_BITS) == F.col("prefix"))
            .groupBy("s", "prefix", "need", F.shiftright("axis", low).alias("bin"))
            .agg(F.sum("size").alias("words"))
        )
        order = Window.partitionBy("s").orderBy("bin")  # at most 4,096 bins of one source
        bins = bins.withColumn("before", F.sum("words").over(order) - F.col("words"))
        found = bins.where(F.col("before") <= F.col("need")).groupBy("s").agg(F.max_by(F.struct("bin", F.col("need") - F.col("before")), "bin").alias("x"))
        state = found.select(F.col("s").alias("source"), F.col("x.bin").alias("prefix"), F.col("x.col2").alias("need"))
        rows = [(r.source, r.prefix, float(r.need)) for r in state.collect()]  # a row a source
        state = docs.sparkSession.createDataFrame(rows, "source string, prefix long, need double")
    return state


def subtrees(quotas: np.ndarray, shards: int, most: int, rng: np.random.Generator) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """The top of the tree, at most about ``most`` nodes: (first shard, shards, quotas, blocks before) of each."""
    nodes = [(0, shards, quotas)]
    while len(nodes) < most and any(n > 1 for _, n, _ in nodes):
        lower = []
        for first, n, own in nodes:
            if n > 1:
                left, total = n // 2, int(own.sum())
                drawn = rng.multivariate_hypergeometric(own, total * left // n, method="marginals") if total else own * 0
                lower += [(first, left, drawn), (first + left, n - left, own - drawn)]
            else:
                lower.append((first, n, own))
        nodes = lower
    before = np.cumsum([own for _, _, own in nodes], axis=0) - [own for _, _, own in nodes]
    return [(first, n, own, start) for (first, n, own), start in zip(nodes, before)]


def shard_blocks(spark: SparkSession, quotas: np.ndarray, shards: int, seed: int) -> DataFrame:
    """(src, at, shard): which shard draws the block at a place of a source's permuted sequence.

    The driver splits down to SUBTREES nodes; tasks split those to shards.
    """
    nodes = subtrees(quotas, shards, SUBTREES, np.random.default_rng(seed))
    rows = [(f, n, own.tolist(), start.tolist()) for f, n, own, start in nodes if len(own)]

    def task(batches):
        for batch in batches:
            for first, n, own, start in zip(*(c.to_pylist() for c in batch.columns)):
                counts = split_quotas(np.array(own, dtype=np.int64), n, np.random.default_rng([seed, first]))
                for i, (blocks, at) in enumerate(zip(own, start)):
                    shard = np.repeat(np.arange(first, first + n), counts[:, i])
                    for k in range(0, blocks, 100_000):
                        some = shard[k : k + 100_000]
                        yield pa.RecordBatch.from_pydict({"src": np.full(len(some), i, np.int32), "at": np.arange(at + k, at + k + len(some)), "shard": some})

    frame = spark.createDataFrame(rows, "first long, shards long, quotas array<long>, before array<long>")
    return frame.repartition(max(1, min(len(rows), 64))).mapInArrow(task, "src int, at long, shard long")


def plan_mix(sizes: DataFrame, weights=(5.0, 2.0, 1.0), share=1.5, cap=2.0, seed=20, block_words=BLOCK_WORDS, shard_words=SHARD_WORDS) -> tuple[DataFrame, DataFrame, int]:
    """One row per source (target, whole passes, boundary prefix, block bits), the blocks of shards, and how many shards.

    ``sizes`` has source, size (words) and axis.
    """
    spark = sizes.sparkSession
    totals = sorted(((r.source, int(r.words)) for r in sizes.groupBy("source").agg(F.sum("size").alias("words")).limit(MAX_SOURCES + 1).collect()), key=lambda r: (r[0] is None, (r[0] or "").encode("utf-32-be")))
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: this operator mixes sources, not documents")
    words = [n for _, n in totals]
    targets = fill_targets(words, [weights[i % len(weights)] for i in range(len(words))], share, cap)
    passes = [int(t // n) if n else 0 for t, n in zip(targets, words)]
    need = [(s, t - p * n) for (s, n), t, p in zip(totals, targets, passes)]
    edges = {r.source: r.prefix for r in _boundaries(sizes, spark.createDataFrame([x for x in need if x[1] > 0] or [("", 0.0)], "source string, need double")).collect()}
    bits = [min(24, max(4, math.ceil(math.log2(max(1, n / block_words))))) for n in words]
    prefix = [int(edges.get(s) or 0) if m > 0 else 0 for s, m in need]
    partial = [(e + (1 << (LEVELS * LEVEL_BITS - b)) - 1) >> (LEVELS * LEVEL_BITS - b) for e, b in zip(prefix, bits)]
    quotas = np.array([p * (1 << b) + x for p, b, x in zip(passes, bits, partial)], dtype=np.int64)
    shards = max(1, math.ceil(sum(targets) / shard_words))
    rows = [(s, i, n, float(t), p, e, b) for i, ((s, n), t, p, e, b) in enumerate(zip(totals, targets, passes, prefix, bits))]
    plan = spark.createDataFrame(rows, "plan_source string, src int, source_size long, target double, passes int, prefix long, bits int")
    return plan, shard_blocks(spark, quotas, shards, seed), shards


def drawn_copies(docs: DataFrame, plan: DataFrame, blocks: DataFrame, axis: str, keep: list[str], copy: str, shard: str) -> DataFrame:
    """The ``keep`` columns of docs, a row for each copy that a shard's block quota draws, with its number and shard.

    A copy stands in block ``copy * 2^bits + block of its axis``; of the last pass, what lies before the
    boundary is offered. ``docs`` has source and the ``axis`` column.
    """
    a, some = plan.alias("p"), docs.alias("d")
    b = blocks.select(F.col("src").alias("block_src"), F.col("at").alias("block_at"), F.col("shard").alias("block_shard"))
    joined = some.join(a, F.col("d.source").eqNullSafe(F.col("p.plan_source")))
    position = F.col(f"d.{axis}")
    copies = F.col("p.passes") + (F.shiftright(position, AXIS_BITS - LEVELS * LEVEL_BITS) < F.col("p.prefix")).cast("int")
    offered = joined.select(F.struct(*[F.col(f"d.`{c}`") for c in keep]).alias("d"), F.struct("p.*").alias("p"), F.explode(F.when(copies > 0, F.sequence(F.lit(0), copies - 1)).otherwise(F.array().cast("array<int>"))).alias("n"))
    at = F.expr(f"n * shiftleft(1L, p.bits) + shiftright(d.`{axis}`, {AXIS_BITS} - p.bits)")
    drawn = offered.withColumn("at", at).join(b, (F.col("p.src") == F.col("block_src")) & (F.col("at") == F.col("block_at")))
    return drawn.select(*[F.col(f"d.`{c}`").alias(c) for c in keep], F.col("n").alias(copy), F.col("block_shard").alias(shard))


def mix_sizes(docs: DataFrame, seed: int = 20, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, copies, shards."""
    row = F.monotonically_increasing_id().alias("row")
    sizes = staged(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), axis_position(seed, "doc_id", "text").alias("axis"), row), "mix")
    plan, blocks, _ = plan_mix(sizes, seed=seed, **options)
    drawn = drawn_copies(sizes, plan, blocks, "axis", ["row", "axis"], "copy", "shard").groupBy("row").agg(F.count("*").cast("int").alias("copies"), F.sort_array(F.collect_list("shard")).alias("shards"))
    out = sizes.join(plan, sizes["source"].eqNullSafe(plan["plan_source"])).join(drawn, "row", "left")
    copies = F.coalesce("copies", F.lit(0))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"), F.coalesce("shards", F.array().cast("array<long>")).alias("shards"))


def mix_documents(docs: DataFrame, seed: int = 20, **options) -> DataFrame:
    """The mixed rows with the columns of ``docs``: a document taken twice appears twice, one not taken goes.

    Rows of an output shard lie together in one partition, in the order of a shard-local key.
    """
    axis, copy, shard, order = free_names(docs, "axis", "copy", "shard", "order")
    keyed = docs.withColumn(axis, axis_position(seed, "doc_id", "text"))
    sizes = staged(docs.select("source", word_count(F.col("text")).alias("size"), axis_position(seed, "doc_id", "text").alias("axis")), "mix")
    plan, blocks, shards = plan_mix(sizes, seed=seed, **options)
    drawn = drawn_copies(keyed, plan, blocks, axis, [*docs.columns, axis], copy, shard)
    local = F.xxhash64(F.lit(seed + 1), F.col(shard), F.col(axis), F.col(copy))
    return drawn.withColumn(order, local).repartition(shards, shard).sortWithinPartitions(shard, order).select(*[F.col(f"`{c}`") for c in docs.columns])
