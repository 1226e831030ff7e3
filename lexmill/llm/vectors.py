"""Embedding near-duplicates by lattice hashing.

A table projects a unit vector to a few groups of 8 dimensions at random and decodes each group to
its nearest E8 lattice point; the points together are the vector's cell. A vector also probes the
cells that differ by the nearest of the 240 minimal steps in one group. Vectors that meet (one at
home, the other at home or probing) are compared by cosine in double precision.

How many groups make a cell follows from the number of vectors (so that a cell of random vectors
holds about OCCUPANCY); how many tables follows from the hit rate of simulated pairs at the
threshold and the miss rate allowed.

Equal vectors are one class first. A cell's rows are dealt to blocks, pairs of blocks are compared
by matrix products, and a task returns link counts and a spanning star, never pairs. A pair counts
in the first of the cells where it meets only, which is told from the vectors alone.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with
nothing; vectors of different lengths are not compared; rows that share a vec_id are vectors of
their own with one id; null ids keep null components; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._graph import components
from ._shared import staged

COSINE = 0.9
MISS = 0.02
OCCUPANCY = 512
PROBES = 4
SCALE = 8.0
BLOCK_ROWS = 1024
MOST_GROUPS, MOST_TABLES = 12, 64
SEED = 88


def _minimal() -> np.ndarray:
    steps = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1.0, -1.0), repeat=2):
            step = np.zeros(8)
            step[i], step[j] = s, t
            steps.append(step)
    steps += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(steps)


MINIMAL = _minimal()


def _decode_d8(x: np.ndarray) -> np.ndarray:
    near = np.rint(x)
    rest = x - near
    rows = np.flatnonzero(near.sum(axis=1) % 2)
    k = np.abs(rest[rows]).argmax(axis=1)
    near[rows, k] += np.where(rest[rows, k] >= 0, 1.0, -1.0)
    return near


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 lattice point of each row of 8 numbers."""
    whole, half = _decode_d8(x), _decode_d8(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1))[:, None], whole, half)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def projections(dims: int, groups: int, tables: int) -> np.ndarray:
    """(tables, 8 * groups, dims) scaled rows, orthonormal as far as the dimension allows."""
    out = []
    for t in range(tables):
        rng, rows = np.random.default_rng([SEED, dims, groups, t]), []
        while sum(map(len, rows)) < 8 * groups:
            q, _ = np.linalg.qr(rng.normal(size=(dims, dims)))
            rows.append(q.T)
        out.append(np.concatenate(rows)[: 8 * groups] * SCALE / math.sqrt(512 / dims))
    return np.array(out)


def cells(unit: np.ndarray, matrix: np.ndarray, probes: int) -> np.ndarray:
    """(n, tables, 1 + probes) cell keys of unit vectors, home first.

    Sums run row by row in one order, so a vector has the same cells in every batch.
    """
    n, tables, groups = len(unit), len(matrix), matrix.shape[1] // 8
    out = np.empty((n, tables, 1 + probes), dtype=np.int64)
    for t in range(tables):
        x = np.stack([(unit * row).sum(axis=1) for row in matrix[t]], axis=1)
        points = [decode_e8(x[:, 8 * g : 8 * g + 8]) for g in range(groups)]
        home = np.concatenate(points, axis=1)
        cost = np.concatenate([-((x[:, 8 * g : 8 * g + 8] - points[g])[:, None, :] * MINIMAL[None]).sum(axis=2) for g in range(groups)], axis=1)
        steps = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        for p in range(1 + probes):
            cell = home.copy()
            if p:
                group, step = np.divmod(steps[:, p - 1], len(MINIMAL))
                for g in range(groups):
                    own = group == g
                    cell[own, 8 * g : 8 * g + 8] += MINIMAL[step[own]]
            with np.errstate(over="ignore"):
                key = np.full(n, t + 1, dtype=np.uint64)
                for c in (cell * 2).astype(np.int64).astype(np.uint64).T:
                    key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + c)
            out[:, t, p] = key.view(np.int64)
    return out


def plan_tables(dims: int, count: int, cosine: float = COSINE, miss: float = MISS, probes: int = PROBES) -> tuple[int, int]:
    """(groups, tables) for ``count`` vectors of a length.

    Groups are independent of each other, so the share of random pairs in one cell is that of one group
    to the power of their number; it is simulated for one group and carried on to any number of vectors.
    Tables follow from simulated pairs at the threshold. Where more than MOST_TABLES would be needed,
    groups are taken away: cells are larger then, and their blocks more, but the miss rate holds.
    """
    rng = np.random.default_rng(SEED)
    a, b = rng.normal(size=(2, 1500, dims))
    a /= np.linalg.norm(a, axis=1)[:, None]
    if dims > 1:
        b -= (b * a).sum(axis=1)[:, None] * a
        b = cosine * a + math.sqrt(max(0.0, 1 - cosine**2)) * b / np.linalg.norm(b, axis=1)[:, None]
    else:
        b = a
    one = cells(a, projections(dims, 1, 8), 0)[:, :, 0]
    pairs = len(a) * (len(a) - 1)
    shared = max(1 / pairs, np.mean([(n * (n - 1)).sum() / pairs for n in (np.unique(one[:, t], return_counts=True)[1] for t in range(8))]))
    groups = 1
    while groups < MOST_GROUPS and shared < 1 and count * shared**groups > OCCUPANCY:
        groups += 1
    while True:
        matrix = projections(dims, groups, 2)
        x, y = cells(a, matrix, probes), cells(b, matrix, probes)
        met = ((x[:, :, :1] == y).any(axis=2) | (y[:, :, :1] == x).any(axis=2)).mean()
        tables = max(2, math.ceil(math.log(miss) / math.log(1 - min(met, 0.999)))) if met > 0 else MOST_TABLES + 1
        if tables <= MOST_TABLES or groups == 1:
            return groups, tables
        groups -= 1


def _unit(column: pa.Array, dims: int) -> np.ndarray:
    x = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    x = x / np.abs(x).max(axis=1)[:, None]  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """First key (smallest) at which each pair meets; a and b are (pairs, tables, 1 + probes)."""
    none = np.iinfo(np.int64).max
    at_a = np.where((b == a[:, :, :1]).any(axis=2), a[:, :, 0], none)
    at_b = np.where((a == b[:, :, :1]).any(axis=2), b[:, :, 0], none)
    return np.minimum(at_a, at_b).min(axis=1)


def _block_links(dims: int, matrix: np.ndarray, cosine: float, probes: int):
    """Function of one (key, block, block) group: rep, links counted here, smallest id of its star here."""

    def task(group: pa.Table) -> pa.Table:
        key = group.column("key")[0].as_py()
        left, right = group.column("left")[0].as_py(), group.column("right")[0].as_py()
        rep, block = group.column("rep").to_numpy(), group.column("block").to_numpy()
        copies, home = group.column("copies").to_numpy(), group.column("home").to_numpy(zero_copy_only=False).astype(bool)
        unit = _unit(group.column("embedding"), dims)
        rows, columns = np.flatnonzero(block == left), np.flatnonzero(block == right)
        near = unit[rows] @ unit[columns].T >= cosine
        near &= home[rows][:, None] | home[columns][None, :]
        if left == right:
            near = np.triu(near, 1)
        i, j = np.nonzero(near)
        i, j = rows[i], columns[j]
        if len(i):
            used, where = np.unique(np.concatenate([i, j]), return_inverse=True)
            own = cells(unit[used], matrix, probes)
            first = np.concatenate([_meet(own[where[: len(i)][k : k + 20_000]], own[where[len(i) :][k : k + 20_000]]) for k in range(0, len(i), 20_000)])
            i, j = i[first == key], j[first == key]
        n = np.bincount(i, copies[j], minlength=len(rep)) + np.bincount(j, copies[i], minlength=len(rep))
        root = rep.copy()
        while len(i):
            low = np.minimum(root[i], root[j])
            if (root[i] == low).all() and (root[j] == low).all():
                break
            np.minimum.at(root, i, low)
            np.minimum.at(root, j, low)
        hit = n > 0
        return pa.table({"rep": rep[hit], "n": n[hit].astype(np.int64), "root": root[hit]})

    return task


def link_vectors(vectors: DataFrame, cosine: float = COSINE, miss: float = MISS, probes: int = PROBES) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    exact = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if exact else "array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    valid = rows.where(good & F.col("vec_id").isNotNull())
    classes = staged(valid.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vectors")
    sizes = classes.groupBy(F.size("embedding").alias("dims")).count().collect()  # one row per vector length
    found, links = [], None
    for dims, count in sorted((r.dims, r["count"]) for r in sizes):
        groups, tables = plan_tables(dims, count, cosine, miss, probes)
        matrix = projections(dims, groups, tables)

        def place(batches, dims=dims, matrix=matrix):
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    some = batch.slice(at, 512)
                    keys = cells(_unit(some.column(1), dims), matrix, probes).reshape(some.num_rows, -1)
                    yield pa.RecordBatch.from_arrays([some.column(0), pa.array(list(keys), pa.list_(pa.int64()))], names=["rep", "keys"])

        own = classes.where(F.size("embedding") == dims)
        placed = staged(own.repartition("rep").select("rep", "embedding").mapInArrow(place, "rep long, keys array<long>"), "cells")
        visits = placed.select("rep", F.posexplode("keys").alias("slot", "key")).groupBy("key", "rep").agg(F.max((F.col("slot") % (1 + probes) == 0).cast("int")).alias("home"))
        visits = staged(visits, "visits")
        used = visits.groupBy("key").agg(F.count("*").alias("all"), F.sum("home").alias("homes")).where("homes >= 1 AND all >= 2")
        blocks = F.ceil(F.col("all") / BLOCK_ROWS)
        dealt = visits.join(used.select("key", blocks.cast("int").alias("blocks")), "key").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(F.least(b, F.col("block")).alias("left"), F.greatest(b, F.col("block")).alias("right")))
        dealt = dealt.join(own, "rep").select("key", F.explode(others).alias("pair"), "block", "rep", "copies", "home", "embedding")
        dealt = dealt.select("key", "pair.left", "pair.right", "block", "rep", "copies", "home", "embedding")
        found.append(staged(dealt.groupBy("key", "left", "right").applyInArrow(_block_links(dims, matrix, cosine, probes), "rep long, n long, root long"), "links"))
    for part in found:
        links = part if links is None else links.unionByName(part)
    if links is None:
        links = spark.createDataFrame([], "rep long, n long, root long")
    roots = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    per = classes.join(links.groupBy("rep").agg(F.sum("n").alias("n")), "rep", "left").join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    per = per.select(F.col("embedding").alias("_e"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    keyed = rows.select("vec_id", F.when(good & F.col("vec_id").isNotNull(), F.col("embedding")).alias("embedding"))
    out = keyed.join(per, keyed["embedding"] == per["_e"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
