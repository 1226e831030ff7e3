"""N-gram Jaccard join over a token-group matrix.

Tokens are the hashes of a document's 5-word shingles. Similar documents form groups; a group's
token union bounds what any of its members can share with a query, and only groups that can
qualify are opened and compared with the query, set by set:

1. A document with q tokens needs ceil(0.8 q) of them in one other document. ``foreign_counts``
   counts how many lie in the union of everything else; documents below the bound are done. Tokens
   travel packed and sorted, a token that recurs within a task once only.
2. Equal sets are one class. Classes with the same least token hash are similar and form a group (for
   classes that mostly consist of tokens that many classes hold, the least of those); groups of over
   GROUP_ROWS classes are dealt to several.
3. The matrix has a row (token, group) for each token that one of the group's members could need:
   the first q - ceil(0.8 q) + 1 of its tokens, tokens that many classes hold standing last. If two
   sets link, their groups share such a token. Pairs of groups that share one are opened: a task
   counts each query's overlap with the other group's union, drops queries below their bound, and
   compares the rest by overlap matrices. It returns spanning links, never pairs.

All links that count are verified on whole sets; the result is exact but for 64-bit hash collisions.

Defined results: null or blank text has an empty set and links with nothing; under five words the
whole sequence is the only shingle; rows that share a doc_id are one document (largest set size,
smallest component); null doc_ids are returned with a null component; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._graph import components
from ._shared import MEMORIES, bloom, free_names, only, partitions, staged

SHINGLE = 5
PERCENT = 80
GROUP_ROWS = 256
COMMON = 64
COLUMNS = 4096
LARGE_LABELS = 100_000
DEAL_TOKENS = 1_000_000  # about as many tokens of groups are dealt to a task
CHUNK_TOKENS, CHUNK_DOCS = 1_500_000, 65_000
KNOWN_WORDS = 250_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
PLACES = np.random.default_rng(5).integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word):
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _WordHashes()
MEMORIES["jaccard"] = _words.clear


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_words) > KNOWN_WORDS:
        _words.clear()
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = min(SHINGLE, len(h))
    total = np.full(len(h) - n + 1, n, dtype=np.uint64) * GOLDEN
    for k in range(n):
        total += h[k : len(h) - n + 1 + k] * PLACES[k]
    return np.unique(_mix(total))


def _pack(chunk: list[tuple[int, int, np.ndarray]], buckets: int):
    """Rows (bucket, kind, ids, a, b) of a chunk of (id, n, tokens); ids may recur.

    Kind 0: 32-bit token remainders and places in ids, -1 for tokens that several ids of the chunk
    hold. Kind 1: per id the count of such tokens and n.
    """
    ids, where = np.unique(np.array([i for i, _, _ in chunk], dtype=np.int64), return_inverse=True)
    sizes = np.zeros(len(ids), dtype=np.int64)
    np.maximum.at(sizes, where, np.array([n for _, n, _ in chunk], dtype=np.int64))
    lengths = np.array([len(t) for _, _, t in chunk])
    tokens = np.concatenate([t for _, _, t in chunk])
    owner = np.repeat(where.astype(np.int32), lengths)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    if len(ids) < len(chunk) and len(tokens):  # an id's rows may hold a token twice
        order = np.lexsort((owner, tokens))
        tokens, owner = tokens[order], owner[order]
        new = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])])
        tokens, owner = tokens[new], owner[new]
    new = np.concatenate([[True], tokens[1:] != tokens[:-1]]) if len(tokens) else np.empty(0, bool)
    run = np.cumsum(new) - 1
    many = np.bincount(run)[run] > 1 if len(tokens) else np.empty(0, bool)
    local = np.bincount(owner[many], minlength=len(ids))
    yield int(ids[0]) % buckets if len(ids) else 0, 1, ids.tobytes(), local.astype(np.int64).tobytes(), sizes.tobytes()
    owner = np.where(many, -1, owner)[new]
    tokens = tokens[new]
    share = ((tokens >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    bounds = np.searchsorted(share, np.arange(buckets + 1, dtype=np.uint64))
    # what a bucket has left to tell tokens apart: the next 32 bits of token * buckets
    rest = ((tokens >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(16)).astype(np.uint32) if buckets < 65_536 else tokens.astype(np.uint32)
    for k in range(buckets):
        i, j = bounds[k], bounds[k + 1]
        if i < j:
            used, place = np.unique(owner[i:j], return_inverse=True)
            own = np.where(used >= 0, ids[np.maximum(used, 0)], 0)
            one = place.astype(np.uint16 if len(used) < 65_536 else np.uint32)
            planes = np.diff(rest[i:j], prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()  # gaps, high bytes together: they compress
            yield k, 2 if used[0] < 0 else 0, own.tobytes(), planes, one.tobytes()


PACKED = "bucket int, kind int, ids binary, a binary, b binary"


def _packer(sets, buckets: int):
    """mapInArrow function: ``sets`` turns a batch to (id, n, tokens)."""

    def task(batches):
        only("jaccard")
        chunk, size = [], 0

        def out():
            columns = list(zip(*_pack(chunk, buckets)))
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "kind", "ids", "a", "b"])

        for batch in batches:
            for row in sets(batch):
                chunk.append(row)
                size += len(row[2])
                if size >= CHUNK_TOKENS or len(chunk) >= CHUNK_DOCS:
                    yield out()
                    chunk, size = [], 0
        if chunk:
            yield out()

    return task


def _count_bucket(group: pa.Table) -> pa.Table:
    """(id, count, n): tokens of each id in this bucket that another id holds too."""
    ids, counts, sizes, tokens, owners = [], [], [], [], []
    for kind, i, a, b in zip(*(group.column(c).to_pylist() for c in ("kind", "ids", "a", "b"))):
        own = np.frombuffer(i, np.int64)
        if kind == 1:
            ids.append(own)
            counts.append(np.frombuffer(a, np.int64))
            sizes.append(np.frombuffer(b, np.int64))
            continue
        part = np.cumsum(np.frombuffer(a, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel(), dtype=np.uint32)
        place = np.frombuffer(b, np.uint16 if len(own) < 65_536 else np.uint32)
        tokens.append(part)
        owner = own[place]
        known = np.ones(len(place), bool) if kind == 0 else place > 0
        owners.append((owner, known))
    if tokens:
        token = np.concatenate(tokens)
        owner, known = np.concatenate([o for o, _ in owners]), np.concatenate([k for _, k in owners])
        order = np.lexsort((owner, ~known, token)) if len(token) else np.empty(0, np.int64)
        token, owner, known = token[order], owner[order], known[order]
        fresh = np.concatenate([[True], (token[1:] != token[:-1]) | (owner[1:] != owner[:-1]) | (known[1:] != known[:-1])])
        fresh |= ~known
        run = np.cumsum(np.concatenate([[True], token[1:] != token[:-1]])) - 1
        held = np.bincount(run, fresh)  # a token of several ids of a chunk counts as two
        held += np.bincount(run, ~known)
        hit = fresh & known & (held[run] > 1)
        found, n = np.unique(owner[hit], return_counts=True)
        ids.append(found)
        counts.append(n)
        sizes.append(np.zeros(len(found), dtype=np.int64))
    ids, counts, sizes = np.concatenate(ids), np.concatenate(counts).astype(np.int64), np.concatenate(sizes)
    slots = group.column("slots")[0].as_py()
    slot = (_mix(ids.view(np.uint64)) % np.uint64(slots)).astype(np.int32)
    order = np.argsort(slot, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(slot[order])) + 1) if len(order) else []
    return pa.table({"slot": pa.array([slot[p[0]] for p in parts], pa.int32())} | {k: pa.array([x[p].tobytes() for p in parts], pa.binary()) for k, x in (("ids", ids), ("held", counts), ("n", sizes))})


def _sum_slot(group: pa.Table) -> pa.Table:
    ids, held, n = (np.concatenate([np.frombuffer(x, np.int64) for x in group.column(c).to_pylist()]) for c in ("ids", "held", "n"))
    found, where = np.unique(ids, return_inverse=True)
    size = np.zeros(len(found), dtype=np.int64)
    np.maximum.at(size, where, n)
    return pa.table({"id": found, "held": np.bincount(where, held, minlength=len(found)).astype(np.int64), "n": size})


def foreign_counts(df: DataFrame, sets) -> DataFrame:
    """(id, held, n): at most how many of an id's tokens other ids hold, and its size.

    Counts travel packed too: a row for each bucket of tokens and slot of ids. An id whose rows lie
    in several tasks may be counted high, never low.
    """
    parts = partitions(df.sparkSession)
    packed = df.mapInArrow(_packer(sets, parts), PACKED).withColumn("slots", F.lit(parts))
    counted = packed.groupBy("bucket").applyInArrow(_count_bucket, "slot int, ids binary, held binary, n binary")
    return counted.groupBy("slot").applyInArrow(_sum_slot, "id long, held long, n long")


def _text_sets(batch):
    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        tokens = shingles(text.as_py())
        yield doc_id, len(tokens), tokens


ALIVE = "doc_id long, sig long, n long, text string"
FILTER_IDS, FILTER_BITS = 4_000_000, 1 << 26


def _passes(table: np.ndarray, *hashes: np.ndarray) -> np.ndarray:
    """Which rows a Bloom filter holds."""
    keep = np.ones(len(hashes[0]), dtype=bool)
    for h in hashes:
        spot = h & (len(table) * 32 - 1)
        keep &= (table[spot >> 5] >> (spot & 31).astype(np.uint32)) & np.uint32(1) == 1
    return keep


def _describe(words):
    """mapInArrow function: (doc_id, text) to set signature, size and text.

    ``words`` is a broadcast Bloom filter of the documents to keep, or None.
    """

    def task(batches):
        only("jaccard")
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some, rows = batch.slice(at, 1024), []
                if words is not None:
                    some = some.filter(pa.array(_passes(words.value, some.column(2).to_numpy(), some.column(3).to_numpy())))
                texts = some.column(1).to_pylist()
                for text, (doc_id, n, tokens) in zip(texts, _text_sets(some)):
                    if n:
                        rows.append((doc_id, xxhash.xxh3_64_intdigest(tokens.tobytes()) - 2**63, n, text))
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[x.split()[0] for x in ALIVE.split(", ")])

    return task


def _alive_documents(known: DataFrame, alive: DataFrame) -> DataFrame:
    """Described documents of ``alive``, perhaps with a few more, which changes nothing but work.

    Up to FILTER_IDS of them pass by a fixed-size filter without moving texts; beyond, by a join.
    """
    hashes = [F.xxhash64("doc_id").alias("h0"), F.xxhash64("doc_id", F.lit(1)).alias("h1")]
    if alive.count() <= FILTER_IDS:
        words = known.sparkSession.sparkContext.broadcast(bloom(alive, FILTER_BITS))
        return known.select("doc_id", "text", *hashes).mapInArrow(_describe(words), ALIVE)
    return known.join(alive, "doc_id", "left_semi").mapInArrow(_describe(None), ALIVE)


def _tokens(batches):
    """Tokens of (text)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            sets = [shingles(t.as_py()).view(np.int64) for t in batch.column(0).slice(at, 256)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets) if sets else [], pa.int64())], names=["token"])


def _common(words, tokens: np.ndarray) -> np.ndarray:
    mixed = _mix(tokens)
    return _passes(words.value, mixed.view(np.int64), _mix(mixed).view(np.int64))


def _labelling(words):
    """mapInArrow function: adds the group label of (id, text)."""

    def task(batches):
        for batch in batches:
            labels, sizes = [], []
            for text in batch.column(1):
                tokens = shingles(text.as_py())
                sizes.append(len(tokens))
                common = _common(words, tokens)
                labels.append(int(_mix(tokens[common] if 2 * common.sum() >= len(tokens) else tokens).min().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(labels, pa.int64()), pa.array(sizes, pa.int64()), batch.column(1)], names=["id", "label", "n", "text"])

    return task


def _signing(percent: int, words):
    """mapInArrow function: (grp, text) to the tokens a link of the text cannot miss, common ones last."""

    def task(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                groups, out = [], []
                for grp, text in zip(batch.column(0).slice(at, 256).to_pylist(), batch.column(1).slice(at, 256)):
                    tokens = shingles(text.as_py())
                    keep = len(tokens) - -(-len(tokens) * percent // 100) + 1
                    out.append(tokens[np.lexsort((tokens, _common(words, tokens)))[:keep]].view(np.int64))
                    groups.append(np.full(len(out[-1]), grp))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(groups), pa.int64()), pa.array(np.concatenate(out), pa.int64())], names=["grp", "token"])

    return task


def common_tokens(texts: DataFrame, least: int = COMMON):
    """Bloom filter of the tokens that at least ``least`` classes hold.

    It only fixes an order, the same for all sets; whatever it holds, no link is lost.
    """
    counts = texts.select("text").mapInArrow(_tokens, "token long").groupBy("token").agg(F.count("*").alias("c"))

    def hashed(batches):
        for batch in batches:
            mixed = _mix(batch.column(0).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([mixed.view(np.int64), _mix(mixed).view(np.int64)]))], names=["h"])

    spots = counts.where(F.col("c") >= least).select("token").mapInArrow(hashed, "h long")
    spots = spots.select(F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1)).alias("s"))
    words = spots.groupBy(F.shiftright("s", 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 31 AS int))")).alias("b")).toPandas()
    out = np.zeros(FILTER_BITS // 32, dtype=np.uint32)
    out[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).astype(np.uint32)
    return out


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products over COLUMNS shared tokens at a time."""
    a, b = np.concatenate(left), np.concatenate(right)
    rows, columns = (np.repeat(np.arange(len(x)), [len(t) for t in x]) for x in (left, right))
    shared = np.intersect1d(np.unique(a), np.unique(b), assume_unique=True)
    out = np.zeros((len(left), len(right)))
    for tokens, owner in ((a, rows), (b, columns)):
        order = np.argsort(tokens, kind="stable")
        tokens[:], owner[:] = tokens[order], owner[order]
    for at in range(0, len(shared), COLUMNS):
        some = shared[at : at + COLUMNS]
        parts = []
        for tokens, owner, n in ((a, rows, len(left)), (b, columns, len(right))):
            i, j = np.searchsorted(tokens, some[0]), np.searchsorted(tokens, some[-1], side="right")
            place = np.minimum(np.searchsorted(some, tokens[i:j]), len(some) - 1)
            hit = some[place] == tokens[i:j]
            grid = np.zeros((n, len(some)), dtype=np.float32)
            grid[owner[i:j][hit], place[hit]] = 1
            parts.append(grid)
        out += parts[0] @ parts[1].T
    return out


def _open_pair(sides: list[tuple[np.ndarray, list[np.ndarray]]], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, roots) of what is linked between two groups of (ids, sets), or inside one.

    The union of the other group bounds what a query can share; queries below it are dropped.
    """
    ids = np.concatenate([x for x, _ in sides])
    sets = [t for _, own in sides for t in own]
    sizes = np.array([len(t) for t in sets])
    rows = [np.arange(len(sides[0][0])), np.arange(len(ids) - len(sides[-1][0]), len(ids))]
    if len(sides) > 1:
        whole = [np.concatenate([sets[i] for i in side]) for side in rows]
        unions = [np.unique(tokens) for tokens in whole]
        for k, union in enumerate(reversed(unions)):
            place = np.minimum(np.searchsorted(union, whole[k]), len(union) - 1)
            owner = np.repeat(np.arange(len(rows[k])), sizes[rows[k]])
            held = np.bincount(owner, union[place] == whole[k], minlength=len(rows[k]))
            rows[k] = rows[k][held * 100 >= sizes[rows[k]] * percent]
    left, right = rows
    if not len(left) or not len(right):
        return ids[:0], ids[:0]
    inter = np.rint(_overlaps([sets[i] for i in left], [sets[i] for i in right])).astype(np.int64)
    i, j = np.nonzero(inter * 100 >= (sizes[left][:, None] + sizes[right][None, :] - inter) * percent)
    i, j = left[i], right[j]
    root = ids.copy()
    while len(i):
        low = np.minimum(root[i], root[j])
        if (root[i] == low).all() and (root[j] == low).all():
            break
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
    hit = root != ids
    return ids[hit], root[hit]


def _opening(percent: int):
    """applyInArrow function of one deal: the texts of its groups and its pairs of groups to (a, b) links."""

    def task(deal: pa.Table) -> pa.Table:
        pairs = deal.filter(pa.compute.is_valid(deal.column("g1"))).select(["g1", "g2"])
        texts = deal.filter(pa.compute.is_valid(deal.column("id")))
        groups: dict[int, tuple[list, list]] = {}
        for grp, ident, text in zip(texts.column("grp").to_pylist(), texts.column("id").to_pylist(), texts.column("text")):
            ids, sets = groups.setdefault(grp, ([], []))
            ids.append(ident)
            sets.append(shingles(text.as_py()))
        groups = {g: (np.array(ids, dtype=np.int64), sets) for g, (ids, sets) in groups.items()}
        found = [_open_pair([groups[g] for g in dict.fromkeys((g1, g2))], percent) for g1, g2 in zip(*(c.to_pylist() for c in pairs.columns))]
        a, b = (np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in (0, 1))
        return pa.table({"a": a, "b": b})

    return task


def _need(n: Column, percent: int) -> Column:
    """Least overlap of a set of n tokens with any that links to it: ceil(n * percent / 100)."""
    return F.ceil(n * percent / 100)


def grouped_texts(texts: DataFrame, words) -> DataFrame:
    """(id, grp, n, text): texts by label and size, labels of over GROUP_ROWS texts dealt to several groups."""
    labelled = staged(texts.mapInArrow(_labelling(words), "id long, label long, n long, text string"), "labelled")
    band = F.floor(F.log("n") / F.log(F.lit(100 / PERCENT)))  # members of a group are about as large
    labelled = labelled.withColumn("label", F.xxhash64("label", band))
    large = labelled.groupBy("label").agg(F.ceil(F.count("*") / GROUP_ROWS).alias("_parts")).where("_parts > 1")
    if large.count() <= LARGE_LABELS:
        large = F.broadcast(large)
    part = F.pmod(F.xxhash64("id"), F.coalesce("_parts", F.lit(1)))
    return labelled.join(large, "label", "left").select("id", F.xxhash64("label", part).alias("grp"), "n", "text")


def link_groups(members: DataFrame, words, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) that span the components of members (id, grp, n, text)."""
    matrix = members.select("grp", "text").mapInArrow(_signing(percent, words), "grp long, token long").distinct()
    matrix = staged(matrix, "matrix")
    shared = matrix.groupBy("token").agg(F.count("*").alias("groups")).where("groups > 1")
    sizes = staged(members.groupBy("grp").agg(F.count("*").alias("n"), F.min("n").alias("lo"), F.max("n").alias("hi")), "group-sizes")
    matrix = staged(matrix.join(shared.select("token"), "token").join(sizes.select("grp", "lo", "hi"), "grp"), "matrix")
    left, right = (matrix.select("token", *[F.col(c).alias(c + k) for c in ("grp", "lo", "hi")]) for k in "12")
    alike = (F.col("lo1") * percent <= F.col("hi2") * 100) & (F.col("lo2") * percent <= F.col("hi1") * 100)
    pairs = left.join(right, "token").where((F.col("grp1") < F.col("grp2")) & alike).select(F.col("grp1").alias("g1"), F.col("grp2").alias("g2")).distinct()
    inside = sizes.where("n > 1").select(F.col("grp").alias("g1"), F.col("grp").alias("g2"))
    # a pair goes where its smaller group is dealt; a deal gets each of its groups' texts once
    sized = pairs.unionByName(inside).join(sizes.select(F.col("grp").alias("g1"), F.col("n").alias("n1")), "g1").join(sizes.select(F.col("grp").alias("g2"), F.col("n").alias("n2")), "g2")
    smaller = F.when(F.col("n1") <= F.col("n2"), F.col("g1")).otherwise(F.col("g2"))
    tokens = members.agg(F.sum("n")).first()[0] or 0
    pairs = sized.select(F.pmod(F.xxhash64(smaller), F.lit(max(partitions(members.sparkSession), -(-tokens // DEAL_TOKENS)))).alias("deal"), "g1", "g2")
    pairs = staged(pairs, "group-pairs")
    needed = pairs.select("deal", F.explode(F.array("g1", "g2")).alias("grp")).distinct()
    rows = needed.join(members, "grp").select("deal", "grp", "id", "text").unionByName(pairs, allowMissingColumns=True)
    return rows.groupBy("deal").applyInArrow(_opening(percent), "a long, b long")


def jaccard_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = base.where("doc_id IS NOT NULL")
    sizes = staged(foreign_counts(known, _text_sets), "sizes")
    alive = sizes.where((F.col("n") > 0) & (F.col("held") >= _need(F.col("n"), percent))).select(F.col("id").alias("doc_id"))
    described = staged(_alive_documents(known, alive), "alive")
    classes = staged(described.groupBy("sig").agg(F.min("doc_id").alias("id")), "classes")
    # a class is known by its smallest doc_id; texts of one row of it, and of no other, are read
    texts = described.select("sig", "doc_id", "text").join(classes.withColumnRenamed("id", "doc_id"), ["sig", "doc_id"], "left_semi").dropDuplicates(["sig", "doc_id"])
    texts = staged(texts.select(F.col("doc_id").alias("id"), "text"), "texts")
    words = docs.sparkSession.sparkContext.broadcast(common_tokens(texts))
    roots = components(staged(link_groups(grouped_texts(texts, words), words, percent), "links"))
    named = classes.select("sig", "id").join(roots, "id", "left").select("sig", F.coalesce("component", "id").alias("node"))
    member = staged(described.select("doc_id", "sig").distinct().join(named, "sig").select("doc_id", "node"), "members")
    first = member.groupBy("node").agg(F.min("doc_id").alias("component_id"))
    named = member.join(first, "node").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = sizes.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles")).join(named, "doc_id", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))

    def lone(batches):
        for batch in batches:
            n = [len(shingles(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.nulls(len(n), pa.int64())], names=["doc_id", "n_shingles", "component_id"])

    return out.unionByName(base.where("doc_id IS NULL").mapInArrow(lone, "doc_id long, n_shingles long, component_id long"))


def keep_one_of_group(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near copies, with all its columns: that of the least doc_id, null last.

    Rows are told apart by a number of their own, so rows that share a doc_id but not their text are
    documents of their own, and of equal rows one stays. Equal doc_ids go by the hash of the row. Texts
    without words stay, each.
    """
    row, doc, tie = free_names(docs, "row", "doc", "tie")
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")  # written once: the numbers stay
    found = jaccard_components(numbered.select(F.col(row).alias("doc_id"), "text"), percent).withColumnsRenamed({"doc_id": row})
    ties = numbered.select(row, F.col("doc_id").alias(doc), F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)).alias(tie))
    order = F.struct(F.col(doc).isNull(), doc, tie, row)
    kept = ties.join(found, row).groupBy("component_id").agg(F.min(order)[row].alias(row)).select(row)
    return numbered.join(kept, row, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
