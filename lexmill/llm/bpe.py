"""Byte-level BPE encoding and decoding by recursive DuckDB queries inside each partition.

A batch's texts are split by the pattern. Its pieces that are not known yet become token-position
rows (piece, place, token id); one recursive query joins adjacent tokens to the merge table and
contracts each piece's leftmost pair of least rank, for all pieces at once, until no pair is left.
A piece that is a token is that token. Pieces are remembered, up to CACHE_PIECES, so each is encoded
about once a worker. Decoding aggregates the bytes of each document's ids in their order.

A recursive query takes a step per merge, which is quadratic in the length of a piece; pieces of
over LONG_PIECE bytes (a run of letters without a break) are contracted in the same order by a heap. A
long text is split, encoded and decoded in lots, so DuckDB's memory is bounded whatever a text's length.

Defined results: null text is the empty text: 0 ids and the digests of nothing; repeated rows give a
row each; an empty table no rows; other columns are ignored (``encode_documents``) or kept.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import MEMORIES, Remembered, free_names, only

CACHE_PIECES = 300_000
QUERY_PIECES = 20_000
#: Rows that a recursive query may come to: a piece of n bytes has at most n in each of at most n steps.
QUERY_ROWS = 300_000
QUERY_TOKENS = 100_000
LONG_PIECE = 1024
#: Texts of more characters are split and encoded so many pieces at a time.
LONG_TEXT, LOT_PIECES = 1 << 20, 200_000

#: A token-position row is one number: piece, place (PLACE_BITS), token (TOKEN_BITS). One window over all
#: pieces gives each token its neighbour; a pair's rank, place and next place in one number make the
#: leftmost pair of least rank a minimum.
TOKEN_BITS, PLACE_BITS = 21, 11
_TOKEN, _PLACE = (1 << TOKEN_BITS) - 1, (1 << PLACE_BITS) - 1
_BOTH = TOKEN_BITS + PLACE_BITS
ENCODE = f"""
WITH RECURSIVE state(step, v) AS (
    SELECT 0, v FROM seed
    UNION ALL
    SELECT step + 1, CASE WHEN (s.v >> {TOKEN_BITS}) & {_PLACE} = (b.best >> {PLACE_BITS}) & {_PLACE} THEN s.v - (s.v & {_TOKEN}) + (b.best >> {2 * PLACE_BITS}) ELSE s.v END
    FROM state s JOIN (
        SELECT q.v >> {_BOTH} AS piece, min((m.rank << {2 * PLACE_BITS}) | (((q.v >> {TOKEN_BITS}) & {_PLACE}) << {PLACE_BITS}) | ((q.next >> {TOKEN_BITS}) & {_PLACE})) AS best
        FROM (SELECT v, lead(v) OVER (ORDER BY v) AS next FROM state) q
        JOIN merges m ON m.pair = ((q.v & {_TOKEN}) << {TOKEN_BITS}) | (q.next & {_TOKEN})
        WHERE q.next >> {_BOTH} = q.v >> {_BOTH}
        GROUP BY 1
    ) b ON s.v >> {_BOTH} = b.piece
    WHERE (s.v >> {TOKEN_BITS}) & {_PLACE} <> b.best & {_PLACE}
)
SELECT s.v
FROM state s JOIN (SELECT v >> {_BOTH} AS piece, max(step) AS step FROM state GROUP BY 1) l ON s.v >> {_BOTH} = l.piece AND s.step = l.step
ORDER BY s.v
"""
#: What the ids of each document decode to: the tokens' bytes, as characters of the same numbers,
#: aggregated in the order of the ids (``ids`` counts from 1 in the list of all tokens).
DECODE = """
SELECT d.document, list_aggregate(list_select(v.all_bytes, d.ids), 'string_agg', '') AS bytes
FROM stream d, vocabulary v
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def rust_pattern(pattern: str) -> str:
    """The pattern with white space as Unicode defines it (Python's \\s also takes U+001C to U+001F)."""
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same contraction for one long piece: leftmost pair of least rank first, by a heap."""
    n = len(piece)
    ends, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = ends[i]
        if j < n and (rank := ranks.get(piece[i : ends[j]])) is not None:
            heapq.heappush(heap, (rank, i, ends[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = ends[i]
        if not alive[i] or j >= n or ends[j] != end:
            continue
        alive[j], ends[i] = False, end
        if end < n:
            before[end] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[piece[i : ends[i]]] for i in range(n) if alive[i]]


class PieceCoder:
    """Ids of pieces and bytes of ids, by DuckDB; lives in a worker."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.ranks = load_ranks(path)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.pattern = regex.compile(rust_pattern(pattern))
        self.known = Remembered(CACHE_PIECES)  # piece: its ids
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "250MB", "temp_directory": ""})  # queries are bounded: nothing spills to the worker's folder
        if max(self.ranks.values()) > _TOKEN:
            raise ValueError(f"a token's number takes at most {TOKEN_BITS} bits")
        rows = [(self.ranks[t[:i]] << TOKEN_BITS | self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        spelled = {r: t.decode("latin-1") for t, r in self.ranks.items()}
        self._load("merges", {"pair": pa.array([x[0] for x in rows], pa.int64()), "rank": pa.array([x[1] for x in rows], pa.int64())})
        self._load("vocabulary", {"all_bytes": pa.array([[spelled.get(r) for r in range(max(spelled) + 1)]], pa.list_(pa.string()))})

    def _load(self, name: str, columns: dict[str, pa.Array]) -> None:
        self.db.register("loading", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM loading")
        self.db.unregister("loading")

    def _query(self, pieces: list[str], raw: list[bytes]) -> None:
        lengths = np.array([len(b) for b in raw], dtype=np.int64)
        piece = np.repeat(np.arange(len(raw), dtype=np.int64), lengths)
        place = np.arange(len(piece)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        token = self.single[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        self.db.register("seed", pa.table({"v": piece << _BOTH | place << TOKEN_BITS | token}))
        found = self.db.sql(ENCODE).to_arrow_table().column("v").to_numpy()
        self.db.unregister("seed")
        data, ends = (found & _TOKEN).astype("<u4").tobytes(), (4 * np.cumsum(np.bincount(found >> _BOTH, minlength=len(raw)))).tolist()
        self.known.young.update((text, data[i:j]) for text, i, j in zip(pieces, [0, *ends], ends))

    def learn(self, pieces: set[str]) -> None:
        """Encodes the pieces that are not known yet."""
        new = self.known.missing(pieces)
        batch, raw, size = [], [], 0
        for piece in new:
            b = piece.encode()
            if (whole := self.ranks.get(b)) is not None:  # a piece of the vocabulary is its own token
                self.known.young[piece] = whole.to_bytes(4, "little")
                continue
            if len(b) > LONG_PIECE:
                self.known.young[piece] = np.array(merge_long(b, self.ranks), dtype="<u4").tobytes()
                continue
            batch.append(piece)
            raw.append(b)
            size += len(b) * len(b) // 2
            if len(batch) >= QUERY_PIECES or size >= QUERY_ROWS:
                self._query(batch, raw)
                batch, raw, size = [], [], 0
        if batch:
            self._query(batch, raw)

    def code(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian 32-bit integers, decoded bytes) of each text."""
        long_ = {k: self._long(t) for k, t in enumerate(texts) if t and len(t) > LONG_TEXT}
        split = [self.pattern.findall(t) if t and k not in long_ else [] for k, t in enumerate(texts)]
        self.learn(set(chain.from_iterable(split)))
        get = self.known.young.__getitem__
        ids = [long_.get(k) or b"".join(map(get, pieces)) for k, pieces in enumerate(split)]
        return list(zip(ids, self.decode(ids)))

    def _long(self, text: str) -> bytes:
        """Ids of a long text, whose pieces are never all held at once."""
        found, out = (m.group() for m in self.pattern.finditer(text)), []
        while pieces := list(islice(found, LOT_PIECES)):
            self.learn(set(pieces))
            out.append(b"".join(map(self.known.young.__getitem__, pieces)))
        return b"".join(out)

    def decode(self, documents: list[bytes]) -> list[bytes]:
        """The bytes that each document's ids (little-endian 32-bit integers) stand for; a query takes QUERY_TOKENS ids at most."""
        out: list[list[bytes]] = [[] for _ in documents]
        lots = [(k, ids[at : at + 4 * QUERY_TOKENS]) for k, ids in enumerate(documents) for at in range(0, len(ids), 4 * QUERY_TOKENS)]
        at = 0
        while at < len(lots):
            upto, many = at, 0
            while upto < len(lots) and (upto == at or many + len(lots[upto][1]) // 4 <= QUERY_TOKENS):
                many += len(lots[upto][1]) // 4
                upto += 1
            some = [ids for _, ids in lots[at:upto]]
            token = np.frombuffer(b"".join(some), dtype="<u4").astype(np.int32)
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in some])])
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(token + 1))
            self.db.register("stream", pa.table({"document": np.arange(at, upto, dtype=np.int32), "ids": ids}))
            found = self.db.sql(DECODE).to_arrow_table().sort_by("document")
            self.db.unregister("stream")
            for k, text in zip(found.column("document").to_pylist(), found.column("bytes")):
                out[lots[k][0]].append((text.as_py() or "").encode("latin-1"))
            at = upto
        return [b"".join(parts) for parts in out]


_coders: dict[str, PieceCoder] = {}
MEMORIES["bpe"] = _coders.clear


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, keep: list[str] = ("doc_id",), ids: bool = False) -> DataFrame:
    """The ``keep`` columns, n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids themselves."""
    keep = list(keep)

    def task(batches):
        only("bpe")
        coder = _coders.get(ranks_path) or _coders.setdefault(ranks_path, PieceCoder(ranks_path, pattern))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                coded = coder.code(some.column(some.num_columns - 1).to_pylist())
                out = [some.column(i) for i in range(len(keep))]
                out += [pa.array([len(a) // 4 for a, _ in coded], pa.int64()), pa.array([hashlib.sha256(a).hexdigest() for a, _ in coded], pa.string()), pa.array([hashlib.sha256(b).hexdigest() for _, b in coded], pa.string())]
                names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    out.append(pa.array([np.frombuffer(a, "<u4").astype(np.int32) for a, _ in coded], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    schema = [*fields, "n_tokens long", "ids_sha256 string", "decoded_sha256 string", *["ids array<int>"] * ids]
    return docs.select(*keep, F.col("text").alias(*free_names(docs, "text"))).mapInArrow(task, ", ".join(schema))
