"""Token ids as binary shards in patched frame-of-reference blocks.

A shard holds chunks of up to CHUNK_BLOCKS blocks of 128 ids. A block stores its minimum; the
differences are packed at the width that holds ``percentile`` of them; the rest are exceptions with
place and full value. A chunk carries the start of every block in its packed words and in its
exception list, so any range of ids is read by decoding its blocks alone.

Documents are range-partitioned by doc_id, so shards in order hold the ids in ascending doc_id
order. A shard counts only once the manifest that names it is committed; a repeated task writes
under a new name.

Defined results: null and empty text give the end id alone; null doc_ids come first; documents that
share a doc_id follow each other by text hash, one row each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import struct
import unicodedata
import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import MEMORIES, Remembered, only, open_store, shared_dir

BLOCK = 128
CHUNK_BLOCKS = 4096
PERCENTILE = 0.9
SHARD_TOKENS = 64 << 20
CACHE_WORDS = 800_000
END_ID = 2
MAGIC = b"LXPFOR01"
MANIFEST = "part int, sequence int, shard string, tokens long, documents long"


def pack_chunk(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One chunk of ids (uint32, at most CHUNK_BLOCKS blocks) as bytes."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    grid = np.full(blocks * BLOCK, ids[-1] if n else 0, dtype=np.uint32)
    grid[:n] = ids
    grid = grid.reshape(blocks, BLOCK)
    low = grid.min(axis=1)
    rest = (grid - low[:, None]).astype(np.uint64)
    kth = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    width = np.frexp(np.partition(rest, kth, axis=1)[:, kth].astype(np.float64))[1].astype(np.uint8)
    outlier = rest >> width[:, None].astype(np.uint64) > 0
    starts = np.concatenate([[0], np.cumsum(width.astype(np.int64) * 2)])
    words = np.zeros(starts[-1], dtype=np.uint64)
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        part = np.where(outlier[own], 0, rest[own])
        packed = np.zeros((len(own), 2 * w), dtype=np.uint64)
        for i in range(BLOCK):
            at, shift = divmod(i * w, 64)
            packed[:, at] |= part[:, i] << np.uint64(shift)
            if shift + w > 64:
                packed[:, at + 1] |= part[:, i] >> np.uint64(64 - shift)
        words[(starts[own][:, None] + np.arange(2 * w)).ravel()] = packed.ravel()
    exceptions = np.concatenate([[0], np.cumsum(outlier.sum(axis=1))]).astype(np.uint32)
    places = np.nonzero(outlier)[1].astype(np.uint8)
    head = struct.pack("<IIII", n, blocks, len(words), len(places))
    return b"".join([head, low.tobytes(), width.tobytes(), starts.astype(np.uint32).tobytes(), exceptions.tobytes(), words.tobytes(), places.tobytes(), grid[outlier].tobytes()])


def unpack_chunk(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of blocks first to last (all by default) of a chunk."""
    n, blocks, n_words, n_places = struct.unpack_from("<IIII", data)
    at = 16
    parts = []
    for kind, count in ((np.uint32, blocks), (np.uint8, blocks), (np.uint32, blocks + 1), (np.uint32, blocks + 1), (np.uint64, n_words), (np.uint8, n_places), (np.uint32, n_places)):
        parts.append(np.frombuffer(data, kind, count, at))
        at += parts[-1].nbytes
    low, width, starts, exceptions, words, places, values = parts
    last = blocks if last is None else last
    out = np.zeros((last - first, BLOCK), dtype=np.uint64)
    for w in np.unique(width[first:last]).tolist():
        if not w:
            continue
        own = np.flatnonzero(width[first:last] == w)
        packed = words[(starts[first:last][own].astype(np.int64)[:, None] + np.arange(2 * w))]
        mask = np.uint64((1 << w) - 1)
        for i in range(BLOCK):
            k, shift = divmod(i * w, 64)
            x = packed[:, k] >> np.uint64(shift)
            if shift + w > 64:
                x |= packed[:, k + 1] << np.uint64(64 - shift)
            out[own, i] = x & mask
    out += low[first:last, None]
    a, b = int(exceptions[first]), int(exceptions[last])
    rows = np.repeat(np.arange(last - first), np.diff(exceptions[first : last + 1].astype(np.int64)))
    out[rows, places[a:b]] = values[a:b]
    return out.astype(np.uint32).ravel()[: max(0, n - first * BLOCK)]


class ShardWriter:
    """Streams ids to chunks; the footer has the chunks' places and the documents' first ids."""

    def __init__(self, root: str):
        self.name = f"tokens-{uuid.uuid4().hex}.pfor"
        fs, path = open_store(root)
        fs.create_dir(path, recursive=True)
        self.out = fs.open_output_stream(f"{path}/{self.name}")
        self.out.write(MAGIC)
        self.at, self.tokens, self.waiting, self.held = len(MAGIC), 0, [], 0
        self.chunks: list[int] = []
        self.ids: list[int | None] = []
        self.starts: list[int] = []

    def put(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.starts.append(self.tokens)
        self.tokens += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= CHUNK_BLOCKS * BLOCK:
            self._flush(False)

    def _flush(self, end: bool) -> None:
        stream, size = np.concatenate(self.waiting), CHUNK_BLOCKS * BLOCK
        whole = len(stream) if end else len(stream) // size * size
        for i in range(0, whole, size):
            data = pack_chunk(stream[i : min(i + size, whole)])
            self.chunks.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.waiting, self.held = [stream[whole:]], len(stream) - whole

    def close(self) -> None:
        if self.held:
            self._flush(True)
        ids = np.array([x or 0 for x in self.ids], dtype=np.int64)
        known = np.array([x is not None for x in self.ids], dtype=np.uint8)
        footer = np.array([*self.chunks, self.at], dtype=np.uint64).tobytes() + ids.tobytes() + known.tobytes() + np.array([*self.starts, self.tokens], dtype=np.uint64).tobytes()
        self.out.write(footer + struct.pack("<QQQ", len(self.chunks), len(self.ids), self.at) + MAGIC)
        self.out.close()


class ShardReader:
    """Reads a shard back: the index first, ids by ranges."""

    def __init__(self, root: str, name: str):
        fs, path = open_store(root)
        self.source = fs.open_input_file(f"{path}/{name}")
        size = self.source.size()
        n_chunks, n_docs, at = struct.unpack("<QQQ", self.source.read_at(24, size - 32))
        data = self.source.read_at(size - 32 - at, at)
        self.chunks = np.frombuffer(data, np.uint64, n_chunks + 1)
        known = np.frombuffer(data, np.uint8, n_docs, self.chunks.nbytes + 8 * n_docs)
        self.ids = [x if k else None for x, k in zip(np.frombuffer(data, np.int64, n_docs, self.chunks.nbytes).tolist(), known)]
        self.starts = np.frombuffer(data, np.uint64, n_docs + 1, self.chunks.nbytes + 9 * n_docs).astype(np.int64)

    def chunk(self, k: int) -> bytes:
        return self.source.read_at(int(self.chunks[k + 1] - self.chunks[k]), int(self.chunks[k]))

    def range(self, first: int, last: int) -> np.ndarray:
        """Ids first to last of the shard; only the blocks that hold them are decoded."""
        size, parts = CHUNK_BLOCKS * BLOCK, []
        for k in range(first // size, -(-last // size)):
            a, b = max(first, k * size) - k * size, min(last, (k + 1) * size) - k * size
            parts.append(unpack_chunk(self.chunk(k), a // BLOCK, -(-b // BLOCK))[a % BLOCK : a % BLOCK + b - a])
        return np.concatenate(parts) if parts else np.empty(0, np.uint32)

    def documents(self):
        """(doc_id, first id, ids) of every document, one chunk in memory at a time."""
        k, held, at = 0, [], 0
        have, size = 0, CHUNK_BLOCKS * BLOCK
        for i, doc_id in enumerate(self.ids):
            first, last = int(self.starts[i]), int(self.starts[i + 1])
            while have < last:
                held.append(unpack_chunk(self.chunk(k)))
                have += len(held[-1])
                k += 1
            if len(held) > 1:
                held = [np.concatenate(held)]
            yield doc_id, first, held[0][first - at : last - at] if held else np.empty(0, np.uint32)
            if last - at > size:
                held, at = [held[0][last - at :]], last


class _Numbers(dict):
    """Numbers words as they come; ``new`` lists those not seen before."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class WordEncoder:
    """Encodes texts with the tokenizers library, each distinct word stem once.

    The tokenizer folds case and its splits never cross white space, nor run from a letter or digit
    into ASCII punctuation, so a text's ids are those of its words in order, and a word's those of
    its stem and of the punctuation after it. New stems are encoded many at a time, between
    separators that no stem holds. Texts that hold an added token, and all texts if the tokenizer does
    not split so, go to the library whole. Words are numbered and their ids lie in one array; words and stems
    are remembered, up to about CACHE_WORDS each.
    """

    SEPARATOR = "\x01"
    TRAILING = bytes(c for c in range(33, 127) if not chr(c).isalnum())
    CLOSED = frozenset(c for c in range(128) if chr(c).isalnum())

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = sorted({t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.stemmed = self._splits_as_known()
        ids = self.tokenizer.encode(self.SEPARATOR, add_special_tokens=False).ids
        self.separator = ids[0] if len(ids) == 1 else None
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[n for t, n in vocabulary.items() if t.endswith("</w>")]] = True
        self.stems = Remembered(CACHE_WORDS)
        self._forget()

    def _splits_as_known(self) -> bool:
        """Whether texts may be cut at white space and before punctuation, told from what the tokenizer does."""
        whole = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        for text in ("Some words, (and) MORE! don't stop-it: a.b c_d", "Él niño 12,5 über; ñandú... x=y", "one\ttwo\n\n three"):
            parts = [x for w in text.lower().split() for x in (w.rstrip(self.TRAILING.decode()), w[len(w.rstrip(self.TRAILING.decode())) :])]
            if whole(text) != [i for p in parts for i in whole(p)]:
                return False
        return True

    def _forget(self) -> None:
        self.words, self.flat = _Numbers(), np.empty(0, np.uint32)
        self.starts, self.lengths = np.empty(0, np.int64), np.empty(0, np.int64)

    @staticmethod
    def _closes(stem: bytes) -> bool:
        """Whether a stem's last letter ends a split before punctuation, whatever normalising makes of it."""
        c = stem.decode()[-1]
        return c.isalnum() and len(c.lower()) == 1 and unicodedata.is_normalized("NFC", c)

    @staticmethod
    def _one_split(text: str) -> bool:
        """Whether a stem is letters only, before and after normalising: one split of the tokenizer."""
        return text.isalpha() and (text.isascii() or unicodedata.is_normalized("NFC", text) and len(text.lower()) == len(text))

    def _lots(self, stems: list[str], between: str, cut) -> list[str]:
        """Encodes stems 200 at a time; ``cut`` gives (first, last) of each stem's ids, or None to give the lot back."""
        known, back = self.stems.young, []
        for at in range(0, len(stems), 20_000):
            lots = [stems[i : i + 200] for i in range(at, min(at + 20_000, len(stems)), 200)]
            for lot, found in zip(lots, self.tokenizer.encode_batch_fast([between.join(x) for x in lots], add_special_tokens=False)):
                ids = np.array(found.ids, dtype="<u4")
                places = cut(ids, len(lot))
                if places is None:
                    back += lot
                    continue
                data = ids.tobytes()
                for stem, i, j in zip(lot, (places[0] * 4).tolist(), (places[1] * 4).tolist()):
                    known[stem.encode()] = data[i:j]
        return back

    def _at_ends(self, ids: np.ndarray, n: int):
        last = np.flatnonzero(self.ends[ids]) + 1
        return (np.concatenate([[0], last[:-1]]), last) if len(last) == n and last[-1] == len(ids) else None

    def _at_separators(self, ids: np.ndarray, n: int):
        at = np.flatnonzero(ids == self.separator)
        return (np.concatenate([[0], at + 1]), np.concatenate([at, [len(ids)]])) if len(at) == n - 1 else None

    def _learn(self, stems: list[bytes]) -> None:
        """Letters alone are told apart by the tokens that end a split, other stems by a separator token."""
        plain, other = [], []
        for s in stems:
            text = s.decode()
            (plain if s.isalpha() or self._one_split(text) else other).append(text)
        rest = self._lots(plain, " ", self._at_ends) + other
        mixed = [t for t in rest if self.separator is not None and self.SEPARATOR not in t]
        rest = self._lots(mixed, f" {self.SEPARATOR} ", self._at_separators) + [t for t in rest if self.separator is None or self.SEPARATOR in t]
        for t in rest:
            self.stems.young[t.encode()] = np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _words(self, new: list[bytes]) -> None:
        stems, ends, wanted, closed, trailing = [], [], set(), self.CLOSED, self.TRAILING
        for word in new:
            stem = word.rstrip(trailing)
            if len(stem) < len(word) and stem and (stem[-1] in closed or stem[-1] > 127 and self._closes(stem)):
                ends.append(word[len(stem) :])
                wanted.add(ends[-1])
            else:
                stem = word
                ends.append(b"")
            stems.append(stem)
        wanted.update(stems)
        wanted.discard(b"")
        self._learn(self.stems.missing(wanted))
        self.stems.young[b""] = b""
        get = self.stems.young.__getitem__
        parts = [*map(get, chain.from_iterable(zip(stems, ends)))]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)).reshape(-1, 2).sum(axis=1) // 4
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(parts), dtype="<u4")])

    def _whole(self, lowered: bytes) -> bool:
        """Whether a text goes to the library as it is: it may hold an added token, or the tokenizer splits otherwise."""
        return bool(lowered) and (not self.stemmed or any(t in lowered for t in self.added))

    def __call__(self, texts: list[bytes | None]) -> list[np.ndarray]:
        lowered = [(t or b"").lower() for t in texts]
        apart = [i for i, t in enumerate(lowered) if self._whole(t)]
        for i in apart:
            lowered[i] = b""
        out = self._by_words(lowered)
        for i in apart:
            out[i] = np.array(self.tokenizer.encode(texts[i].decode(), add_special_tokens=False).ids, dtype=np.uint32)
        return out

    def _by_words(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.words) > CACHE_WORDS:
            self._forget()
        number, self.words.new = self.words.__getitem__, []
        docs = [t.split() for t in texts]
        counts = np.array([len(d) for d in docs], dtype=np.int64)
        index = np.fromiter(map(number, chain.from_iterable(docs)), np.int32, int(counts.sum()))
        if self.words.new:
            self._words(self.words.new)
        lengths = self.lengths[index]
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        kind = np.int32 if ends[-1] + len(self.flat) < 2**31 else np.int64  # half the memory to move
        places = np.repeat((self.starts[index] - ends[:-1]).astype(kind), lengths)
        places += np.arange(ends[-1], dtype=kind)
        return np.split(self.flat[places], ends[np.cumsum(counts)][:-1]) if docs else []


_encoders: dict[str, WordEncoder] = {}
MEMORIES["tokenbin"] = _encoders.clear


def write_tokens(docs: DataFrame, root: str, tokenizer: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes shards below ``root``; returns the committed manifest, one row per shard."""
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", F.col("text").cast("binary").alias("text"))

    def task(batches):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        only("tokenbin")
        encode = _encoders.get(tokenizer) or _encoders.setdefault(tokenizer, WordEncoder(tokenizer))
        part, sequence, shard, rows = TaskContext.get().partitionId(), 0, None, []
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                for doc_id, ids in zip(some.column(0).to_pylist(), encode(some.column(1).to_pylist())):
                    shard = shard or ShardWriter(root)
                    shard.put(doc_id, np.concatenate([ids, end]))
                    if shard.tokens >= shard_tokens:
                        shard.close()
                        rows.append((part, sequence, shard.name, shard.tokens, len(shard.ids)))
                        sequence, shard = sequence + 1, None
        if shard:
            shard.close()
            rows.append((part, sequence, shard.name, shard.tokens, len(shard.ids)))
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["part", "sequence", "shard", "tokens", "documents"])

    ordered.mapInArrow(task, MANIFEST).write.parquet(f"{root}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{root}/manifest")


def read_tokens(manifest: DataFrame, root: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the shards; one row per shard goes through the driver."""
    spark = manifest.sparkSession
    shards = sorted(manifest.collect(), key=lambda r: (r.part, r.sequence))
    first, rows = 0, []
    for r in shards:
        rows.append((r.shard, first))
        first += r.tokens

    def task(batches):
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out: list[list] = [[], [], [], []]
                for doc_id, start, ids in ShardReader(root, name).documents():
                    for column, value in zip(out, (doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    index = spark.createDataFrame(rows, "shard string, base long")
    return index.repartition(max(1, len(rows))).mapInArrow(task, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokens_to_shards(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encodes, writes and reads back every document."""
    root = shared_dir(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, root, tokenizer), root)
