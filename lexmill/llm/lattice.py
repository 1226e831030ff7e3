"""Language-model scoring by a subword lattice.

A word's probability is the sum over all ways to cut it into pieces of an existing vocabulary
(white space ends a cut, a word starts with the vocabulary's word mark, characters can always be
spelled by byte pieces), each piece weighted by the vocabulary's own score; log-space forward
recursion gives that marginal. A text's score adds its words and one end, which is as likely as it is
among training tokens. That is ``score``.

Two options change it: ``rounds`` fits the weights by expected piece counts over the training words
(forward and backward recursion); ``whole_words`` adds a path that takes a training word whole, by
its count less a discount over all tokens, the discounts' mass (absolute discounting, n1 / (n1 + 2 n2))
being what the cuts share.

Words recur, so the recursion runs once per distinct word. A task numbers the words of its part of
the corpus and writes it packed; only (part, word, training count) rows are shuffled: to sum counts,
and to bring each part the counts and scores of its own words. Nothing but the piece table (bounded
by the vocabulary) and three totals passes the driver.

Defined results: null text is the empty text: the end token alone; without training documents all
counts are 0 and pieces keep their starting probabilities; null doc_ids train; repeated rows count
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import staged, staged_twice
from .langid import remainder

MARK = "▁"
PART_WORDS, PART_TOKENS = 600_000, 6_000_000
ROUNDS = 0
SPAN = 1 << 15
LONG_WORD = 256
NEVER = -1e30
#: Stands in a grid for the character 0, which pads it.
NUL = 0x110000
LN10 = math.log(10)
PACKED = "part long, doc_ids array<long>, held array<boolean>, lengths array<int>, sequence binary, words array<binary>, counts array<long>"


class _Numbers(dict):
    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def pack_documents(docs: DataFrame) -> DataFrame:
    """Parts of the corpus: word numbers of each document in order, the words and their training counts.

    ``docs`` has doc_id, held_out and text.
    """
    names = [x.split()[0] for x in PACKED.split(", ")]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]

    def task(batches):
        sequence = TaskContext.get().partitionId() << 24
        numbers, ids, held, runs, size = _Numbers(), [], [], [], 0

        def part():
            lengths = np.array([len(r) for r in runs], dtype=np.int32)
            stream = np.concatenate([np.empty(0, np.int32), *runs])
            train = np.repeat(~np.array(held, dtype=bool), lengths)
            counts = np.bincount(stream[train], minlength=len(numbers))
            values = (sequence, ids, held, lengths, stream.astype("<i4").tobytes(), list(numbers), counts)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

        for batch in batches:
            for doc_id, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = (text.as_py() or "").encode().lower().split()
                ids.append(doc_id)
                held.append(out)
                runs.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                size += len(words)
                if len(numbers) >= PART_WORDS or size >= PART_TOKENS:
                    yield part()
                    sequence, numbers, ids, held, runs, size = sequence + 1, _Numbers(), [], [], [], 0
        if ids:
            yield part()

    return docs.select(F.col("doc_id").cast("long"), "held_out", "text").mapInArrow(task, PACKED)


def _utf8(point: int) -> bytes:
    return b"\0" if point == NUL else chr(point).encode("utf-8", "replace")


class Pieces:
    """A vocabulary with log probabilities, found in words by hashes of their substrings."""

    def __init__(self, pieces: list[str], logs: np.ndarray, bytes_at: list[int]):
        self.pieces, self.logs = pieces, logs
        self.index = {p: i for i, p in enumerate(pieces)}
        self.spelled = bytes_at  # number of the piece of each byte
        self.byte_logs = logs[np.array(bytes_at)]
        self.longest = max(map(len, pieces))
        self.keys = np.array([self._hash(p) for p in pieces], dtype=np.uint64)
        self.order = np.argsort(self.keys)
        self.sorted = self.keys[self.order]

    BASE = np.uint64(0x9E3779B97F4A7C15)

    @staticmethod
    def _mix(points: np.ndarray) -> np.ndarray:
        x = points.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def _hash(self, piece: str) -> int:
        with np.errstate(over="ignore"):
            h = np.uint64(0)
            for x in self._mix(np.array([ord(c) for c in piece])):
                h = h * self.BASE + x
        return int(h)

    def _spelling(self, points: np.ndarray) -> np.ndarray:
        """Log probability of each character by its UTF-8 bytes."""
        out = np.empty(len(points))
        for i, c in enumerate(points.tolist()):
            out[i] = self.byte_logs[list(_utf8(c))].sum() if c else NEVER
        return out

    def edges(self, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For words (n, L) of code points, 0 beyond their end: piece number (or -1) and log probability
        of each substring by (length - 1, word, start), and log probability of spelled characters."""
        n, width = grid.shape
        with np.errstate(over="ignore"):
            mixed = self._mix(grid)
            rolling, numbers, logs = np.zeros((n, width), dtype=np.uint64), [], []
            for k in range(min(self.longest, width)):
                rolling = rolling[:, : width - k] * self.BASE + mixed[:, k:]
                at = np.minimum(np.searchsorted(self.sorted, rolling.ravel()), len(self.sorted) - 1)
                hit = (self.sorted[at] == rolling.ravel()) & (grid[:, k:] != 0).ravel()
                number = np.where(hit, self.order[at], -1).reshape(n, width - k)
                numbers.append(number)
                logs.append(np.where(number >= 0, self.logs[number], NEVER))
        points, where = np.unique(grid, return_inverse=True)
        return numbers, logs, self._spelling(points)[where.reshape(grid.shape)]


def _log_sum(parts: list[np.ndarray]) -> np.ndarray:
    stack = np.stack(parts)
    top = stack.max(axis=0)
    return top + np.log(np.exp(stack - top).sum(axis=0))


def forward(logs: list[np.ndarray], spelled: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
    """Log mass of all cuts of each prefix, (n, L + 1); ``known`` are the first columns (by default the empty prefix)."""
    n, width = spelled.shape
    known = np.zeros((n, 1)) if known is None else known
    mass = np.full((n, width + 1), NEVER)
    mass[:, : known.shape[1]] = known
    for j in range(known.shape[1], width + 1):
        parts = [mass[:, j - 1] + spelled[:, j - 1]]
        parts += [mass[:, j - 1 - k] + logs[k][:, j - 1 - k] for k in range(min(len(logs), j))]
        mass[:, j] = _log_sum(parts)
    return mass


def backward(logs: list[np.ndarray], spelled: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Log mass of all cuts of each suffix, (n, L + 1)."""
    n, width = spelled.shape
    mass = np.full((n, width + 1), NEVER)
    mass[lengths == width, width] = 0.0
    for i in range(width - 1, -1, -1):
        parts = [mass[:, i + 1] + spelled[:, i]]
        parts += [mass[:, i + 1 + k] + logs[k][:, i] for k in range(min(len(logs), width - i))]
        mass[:, i] = _log_sum(parts)
        mass[lengths == i, i] = 0.0
    return mass


def grids(words: list[bytes]):
    """(positions, grid of code points, lengths) for words of about the same length, marked."""
    texts = [MARK + w.decode("utf-8", "replace") for w in words]
    size = np.array([len(t) for t in texts])
    key = np.where(size <= LONG_WORD, -(-size // 2) * 2, size)
    order = np.argsort(key, kind="stable")
    bounds = np.flatnonzero(np.diff(key[order])) + 1
    for group in np.split(order, bounds):
        width = int(size[group].max()) if len(group) else 0
        step = max(1, 400_000 // max(1, width))
        for at in range(0, len(group), step):
            some = group[at : at + step]
            text = "".join(texts[i].ljust(width, "\0") for i in some)
            grid = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(some), width)
            within = np.arange(width) < size[some][:, None]
            yield some, np.where((grid == 0) & within, np.uint32(NUL), grid), size[some]


def long_score(word: bytes, pieces: Pieces) -> float:
    """As ``word_scores`` of one word of any length: span by span, carrying the masses that a piece can reach back to."""
    points = np.frombuffer((MARK + word.decode("utf-8", "replace")).encode("utf-32-le"), dtype=np.uint32)
    points = np.where(points == 0, np.uint32(NUL), points)
    known, at, back = np.zeros((1, 1)), 0, 0
    while at < len(points):
        _, logs, spelled = pieces.edges(points[None, at - back : at + SPAN])
        mass = forward(logs, spelled, known)
        at = min(at + SPAN, len(points))
        back = min(pieces.longest, mass.shape[1] - 1)
        known = mass[:, mass.shape[1] - 1 - back :]
    return float(known[0, -1])


def word_scores(words: list[bytes], pieces: Pieces) -> np.ndarray:
    """Natural log of each word's marginal probability."""
    out, long_ = np.empty(len(words)), np.array([len(w) > SPAN for w in words], dtype=bool)
    for i in np.flatnonzero(long_):
        out[i] = long_score(words[i], pieces)
    short = np.flatnonzero(~long_)
    for some, grid, lengths in grids([words[i] for i in short]):
        _, logs, spelled = pieces.edges(grid)
        out[short[some]] = forward(logs, spelled)[np.arange(len(some)), lengths]
    return out


def expected_counts(words: list[bytes], counts: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Expected number of uses of each piece in words that occur ``counts`` times."""
    total = np.zeros(len(pieces.pieces))
    for some, grid, lengths in grids(words):
        numbers, logs, spelled = pieces.edges(grid)
        ahead, behind = forward(logs, spelled), backward(logs, spelled, lengths)
        whole, times = behind[:, :1], counts[some][:, None]
        for k, (number, log) in enumerate(zip(numbers, logs)):
            width = log.shape[1]
            use = np.exp(np.minimum(0.0, ahead[:, :width] + log + behind[:, k + 1 : k + 1 + width] - whole)) * times
            hit = number >= 0
            total += np.bincount(number[hit], use[hit], minlength=len(total))
        width = grid.shape[1]
        use = np.exp(np.minimum(0.0, ahead[:, :width] + spelled + behind[:, 1:] - whole)) * times
        hit = use > 1e-12
        for c, n in zip(*_sums(grid[hit], use[hit])):
            for b in _utf8(c):
                total[pieces.spelled[b]] += n
    return total


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[list, list]:
    found, where = np.unique(keys, return_inverse=True)
    return found.tolist(), np.bincount(where, values, minlength=len(found)).tolist()


def load_vocabulary(path: str) -> tuple[list[str], np.ndarray, list[int]]:
    """Pieces, starting weights from the vocabulary's own scores, and where the 256 byte pieces are.

    A score is minus a rank in vocabularies of merges; the weight is 1 / (2 + rank).
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    numbers = [i for i in range(model.get_piece_size()) if not model.is_control(i) and not model.is_unknown(i)]
    pieces = [model.id_to_piece(i) for i in numbers]
    ranks = np.array([max(0.0, -model.get_score(i)) for i in numbers])
    ranks[[k for k, i in enumerate(numbers) if model.is_byte(i)]] = len(numbers)
    at = {p: k for k, p in enumerate(pieces)}
    # a byte piece's name must not be found in a text
    spelled = [at[f"<0x{b:02X}>"] for b in range(256)]
    for b, k in enumerate(spelled):
        pieces[k] = f"\0{b:02X}"
    return pieces, 1.0 / (2.0 + ranks), spelled


def fit_pieces(counts: DataFrame, vocabulary: str, rounds: int = ROUNDS) -> Pieces:
    """Piece probabilities fitted to (word, c) rows; without rows the vocabulary's own."""
    names, weights, spelled = load_vocabulary(vocabulary)
    logs = np.log(weights / weights.sum())
    for _ in range(rounds):
        start = logs

        def task(batches, start=start):
            pieces, total = Pieces(names, start, spelled), 0.0
            for batch in batches:
                total = total + expected_counts(batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(float), pieces)
            if isinstance(total, np.ndarray):
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_pydict({"piece": at.astype(np.int32), "n": total[at]})

        rows = counts.where("c > 0").select("word", "c").mapInArrow(task, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
        if not len(rows):
            break
        found = np.zeros(len(names))
        found[rows["piece"]] = rows["n"]
        found += 0.1  # no piece becomes impossible
        logs = np.log(found / found.sum())
    return Pieces(names, logs, spelled)


def score_documents(docs: DataFrame, vocabulary: str, rounds: int = ROUNDS, whole_words: bool = False) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; ``docs`` has doc_id, held_out, text."""
    packed, body = staged_twice(pack_documents(docs), "lm-parts")
    words = packed.select("part", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "x")).select("part", "at", F.col("x.words").alias("word"), F.col("x.counts").alias("n"))
    counts = staged(words.groupBy("word").agg(F.sum("n").alias("c")), "lm-counts")
    ends = packed.select(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    types, tokens, once, twice = (int(x or 0) for x in counts.where("c > 0").agg(F.count("*"), F.sum("c"), F.expr("count_if(c = 1)"), F.expr("count_if(c = 2)")).first())
    tokens, distinct = tokens + ends, types + (ends > 0)
    pieces = fit_pieces(counts, vocabulary, rounds)
    names, logs, spelled = pieces.pieces, pieces.logs, pieces.spelled
    discount = once / (once + 2 * twice) if once and twice else 0.5
    cut = math.log(discount * types / tokens) if types else 0.0
    end = math.log(ends / tokens) if ends else -math.log(2)

    def mark(batches):
        table = Pieces(names, logs, spelled)
        for batch in batches:
            c = batch.column(1).to_numpy()
            marginal = word_scores(batch.column(0).to_pylist(), table)
            if whole_words:
                whole = np.where(c > 0, np.log(np.maximum(c - discount, 1e-9) / max(tokens, 1)), NEVER)
                marginal = np.logaddexp(whole, cut + marginal)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marginal)], names=["word", "c", "marginal"])

    marked = counts.mapInArrow(mark, "word binary, c long, marginal double")
    back = words.select("part", "at", "word").join(marked, "word").select("part", "at", "c", "marginal")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        at, size = right.column("at").to_numpy(), right.num_rows
        known, base, marginal = np.zeros(size, dtype=np.int64), np.zeros(size), np.zeros(size)
        c = right.column("c").to_numpy()
        known[at], base[at], marginal[at] = c > 0, np.log10(c + 1.0), right.column("marginal").to_numpy() / LN10
        out = []
        for row in left.to_pylist():
            lengths = np.array(row["lengths"], dtype=np.int64)
            stream = np.frombuffer(row["sequence"], dtype="<i4")
            starts = np.concatenate([[0], np.cumsum(lengths)])

            def sums(x):
                total = np.concatenate([x[stream], [0]])
                return np.where(lengths > 0, np.add.reduceat(total, starts[:-1]), 0)

            n = lengths + 1
            out.append(
                pa.table(
                    {
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "held_out": pa.array(row["held"], pa.bool_()),
                        "n_tokens": n,
                        "n_known": sums(known).astype(np.int64) + (ends > 0),
                        "train_tokens": np.full(len(n), tokens, dtype=np.int64),
                        "base_score": sums(base) + math.log10(ends + 1) - n * math.log10(tokens + distinct + 1),
                        "score": sums(marginal) + end / LN10,
                    }
                )
            )
        return pa.concat_tables(out) if out else None

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    body = body.select("part", "doc_ids", "held", "lengths", "sequence")
    return body.groupBy("part").cogroup(back.groupBy("part")).applyInArrow(score, schema)


def lm_scores(docs: DataFrame, vocabulary: str, rounds: int = ROUNDS, whole_words: bool = False) -> DataFrame:
    """Scores all documents, learning from six of seven crc32 remainders of doc_id."""
    held = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    return score_documents(docs.select("doc_id", held.alias("held_out"), "text"), vocabulary, rounds, whole_words)
