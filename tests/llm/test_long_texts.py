"""Very long texts in every operator that takes whole texts."""

import hashlib
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from lexmill.llm import bpe, jaccard, langid, lattice, lines, media, mixing, ranked, secrets, tokenbin  # noqa: E402

WORDS = [f"word{i:x}" for i in range(997)]
LONG = " ".join(WORDS[(i * 7919) % 997] for i in range(40_000))  # about 300 KB
ROWS = [(1, LONG, "en", "a"), (2, "the quick brown fox jumps over the lazy dog", "en", "a"), (3, LONG + " end", "en", "b"), (4, "x" * 200_000, "en", "b"), (5, "a short text of some words for the language", "en", "b")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, len(r[1])) for r in ROWS], "doc_id long, text string, lang string, source string, n_chars long").repartition(2)


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def test_language(docs):
    got = by_id(langid.language_id(docs), "lang_pred")
    assert {i: g[0] for i, g in got.items()} == dict.fromkeys(range(1, 6), "en")


def test_tokens(docs):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    got = by_id(tokenbin.tokens_to_shards(docs, path), "n_tokens", "ids_crc32")
    for i, text, *_ in ROWS[:3]:
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [2], dtype="<u4")
        assert got[i] == (len(ids), zlib.crc32(ids.tobytes()))


def test_groups(docs):
    got = by_id(jaccard.jaccard_components(docs), "component_id")
    assert got == {1: (1,), 2: (2,), 3: (1,), 4: (4,), 5: (5,)}
    assert {r.doc_id for r in jaccard.keep_one_of_group(docs).collect()} == {1, 2, 4, 5}


def test_bpe(docs):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    got = by_id(bpe.encode_documents(docs, path, P.PATTERN), "ids_sha256", "decoded_sha256")
    for i, text, *_ in ROWS:
        if i != 4:  # the library itself is quadratic there
            assert got[i][0] == hashlib.sha256(np.array(encoding.encode_ordinary(text), dtype="<u4").tobytes()).hexdigest()
        assert got[i][1] == hashlib.sha256(text.encode()).hexdigest()


def test_secrets(docs):
    assert secrets.scan_secrets(docs).count() == 0


def test_mixing(docs):
    got = by_id(mixing.mix_sizes(docs), "size", "taken")
    assert {i: g[0] for i, g in got.items()} == {i: len(t.split()) for i, t, *_ in ROWS} and all(g[1] <= 2 * g[0] for g in got.values())


def test_media(docs):
    got = by_id(media.media_columns(docs), "n_bytes", "payload_sha256")
    for i, text, *_ in ROWS:
        data = text.encode()
        assert got[i] == (len(data), hashlib.sha256(data + bytes(-len(data) % 64)).hexdigest())


def test_lines(docs):
    got = by_id(lines.dedup_lines(docs), "text")
    assert got[2][0] == ROWS[1][1] and got[4][0] == ROWS[3][1]  # one word is no line that takes part
    assert sorted(len(got[i][0]) for i in (1, 3)) == [0, len(LONG)]  # one is a near copy of the other: the first stays


def test_scores(docs):
    got = by_id(lattice.lm_scores(docs, P.path("piece_bpe_32k.model")), "n_tokens", "score")
    assert {i: g[0] for i, g in got.items()} == {i: len(t.split()) + 1 for i, t, *_ in ROWS} and all(np.isfinite(g[1]) for g in got.values())


def test_ranked(spark, docs):
    asked = spark.createDataFrame([(0, "end word3"), (1, LONG)], "item_id long, text string")
    got = ranked.search_ranked(docs, asked).collect()
    assert [r.doc_id for r in sorted(got, key=lambda r: r["rank"]) if r.item_id == 0][0] == 3
    assert {r.doc_id for r in got if r.item_id == 1} == {1, 3}
