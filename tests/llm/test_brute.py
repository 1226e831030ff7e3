"""Whole results of language ID, line dedup and the pipeline against plain versions that compare everything."""

import hashlib
import itertools
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from lexmill.llm import bpe, langid, lines  # noqa: E402
from lexmill.llm.edits import edit_distances  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_languages(rows, learns):
    """(doc_id: language, cosine) by whole vectors of every n-gram; rows are (doc_id, text, lang)."""
    vectors = langid.GramVectors(langid.DIMS)
    profile = lambda text: [(int(c), int(n)) for c, n in zip(*langid.gram_counts(text))]
    bound = {}
    total = lambda grams: sum(n * bound.setdefault(c, vectors.bind(c).astype(float)) for c, n in grams)
    prototypes = {}
    for i, text, lang in rows:
        grams = profile(text)
        if lang is not None and grams and learns(i):
            size = sum(n * n for _, n in grams) ** 0.5
            prototypes[lang] = prototypes.get(lang, 0) + total(grams) / size
    out = {}
    for i, text, _ in rows:
        grams = profile(text)
        if not grams or not prototypes:
            out[i] = ("und", 0.0)
            continue
        x = total(grams)
        cosine = {name: float(x @ p / np.linalg.norm(x) / np.linalg.norm(p)) for name, p in prototypes.items()}
        best = max(sorted(cosine), key=cosine.get)
        out[i] = (best, min(1.0, max(0.0, cosine[best])))
    return out


def plain_lines(rows, drop_emptied):
    """Texts after line dedup: all pairs of lines by edit distance, the first of each connected group stays."""
    spots = [(i, place, norm) for i, text in sorted(rows, key=lambda r: r[0]) for place, norm in lines._eligible(text, lines.LEAST_WORDS)]
    known = sorted({norm for *_, norm in spots})
    root = {x: x for x in known}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = [(a.decode(), b.decode()) for a, b in itertools.combinations(known, 2) if min(len(a), len(b)) >= 0.88 * max(len(a), len(b))]
    most = np.array([int(0.1 * max(len(a), len(b)) + 1e-9) for a, b in pairs], dtype=np.int64)
    if pairs:
        for (a, b), near in zip(pairs, edit_distances([a for a, _ in pairs], [b for _, b in pairs], most) <= most):
            if near:
                root[find(a.encode())] = find(b.encode())
    seen, gone = set(), {}
    for i, place, norm in spots:
        if find(norm) in seen:
            gone.setdefault(i, set()).add(place)
        seen.add(find(norm))
    out = {}
    for i, text in rows:
        left = [x for k, x in enumerate((text or "").split("\n")) if k not in gone.get(i, ())]
        if not (drop_emptied and i in gone and not "".join(left).strip()):
            out[i] = text if i not in gone else "\n".join(left)
    return out


def plain_groups(rows, percent=80):
    """doc_id to the least doc_id of its component, by comparing all sets of shingles."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    least = {i: i for i in sets}
    for _ in range(len(sets)):
        before = dict(least)
        for a, b in itertools.combinations(sets, 2):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                least[a] = least[b] = min(least[a], least[b])
        if before == least:
            return least
    return least


def sample(spark, count, edits, share=20):
    """Documents of the small tables and copies of some of their lines with up to 1 / share of the letters edited."""
    rng = np.random.default_rng(8)
    found = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) < 3000").orderBy("doc_id").limit(count)
    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in found.collect()]
    every = sorted({x for _, t, *_ in rows for x in (t or "").split("\n") if len(x.split()) >= 4})
    letters = list("abcdefgh ")
    for k in range(edits):
        line = list(every[int(rng.integers(len(every)))])
        for _ in range(int(rng.integers(0, max(2, len(line) // share)))):
            at = int(rng.integers(len(line)))
            kind = rng.integers(3)
            if kind == 0:
                line[at] = letters[rng.integers(9)]
            elif kind == 1:
                line.insert(at, letters[rng.integers(9)])
            elif len(line) > 9:
                del line[at]
        text = "".join(line)
        rows.append((10_000 + k, text, "en", f"s{k % 3}", len(text)))
    return rows


def test_language_id_whole(spark):
    rows = sample(spark, 60, 10) + [(20_000, None, "en", "a", 0), (20_001, "12 34", "en", "a", 5)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.language_id(spark.createDataFrame(rows, COLUMNS).repartition(3)).collect()}
    want = plain_languages([r[:3] for r in rows], lambda i: zlib.crc32(str(i).encode()) % 4 != 2)
    assert {i: g[0] for i, g in got.items()} == {i: w[0] for i, w in want.items()}
    for i, (_, score) in want.items():
        assert got[i][1] == pytest.approx(score, abs=1e-3)


@pytest.mark.parametrize("share,missed", [(20, 0), (8, 3)])
def test_lines_whole(spark, share, missed):
    """All pairs of lines by edit distance give the same texts; with edits about the limit few lines more may stay, none may go."""
    rows = sample(spark, 110, 110, share)
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(rows, COLUMNS).repartition(3)).collect()}
    want = plain_lines([r[:2] for r in rows], False)
    unlike = [i for i in want if got[i] != want[i]]
    assert set(got) == set(want) and len(unlike) <= missed and all(len(got[i] or "") > len(want[i] or "") for i in unlike)


def test_pipeline_whole(spark, tmp_path):
    """Each stage on its own input: the first three and the last equal plain versions, mixing stays within its bounds."""
    import tiktoken

    rows = sample(spark, 50, 25) + [(20_000, None, "en", "a", 0), (20_001, "12 34", "en", "a", 5)]
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    frame = spark.read.parquet(f"{path}/documents.parquet")
    held = []
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, path)
        frame.write.parquet(f"{path}/{name}")
        frame = spark.read.parquet(f"{path}/{name}")
        held.append(frame.collect())
    one, two, three, four, five = held
    told = plain_languages([r[:3] for r in rows], lambda i: True)
    least = langid.CHANCE / langid.DIMS**0.5
    clear = {i for i, (lang, score) in told.items() if lang != "und" and score >= least + 1e-3}
    assert clear <= {r.doc_id for r in one} <= {i for i, (lang, score) in told.items() if lang != "und" and score >= least - 1e-3}
    want = plain_lines([(r.doc_id, r.text) for r in one], True)
    assert {r.doc_id: r.text for r in two} == want and all(r.n_chars == len(r.text) for r in two)
    groups = plain_groups([(r.doc_id, r.text) for r in two])
    assert sorted(r.doc_id for r in three) == sorted(i for i, g in groups.items() if i == g)
    texts = {r.doc_id: r.text for r in three}
    counts = {i: sum(r.doc_id == i for r in four) for i in texts}
    assert all(r.text == texts[r.doc_id] for r in four) and max(counts.values()) <= 2
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    assert sorted(r.doc_id for r in five) == sorted(r.doc_id for r in four)
    for r in five:
        assert list(r.ids) == encoding.encode_ordinary(texts[r.doc_id]) and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
