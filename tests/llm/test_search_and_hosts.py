"""Ranked search, host reputations and hard negatives against brute force, and their edge cases."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from lexmill.llm import negatives, ranked, urls  # noqa: E402

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


# --- 11 ranked search -----------------------------------------------------------------------------------
def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute_ranking(docs, queries, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = {}
    for item, text in queries:
        rows = []
        for i, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                rows.append((-score, i is None, i or 0))
        out[item] = [(None if gone else i, -s) for s, gone, i in sorted(rows)[:k]]
    return {q: r for q, r in out.items() if r}


def random_texts(seed, count):
    rng = np.random.default_rng(seed)
    words = ["a", "B", "ñu", "Ärger", "x1", "it's", "end.", "日本", "e\u0301", "Zz-Zz"] + [f"w{i}" for i in range(60)]
    share = 1 / np.arange(1, len(words) + 1)
    return [" ".join(rng.choice(words, size=rng.integers(0, 60), p=share / share.sum())) for _ in range(count)]


@pytest.mark.parametrize("shard,step,block", [(2_000_000, 64, 200_000), (40, 1, 200_000), (500, 3, 20)])
def test_ranked_search(spark, monkeypatch, shard, step, block):
    monkeypatch.setattr(ranked, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(ranked, "STEP", step)
    texts = random_texts(1, 150)
    rows = list(enumerate(texts)) + [(3, texts[3]), (3, texts[3]), (None, texts[5]), (500, None), (501, ""), (502, "  ..!\x00 "), (503, "w1 " * 50_000 + "rare")]
    asked = [(0, texts[0]), (1, "w3 W3 rare"), (2, "unknown"), (3, None), (4, " ".join(texts[10:20])), (None, "ÄRGER ärger Ärger x1")]
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t in rows], "doc_id long, text string, term string, score double").repartition(3)
    queries = spark.createDataFrame([(i, t, 5) for i, t in asked], "item_id long, text string, rank int")
    got = {}
    for r in ranked.search_ranked(docs, queries, k=7, block_terms=block).orderBy("rank").collect():
        got.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(got[r.item_id])
    assert got == brute_ranking(rows, asked, 7)
    assert ranked.search_ranked(docs.limit(0), queries).count() == 0
    assert ranked.search_ranked(docs, queries.limit(0)).count() == 0


def test_threshold_stops_early():
    """A shard of many documents is not read to its end, and what is returned holds all ties of the kth score."""
    rng = np.random.default_rng(2)
    docs = 5000
    impacts = np.sort(rng.integers(1, 10**6, size=(docs, 2)), axis=0)
    starts = np.arange(docs + 1) * 2
    shard = ranked.Shard(np.arange(docs), starts, np.tile([0, 1], docs), impacts.reshape(-1).astype(np.int64), 2)
    places, scores = shard.best(np.array([0, 1]), 10, 1)
    assert sorted(scores)[-10:] == sorted(impacts.sum(axis=1))[-10:] and shard.read < docs
    flat = ranked.Shard(np.arange(300), np.arange(301), np.zeros(300, dtype=np.int64), np.full(300, 5, dtype=np.int64), 1)
    assert len(flat.best(np.array([0]), 10, 1)[0]) == 300  # all are ties: ids decide later


# --- 12 host reputation -----------------------------------------------------------------------------------
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "allow"), ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("twice.net", "/", "block"), ("twice.net", "/", "allow")]
URLS = [
    ("http://A.Example.ORG/es/5?x#y", "a.example.org", "/es/5", "example.org/es/", "block"),
    ("https://example.org/en/17", "example.org", "/en/17", "example.org/en/1", "allow"),
    ("https://badexample.org/es/1", "badexample.org", "/es/1", "org/", "allow"),
    ("https://example.org", "example.org", "", None, "allow"),
    ("https://example.org?p=/es/", "example.org", "", None, "allow"),
    ("x://u.com/de/1://q/fr/", "u.com", "/de/1://q/fr/", "com/de/", "block"),
    ("https://com/fr/", "com", "/fr/", "com/fr/", "allow"),
    ("https://www.twice.net/a", "www.twice.net", "/a", "twice.net/", "block"),
    ("//example.org/es/", "", "", None, "allow"),
    ("://", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("http://ÑAM.net/Path", "Ñam.net", "/Path", None, "allow"),
    ("http://" + "sub." * 5000 + "org/" + "p" * 100_000 + "#f", "sub." * 5000 + "org", "/" + "p" * 100_000, "org/", "allow"),
]


@pytest.mark.parametrize("most", [0, 100_000])
def test_rules(spark, monkeypatch, most):
    monkeypatch.setattr(urls.with_row, "__defaults__", (most, 4))
    pages = spark.createDataFrame([(i if i else None, u[0], "v", "r") for i, u in enumerate(URLS)] + [(5, URLS[5][0], "v", "r")], "page_id long, url string, verdict string, rules string")
    outcomes = spark.createDataFrame([(1, None), (None, True), (99, True)], "page_id long, bad boolean")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = urls.judge_urls(pages, outcomes, rules).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        _, host, path, rule, verdict = URLS[r.page_id or 0]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)
    assert urls.judge_urls(pages.limit(0), outcomes, rules).count() == 0
    assert {r.rule for r in urls.judge_urls(pages, outcomes.limit(0), rules.limit(0)).collect()} == {None}


def test_domains(spark):
    hosts = ["a.b.example.com", "example.com", "com", "x.y.co.uk", "co.uk", "u:p@h.example.net:80", "10.0.0.1", "10.0.0.1:8080", "", "[::1]:80"]
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    domain, suffix = urls.domain_parts(frame["host"])
    got = [tuple(r) for r in frame.select(domain, suffix).collect()]
    assert got == [("example.com", "com"), ("example.com", "com"), ("com", "com"), ("y.co.uk", "co.uk"), ("co.uk", "co.uk"), ("example.net", "net"), ("10.0.0.1", ""), ("10.0.0.1", ""), ("", ""), ("[::1]", "")]


def brute_reputations(counts, z):
    """Every level by plain sums: host -> (mean, bound)."""
    parts = {h: (".".join(h.split(".")[-2:]), h.split(".")[-1]) for h in counts}

    def rho(units):
        over = sum((k - n * m) ** 2 / n - m * (1 - m) for n, k, m in units if n)
        pairs = sum((n - 1) * m * (1 - m) for n, k, m in units if n)
        return min(max(over / pairs if pairs else 0, 1e-4), 0.9)

    def level(units):
        c = 1 / rho(units.values()) - 1
        return {u: (c * m + k, c * (1 - m) + n - k) for u, (n, k, m) in units.items()}

    def grouped(of, prior, held):
        out = {}
        for h, (n, k) in held.items():
            a, b, _ = out.get(of(h), (0, 0, 0))
            out[of(h)] = (a + n, b + k, prior(h))
        return out

    rates = [k / n for n, k in counts.values() if n]
    plain = min(max(sum(rates) / len(rates), 0.01), 0.99)
    r = rho([(n, k, plain) for n, k in counts.values()])
    fewer = {h: (n / (1 + (n - 1) * r), k / (1 + (n - 1) * r)) if n else (0, 0) for h, (n, k) in counts.items()}
    total = [sum(c[i] for c in fewer.values()) for i in (0, 1)]
    share = lambda ab: ab[0] / (ab[0] + ab[1])
    top = level(grouped(lambda h: parts[h][1], lambda h: (total[1] + 1) / (total[0] + 2), fewer))
    middle = level(grouped(lambda h: parts[h][0], lambda h: share(top[parts[h][1]]), fewer))
    hosts = level(grouped(lambda h: h, lambda h: share(middle[parts[h][0]]), counts))
    return {h: (share(ab), share(ab) - z * math.sqrt(share(ab) * (1 - share(ab)) / (sum(ab) + 1))) for h, ab in hosts.items()}


@pytest.mark.parametrize("most", [0, 100_000])
def test_reputations(spark, monkeypatch, most):
    monkeypatch.setattr(urls.with_row, "__defaults__", (most, 4))
    rng = np.random.default_rng(3)
    counts = {}
    for d in range(30):
        p = 0.9 if d % 10 == 0 else 0.1
        for h in range(rng.integers(1, 6)):
            n = int(rng.integers(0, 40))
            counts[f"h{h}.d{d}.{'com' if d % 3 else 'net'}"] = (n, int(rng.binomial(n, p)))
    counts |= {"new.d0.net": (0, 0), "new.d1.com": (0, 0), "once.d99.com": (1, 1), "hot.d98.com": (5000, 4000)}
    frame = spark.createDataFrame([(h, n, k) for h, (n, k) in counts.items()], "host string, n long, bad long").repartition(3)
    got = {r.host: (r["mean"], r.bound) for r in urls.reputations(frame).collect()}
    want = brute_reputations(counts, urls.Z)
    assert set(got) == set(want)
    for h in want:
        assert got[h] == pytest.approx(want[h], abs=1e-9)
    assert got["new.d0.net"][0] > 0.5 > got["new.d1.com"][0]  # a new host has what is known of its domain
    assert got["once.d99.com"][1] < 0.5 < got["hot.d98.com"][1]  # one bad page does not block, many do


def test_bad_hosts_are_blocked(spark):
    """Planted: hosts of mostly bad pages are blocked, all others allowed, labels on a quarter of the pages."""
    rng = np.random.default_rng(4)
    pages, marks = [], []
    for i in range(4000):
        host = f"s{i % 20}.site{i % 7}.net" if i % 10 else f"spam{i % 3}.farm{i % 2}.biz"
        pages.append((i, f"http://{host}/{i}"))
        if rng.random() < 0.25:
            marks.append((i, bool(rng.random() < (0.05 if i % 10 else 0.95))))
    got = urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(marks, "page_id long, bad boolean"), spark.createDataFrame([], "host string, path string, verdict string"))
    assert all((r.verdict == "block") == (r.page_id % 10 == 0) for r in got.collect())


# --- 13 hard negatives --------------------------------------------------------------------------------------
def brute_negatives(rows, positives=5, count=10):
    held = set()
    for i, e, label in rows:
        if i is not None and label is not None and e and all(x is not None and math.isfinite(x) for x in e):
            held.add((i, tuple(math.floor(256 * float(x)) for x in e), label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, a, label in held:
        if i % 10:
            continue
        others = [(-dot(a, b), j, m) for j, b, m in held if len(b) == len(a)]
        near = sorted((s, j) for s, j, m in others if m == label and j != i)[:positives]
        far = sorted((s, j) for s, j, m in others if m != label)
        for s, j in near:
            hits = [(n, t) for t, n in far if 30 * -s <= 100 * -t <= 90 * -s][:count]
            out += [(i, j, r, n, -s, -t) for r, (n, t) in enumerate(hits, 1)]
    return sorted(out)


def vectors_with_ties(seed, count, dims):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dims))
    rows = [(i, (centres[i % 4] * rng.uniform(0.1, 2) + rng.normal(size=dims) * 0.4).round(2).tolist(), int(rng.integers(0, 3))) for i in range(count)]
    same = rows[7][1]
    return rows + [(count + i, same, i % 3) for i in range(count // 3)]  # a third of all rows are one vector


@pytest.mark.parametrize("bucket,anchors", [(1024, 2048), (8, 4)])
def test_hard_negatives(spark, monkeypatch, bucket, anchors):
    monkeypatch.setattr(negatives, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", anchors)
    rows = vectors_with_ties(5, 240, 6)
    rows += [(1000 + i, v, 1) for i, v in enumerate([None, [], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [0.0] * 6, [1e9] * 6, [-1.0] * 6])]
    rows += [(1010, rows[0][1], None), (None, rows[0][1], 1), (20, rows[20][1], rows[20][2]), (30, rows[31][1], 2)]
    rows += [(2000 + 10 * i, [float(i), 1.0, -0.5], i % 2) for i in range(8)]
    frame = spark.createDataFrame([(i, e, label, 1, "k") for i, e, label in rows], "vec_id long, embedding array<double>, label int, rank int, key string").repartition(3)
    got = sorted(tuple(r) for r in negatives.mine_negatives(frame, F.col("vec_id") % 10 == 0).collect())
    assert got == brute_negatives([r for r in rows if r[0] != 1006])
    assert negatives.mine_negatives(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_buckets_are_passed_over():
    """Buckets whose Cauchy-Schwarz bound is under all limits are not multiplied."""
    rng = np.random.default_rng(6)
    x = rng.integers(-50, 50, size=(3, 8))

    class Counted(np.ndarray):
        pass

    def lane():
        for top in (4000.0, 400.0, 10.0):
            c = rng.normal(size=(40, 8))
            c = np.rint(c / np.linalg.norm(c, axis=1)[:, None] * top)
            seen.append(top)
            yield float(np.linalg.norm(c, axis=1).max()), np.arange(40), np.ones(40, dtype=np.int64), c

    seen = []
    low = np.full((3, 1), 10_000, dtype=np.int64)
    owner, score, ident = negatives.best_in_windows(np.arange(3), np.zeros(3, dtype=np.int64), x, low, np.full((3, 1), 2**40), lane(), 5, False)
    assert len(owner) and (score >= 10_000).all() and seen == [4000.0, 400.0, 10.0]
    assert np.bincount(owner).max() <= 5


def test_windows_without_room(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [0.5, 0.0], 1), (3, [0.0, 1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert negatives.mine_negatives(frame, F.col("vec_id") == 0).count() == 0  # a negative positive score leaves no window
    got = negatives.mine_negatives(frame.unionByName(spark.createDataFrame([(4, [0.0, 0.5], 0)], frame.schema)), F.col("vec_id") == 0).collect()
    assert [(r.positive_id, r.negative_id, r.negative_score) for r in got] == [(4, 3, 0)]


def test_query_rules_are_the_contracts(spark, tmp_path):
    """The registered query's rules: allow org/, block example.org/es/, block example.org/en/1, allow com/fr/, block com/de/."""
    from lexmill.llm import registry

    assert registry.URL_RULES == [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    urls_ = ["http://a.org/x", "http://example.org/es/1", "http://w.example.org/en/17", "http://b.com/fr/", "http://b.com/de/2", "http://example.org/en/2"]
    spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.page_id: (r.rule, r.verdict) for r in registry.op12_host_reputation(spark, str(tmp_path)).collect()}
    assert got == {0: ("org/", "allow"), 1: ("example.org/es/", "block"), 2: ("example.org/en/1", "block"), 3: ("com/fr/", "allow"), 4: ("com/de/", "block"), 5: ("org/", "allow")}
