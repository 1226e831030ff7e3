"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import language_id

    return language_id(table(spark, sf_dir, "documents"))


def op2_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .tokenbin import tokens_to_shards

    return tokens_to_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import scan_secrets

    return scan_secrets(table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sizes

    return mix_sizes(table(spark, sf_dir, "documents"))


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .media import media_columns

    return media_columns(table(spark, sf_dir, "documents"))


def op8_embedding_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vectors import link_vectors

    return link_vectors(table(spark, sf_dir, "embeddings"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lines import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text")


def op10_lattice_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights fitted to the training words, which can also be taken whole: the model learns from them, as base_score does."""
    import public_tokenizers

    from .lattice import lm_scores

    return lm_scores(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), rounds=2, whole_words=True)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ranked import search_ranked

    return search_ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of pages are the labels of the same number: bad without quality or if toxic."""
    from .urls import judge_urls

    outcomes = table(spark, sf_dir, "labels").selectExpr("doc_id AS page_id", "quality = 0 OR toxic = 1 AS bad")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), outcomes, rules)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .negatives import mine_negatives

    vectors = table(spark, sf_dir, "embeddings").selectExpr("vec_id", "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label", "embedding")
    return mine_negatives(vectors, F.col("vec_id") % 100 == 0)


#: Fixed values of the query: host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_token_binary,
        op3_jaccard_join,
        op4_byte_bpe,
        op5_secret_scan,
        op6_source_mixing,
        op7_media_columns,
        op8_embedding_lattice,
        op9_line_dedup,
        op10_lattice_scoring,
        op11_ranked_search,
        op12_host_reputation,
        op13_hard_negatives,
    )
}
ORACLE_SQL = {
    "op3_jaccard_join": """
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS l FROM documents
        ), s AS (
            SELECT doc_id, unnest(CASE WHEN len(l) >= 5 THEN list_distinct(list_transform(range(1, len(l) - 3), lambda i: array_to_string(l[i:i + 4], ' '))) WHEN len(l) > 0 THEN [array_to_string(l, ' ')] END) AS t FROM w
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), p AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY ALL
        ), e AS (
            SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
        ), r(id, c) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.c) AS component_id FROM documents d JOIN r ON r.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n""",
    "op8_embedding_lattice": """
        WITH RECURSIVE e AS (
            SELECT x.vec_id AS a, y.vec_id AS b FROM embeddings x JOIN embeddings y ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.embedding::DOUBLE[], y.embedding::DOUBLE[]) >= 0.9
        ), r(id, c) AS (
            SELECT vec_id, vec_id FROM embeddings UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id
        )
        SELECT vec_id, (SELECT count(*) FROM e WHERE a = vec_id) AS n_links, min(c) AS component_id, vec_id = min(c) AS kept FROM embeddings JOIN r ON id = vec_id GROUP BY vec_id""",
    "op11_ranked_search": r"""
        WITH t AS (
            SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS l FROM documents
        ), s AS (
            SELECT count(*) AS nn, sum(len(l))::BIGINT AS ll FROM t WHERE len(l) > 0
        ), q AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
        ), h AS (
            SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(l) AS n, unnest(l) AS term FROM t) WHERE term IN (SELECT term FROM q) GROUP BY ALL
        ), w AS (
            SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM h, s GROUP BY term, nn
        ), r AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + ((50 * n * nn) // ll)))))::BIGINT AS score FROM h JOIN w USING (term) JOIN q USING (term), s GROUP BY item_id, rid, doc_id
        ), k AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM r WHERE score > 0
        )
        SELECT * FROM k WHERE rank <= 50""",
    "op12_host_reputation": r"""
        WITH r(rh, rp, rv) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'allow'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
        q AS (SELECT page_id, rest, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS h0 FROM u),
        p AS (SELECT page_id, translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(substr(rest, length(h0) + 1), '^[^?#]*'), '') AS path FROM q),
        m AS (SELECT doc_id, max((quality = 0 OR toxic = 1)::BIGINT) AS bad FROM labels GROUP BY doc_id),
        c AS (SELECT host, count(m.bad)::DOUBLE AS n, coalesce(sum(m.bad), 0)::DOUBLE AS k FROM p LEFT JOIN m ON m.doc_id = p.page_id GROUP BY host),
        h AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare FROM c),
        l AS (SELECT host, n, k, CASE WHEN regexp_matches(bare, '^[0-9.]+$') THEN bare ELSE array_to_string(string_split(bare, '.')[-2:], '.') END AS dom, CASE WHEN regexp_matches(bare, '^[0-9.]+$') THEN '' ELSE string_split(bare, '.')[-1] END AS suf FROM h),
        l0 AS (SELECT l.*, coalesce((SELECT least(greatest(avg(k / n), 0.01), 0.99) FROM l WHERE n > 0), 0.5) AS mean FROM l),
        l1 AS (SELECT least(greatest(coalesce(sum(power(k - n * mean, 2) / n - mean * (1 - mean)) / nullif(sum((n - 1) * mean * (1 - mean)), 0), 0), 1e-4), 0.9) AS rho FROM l0 WHERE n > 0),
        l2 AS (SELECT dom, suf, CASE WHEN n > 0 THEN n / (1 + (n - 1) * rho) ELSE 0 END AS n, CASE WHEN n > 0 THEN k / (1 + (n - 1) * rho) ELSE 0 END AS k FROM l, l1),
        t AS (SELECT (sum(k) + 1) / (sum(n) + 2) AS mean FROM l2),
        s0 AS (SELECT suf, sum(n) AS n, sum(k) AS k, any_value(mean) AS mean FROM l2, t GROUP BY suf),
        s2 AS (SELECT 1 / rho - 1 AS c FROM (SELECT least(greatest(coalesce(sum(power(k - n * mean, 2) / n - mean * (1 - mean)) / nullif(sum((n - 1) * mean * (1 - mean)), 0), 0), 1e-4), 0.9) AS rho FROM s0 WHERE n > 0)),
        s3 AS (SELECT suf, (c * mean + k) / (c + n) AS mean FROM s0, s2),
        d0 AS (SELECT dom, suf, sum(n) AS n, sum(k) AS k, any_value(s3.mean) AS mean FROM l2 JOIN s3 USING (suf) GROUP BY dom, suf),
        d2 AS (SELECT 1 / rho - 1 AS c FROM (SELECT least(greatest(coalesce(sum(power(k - n * mean, 2) / n - mean * (1 - mean)) / nullif(sum((n - 1) * mean * (1 - mean)), 0), 0), 1e-4), 0.9) AS rho FROM d0 WHERE n > 0)),
        d3 AS (SELECT dom, (c * mean + k) / (c + n) AS mean FROM d0, d2),
        h0 AS (SELECT host, l.n, l.k, d3.mean FROM l JOIN d3 USING (dom)),
        h2 AS (SELECT 1 / rho - 1 AS c FROM (SELECT least(greatest(coalesce(sum(power(k - n * mean, 2) / n - mean * (1 - mean)) / nullif(sum((n - 1) * mean * (1 - mean)), 0), 0), 1e-4), 0.9) AS rho FROM h0 WHERE n > 0)),
        h3 AS (SELECT host, (c * mean + k) / (c + n) AS share, c + n AS size FROM h0, h2),
        o AS (SELECT host, CASE WHEN share - 1.645 * sqrt(share * (1 - share) / (size + 1)) > 0.5 THEN 'block' ELSE 'allow' END AS own FROM h3),
        f AS (SELECT page_id, host, path, own, rh || rp AS rule, rv, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC NULLS LAST, rv = 'allow', rh || rp) AS i
            FROM p JOIN o USING (host) LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
        SELECT page_id, host, path, rule, coalesce(rv, own) AS verdict FROM f WHERE i = 1""",
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS i FROM s WHERE same) WHERE i <= 5
        ), n AS (
            SELECT p.a AS anchor_id, p.b AS positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS INT) AS rank, s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
            FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
        )
        SELECT * FROM n WHERE rank <= 10""",
}
