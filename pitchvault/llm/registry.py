"""Queries over the driver's tables, one per operator, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchvault.llm import (
    decontamination, fill_in_middle, jaccard_join, language_model, packing, phrases, pii, secret_scan, suffix_dedup,
    token_counts, topk, toxicity, url_filter,
)
from pitchvault.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query(r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
    ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
    ), shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
    ), links AS (
        SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
    ), reach AS (
        SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
    )
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
    JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id""")
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents"))


@query(r"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), item_words AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ), windows AS (
        SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS s
        FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
    ), sizes AS (SELECT DISTINCT k FROM windows
    ), places AS (
        SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, sizes)
    ), found AS (
        SELECT p.doc_id, p.k, p.i, x.item_id FROM places p JOIN windows x ON p.k = x.k AND p.s = x.s
    ), hit AS (
        SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM found) GROUP BY doc_id
    ), items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
    FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer())


@query()
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


@query("""
    WITH v AS (
        SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
    ), ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""")
def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(topk.quantised(read(spark, sf_dir, "embeddings")), F.col("vec_id") % 20 == 0)


@query()
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.verdicts(read(spark, sf_dir, "pages"))


@query()
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(read(spark, sf_dir, "documents"))


@query()
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), tokenizer())


@query()
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read(spark, sf_dir, "documents"))


@query()
def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.report(read(spark, sf_dir, "documents"))


@query(r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^.,;:!?\x0A-\x0D]+')) AS piece
        FROM documents
    ), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
    ), grams AS (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g, count(*) AS f
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k)
        GROUP BY ALL
    ), sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang
    ), candidates AS (SELECT lang, k, g, string_split(g, ' ') AS w, f AS a FROM grams WHERE k > 1 AND f >= 10
    ), cuts AS (
        SELECT c.*, j, l.f AS l, r.f AS r, CAST((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
        FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
        JOIN grams l ON l.lang = c.lang AND l.g = array_to_string(c.w[1:j], ' ')
        JOIN grams r ON r.lang = c.lang AND r.g = array_to_string(c.w[j + 1:], ' ')
    ), lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1
    ), covered AS (
        SELECT DISTINCT c.lang, c.g
        FROM candidates c JOIN (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS g
                                FROM candidates WHERE k = 3) t ON t.lang = c.lang AND t.g = c.g
        WHERE 100 * t.a >= 50 * c.a
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank
        FROM lowest ANTI JOIN covered USING (lang, g)
    )
    SELECT lang, rank, g AS phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000""")
def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


@query(r"""
    WITH h AS (SELECT *, sha256('1:' || doc_id) AS d FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
    ), drawn AS (
        SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS t,
               CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2,
               CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4
        FROM h
    ), cut AS (
        SELECT *, CAST(len(t) AS BIGINT) AS n, least(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS a,
               greatest(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS b,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
                    THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM drawn
    ), parts AS (
        SELECT *, coalesce(array_to_string(t[1:a], ''), '') AS p, coalesce(array_to_string(t[a + 1:b], ''), '') AS m,
               coalesce(array_to_string(t[b + 1:], ''), '') AS s
        FROM cut
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                            ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(CASE form WHEN 'plain' THEN text ELSE p || m || s END) AS restored_sha256
    FROM parts""")
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.report(read(spark, sf_dir, "documents"))
