"""Registered queries opN_<name>: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    chat,
    class_lm,
    collocations,
    decontaminate,
    embeddings,
    jaccard,
    packing,
    secret_scan,
    substrings,
    toxicity,
    whitening,
    wrappers,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

BPE_FILE = "byte_bpe_multi_50k.tiktoken"
WORD_BPE_FILE = "word_bpe_49k.json"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_chat_formatting(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast(rows.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(planted).alias("text"),
    )
    return chat.read_back(chat.prefix_target_examples(rows.unionByName(extra)))


ORACLE["op9_chat_formatting"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n,
        length(text) + len(regexp_extract_all(text, '\\|</?s>|\[/?INST\]|<</?SYS>>|\[/?ROLE\]'))
        + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 WHEN 'system' THEN 17
            ELSE 23 + length(role) + len(regexp_extract_all(role, '\\|</?s>|\[/?INST\]|<</?SYS>>|\[/?ROLE\]')) END AS chars
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), summed AS (
    SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS whole FROM sized
)
SELECT conv_id, max(n)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(whole) FILTER (role = 'assistant' OR k = n)::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id
"""


@query
def op10_bpe(spark, sf_dir):
    path = public_tokenizers.path(BPE_FILE)
    return bpe.digest(bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, decoded=True))


@query
def op4_ngram_jaccard_join(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op4_ngram_jaccard_join"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), sets AS MATERIALIZED (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
    FROM words
), rows AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c
    FROM rows a JOIN rows b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS MATERIALIZED (SELECT a, b FROM pairs WHERE 100 * c >= 75 * (na + nb - c)),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT DISTINCT a AS node, a AS other FROM ways
    UNION
    SELECT r.node, w.b FROM reach r JOIN ways w ON r.other = w.a
), least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(l.component_id, s.doc_id) AS component_id
FROM sets s LEFT JOIN least l ON l.node = s.doc_id
"""


@query
def op6_benchmark_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Best window of each item in each document, by all windows of the items' sizes.
ORACLE["op6_benchmark_decontamination"] = r"""
WITH doc AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), item AS (
    SELECT item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark
), item_row AS MATERIALIZED (
    SELECT item_id, len(w) AS words, len(w) - 4 AS n, array_to_string(w[i:i + 4], ' ') AS shingle, count(*) AS c
    FROM (SELECT *, unnest(generate_series(1, len(w) - 4)) AS i FROM item WHERE len(w) >= 5) GROUP BY ALL
), doc_row AS MATERIALIZED (
    SELECT doc_id, len(w) AS doc_words, i - 1 AS pos, array_to_string(w[i:i + 4], ' ') AS shingle
    FROM (SELECT *, unnest(generate_series(1, len(w) - 4)) AS i FROM doc WHERE len(w) >= 5)
), hit AS MATERIALIZED (
    SELECT doc_id, doc_words, pos, shingle, item_id, words, n, c FROM doc_row JOIN item_row USING (shingle)
), start AS (
    SELECT DISTINCT doc_id, item_id, words, n, unnest(generate_series(greatest(0, pos - n + 1), least(pos, doc_words - words))) AS start_word FROM hit
), part AS (
    SELECT s.doc_id, s.item_id, s.start_word, s.words, s.n, h.shingle, least(count(*), any_value(h.c)) AS shared
    FROM start s JOIN hit h ON h.doc_id = s.doc_id AND h.item_id = s.item_id AND h.pos BETWEEN s.start_word AND s.start_word + s.n - 1
    GROUP BY ALL
), ratio AS (
    SELECT doc_id, item_id, start_word, words, n, sum(shared) AS shared FROM part GROUP BY ALL
), good AS (
    SELECT *, shared / (2 * n - shared) AS similarity FROM ratio WHERE 100 * shared >= 75 * (2 * n - shared)
)
SELECT doc_id, item_id, start_word::BIGINT AS start_word, words::INTEGER AS n_words, similarity::DOUBLE AS similarity
FROM good QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY shared DESC, start_word) = 1
"""


@query
def op7_substring_dedup(spark, sf_dir):
    return substrings.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op8_embedding_near_dedup(spark, sf_dir):
    return embeddings.linked(table(spark, sf_dir, "embeddings"), 0.93)


ORACLE["op8_embedding_near_dedup"] = """
WITH RECURSIVE usable AS MATERIALIZED (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), ways AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
    SELECT DISTINCT a AS node, a AS other FROM ways
    UNION
    SELECT r.node, w.b FROM reach r JOIN ways w ON r.other = w.a
), least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a AS node, count(*) AS n FROM ways GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, coalesce(l.component_id, e.vec_id) AS component_id,
    e.vec_id = coalesce(l.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN least l ON l.node = e.vec_id LEFT JOIN counts c ON c.node = e.vec_id
"""


@query
def op2_secret_scan(spark, sf_dir):
    return secret_scan.digest(secret_scan.found_secrets(table(spark, sf_dir, "documents")))


@query
def op5_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_lm_scoring(spark, sf_dir):
    return class_lm.scores(table(spark, sf_dir, "documents"))


@query
def op1_html_extraction(spark, sf_dir):
    return wrappers.extracted(table(spark, sf_dir, "pages"))


# The SQL oracle has no eigenvectors; tests hold the query against numpy's dense solvers.
@query
def op11_embedding_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLE["op12_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), runs AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
    SELECT lang, unnest(list_transform(w, lambda x: [x]) || list_zip(w[:-2], w[2:]).list_transform(lambda z: [z[1], z[2]])
        || list_zip(w[:-3], w[2:-2], w[3:]).list_transform(lambda z: [z[1], z[2], z[3]])) AS p FROM runs
), f AS MATERIALIZED (SELECT lang, p, count(*)::HUGEINT AS a FROM grams GROUP BY ALL),
whole AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE len(p) = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, p, a FROM f WHERE len(p) >= 2 AND a >= 10),
longest AS (
    SELECT lang, p, max(a) AS longest FROM (
        SELECT lang, p[1:2] AS p, a FROM candidates WHERE len(p) = 3 UNION ALL SELECT lang, p[2:3], a FROM candidates WHERE len(p) = 3
    ) GROUP BY ALL
), cuts AS (
    SELECT c.lang, c.p, c.a, k, l.a AS l, r.a AS r, 1000000 * c.a * c.a // (l.a * r.a) AS score
    FROM (SELECT *, unnest(generate_series(1, len(p) - 1)) AS k FROM candidates) c
    JOIN f l ON l.lang = c.lang AND l.p = c.p[1:k] JOIN f r ON r.lang = c.lang AND r.p = c.p[k + 1:len(c.p)]
), least AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), ranked AS (
    SELECT c.lang, array_to_string(c.p, ' ') AS phrase, c.a, c.l, c.r, c.score,
        row_number() OVER (PARTITION BY c.lang ORDER BY c.score DESC, c.a DESC, array_to_string(c.p, ' ')) AS rank
    FROM least c LEFT JOIN longest m ON m.lang = c.lang AND m.p = c.p WHERE m.longest IS NULL OR 100 * m.longest < 50 * c.a
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM ranked JOIN whole USING (lang) WHERE rank <= 2000
"""


# Token ids are beyond SQL; tests hold the query against the tokenizer library and the bound of full sequences.
@query
def op13_best_fit_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE_FILE))
