"""One query per operator over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from pipecast.llm.alignment import align_tokenizers
from pipecast.llm.chat import format_chats
from pipecast.llm.exact_dedup import exact_duplicates
from pipecast.llm.fingerprints import document_fingerprints
from pipecast.llm.language_id import fit_centroids, identify, training_rows
from pipecast.llm.lattice import lattice_scores
from pipecast.llm.mixing import mix
from pipecast.llm.ngram_join import ngram_jaccard_join
from pipecast.llm.pieces import round_trip
from pipecast.llm.quality import fit_quality, quality
from pipecast.llm.store import read
from pipecast.llm.substrings import deduplicate_substrings
from pipecast.llm.toxicity import fit_toxicity, toxicity
from pipecast.llm.vocabulary import load_vocabulary
from pipecast.llm.whitening import fit_whitening, whiten

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(read(spark, sf_dir, "documents"), width=4, percent=85)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).drop("copies", "source")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read(spark, sf_dir, "documents"), load_vocabulary())


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(read(spark, sf_dir, "documents"))


def op5_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_scores(read(spark, sf_dir, "documents"), load_vocabulary())


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity(docs, fit_toxicity(docs, read(spark, sf_dir, "labels")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return identify(docs, fit_centroids(training_rows(docs)))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate_substrings(read(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(read(spark, sf_dir, "conversations"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality(docs, fit_quality(docs, read(spark, sf_dir, "labels")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return whiten(vectors, fit_whitening(vectors))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(read(spark, sf_dir, "documents"))


# Links from the shared shingles of every pair that shares one, components from all that links reach.
OP1_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), spots AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p, greatest(len(w) - 3, 1) AS starts FROM words
), runs AS (
  SELECT doc_id, p, starts, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS shingle
  FROM spots
), shingles AS (
  SELECT DISTINCT doc_id, shingle FROM runs WHERE p <= starts
), sets AS (
  SELECT doc_id, count(*) AS n, list(shingle ORDER BY shingle) AS shingles FROM shingles GROUP BY doc_id
), classes AS (
  SELECT doc_id, n, min(doc_id) OVER (PARTITION BY shingles) AS class_id FROM sets
), links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
  ) JOIN sets s ON s.doc_id = a JOIN sets t ON t.doc_id = b
  WHERE 100 * shared >= 85 * (s.n + t.n - shared)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other
), components AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
), degrees AS (
  SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(class_id, doc_id) AS class_id, component_id, coalesce(n_links, 0) AS n_links
FROM components LEFT JOIN classes USING (doc_id) LEFT JOIN degrees USING (doc_id)
"""

# Every window is compared as text.
OP8_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), spots AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p, len(w) - 34 AS starts FROM words
), runs AS (
  SELECT *, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) AS passage
  FROM spots
), marked AS (
  SELECT doc_id, word, p, p <= starts AND count(*) FILTER (WHERE p <= starts) OVER (PARTITION BY passage) > 1 AS recurs FROM runs
), covered AS (
  SELECT doc_id, word, p, bool_or(recurs) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM marked
), kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
         string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS rest
  FROM covered GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""

OP10_SQL = r"""
WITH turns AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
), whole AS (
  SELECT conv_id, count(*) AS n_turns, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, text) AS turns,
         string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10)
                    || replace(coalesce(text, ''), '<|im_', '<| im_') || '<|im_end|>' || chr(10),
                    '' ORDER BY turn NULLS FIRST, role, text) AS chat
  FROM turns GROUP BY conv_id
), firsts AS (
  SELECT turns, min(conv_id) AS conv_id FROM whole GROUP BY turns
), continued AS (
  SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM whole)
)
SELECT w.conv_id, n_turns, f.conv_id IS NOT NULL AS kept, CASE WHEN f.conv_id IS NOT NULL THEN chat END AS chat
FROM whole w LEFT JOIN (
  SELECT conv_id FROM firsts WHERE NOT EXISTS (SELECT 1 FROM continued c WHERE c.turns = firsts.turns)
) f ON f.conv_id = w.conv_id
"""

OP9_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content
  FROM documents
), classes AS (
  SELECT content, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY content
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256
FROM texts JOIN classes USING (content)
"""


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
        "op2_source_mix": op2_source_mix,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_fingerprints": op4_fingerprints,
        "op5_lattice_lm": op5_lattice_lm,
        "op6_toxicity": op6_toxicity,
        "op7_language_id": op7_language_id,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_chat_format": op10_chat_format,
        "op11_quality": op11_quality,
        "op12_whitening": op12_whitening,
        "op13_token_alignment": op13_token_alignment,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_jaccard_join": OP1_SQL,
        "op8_substring_dedup": OP8_SQL,
        "op9_exact_dedup": OP9_SQL,
        "op10_chat_format": OP10_SQL,
    }
