"""From raw documents to encoded training text: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read
back as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pipecast.llm import exact_dedup, language_id, mixing, ngram_join, pieces
from pipecast.llm.store import DOCUMENT_COLUMNS, keep, read
from pipecast.llm.vocabulary import load_vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is rejected; the model learns from the stage's own rows."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    return language_id.keep_identified(docs, language_id.fit_centroids(language_id.training_rows(docs)))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the smallest doc_id stays."""
    return exact_dedup.drop_duplicates(docs.select(*DOCUMENT_COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word shingles at a similarity of 0.8, the smallest doc_id stays."""
    return ngram_join.keep_one_of_each_component(docs.select(*DOCUMENT_COLUMNS), width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it; copies are repeated rows."""
    return mixing.mixed_documents(docs.select(*DOCUMENT_COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids as ``pieces``."""
    return pieces.encode_documents(docs.select(*DOCUMENT_COLUMNS), load_vocabulary())


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("source_mix", mix_sources),
    ("sentencepiece", encode),
]

# Clustering, balanced sampling and the Viterbi search have no SQL form; tests compare the stages
# with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last one's rows."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
