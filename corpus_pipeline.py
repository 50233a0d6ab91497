"""A corpus from raw documents to tokens: five operators of ``seriesloom.llm``, one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import bpe, exact, minhash, mixing, quality
from seriesloom.llm.common import kept_rows, stored, table
from seriesloom.llm.queries import WORD_BPE, vocabulary


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the classifier, fitted on labelled rows among ``docs``, scores below its threshold."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score(model, F.col("text")) >= quality.THRESHOLD)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts."""
    return kept_rows(docs, lambda rows, own: exact.exact_duplicates(rows, id_col=own))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return kept_rows(docs, lambda rows, own: minhash.near_duplicates(rows, id_col=own))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and sample documents so that the sources' words come to their targets."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digests of ids and of the text decoded from them."""
    made = bpe.round_trip(docs, vocabulary(WORD_BPE))
    digests = (F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
    return made.select("doc_id", "n_tokens", "ids", *digests)


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("mixing sources to target weights", mixed_sources),
    ("BPE encoding and decoding", tokens),
]

#: Compression, MinHash and BPE have no SQL; tests/llm compare the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
