"""A corpus in five stages: drop toxic documents, dedup lines, keep one of each group of near
copies, mix the sources to their weights, encode.

Each stage gets what its predecessor kept. `run` writes each stage's table to the shared
folder and rereads it, so no stage repeats another's work and a lost executor costs one stage
at most; a stage's table goes once the next one is written.

Odd input: a null text is an empty one from the line stage on; empty texts stay until they are
encoded, to no ids. Rows without an id are kept by the first three stages, are one document for
each different text in the mix, and keep their null id. Rows that share an id are one document
for the lines and the mix; exact copies with other ids go, but for the smallest. Texts are never
cut. Columns besides doc_id, text, source and n_chars pass through, whatever their names. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.llm import jaccard_join, lines, mixing, pieces, toxicity
from rostrum.llm.common import Scratch, documents


def small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage in a session whose Arrow batches hold 1,000 rows, not 10,000 whole texts, in the JVM and in Python at once."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        return stage(spark, docs, sf_dir)

    return run


@small_batches
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold. Rows held out are not learned from here either.

    The score depends on the text alone: null and empty texts, repeated rows and null ids are
    scored as all others. Without labels nothing is known of toxicity and every document stays.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels, ~toxicity.held_out(F.col("doc_id"))))


@small_batches
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many others hold; n_chars follows the text.

    A null text becomes an empty one. No document goes, even if all its lines do.
    """
    kept = lines.dedup_lines(docs)
    return kept.withColumns({"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}).select(docs.columns)


@small_batches
def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group linked by five-word shingles at 0.8 or more.

    Texts without words and rows without an id link with nothing and stay.
    """
    return jaccard_join.one_of_each(docs, 5, 80)


@small_batches
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, each at most three times; a null source is one of its own."""
    return mixing.mix_documents(docs)


@small_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), a row for each document taken."""
    return pieces.piece_digest(docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", dedup_lines), ("n-gram Jaccard join", dedup_documents), ("mixing sources", mix_sources), ("SentencePiece", encode)]

#: Learned scores, set similarity over all pairs, balanced draws and merges have no SQL form here.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark), documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
    return docs
