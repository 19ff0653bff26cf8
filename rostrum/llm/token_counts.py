"""Exact histogram of encoded lengths, and what it answers for every context limit."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Scratch, arrow_map, documents

#: A tokenizer file: a path, or a name that the installed package of public tokenizers resolves.
TOKENIZER = "byte_bpe_multi_50k.tiktoken"


@lru_cache(4)
def _encoding(name: str):  # noqa: ANN202
    import public_tokenizers
    import tiktoken

    with open(name if "/" in name else public_tokenizers.path(name), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded_lengths(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens) of every whole text, one row for each row of docs.

    A null or empty text has no tokens. Repeated rows and null ids keep rows of their own; texts
    of any length are encoded whole, one at a time; other columns are ignored; an empty table
    gives no rows.
    """

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encode = _encoding(tokenizer).encode_ordinary
        lengths = [len(encode(text)) if text else 0 for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], ["doc_id", "n_tokens"])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), each, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame, block: int = 64, scratch: Scratch | None = None) -> DataFrame:
    """One row for each length that occurs, with the answers for a context limit of that length.

    n_tokens, docs (of just that length), tokens (in them); docs_from and tokens_from (suffix
    sums over lengths at least this); truncated_total (tokens left when every document is cut
    to n_tokens); quantile (share of documents of at most this length). The documents are
    aggregated to lengths first, once, into a written table; suffix sums run in blocks of
    lengths, then over the blocks. Every row counts, also repeated ones and those with a null
    id; rows with a null n_tokens don't. An empty table gives no rows.
    """
    scratch = scratch or Scratch(lengths.sparkSession)
    hist = scratch.save(lengths.where("n_tokens is not null").groupBy("n_tokens").agg(F.count("*").alias("docs")), "lengths")
    hist = hist.select("n_tokens", "docs", (F.col("n_tokens") * F.col("docs")).alias("tokens"), F.expr(f"n_tokens div {block}").alias("block"))
    later = W.orderBy(F.col("block").desc()).rowsBetween(W.unboundedPreceding, -1)  # a row for each block of lengths
    blocks = hist.groupBy("block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    blocks = blocks.select("block", *(F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_later") for c in "dt"), F.sum("d").over(W.partitionBy(F.lit(0))).alias("all_docs"), F.sum("t").over(W.partitionBy(F.lit(0))).alias("all_tokens"))
    inside = W.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(W.unboundedPreceding, 0)
    summed = hist.join(blocks, "block").withColumns({"docs_from": F.sum("docs").over(inside) + F.col("d_later"), "tokens_from": F.sum("tokens").over(inside) + F.col("t_later")})
    return summed.select(
        "n_tokens", "docs", "tokens", "docs_from", "tokens_from",
        (F.col("all_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("truncated_total"),
        ((F.col("all_docs") - F.col("docs_from") + F.col("docs")) / F.col("all_docs")).alias("quantile"),
    )


def answers(hist: DataFrame, limits: list[int]) -> DataFrame:
    """(context, docs_cut, truncated_total) for any limits, from the histogram alone."""
    spark = hist.sparkSession
    asked = F.broadcast(spark.createDataFrame([(int(x),) for x in limits], "context long"))
    # The limits are a short list of the caller; each needs one pass of conditional sums.
    return hist.crossJoin(asked).groupBy("context").agg(
        F.sum(F.when(F.col("n_tokens") > F.col("context"), F.col("docs")).otherwise(0)).alias("docs_cut"),
        F.sum(F.least("n_tokens", "context") * F.col("docs")).alias("truncated_total"),
    )


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the smallest length that this share of the documents does not exceed."""
    return hist.agg(*(F.min(F.when(F.col("quantile") >= q, F.col("n_tokens"))).alias(str(k)) for k, q in enumerate(shares))).select(
        F.explode(F.array(*(F.struct(F.lit(q).alias("share"), F.col(f"`{k}`").alias("n_tokens")) for k, q in enumerate(shares)))).alias("a")
    ).select("a.*")


def op9_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(encoded_lengths(documents(spark, sf_dir)))


QUERIES, ORACLE = {"op9_length_histogram": op9_length_histogram}, {}
