"""Text search: an inverted index, ranked and dated results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def build_index(docs: DataFrame, key: str, text: str, extra: list[str] | None = None) -> DataFrame:
    """(token, key, tf, n_tokens, extra): postings; write them partitioned by token hash for pruned reads."""
    counted = docs.select(key, *(extra or []), tokens(F.col(text)).alias("_t")).withColumn("n_tokens", F.size("_t"))
    return counted.select(key, "n_tokens", *(extra or []), F.explode("_t").alias("token")).groupBy("token", key, "n_tokens", *(extra or [])).agg(F.count("*").alias("tf"))


def search(index: DataFrame, key: str, words: list[str], extra: list[str] | None = None) -> DataFrame:
    """(key, extra, score): documents with all words; the score is sum(tf) * 1000 div (n_tokens + 100).

    Only the postings of the words are read.
    """
    hits = index.where(F.col("token").isin(words)).groupBy(key, "n_tokens", *(extra or [])).agg(F.sum("tf").alias("tf"), F.count("*").alias("_n")).where(F.col("_n") == len(set(words)))
    return hits.select(key, *(extra or []), F.expr("(tf * 1000) div (n_tokens + 100)").alias("score"))


def by_relevance(hits: DataFrame, key: str, n: int) -> DataFrame:
    return hits.orderBy(F.col("score").desc(), key).limit(n)


def by_date(hits: DataFrame, key: str, day: str, n: int, oldest_first: bool = True) -> DataFrame:
    """The top n go through a bounded heap a task, not a full sort."""
    return hits.orderBy(F.col(day).asc() if oldest_first else F.col(day).desc(), key).limit(n)
