"""Sampling, scoring, gates and search over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.operators import sampling as P
from rostrum.operators import search as S
from rostrum.plans.registry import query, rows

_STRATA = "SELECT lang, count(*) AS size FROM documents GROUP BY 1"
_SEATS = f"WITH s AS ({_STRATA}), q AS (SELECT lang, size, size * 137 // sum(size) OVER () AS f, size * 137 % sum(size) OVER () AS r FROM s), k AS (SELECT *, row_number() OVER (ORDER BY r DESC, lang) AS rank, 137 - sum(f) OVER () AS missing FROM q), seats AS (SELECT lang, size, (f + (rank <= missing)::INT)::BIGINT AS seats FROM k)"


def _seats(spark: SparkSession, d: str) -> DataFrame:
    return P.largest_remainder(rows(spark, d, "documents", "lang").groupBy("lang").agg(F.count("*").alias("size")), "lang", "size", 137)


@query(f"{_SEATS} SELECT * FROM seats")
def largest_remainder(spark: SparkSession, d: str) -> DataFrame:
    return _seats(spark, d)


@query(f"{_SEATS}, n AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS n FROM documents), w AS (SELECT lang, size, seats, unnest(range(seats)) AS draw FROM seats) SELECT n.lang, doc_id, draw FROM w JOIN n ON n.lang = w.lang AND n.n = (3 + draw * 10) * size // (seats * 10)")
def systematic_sample(spark: SparkSession, d: str) -> DataFrame:
    return P.systematic_sample(rows(spark, d, "documents", "lang", "doc_id"), _seats(spark, d), "lang", [F.col("doc_id")], 3, 10)


@query(f"{_SEATS} SELECT round(max(size / seats) / min(size / seats) - 1, 6) AS spread FROM seats WHERE seats > 0")
def weight_spread(spark: SparkSession, d: str) -> DataFrame:
    return P.weight_spread(_seats(spark, d))


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id) AS r FROM documents) WHERE r <= 3")
def n_per_group(spark: SparkSession, d: str) -> DataFrame:
    return P.n_per_group(rows(spark, d, "documents", "source", "doc_id"), "source", [F.md5(F.col("doc_id").cast("string").cast("binary")), F.col("doc_id")], 3)


@query("SELECT source, doc_id, CASE WHEN r <= 2 THEN 'pilot' WHEN r <= 5 THEN 'held_out' ELSE 'regression' END AS set FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id) AS r FROM documents) WHERE r <= 6")
def split_sets(spark: SparkSession, d: str) -> DataFrame:
    return P.split_sets(rows(spark, d, "documents", "source", "doc_id"), "source", [F.md5(F.col("doc_id").cast("string").cast("binary")), F.col("doc_id")], [("pilot", 2), ("held_out", 3), ("regression", 1)])


_VERDICT = ["doc_id AS item", "CASE WHEN quality = 0 OR toxic = 1 THEN 'WRONG' ELSE 'RIGHT' END AS verdict"]
_VERDICTS = "SELECT doc_id AS item, CASE WHEN quality = 0 OR toxic = 1 THEN 'WRONG' ELSE 'RIGHT' END AS verdict FROM labels UNION ALL SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'UNCLEAR' ELSE 'RIGHT' END FROM labels WHERE doc_id % 3 = 0"


def _verdicts(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "labels", *_VERDICT).unionByName(rows(spark, d, "labels", "doc_id AS item", "CASE WHEN doc_id % 9 = 0 THEN 'UNCLEAR' ELSE 'RIGHT' END AS verdict", where="doc_id % 3 = 0"))


@query(f"WITH f AS (SELECT item, bool_or(verdict <> 'RIGHT') AS flag FROM ({_VERDICTS}) GROUP BY 1) SELECT count(*) AS planted, count(*) FILTER (flag) AS caught, round(count(*) FILTER (flag) / nullif(count(*), 0), 6) AS recall FROM (SELECT DISTINCT item_id AS item FROM benchmark) b LEFT JOIN f USING (item)")
def plant_recall(spark: SparkSession, d: str) -> DataFrame:
    return P.plant_recall(rows(spark, d, "benchmark", "item_id AS item"), _verdicts(spark, d), "item", "verdict")


@query(f"SELECT item, count(*) AS n_readers, bool_or(verdict <> 'RIGHT') AS is_flagged FROM ({_VERDICTS}) GROUP BY 1")
def reader_flags(spark: SparkSession, d: str) -> DataFrame:
    return P.reader_flags(_verdicts(spark, d), "item", "verdict")


@query("""
WITH r AS (SELECT o_custkey, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day FROM orders GROUP BY 1), k AS (SELECT c_custkey, DATE '1995-03-01' AS f, DATE '2001-06-01' AS l FROM customer WHERE c_custkey % 10 <> 0)
SELECT o_custkey, first_day, last_day, CASE WHEN f IS NULL THEN 'UNKNOWN' ELSE 'OUTSIDE' END AS flag FROM r LEFT JOIN k ON o_custkey = c_custkey WHERE f IS NULL OR first_day < f OR last_day > l
""")
def range_against_known(spark: SparkSession, d: str) -> DataFrame:
    ranges = rows(spark, d, "orders", "o_custkey", "to_date(o_orderdate) AS day").groupBy("o_custkey").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    known = rows(spark, d, "customer", "c_custkey AS o_custkey", "DATE '1995-03-01' AS known_first", "DATE '2001-06-01' AS known_last", where="c_custkey % 10 <> 0")
    return P.outside_interval(ranges, known, ["o_custkey"]).select("o_custkey", "first_day", "last_day", "flag")


@query("SELECT 'LARGE_ORDER' AS kind, o_orderkey::VARCHAR AS item FROM orders WHERE o_totalprice > 450000 UNION ALL SELECT 'POOR_CUSTOMER', c_custkey::VARCHAR FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'TOXIC', doc_id::VARCHAR FROM labels WHERE toxic = 1")
def review_union(spark: SparkSession, d: str) -> DataFrame:
    parts = [("LARGE_ORDER", rows(spark, d, "orders", "o_orderkey AS k", where="o_totalprice > 450000")), ("POOR_CUSTOMER", rows(spark, d, "customer", "c_custkey AS k", where="c_acctbal < 0")), ("TOXIC", rows(spark, d, "labels", "doc_id AS k", where="toxic = 1"))]
    return P.review_union(parts, "k")


@query("SELECT doc_id, sha256(text) AS hash, sha256(text) <> sha256(CASE WHEN doc_id % 50 = 0 THEN text || ' ' ELSE text END) AS is_changed FROM documents")
def content_change(spark: SparkSession, d: str) -> DataFrame:
    docs = rows(spark, d, "documents", "doc_id", "text", "CASE WHEN doc_id % 50 = 0 THEN concat(text, ' ') ELSE text END AS fetched")
    hashed = docs.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("hash"), F.sha2(F.col("fetched").cast("binary"), 256).alias("new"))
    return hashed.select("doc_id", "hash", (F.col("hash") != F.col("new")).alias("is_changed"))


@query("SELECT day, linked, unlinked, round(unlinked / nullif(linked + unlinked, 0), 6) AS share, coalesce(unlinked / nullif(linked + unlinked, 0) > 0.21, false) AS halts FROM (SELECT ts::DATE AS day, count(*) FILTER (event_type <> 'error') AS linked, count(*) FILTER (event_type = 'error') AS unlinked FROM events GROUP BY 1)")
def halt_gate(spark: SparkSession, d: str) -> DataFrame:
    from rostrum.plans.refresh import unlinked_share

    e = rows(spark, d, "events", "to_date(ts) AS day", "event_type <> 'error' AS is_linked")
    counts = e.groupBy("day").agg(F.count(F.when(F.col("is_linked"), 1)).alias("linked"), F.count(F.when(~F.col("is_linked"), 1)).alias("unlinked"))
    share = unlinked_share(F.col("linked"), F.col("unlinked"))
    return counts.select("day", "linked", "unlinked", F.round(share, 6).alias("share"), F.coalesce(share > 0.21, F.lit(False)).alias("halts"))


_INDEX = r"WITH t AS (SELECT conv_id, turn, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM conversations), h AS (SELECT conv_id * 1000 + turn AS id, conv_id, len(w) AS n, len(list_filter(w, lambda x: x = 'the')) AS a, len(list_filter(w, lambda x: x = 'of')) AS b FROM t), s AS (SELECT id, conv_id, (a + b) * 1000 // (n + 100) AS score FROM h WHERE a > 0 AND b > 0)"


def _hits(spark: SparkSession, d: str) -> DataFrame:
    docs = rows(spark, d, "conversations", "conv_id * 1000 + turn AS id", "conv_id", "text")
    return S.search(S.build_index(docs, "id", "text", ["conv_id"]), "id", ["the", "of"], ["conv_id"])


@query(f"{_INDEX} SELECT id, conv_id, score FROM s ORDER BY score DESC, id LIMIT 50")
def search_relevance(spark: SparkSession, d: str) -> DataFrame:
    return S.by_relevance(_hits(spark, d), "id", 50)


@query(f"{_INDEX} SELECT id, conv_id, score FROM s ORDER BY conv_id DESC, id LIMIT 50")
def search_by_date(spark: SparkSession, d: str) -> DataFrame:
    return S.by_date(_hits(spark, d), "id", "conv_id", 50, oldest_first=False)
