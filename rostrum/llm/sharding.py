"""Shards of near equal bytes by sampled splitters.

Records are ordered by (hash of the text, hash of the id, id), so equal texts lie side by side.
A size-weighted sample of keys gives quantile boundaries; records are range-partitioned by
them, and a range that holds too much (many copies of one text) is subdivided by id. Prefix
sums over ranges, cells and the rows of a cell place each record at its exact byte position,
and the position gives the shard. Only DataFrame functions are used.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Scratch, documents, numbered, text_of


def draw_splitters(rows: DataFrame, total: int, ranges: int, per_range: int) -> list[int]:
    """At most ranges - 1 increasing boundaries of `place`, the quantiles of a size-weighted sample.

    A row is drawn with probability size * draws / total, by a hash of its id; the sample that
    reaches the driver has about ranges * per_range keys at any input size.
    """
    draws = ranges * per_range
    share = F.col("size") * F.lit(draws / total)
    chance = F.shiftrightunsigned(F.xxhash64(F.lit("draw"), "doc_id", "nth"), 11) / F.lit(float(1 << 53))
    drawn = sorted((r.place, max(1.0, r.share)) for r in rows.where(chance < share).select("place", share.alias("share")).collect())
    if not drawn:
        return []
    sums = list(accumulate(w for _, w in drawn))
    return sorted({drawn[min(len(drawn) - 1, bisect_left(sums, sums[-1] * k / ranges))][0] for k in range(1, ranges)})


def range_of(place: Column, bounds: list[int]) -> Column:
    """How many bounds are at most place, by binary search in the plan."""
    if not bounds:
        return F.lit(0)
    padded = 1 << (len(bounds)).bit_length()
    table = F.lit(bounds)
    steps = F.lit([padded >> k for k in range(1, padded.bit_length())])

    def step(at: Column, width: Column) -> Column:
        return F.when((at + width <= len(bounds)) & (F.get(table, at + width - 1) <= place), at + width).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def shard_by_bytes(docs: DataFrame, shards: int = 8, ranges: int = 512, per_range: int = 16, cell_rows: int = 1 << 20, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row for each row of docs.

    size is the text's UTF-8 bytes plus 1 (null: 1). Shards differ by no more than about one
    record's size from an equal share; slots run from 0 without gaps in each. Equal texts stay
    together except where a boundary or an overfull range parts them. Each row of docs is a
    record, also with a null or repeated id: equal rows are numbered, so many of them are
    subdivided like other rows, and reruns agree however the rows are dealt. Texts of any length
    are one record. Other columns of docs are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    text = text_of()
    rows = numbered(docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("place")), scratch, "records")
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    total = total or 1
    bounds = draw_splitters(rows, total, ranges, per_range)
    rows = rows.withColumn("range", range_of(F.col("place"), bounds))

    # Overfull ranges: over twice the mean, or more rows than one task should sort.
    parts = F.greatest(F.ceil(F.sum("size") * ranges / F.lit(2.0 * total)), F.ceil(F.count("*") / F.lit(cell_rows))).cast("int")
    per = F.broadcast(rows.groupBy("range").agg(parts.alias("parts")))  # a row for each range at most
    rows = rows.join(per, "range").withColumn("cell", F.pmod(F.xxhash64("doc_id", "nth"), F.col("parts").cast("long")).cast("int"))
    rows = rows.select("doc_id", "size", "text_crc32", "place", "nth", "range", "cell")

    cells = rows.groupBy("range", "cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    of_range = cells.groupBy("range").agg(F.sum("bytes").alias("range_bytes"), F.sum("n").alias("range_n"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # at most `ranges` rows
    of_range = of_range.select("range", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("range_bytes", "range_n")))
    inside = W.partitionBy("range").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.join(F.broadcast(of_range), "range").select("range", "cell", *((F.col(f"range_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"{c}_before") for c in ("bytes", "n")))

    order = W.partitionBy("range", "cell").orderBy("place", F.xxhash64("doc_id"), "doc_id", "size", "text_crc32", "nth")
    end = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0))
    placed = rows.select("*", end.alias("end"), F.row_number().over(order).cast("long").alias("rank")).join(cells, ["range", "cell"])
    shard = F.least(F.lit(shards - 1), F.expr(f"(2 * (bytes_before + end) - size) * {shards} div {2 * total}").cast("int"))
    placed = scratch.save(placed.select("doc_id", "size", "text_crc32", shard.alias("shard"), (F.col("n_before") + F.col("rank") - 1).alias("rank")), "placed")

    first = placed.groupBy("shard").agg(F.count("*").alias("n"))
    first = first.select("shard", F.coalesce(F.sum("n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("first"))  # a row for each shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def op8_shard_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(documents(spark, sf_dir))


QUERIES, ORACLE = {"op8_shard_splitters": op8_shard_splitters}, {}
