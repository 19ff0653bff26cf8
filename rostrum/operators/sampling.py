"""Sampling and scoring for hand checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def largest_remainder(strata: DataFrame, group: str, size: str, seats: int) -> DataFrame:
    """(group, size, seats): exact quotas floored, what is left to the largest remainders, ties to the first listed."""
    everything = W.partitionBy(F.lit(0))  # a row for each stratum
    total = F.sum(size).over(everything)
    parts = strata.select(group, size, F.expr(f"({size} * {seats}) div 1").alias("_x"), total.alias("_t"))
    parts = parts.select(group, size, F.expr("_x div _t").alias("_floor"), F.expr("_x % _t").alias("_rest"))
    left = F.lit(seats) - F.sum("_floor").over(everything)
    rank = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.col("_rest").desc(), group))
    return parts.withColumns({"_left": left, "_rank": rank}).select(group, size, (F.col("_floor") + (F.col("_rank") <= F.col("_left")).cast("int")).alias("seats"))


def systematic_sample(rows: DataFrame, strata: DataFrame, group: str, order: list[Column], start_num: int, start_den: int) -> DataFrame:
    """rows drawn at fractional intervals: positions floor((start + i) * size / seats), i = 0, 1, ..., in each stratum.

    strata: (group, size, seats); start is start_num / start_den below 1, all in integers.
    """
    numbered = rows.withColumn("_n", F.row_number().over(W.partitionBy(group).orderBy(*order)) - 1)
    wanted = strata.where("seats > 0").select(group, F.explode(F.sequence(F.lit(0), (F.col("seats") - 1).cast("int"))).alias("draw"), "size", "seats")
    place = F.expr(f"(({start_num} + draw * {start_den}) * size) div (seats * {start_den})")
    return numbered.join(wanted.select(group, "draw", place.cast("int").alias("_n")), [group, "_n"]).drop("_n")


def weight_spread(strata: DataFrame) -> DataFrame:
    """How far apart the strata's weights size / seats are: max / min - 1."""
    weight = F.col("size") / F.col("seats")
    return strata.where("seats > 0").agg(F.round(F.max(weight) / F.min(weight) - 1, 6).alias("spread"))


def n_per_group(rows: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def split_sets(rows: DataFrame, group: str, order: list[Column], sizes: list[tuple[str, int]]) -> DataFrame:
    """Disjoint sets by rank in each group: the first rows are the first set, and so on; the rest is left out."""
    numbered = rows.withColumn("_n", F.row_number().over(W.partitionBy(group).orderBy(*order)))
    name, end = None, 0
    for label, n in sizes:
        end += n
        name = F.when(F.col("_n") <= end, label) if name is None else name.when(F.col("_n") <= end, label)
    return numbered.withColumn("set", name).where("set is not null").drop("_n")


def distinct_owner_picks(drawn: DataFrame, frame: DataFrame, owner: str, key: str) -> DataFrame:
    """drawn with at most one row an owner: later draws of an owner give way to the owners' next undrawn rows."""
    first = drawn.withColumn("_n", F.row_number().over(W.partitionBy(owner).orderBy(key))).where("_n = 1").drop("_n")
    spare = frame.join(drawn.select(owner), owner, "left_anti").withColumn("_n", F.row_number().over(W.partitionBy(owner).orderBy(key))).where("_n = 1").drop("_n")
    missing = drawn.count() - first.count()  # at most the size of a hand check
    return first.unionByName(spare.orderBy(key).limit(missing).select(first.columns))


def plant_recall(planted: DataFrame, verdicts: DataFrame, key: str, verdict: str, right: str = "RIGHT") -> DataFrame:
    """(planted, caught, recall): planted errors that a reader did not call right."""
    flags = verdicts.groupBy(key).agg(F.bool_or(F.col(verdict) != right).alias("_flag"))
    joined = planted.select(key).distinct().join(flags, key, "left")
    return joined.agg(F.count("*").alias("planted"), F.count(F.when(F.col("_flag"), 1)).alias("caught"), F.round(F.try_divide(F.count(F.when(F.col("_flag"), 1)), F.count("*")), 6).alias("recall"))


def reader_flags(verdicts: DataFrame, key: str, verdict: str, right: str = "RIGHT") -> DataFrame:
    """(key, n_readers, is_flagged): flagged if any reader didn't call it right."""
    return verdicts.groupBy(key).agg(F.count("*").alias("n_readers"), F.bool_or(F.col(verdict) != right).alias("is_flagged"))


def outside_interval(ranges: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    """Ranges that reach beyond the known dates of their key; keys without known dates are flagged too."""
    joined = ranges.join(known, key, "left")
    flag = F.when(F.col("known_first").isNull(), "UNKNOWN").when((F.col("first_day") < F.col("known_first")) | (F.col("last_day") > F.col("known_last")), "OUTSIDE")
    return joined.withColumn("flag", flag).where("flag is not null")


def review_union(parts: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """(kind, key): items of many checks in one list."""
    return reduce(DataFrame.unionByName, (df.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("item")) for kind, df in parts))
