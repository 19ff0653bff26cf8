"""Joins that the record needs: unique, as-of, nearest, range and positional ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Days in a bucket of a range join.
BUCKET_DAYS = 32


def unique_candidates(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value) of the keys with exactly one distinct value; ambiguous keys are refused."""
    return rows.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min(value).alias(value), F.max(value).alias("_max")).where(F.col(value) == F.col("_max")).drop("_max")


def unique_match_join(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """left with right's value where its keys have just one, null elsewhere."""
    return left.join(unique_candidates(right, keys, value), keys, "left")


def rule_cascade(rules: list[tuple[str, Column, Column]]) -> tuple[Column, Column]:
    """(value, rule) of the first rule (name, condition, value) that holds."""
    value, name = F.when(rules[0][1], rules[0][2]), F.when(rules[0][1], F.lit(rules[0][0]))
    for rule, condition, result in rules[1:]:
        value, name = value.when(condition, result), name.when(condition, F.lit(rule))
    return value, name


def asof_join(left: DataFrame, right: DataFrame, by: list[str], at: str, start: str, values: list[str], tie: Column | None = None) -> DataFrame:
    """left with the values of right's latest row whose start is not after left's time, in each group.

    Both sides go through one shuffle: markers and rows are united, and the last marker is
    carried on. Rows at a marker's own time see it; of markers at one time the last in the
    order of their values (or `tie`) counts.
    """
    marker = F.struct(F.col(start).alias("start"), *(F.col(v) for v in values))
    rows = left.select(*(F.col(b) for b in by), F.col(at).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"))
    marks = right.select(*(F.col(b) for b in by), F.col(start).alias("_t"), F.lit(0).alias("_side"), marker.alias("_m"), (tie if tie is not None else F.struct(*values)).alias("_tie"))
    both = rows.unionByName(marks, allowMissingColumns=True)
    order = W.partitionBy(*by).orderBy("_t", "_side", "_tie").rowsBetween(W.unboundedPreceding, 0)
    seen = both.withColumn("_m", F.last("_m", ignorenulls=True).over(order)).where("_side = 1")
    return seen.select("_row.*", F.col("_m.start").alias(f"{start}_found" if start in left.columns else start), *(F.col(f"_m.{v}") for v in values))


#: Spans of more buckets are dealt to wide ones.
MOST_BUCKETS = 64


def spans_on_day(rows: DataFrame, spans: DataFrame, day: str, first: str, last: str, by: list[str] | None = None) -> DataFrame:
    """rows joined with the spans that hold their day.

    Spans are dealt to the buckets of days they touch, so the join is an equi-join with a
    filter, not a loop over all pairs. A span without an end goes on for ever; it and spans of
    many buckets are dealt to buckets MOST_BUCKETS times as wide, up to the rows' last one.
    """
    by = by or []
    width = {False: BUCKET_DAYS, True: BUCKET_DAYS * MOST_BUCKETS}
    bucket = lambda c, wide: F.floor(F.unix_date(c) / width[wide]).cast("long")
    is_wide = F.col(last).isNull() | (bucket(F.col(last), False) - bucket(F.col(first), False) >= MOST_BUCKETS)
    holds = (F.col(day) >= F.col(first)) & (F.col(last).isNull() | (F.col(day) <= F.col(last)))
    narrow = spans.where(~is_wide).withColumn("_bucket", F.explode(F.sequence(bucket(F.col(first), False), bucket(F.col(last), False))))
    end = F.broadcast(rows.agg(F.max(bucket(F.col(day), True)).alias("_end")))  # one row
    wide = spans.where(is_wide).join(end).where(F.col("_end") >= bucket(F.col(first), True))
    wide = wide.withColumn("_bucket", F.explode(F.sequence(bucket(F.col(first), True), F.least("_end", F.coalesce(bucket(F.col(last), True), "_end"))))).drop("_end")
    near = rows.withColumn("_bucket", bucket(F.col(day), False)).join(narrow, [*by, "_bucket"])
    far = rows.withColumn("_bucket", bucket(F.col(day), True)).join(wide, [*by, "_bucket"])
    return near.unionByName(far).where(holds).drop("_bucket")


def holder_on_day(rows: DataFrame, spans: DataFrame, key: list[str], day: str, first: str, last: str, name: str, by: list[str] | None = None) -> DataFrame:
    """rows with the one name whose span holds the day; none or several names give null."""
    found = spans_on_day(rows.select(*dict.fromkeys([*key, day, *(by or [])])), spans, day, first, last, by)
    return rows.join(unique_candidates(found, key, name), key, "left")


def nearest_join(left: DataFrame, right: DataFrame, by: list[str], key: list[str], at: str, other: str, most_days: int, tie: list[str]) -> DataFrame:
    """left with right's row of the same group whose day is nearest, within most_days; ties by order.

    Of right's rows of one group and day only the first in the order of ties can be the nearest
    one, so each left row meets at most 2 * most_days + 1 of them, however many there are. Those
    are dealt to the buckets around their day, left's rows stay as they are. Neither side is
    broadcast: Spark takes their size from the files, which may be hundreds of times smaller.
    """
    rest = [c for c in right.columns if c not in (*by, other)]
    order = [t for t in tie if t in rest] or rest
    if rest:
        right = right.groupBy(*by, other).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*by, other, "_r.*")
    bucket = lambda c: F.floor(F.unix_date(F.col(c)) / (most_days + 1)).cast("long")
    keyed = left.withColumn("_bucket", bucket(at))
    dealt = right.withColumn("_bucket", F.explode(F.array(*(bucket(other) + k for k in (-1, 0, 1)))))
    gap = F.abs(F.datediff(F.col(other), F.col(at)))
    near = keyed.join(dealt.hint("merge"), [*by, "_bucket"]).withColumn("gap", gap).where(F.col("gap") <= most_days)
    first = near.withColumn("_n", F.row_number().over(W.partitionBy(*key).orderBy("gap", *tie))).where("_n = 1")
    return first.drop("_n", "_bucket")


def mutual_unique(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Pairs in which each side has no other partner."""
    pairs = pairs.select(left, right).distinct()
    once = lambda side: pairs.groupBy(side).count().where("count = 1").select(side)
    return pairs.join(once(left), left, "left_semi").join(once(right), right, "left_semi").select(left, right)


def positional_join(left: DataFrame, right: DataFrame, by: list[str], left_order: list[Column], right_order: list[Column]) -> DataFrame:
    """The n-th rows of both sides' groups beside each other, with status PAIRED or UNEQUAL_NUMBER.

    Groups of different sizes are not paired: their left rows come alone, as do those whose
    group the right side lacks (NO_MATCH).
    """
    a = left.withColumns({"_n": F.row_number().over(W.partitionBy(*by).orderBy(*left_order)), "_size": F.count("*").over(W.partitionBy(*by))})
    b = right.withColumns({"_n": F.row_number().over(W.partitionBy(*by).orderBy(*right_order))})
    sizes = right.groupBy(*by).agg(F.count("*").alias("_other"))
    status = F.when(F.col("_other").isNull(), "NO_MATCH").when(F.col("_size") != F.col("_other"), "UNEQUAL_NUMBER").otherwise("PAIRED")
    ready = a.join(sizes, by, "left").withColumn("status", status).withColumn("_n", F.when(F.col("status") == "PAIRED", F.col("_n")))
    return ready.join(b, [*by, "_n"], "left").drop("_n", "_size", "_other")


def nth_occurrence_join(left: DataFrame, right: DataFrame, by: list[str], left_order: list[Column], right_order: list[Column]) -> DataFrame:
    """positional_join's pairs alone."""
    return positional_join(left, right, by, left_order, right_order).where("status = 'PAIRED'").drop("status")


def word_set(name: Column) -> Column:
    """A name's number of words and its distinct words, sorted, as one key; null without a name."""
    words = F.filter(F.split(F.lower(name), r"\s+"), lambda w: w != "")
    return F.when(name.isNotNull(), F.concat_ws(" ", F.size(words).cast("string"), F.array_sort(F.array_distinct(words))))


def unique_prefixes(names: DataFrame, by: list[str], name: str, value: str, least_words: int = 2) -> DataFrame:
    """(by, prefix, value): the first 2, 3, ... words of names, short of the whole name, that only one value has."""
    words = F.split(F.lower(F.col(name)), r"\s+")
    prefixes = F.transform(F.sequence(F.lit(least_words), F.greatest(F.size(words) - 1, F.lit(least_words))), lambda n: F.concat_ws(" ", F.slice(words, F.lit(1), n)))
    rows = names.where(F.size(words) > least_words).select(*by, F.explode(prefixes).alias("prefix"), value)
    return unique_candidates(rows, [*by, "prefix"], value)


#: Odd numbers whose powers weigh the words of a run: two runs agree in both hashes or differ.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _rolled(values: np.ndarray, base: int, words: int) -> np.ndarray:
    """The hash of each run of so many values: sums of values times powers of the base, from running sums modulo 2**64."""
    n = len(values)
    powers = lambda b: np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)]))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base)[:n], out=sums[1:])
    return (sums[words:] - sums[:-words]) * powers(pow(base, -1, 1 << 64))[: n - words + 1]


def _run_hashes(runs: DataFrame, group: str, part: str, words: int) -> DataFrame:
    """(group, part, runs array<struct<a, b>>) of rows (group, part, x array<long>, y array<long>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).offsets.to_numpy().astype(np.int64)
            at -= at[0]
            sizes = np.diff(at)
            starts = np.repeat(at[:-1], sizes - words + 1) + np.concatenate([np.arange(s - words + 1) for s in sizes]) if len(sizes) else np.zeros(0, np.int64)
            ab = [pa.array(_rolled(batch.column(k).flatten().to_numpy(zero_copy_only=False).view(np.uint64), base, words)[starts].view(np.int64)) for k, base in zip((2, 3), _BASES, strict=True)]
            offsets = np.concatenate([[0], np.cumsum(sizes - words + 1)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(ab, ["a", "b"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], [group, part, "runs"])

    kind = lambda c: runs.schema[c].dataType.simpleString()
    return runs.mapInArrow(run, f"`{group}` {kind(group)}, `{part}` {kind(part)}, runs array<struct<a:long,b:long>>")


def unique_shingle_places(parts: DataFrame, group: str, part: str, text: str, words: int = 12) -> DataFrame:
    """(group, part, place): for each part the first run of so many words that no other part of the table has.

    Words are hashed once, to 128 bits, and runs by rolling sums over them; counts of runs are
    combined before the shuffle.
    """
    split = F.filter(F.split(F.col(text), r"[ \t\n\r\f\x0b]+"), lambda w: w != "")
    long = parts.select(group, part, split.alias("_w")).where(F.size("_w") >= words)
    hashed = long.select(group, part, F.transform("_w", lambda w: F.xxhash64(w)).alias("x"), F.transform("_w", lambda w: F.xxhash64(F.lit(1), w)).alias("y"))
    # What is shuffled for a run is whole numbers: its hash, its part and place, and a number for the group, which is put back at the end.
    number = F.xxhash64(F.col(group)).alias("g")
    runs = _run_hashes(hashed, group, part, words).select(number, F.col(part), F.posexplode("runs").alias("place", "run")).select("run.a", "run.b", "g", F.col(part).alias("p"), "place")
    dealt = runs.repartition("a", "b")  # hardly any run repeats in one task: counting before the shuffle would only sort and spill
    once = dealt.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("g").alias("g"), F.min("p").alias("p"), F.min("place").alias("place")).where("n = 1")
    first = once.groupBy("g", "p").agg(F.min("place").alias("place"))
    named = long.select(number, F.col(part).alias("p"), F.col(group).alias("_group")).distinct()
    same = [F.col("f.g") == F.col("k.g"), F.col("f.p").eqNullSafe(F.col("k.p"))]
    return first.alias("f").join(named.alias("k"), same).select(F.col("k._group").alias(group), F.col("k.p").alias(part), "f.place")


def presence_status(asked: DataFrame, present: DataFrame, days: DataFrame, day: str, who: str, flag: str) -> DataFrame:
    """asked with status PRESENT, ABSENT, UNLISTED (the day has a list without them) or NO_LIST."""
    marks = present.groupBy(day, who).agg(F.bool_or(flag).alias("_flag"))
    lists = days.select(day).distinct().withColumn("_listed", F.lit(True))
    found = asked.join(marks, [day, who], "left").join(lists, day, "left")
    status = F.when(F.col("_flag"), "PRESENT").when(F.col("_flag").isNotNull(), "ABSENT").when(F.col("_listed"), "UNLISTED").otherwise("NO_LIST")
    return found.withColumn("status", status).drop("_flag", "_listed")


def division_pairing(proceedings: DataFrame, minutes: DataFrame) -> DataFrame:
    """Pairs recorded votes of two sources; one row for each of the minutes.

    proceedings: day, ayes, noes, abstentions, report_id, place, speech_number, ordinal;
    minutes: day, ayes, noes, abstentions, ordinal. Groups are (day, ayes, noes). The statuses
    in order of precedence: NO_MATCHING_DIVISION, TIED (two reports at one place and number),
    UNEQUAL_NUMBER, ABSTENTIONS_DIFFER (for the whole group), PAIRED by position.
    """
    by = ["day", "ayes", "noes"]
    known = proceedings.where(F.col("ayes").isNotNull() & F.col("noes").isNotNull())
    # What a group's rows have in common is aggregated; rows are numbered only where the groups may be paired.
    places = known.groupBy(*by, "place", "speech_number").agg(F.count("*").alias("n"), F.min("report_id").alias("lo"), F.max("report_id").alias("hi"))
    groups = places.groupBy(*by).agg(F.sum("n").alias("size"), F.max(F.coalesce(F.col("lo") != F.col("hi"), F.lit(False))).alias("tied"))
    own = minutes.groupBy(*by).agg(F.count("*").alias("own"))
    groups = own.join(groups, by).withColumn("status", F.when(F.col("tied"), "TIED").when(F.col("size") != F.col("own"), "UNEQUAL_NUMBER"))
    even = groups.where("status is null").select(*by)
    order = W.partitionBy(*by).orderBy(F.col("place").asc_nulls_last(), F.col("speech_number").asc_nulls_last(), "ordinal")
    left = known.join(even, by, "left_semi").select(*by, F.col("abstentions").alias("p_abstentions"), F.col("report_id"), F.col("ordinal").alias("p_ordinal"), F.row_number().over(order).alias("n"))
    right = minutes.join(even, by, "left_semi").withColumn("n", F.row_number().over(W.partitionBy(*by).orderBy("ordinal")))
    pairs = right.join(left, [*by, "n"], "left")
    differ = F.max(F.coalesce(F.col("abstentions") != F.col("p_abstentions"), F.lit(False)))
    verdict = pairs.groupBy(*by).agg(F.when(differ, "ABSTENTIONS_DIFFER").otherwise("PAIRED").alias("status"))
    paired = F.col("status") == "PAIRED"
    placed = pairs.join(verdict, by).select(*by, "ordinal", "status", F.when(paired, F.col("report_id")).alias("report_id"), F.when(paired, F.col("p_ordinal")).alias("p_ordinal"))
    uneven = minutes.join(groups.select(*by, "status"), by, "left").join(even.withColumn("_even", F.lit(True)), by, "left").where("_even is null")
    status = F.coalesce("status", F.lit("NO_MATCHING_DIVISION")).alias("status")
    return placed.unionByName(uneven.select(*by, "ordinal", status), allowMissingColumns=True)


def party_on_day(rows: DataFrame, spans: DataFrame, key: list[str], who: str, day: str, ballot: str) -> DataFrame:
    """rows with party and is_uncertain; each row stays, equal ones too. key is what the caller knows rows by.

    spans (who, started_on, precision DAY or MONTH, is_upper_bound, party). No span: the ballot
    party, certain. None started by the day: the ballot party, uncertain. Else the latest
    started span's; uncertain if a MONTH span starts in the day's month, or if the next later
    start is only an upper bound. A person has a few spans: they are one array beside each of
    the person's rows, joined once.
    """
    own = spans.where("started_on is not null").groupBy(who).agg(F.collect_list(F.struct("started_on", "precision", "is_upper_bound", "party")).alias("_s"))
    joined = rows.join(own, who, "left")
    started = F.filter("_s", lambda s: s["started_on"] <= F.col(day))
    now = F.array_max(F.transform(started, lambda s: F.struct(s["started_on"].alias("at"), s["party"].alias("party"))))
    following = F.array_min(F.transform(F.filter("_s", lambda s: s["started_on"] > F.col(day)), lambda s: F.struct(s["started_on"].alias("at"), s["is_upper_bound"].alias("bound"))))
    month = F.exists("_s", lambda s: (s["precision"] == "MONTH") & (F.trunc(s["started_on"], "MM") == F.trunc(day, "MM")))
    uncertain = F.when(F.col("_s").isNull(), False).when(now.isNull(), True).otherwise(F.coalesce(month, F.lit(False)) | F.coalesce(following["bound"], F.lit(False)))
    return joined.select(*(F.col(c) for c in rows.columns), F.when(now.isNull(), F.col(ballot)).otherwise(now["party"]).alias("party"), uncertain.alias("is_uncertain"))

