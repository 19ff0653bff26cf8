"""Aggregations of the record: seats, speakers, votes, attribution, checksums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rostrum.functions.names import countable_chars, fold_place

# Places that are no electoral division.
NO_DIVISION = ["Nominated Member", "Nominated", "Non-Constituency Member", "ex-officio", "Acting"]


def conditional_counts(rows: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One count a condition, in one pass."""
    return rows.agg(F.count("*").alias("n"), *(F.count(F.when(c, 1)).alias(name) for name, c in conditions.items()))


def decade(day: Column) -> Column:
    return (F.floor(F.year(day) / 10) * 10).cast("int")


def seat_holdings(rows: DataFrame, speaker: str, place: str, day: str) -> DataFrame:
    """(speaker, place_key, place_name, first_day, last_day, sittings).

    Places without a division are left out. The name is the one printed on the first day, the
    smallest of several.
    """
    real = rows.where(F.col(place).isNotNull() & F.col(speaker).isNotNull() & ~F.col(place).isin(NO_DIVISION))
    keyed = real.select(speaker, fold_place(F.col(place)).alias("place_key"), F.col(place).alias("_name"), F.col(day).alias("_day"))
    first = F.min(F.struct("_day", "_name"))
    return keyed.groupBy(speaker, "place_key").agg(first["_name"].alias("place_name"), first["_day"].alias("first_day"), F.max("_day").alias("last_day"), F.count_distinct("_day").alias("sittings"))


def widen_bounds(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Seat holdings of both: first days only go back, last days and counts only up; with an action."""
    both = stored.withColumn("_in", F.lit(1)).alias("s").join(new.withColumn("_in", F.lit(1)).alias("n"), keys, "full_outer")
    values = {"first_day": F.least("s.first_day", "n.first_day"), "last_day": F.greatest("s.last_day", "n.last_day"), "sittings": F.greatest("s.sittings", "n.sittings")}
    same = F.lit(True)
    for name, value in values.items():
        same = same & F.col(f"s.{name}").eqNullSafe(value)
    action = F.when(F.col("s._in").isNull(), "ADD").when(same, "KEEP").otherwise("WIDEN")
    return both.select(*keys, *(v.alias(n) for n, v in values.items()), action.alias("action"))


def first_label_and_count(rows: DataFrame, by: list[str], label: str, order: str) -> DataFrame:
    """(by, first_label, n): rows without a label count but give none; groups without any label go."""
    found = rows.groupBy(*by).agg(F.min_by(label, F.when(F.col(label).isNotNull(), F.col(order))).alias("first_label"), F.count("*").alias("n"))
    return found.where(F.col("first_label").isNotNull())


def credited_only(rows: DataFrame, by: list[str], label: str) -> DataFrame:
    """Groups none of whose rows has a label."""
    return rows.groupBy(*by).agg(F.count(label).alias("_n"), F.count("*").alias("n")).where("_n = 0").drop("_n")


def party_counts(votes: DataFrame, sources: DataFrame, division: str = "division_id") -> DataFrame:
    """(division, source, choice, party, votes, uncertain), one source a division.

    sources (division, minutes_stored, proceedings_stored): the minutes' list if it is stored,
    else that of the proceedings, else none. Only AYE, NO and ABSTAIN count; voters without a
    party are a group of their own.
    """
    chosen = sources.select(division, F.when(F.col("minutes_stored"), "MINUTES").when(F.col("proceedings_stored"), "PROCEEDINGS").alias("source")).where("source is not null")
    counted = votes.where(F.col("choice").isin("AYE", "NO", "ABSTAIN")).join(chosen, [division, "source"])
    return counted.groupBy(division, "source", "choice", "party").agg(F.count("*").alias("votes"), F.sum(F.col("is_uncertain").cast("int")).alias("uncertain"))


def speech_category(label: Column, speaker_id: Column) -> Column:
    """linked, named_unlinked, adr_excluded, no_speaker or credited."""
    excluded = label.rlike(r"(?i)hon\.? members?") | label.startswith("(") | label.startswith("_")
    return F.when(label.isNull() & speaker_id.isNull(), "no_speaker").when(label.isNull(), "credited").when(excluded, "adr_excluded").when(speaker_id.isNull(), "named_unlinked").otherwise("linked")


CATEGORIES = ["linked", "named_unlinked", "adr_excluded", "no_speaker", "credited"]


def attribution_figures(speeches: DataFrame, by: list[str], text: str, label: Column, speaker_id: Column) -> DataFrame:
    """(by, rows and characters of each category)."""
    rows = speeches.select(*by, speech_category(label, speaker_id).alias("category"), countable_chars(F.col(text)).alias("chars"))
    sums = [F.count(F.when(F.col("category") == c, 1)).alias(f"{c}_rows") for c in CATEGORIES]
    sums += [F.coalesce(F.sum(F.when(F.col("category") == c, F.col("chars"))), F.lit(0)).alias(f"{c}_chars") for c in CATEGORIES]
    return rows.groupBy(*by).agg(*sums)


def attribution_rates(figures: DataFrame, by: list[str], body_chars: Column | None = None, digits: int = 6) -> DataFrame:
    """(by, label_rate, row_rate, text_rate): null where nothing is counted.

    text_rate is over the characters of all bodies, also of those that gave no rows.
    """
    linked, credited = F.col("linked_rows"), F.col("credited_rows")
    rows = sum((F.col(f"{c}_rows") for c in CATEGORIES), F.lit(0))
    chars = body_chars if body_chars is not None else sum((F.col(f"{c}_chars") for c in CATEGORIES), F.lit(0))
    rate = lambda a, b: F.round(F.try_divide(a, b), digits)
    return figures.select(*by, rate(linked, linked + F.col("named_unlinked_rows")).alias("label_rate"), rate(linked + credited, rows).alias("row_rate"), rate(F.col("linked_chars") + F.col("credited_chars"), chars).alias("text_rate"))


def short_against_median(counts: DataFrame, by: list[str], value: str, share: float = 0.5) -> DataFrame:
    """counts below that share of their group's exact median."""
    medians = counts.groupBy(*by).agg(F.percentile(value, 0.5).alias("median"))
    return counts.join(medians, by).where(F.col(value) < F.lit(share) * F.col("median"))


def canonical_value(rows: DataFrame, by: list[str], value: str, recency: str) -> DataFrame:
    """(by, value, n): the most frequent value, then the most recent, then the longest."""
    counted = rows.groupBy(*by, value).agg(F.count("*").alias("n"), F.max(recency).alias("_last"))
    best = F.max_by(F.struct(F.col(value), "n"), F.struct("n", "_last", F.length(F.col(value).cast("string")), F.col(value))).alias("_b")
    return counted.groupBy(*by).agg(best).select(*by, F.col(f"_b.{value}"), F.col("_b.n"))


def most_common(rows: DataFrame, value: str, n: int) -> DataFrame:
    return rows.groupBy(value).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), value).limit(n)


def row_text(columns: list[str]) -> Column:
    return F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns))


def row_checksum(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(n, high, low): the count and the sums of the halves of each row's md5; no order, no sort, combined in each task."""
    digest = F.md5(row_text(columns).cast("binary"))
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(38,0)")
    return rows.agg(F.count("*").alias("n"), F.sum(half(1)).cast("string").alias("high"), F.sum(half(17)).cast("string").alias("low"))


def table_hash(rows: DataFrame, columns: list[str], key: str) -> DataFrame:
    """md5 over the rows' md5 in key order; for small tables, `row_checksum` for large ones."""
    return rows.select(F.col(key).alias("_k"), F.md5(row_text(columns).cast("binary")).alias("_h")).agg(F.count("*").alias("n"), F.expr("md5(listagg(_h, '') WITHIN GROUP (ORDER BY _k))").alias("hash"))


def frame_hash(rows: DataFrame, key: str) -> DataFrame:
    """sha256 over the keys in order, a line each."""
    return rows.agg(F.expr(f"sha2(listagg(cast({key} AS string), '\\n') WITHIN GROUP (ORDER BY {key}), 256)").alias("hash"))


def token_differences(old: DataFrame, new: DataFrame, by: str, text: str) -> DataFrame:
    """(by, lost, gained): tokens, counted with repeats, that one text has and the other lacks.

    Texts go to their key's partition as they are, once for each side, and are taken apart
    there: tokens beside their keys would be several times as large in the shuffle.
    """
    texts = old.select(by, text, F.lit(-1).alias("d")).unionByName(new.select(by, text, F.lit(1).alias("d"))).repartition(by)
    words = F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)))
    signed = texts.select(by, words.alias("token"), "d").groupBy(by, "token").agg(F.sum("d").alias("d")).where("d <> 0")
    return signed.groupBy(by).agg(F.sum(F.when(F.col("d") < 0, -F.col("d")).otherwise(0)).alias("lost"), F.sum(F.when(F.col("d") > 0, F.col("d")).otherwise(0)).alias("gained"))


def match_rate(rows: DataFrame, by: list[str], matched: Column, digits: int = 6) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.count(F.when(matched, 1)).alias("matched"), F.round(F.avg(matched.cast("double")), digits).alias("rate"))


def capped_label_list(labels: DataFrame, label: str, most: int = 20) -> DataFrame:
    """One text: the most frequent labels with their counts, and how many more there are."""
    counts = labels.groupBy(label).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.col("n").desc(), label).limit(most)
    listed = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col(label).alias("l")))).alias("a"))
    text = F.concat_ws(", ", F.transform("a", lambda x: F.concat(x["l"].cast("string"), F.lit(" ("), (-x["k"]).cast("string"), F.lit(")"))))
    more = counts.agg(F.greatest(F.count("*") - most, F.lit(0)).alias("more"))
    both = listed.select(text.alias("t"), F.lit(1).alias("_j")).join(more.withColumn("_j", F.lit(1)), "_j")
    return both.select(F.when(F.col("more") > 0, F.concat("t", F.lit(" and "), F.col("more").cast("string"), F.lit(" more"))).otherwise(F.col("t")).alias("labels"))


def above_group_min(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Rows above their group's least value."""
    return rows.withColumn("_min", F.min(value).over(W.partitionBy(*by))).where(F.col(value) > F.col("_min")).drop("_min")


def group_json(figures: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """(by, json): figures as a JSON text."""
    return figures.select(*by, F.to_json(F.struct(*columns)).alias("json"))
