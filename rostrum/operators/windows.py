"""Ordered operators: numbering, islands, sessions, carried values, repairs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def number(rows: DataFrame, by: list[str], order: list[Column], name: str = "ordinal") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)))


def keep_first(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    return number(rows, by, order, "_n").where("_n = 1").drop("_n")


def prefer_present(rows: DataFrame, by: list[str], flag: str, order: str) -> DataFrame:
    """One row a key: its first, replaced by its first present one if that is absent; the place of the first is kept."""
    present = F.coalesce(F.col(flag), F.lit(False))
    best = F.max_by(F.struct(*rows.columns), F.struct(present, -F.col(order)))
    found = rows.groupBy(*by).agg(best.alias("_r"), F.min(order).alias("_first"))
    return found.select(*(F.col("_first").alias(c) if c == order else F.col(f"_r.{c}").alias(c) for c in rows.columns))


def with_next(rows: DataFrame, by: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    w = W.partitionBy(*by).orderBy(*order)
    return rows.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns})


def islands(rows: DataFrame, by: list[str], place: str, columns: dict[str, Column]) -> DataFrame:
    """Runs of consecutive places (integers) in each group, with `columns` aggregated over a run."""
    distinct = F.col(place) - F.row_number().over(W.partitionBy(*by).orderBy(place))
    return rows.withColumn("_run", distinct).groupBy(*by, "_run").agg(*(c.alias(n) for n, c in columns.items())).drop("_run")


def day_places(days: DataFrame, day: str) -> DataFrame:
    """(day, place): the rank of a day among all days. There is one row a day, some thousand in all."""
    return days.select(day).distinct().withColumn("place", F.row_number().over(W.orderBy(day)))


def office_ranges(attendance: DataFrame, days: DataFrame, who: str = "speaker", day: str = "day", office: str = "office") -> DataFrame:
    """(who, office, first_day, last_day, sittings): consecutive sittings with one printed office.

    Places are counted over all sitting days, so a sitting in between without the office ends a
    range, and so does another office. Rows without a speaker are dropped.
    """
    places = F.broadcast(day_places(days, day))  # one row a sitting day
    rows = attendance.where(F.col(who).isNotNull()).select(who, day, office).distinct().join(places, day)
    return islands(rows, [who, office], "place", {"first_day": F.min(day), "last_day": F.max(day), "sittings": F.count("*")})


def extend_ranges(stored: DataFrame, new: DataFrame, days: DataFrame, who: str = "speaker", office: str = "office") -> DataFrame:
    """Plans the writing of new ranges: (…, action, extends_first): EXTEND the latest stored one or INSERT.

    Only a speaker's first new range may extend, and only if the sitting before it is the stored
    range's last day and the office is the same.
    """
    places = day_places(days, "day").withColumn("before", F.lag("day").over(W.orderBy("day")))
    latest = stored.groupBy(who).agg(F.max_by(F.struct(F.col(office).alias("o"), F.col("first_day").alias("f"), F.col("last_day").alias("l")), F.struct("last_day", office)).alias("_s"))
    first = F.row_number().over(W.partitionBy(who).orderBy("first_day", office)) == 1
    joined = new.withColumn("_first", first).join(F.broadcast(places.select(F.col("day").alias("first_day"), "before")), "first_day", "left").join(latest, who, "left")
    extends = F.coalesce(F.col("_first") & (F.col("_s.o") == F.col(office)) & (F.col("_s.l") == F.col("before")), F.lit(False))
    return joined.select(*new.columns, F.when(extends, "EXTEND").otherwise("INSERT").alias("action"), F.when(extends, F.col("_s.f")).alias("extends_first"))


def gap_sessions(rows: DataFrame, by: list[str], day: str, most_days: int, tie: list[str]) -> DataFrame:
    """rows with session 1, 2, ...: a new one after a gap of more than most_days."""
    w = W.partitionBy(*by).orderBy(day, *tie)
    new = F.coalesce(F.datediff(F.col(day), F.lag(day).over(w)) > most_days, F.lit(True))
    return rows.withColumn("_new", new.cast("int")).withColumn("session", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def bill_sessions(rows: DataFrame, most_days: int = 366) -> DataFrame:
    """rows (key, day, id, is_first_reading, is_passing) with session numbers in each key.

    A new session starts when the open one has passed or the row is a first reading, on a later
    day than the last row, or after a gap of more than most_days. A later day either finds the
    session passed, and begins one, or not passed: in both cases only that day's own rows tell
    whether it has passed at the next one. So it has passed if a row of the last day passes.
    """
    w = W.partitionBy("key").orderBy(F.col("day").asc_nulls_last(), F.col("id").asc_nulls_last())
    before = w.rowsBetween(W.unboundedPreceding, -1)
    seen = rows.drop("session").withColumns({"_last": F.lag("day").over(w), "_passed": F.max(F.when(F.col("is_passing"), F.col("day"))).over(before), "_n": F.row_number().over(w)})
    passed = F.coalesce(F.col("_passed") == F.col("_last"), F.lit(False))
    later = (F.col("day") > F.col("_last")) & (passed | F.coalesce("is_first_reading", F.lit(False)))
    new = (F.col("_n") == 1) | F.coalesce(later, F.lit(False)) | F.coalesce(F.datediff("day", "_last") > most_days, F.lit(False))
    session = F.sum(new.cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)).cast("int")
    return seen.withColumn("session", session).drop("_last", "_passed", "_n")


def place_reports(reports: DataFrame, stored: DataFrame, most_days: int = 366) -> DataFrame:
    """(key, id, bill_id, new_bill, reason): reports of one load among the bills that are stored, in date order.

    reports: key, id, day, has_bill_word, is_first_reading, is_passing; stored: key, bill_id,
    first_id, first_day, last_day, is_passed. A key goes on with its stored bill of the latest
    date, or begins new bills (new_bill 1, 2, ...) by the rule of `bill_sessions`. Left out, with
    the reason: a title without the word, a key whose latest date two stored bills share, a day
    before the open bill's last one, and a report on a stored bill's first day whose id sorts
    below the one that the bill is known by. As the open bill depends on what was placed before,
    a key's few rows are walked.
    """

    def walk(key: tuple, rows: pd.DataFrame, bills: pd.DataFrame) -> pd.DataFrame:
        latest = bills[bills["last_day"] == bills["last_day"].max()] if len(bills) else bills
        bill, number, first_id, first, last, passed = None, 0, None, None, None, False
        if len(latest) == 1:
            seed = latest.iloc[0]
            bill, first_id, first, last, passed = int(seed["bill_id"]), int(seed["first_id"]), seed["first_day"], seed["last_day"], bool(seed["is_passed"])
        out = []
        for row in rows.sort_values(["day", "id"]).itertuples():
            reason = None
            is_new = last is None or ((passed or row.is_first_reading) and row.day > last) or (row.day - last).days > most_days
            if not row.has_bill_word:
                reason = "NO_BILL_WORD"
            elif len(latest) > 1:
                reason = "TWO_BILLS_SHARE_LATEST_DATE"
            elif last is not None and row.day < last:
                reason = "DATED_BEFORE_OPEN_BILL"
            elif is_new:
                bill, number, first_id, first, passed = None, number + 1, None, row.day, False
            elif bill is not None and row.day == first and row.id < first_id:
                reason = "SORTS_BELOW_STORED_KEY"
            if reason is None:
                last, passed = row.day, passed or bool(row.is_passing)
            placed = reason is None
            out.append((key[0], row.id, bill if placed else None, number if placed and bill is None else None, reason))
        found = pd.DataFrame(out, columns=["key", "id", "bill_id", "new_bill", "reason"])
        return found.astype({"bill_id": "Int64", "new_bill": "Int32"})

    kind = reports.schema["key"].dataType.simpleString()
    return reports.groupBy("key").cogroup(stored.groupBy("key")).applyInPandas(walk, f"key {kind}, id long, bill_id long, new_bill int, reason string")


def forward_fill(rows: DataFrame, by: list[str], order: list[Column], column: str, name: str) -> DataFrame:
    """The last value so far."""
    return rows.withColumn(name, F.last(column, ignorenulls=True).over(W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))


def backfill(rows: DataFrame, by: list[str], order: list[Column], column: str, name: str) -> DataFrame:
    """The next value from here on."""
    return rows.withColumn(name, F.first(column, ignorenulls=True).over(W.partitionBy(*by).orderBy(*order).rowsBetween(0, W.unboundedFollowing)))


def fill_until_reset(rows: DataFrame, by: list[str], order: list[Column], column: str, reset: Column, name: str) -> DataFrame:
    """The last value so far, none from a reset row on until the next value."""
    mark = F.when(reset | F.col(column).isNotNull(), F.struct(F.when(~reset, F.col(column)).alias("v")))
    return rows.withColumn(name, F.last(mark, ignorenulls=True).over(W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))["v"])


def run_lengths(rows: DataFrame, by: list[str], order: list[Column], column: str) -> DataFrame:
    """rows with run 1, 2, ...: neighbours of equal value share one."""
    w = W.partitionBy(*by).orderBy(*order)
    same = F.coalesce(F.col(column).eqNullSafe(F.lag(column).over(w)) & (F.row_number().over(w) > 1), F.lit(False))
    return rows.withColumn("_new", (~same).cast("int")).withColumn("run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def sequence_repair(rows: DataFrame, by: list[str], order: list[Column], column: str) -> DataFrame:
    """rows with suggested: previous + 1 where previous and next are two apart and the value isn't between them."""
    w = W.partitionBy(*by).orderBy(*order)
    before, after = F.lag(column).over(w), F.lead(column).over(w)
    return rows.withColumn("suggested", F.when((before + 2 == after) & (F.col(column) != before + 1), before + 1))


def monotone(rows: DataFrame, by: list[str], order: list[Column], column: str, most_step: int = 50) -> DataFrame:
    """(by, low, high, is_broken): broken by a step back or one of more than most_step."""
    step = F.col(column) - F.lag(column).over(W.partitionBy(*by).orderBy(*order))
    stepped = rows.withColumn("_step", step)
    return stepped.groupBy(*by).agg(F.min(column).alias("low"), F.max(column).alias("high"), F.coalesce(F.bool_or((F.col("_step") < 0) | (F.col("_step") > most_step)), F.lit(False)).alias("is_broken"))


def bounded_merge(rows: DataFrame, by: list[str], order: str, is_list: Column, is_total: Column, most_rows: int = 5) -> DataFrame:
    """(by, order, total_order): each list row with the next total if it comes within most_rows, before another list."""
    events = rows.where(is_list | is_total).withColumns({"_list": is_list, "_total": is_total})
    w = W.partitionBy(*by).orderBy(order)
    nxt = events.withColumns({"_next": F.lead(order).over(w), "_is": F.lead("_total").over(w)})
    merged = F.when(F.col("_is") & (F.col("_next") - F.col(order) <= most_rows), F.col("_next"))
    return nxt.where("_list").select(*by, order, merged.alias("total_order"))


def bracket_bounds(rows: DataFrame, by: list[str], order: list[Column], column: str) -> DataFrame:
    """rows with the nearest known value before and after."""
    w = W.partitionBy(*by).orderBy(*order)
    return rows.withColumns({"bound_before": F.last(column, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1)), "bound_after": F.first(column, ignorenulls=True).over(w.rowsBetween(1, W.unboundedFollowing))})
