"""Dates as they are printed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def parse_printed(text: Column) -> Column:
    """A date printed as d-m-yyyy; null if there is no such day."""
    return F.try_to_date(text, "d-M-yyyy")


def decade_label(day: Column) -> Column:
    return F.concat((F.floor(F.year(day) / 10) * 10).cast("string"), F.lit("s"))


def date_spine(spark: SparkSession, first: Column, last: Column) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(first, last)).alias("day"))


def interval_gap(day: Column, start: Column, end: Column) -> Column:
    """Days between a day and an interval, 0 inside; an open end goes on."""
    return F.when(day < start, F.datediff(start, day)).when(end.isNotNull() & (day > end), F.datediff(day, end)).when(start.isNotNull(), 0)


def covers(day: Column, start: Column, end: Column, open_days: int = 31) -> Column:
    """Whether the interval holds the day; one without an end holds open_days from its start."""
    return (day >= start) & (day <= F.coalesce(end, F.date_add(start, open_days)))


def add_months_exact(day: Column, months: Column) -> Column:
    """The same day some months on; null where that month has no such day."""
    moved = F.add_months(day, months)
    return F.when(F.dayofmonth(moved) == F.dayofmonth(day), moved)


def duration_end(start: Column, number: Column, unit: Column) -> Column:
    """The last day of 'n days/weeks/months/years' from start on."""
    months = F.when(unit == "year", number * 12).otherwise(number)
    return F.when(unit == "day", F.date_add(start, number - 1)).when(unit == "week", F.date_add(start, 7 * number - 1)).when(unit.isin("month", "year"), F.date_sub(add_months_exact(start, months.cast("int")), 1))


def nearest_year(rows: DataFrame, by: list[str], day: str, printed_day: str, printed_month: str) -> DataFrame:
    """rows with `nearest`: the printed day and month in the year that brings it nearest to `day`.

    The year before, the same and the next are tried; a date that doesn't exist is none, and
    two years equally near give null. `by` identifies a row.
    """
    tried = rows.withColumn("_y", F.explode(F.array(*(F.year(day) + k for k in (-1, 0, 1)))))
    tried = tried.withColumn("_d", F.try_to_date(F.concat_ws("-", F.col("_y"), F.col(printed_month), F.col(printed_day)), "y-M-d"))
    tried = tried.withColumn("_gap", F.abs(F.datediff("_d", day)))
    least = F.min("_gap").over(W.partitionBy(*by))
    best = tried.withColumn("_least", least)
    found = best.groupBy(*rows.columns).agg(F.count(F.when(F.col("_gap") == F.col("_least"), 1)).alias("_n"), F.min(F.when(F.col("_gap") == F.col("_least"), F.col("_d"))).alias("_d"))
    return found.select(*rows.columns, F.when(F.col("_n") == 1, F.col("_d")).alias("nearest"))


# From a year on, the most days between a first reading and the publication; before all of them, EARLIEST_DAYS.
PUBLICATION_ERAS, EARLIEST_DAYS = [(2011, 4), (1990, 9), (1967, 18)], 35
# Month and day of the next year up to which a number's year may still be published.
PUBLICATION_GRACE = (1, 31)


def publication_days(published: Column, eras: list[tuple[int, int]] = PUBLICATION_ERAS, earliest: int = EARLIEST_DAYS) -> Column:
    """The most days between a bill's first reading and its publication, by the era of the publication."""
    out = F.lit(earliest)
    for year, days in sorted(eras):
        out = F.when(F.year(published) >= year, days).otherwise(out)
    return out


def is_misprinted(number: Column, published: Column, grace: tuple[int, int] = PUBLICATION_GRACE) -> Column:
    """Whether a publication date can't be that of a bill numbered n/yyyy: before its year, or after the next year's grace."""
    year = F.element_at(F.split(number, "/"), -1).try_cast("int")
    return (F.year(published) < year) | (published > F.make_date(year + 1, F.lit(grace[0]), F.lit(grace[1])))


def coalesce_map(value: Column, key: Column, mapping: dict) -> Column:
    """value, or what the mapping has for key."""
    pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(value, F.try_element_at(pairs, key))
