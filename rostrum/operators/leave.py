"""Days of leave as they are printed: lists and ranges whose month and year stand at their right end."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rostrum.functions.dates import duration_end
from rostrum.functions.names import _let

MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
#: Words that open a range, that part days of a list, and that change nothing; any other word ends what month and year reach to.
RANGE, APART, NEUTRAL = ["to", "until", "till", "-", "–", "—", "|"], ["and", ",", ";", "&"], ["on", "from", "of", "the", "st", "nd", "rd", "th", "inclusive"]
_DURATION = r"(\d+)\s+(day|week|month|year)s?\s+(?:with effect\s+)?from\b"


#: What words mean to the walk: months are 1 to 12; any number of one or two digits is 1000 more, a year itself, any other word 0.
_RANGE, _APART, _NEUTRAL, _NUMBER, _YEAR = 20, 21, 22, 1000, 1800
_CODES = {**{m[:k]: n for n, m in enumerate(MONTHS, 1) for k in (3, len(m))}, **dict.fromkeys(RANGE, _RANGE), **dict.fromkeys(APART, _APART), **dict.fromkeys(NEUTRAL, _NEUTRAL)}


def _code(word: Column) -> Column:
    known = F.create_map(*(F.lit(x) for pair in _CODES.items() for x in pair))
    number = F.when(word.rlike(r"^\d{1,2}$"), word.try_cast("int") + _NUMBER).when(word.rlike(r"^(?:1[89]|20)\d{2}$"), word.try_cast("int"))
    return F.coalesce(number, F.try_element_at(known, word), F.lit(0))


def _make(year: Column, month: Column, day: Column) -> Column:
    """The date, or null where there is none (30 February)."""
    zero = F.lit(0)
    return F.try_make_timestamp_ntz(year, month, day, zero, zero, zero).cast("date")


def _nearest(month: Column, day: Column, near: Column) -> Column:
    """The date of the year that brings it nearest to `near`; null if there is none, or two are as near."""
    tried = F.filter(F.transform(F.array(*(F.lit(k) for k in (-1, 0, 1))), lambda k: _make(F.year(near) + k, month, day)), lambda d: d.isNotNull())
    far = lambda d: F.abs(F.datediff(d, near))
    best = lambda days: _let(F.array_min(F.transform(days, far)), lambda gap: F.filter(days, lambda d: far(d) == gap))
    return _let(_let(tried, best), lambda days: F.when(F.size(days) == 1, F.get(days, F.lit(0))))


def leave_intervals(text: Column, near: Column) -> Column:
    """The intervals (first, last) that an entry prints, in their order, as an array of structs; empty if it prints no day.

    The entry is read from right to left: a year and a month hold for all days to the left of
    them, up to the next month, year or other word, so '3, 4 and 7 to 9 March 1999' has three
    intervals. A range's start after its end is of the year before. Days without any year are of
    the year that brings them nearest to `near`. 'n weeks from' a day, or days, months, years,
    end so much later. Days that don't exist are left out.
    """
    words = F.transform(F.regexp_extract_all(text, F.lit(r"(\d+|\p{L}+|[-–—|,;&])"), F.lit(1)), lambda t: _let(F.lower(t), _code))
    tokens = F.reverse(F.filter(words, lambda t: t != _NEUTRAL))
    # 'n weeks from': the number is no day.
    kind = "array<struct<first:date,last:date>>"
    start = F.struct(F.lit(0).alias("month"), F.lit(None).cast("int").alias("year"), F.lit(False).alias("open"), F.array().cast(kind).alias("out"))

    def step(a: Column, t: Column) -> Column:
        number, is_year, month = (t >= _NUMBER) & (t < _YEAR), t >= _YEAR, (t > 0) & (t <= 12)
        is_range, stops = t == _RANGE, t == 0
        day = F.when(number & (a["month"] > 0), F.when(a["year"].isNull(), _nearest(a["month"], t - _NUMBER, near)).otherwise(_make(a["year"], a["month"], t - _NUMBER)))

        def grown(day: Column) -> Column:
            last = F.get(a["out"], F.size(a["out"]) - 1)
            begins = F.when(day > last["last"], F.add_months(day, -12)).otherwise(day)
            closed = F.concat(F.slice(a["out"], F.lit(1), F.greatest(F.size(a["out"]) - 1, F.lit(0))), F.array(F.struct(begins.alias("first"), last["last"].alias("last"))))
            added = F.concat(a["out"], F.array(F.struct(day.alias("first"), day.alias("last"))))
            return F.when(day.isNull(), a["out"]).when(a["open"] & (F.size(a["out"]) > 0), closed).otherwise(added)

        return F.struct(
            F.when(stops, 0).when(month, t).otherwise(a["month"]).alias("month"),
            F.when(stops, F.lit(None).cast("int")).when(is_year, t).otherwise(a["year"]).alias("year"),
            F.when(is_range, F.size(a["out"]) > 0).when(number | stops | (t == _APART), False).otherwise(a["open"]).alias("open"),
            F.when(number, _let(day, grown)).otherwise(a["out"]).alias("out"),
        )

    found = F.reverse(F.aggregate(tokens, start, step, lambda a: a["out"]))
    n, unit = F.regexp_extract(text, rf"(?i){_DURATION}", 1).try_cast("int"), F.lower(F.regexp_extract(text, rf"(?i){_DURATION}", 2))
    lasting = F.transform(found, lambda x, i: F.when((i == 0) & n.isNotNull() & (x["first"] == x["last"]), F.struct(x["first"].alias("first"), duration_end(x["first"], n, unit).alias("last"))).otherwise(x))
    return F.coalesce(lasting, F.array().cast(kind))
