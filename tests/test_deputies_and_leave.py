"""Deputies and days of leave, by literal values."""

import datetime

from pyspark.sql import functions as F

from rostrum.operators.deputies import resolve_deputies
from rostrum.operators.leave import leave_intervals


def day(text):
    return datetime.date.fromisoformat(text)


def test_deputies(spark):
    """Sittings with two men, with a man and a woman, with one holder and with three."""
    terms = spark.createDataFrame([(10, day("1970-01-01"), day("1979-12-31"), False), (11, day("1970-01-01"), None, False), (12, day("1980-01-01"), day("1989-12-31"), True), (13, day("1995-01-01"), None, False), (14, day("1995-01-01"), None, False)], "holder long, first_day date, last_day date, is_woman boolean")
    two, mixed, three, before = "1975-05-05", "1985-05-05", "1996-05-05", "1960-05-05"
    reports = [(1, two), (2, two), (3, "1975-06-06"), (4, "1975-07-07"), (5, mixed), (6, mixed), (7, three), (8, before), (9, "1975-08-08"), (10, "1976-01-01"), (11, "1976-01-01")]
    rows = [(100, 1, None), (101, 1, 11), (102, 2, 10), (103, 3, None), (104, 4, None), (105, 5, None), (106, 6, None), (107, 7, 13), (108, 8, 10), (109, 9, 99), (110, 10, None), (111, 11, None)]
    mentions = [
        (1, two, 10, True), (2, two, 99, True),  # 99 holds nothing
        (3, "1975-06-06", 10, True), (None, "1975-06-06", 10, False),
        (4, "1975-07-07", 10, True), (4, "1975-07-07", 11, False),
        (6, mixed, 12, False),
        (9, "1975-08-08", 11, True), (None, "1975-08-08", 10, False),
        (10, "1976-01-01", 10, True), (11, "1976-01-01", 11, True),
    ]
    got = resolve_deputies(
        spark.createDataFrame(rows, "id long, report long, named long"),
        spark.createDataFrame([(r, day(d)) for r, d in reports], "report long, day date"),
        terms,
        spark.createDataFrame([(r, day(d), h, label) for r, d, h, label in mentions], "report long, day date, holder long, is_label boolean"),
    ).collect()
    assert {r.id: (r.holder, r.rule) for r in got} == {
        100: (10, "LABELLED"),
        101: (11, "NAMED"),  # the note before the row, against the report's label
        102: (10, "NAMED"),
        103: (10, "LABELLED"),  # the sitting's text names the same one
        104: (None, "SEVERAL_NAMED"),
        105: (11, "FORM"),
        106: (None, "WOMAN_NAMED"),
        107: (None, "NO_PAIR"),
        108: (None, "NO_PAIR"),
        109: (None, "NAMED_ELSEWHERE"),
        110: (None, "NAMED_ELSEWHERE"),  # each of two reports of a day names another
        111: (None, "NAMED_ELSEWHERE"),
    }


def test_leave(spark):
    """All formats; none of their dates is lost."""
    d = lambda y, m, n: datetime.date(y, m, n)
    cases = {
        "Mr Tan, from 1 March 1999 to 9 May 1999 and on 12 June 1999": [(d(1999, 3, 1), d(1999, 5, 9)), (d(1999, 6, 12), d(1999, 6, 12))],
        "3, 4 and 7 to 9 March 1999": [(d(1999, 3, 3),) * 2, (d(1999, 3, 4),) * 2, (d(1999, 3, 7), d(1999, 3, 9))],
        "28 December to 3 January 2000": [(d(1999, 12, 28), d(2000, 1, 3))],
        "| Mr Tan | 3 Mar 1999 | 9 May 1999 |": [(d(1999, 3, 3), d(1999, 5, 9))],
        "12. Miss Goh (East): 2nd April - 5th April 1999": [(d(1999, 4, 2), d(1999, 4, 5))],
        "2 weeks from 1 March 1999": [(d(1999, 3, 1), d(1999, 3, 14))],
        "1 month from 15 January 1999": [(d(1999, 1, 15), d(1999, 2, 14))],
        "on 2 January": [(d(2000, 1, 2),) * 2],  # nearest to the day of the entry
        "from 30 November until 2 December": [(d(1999, 11, 30), d(1999, 12, 2))],
        "30 February 1999 and 1 March 1999": [(d(1999, 3, 1),) * 2],
        "until further notice": [],
        "": [],
        "5 May 1998, 6 June and 7 July 1999": [(d(1998, 5, 5),) * 2, (d(1999, 6, 6),) * 2, (d(1999, 7, 7),) * 2],
    }
    df = spark.createDataFrame([(t, d(1999, 12, 20)) for t in cases] + [(None, d(1999, 12, 20))], "t string, near date").select("t", leave_intervals(F.col("t"), F.col("near")).alias("x"))
    got = {r.t: [tuple(i) for i in r.x] for r in df.collect()}
    assert got == cases | {None: []}
