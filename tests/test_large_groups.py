"""Operators on groups whose pairs are far too many to build, against what each group must give."""

import datetime
import time

from pyspark.sql import functions as F

from rostrum.operators import citations as C
from rostrum.operators import joins as J

DAY = datetime.date(1990, 1, 1)


def quick(frame, most_seconds=60):
    began = time.time()
    rows = frame.collect()
    assert time.time() - began < most_seconds
    return rows


def hot(spark, n, *columns):
    return spark.range(n).selectExpr(*columns)


def test_act_links_of_one_key(spark):
    """40,000 acts and as many bills share a key: 1.6 billion pairs for each reading."""
    acts = hot(spark, 40000, "id AS act_id", "'k' AS key", "date_add(DATE '1990-01-01', cast(id % 3 * 40 AS int)) AS first_day", "CAST(NULL AS DATE) AS second_day", "CAST(NULL AS DATE) AS third_day")
    bills = hot(spark, 40000, "id AS bill_id", "'k' AS key", "DATE '1990-01-02' AS day")
    got = quick(C.act_links(acts, bills).groupBy("bill_id", "rule").count())
    assert [tuple(r) for r in got] == [(0, "FIRST", 13334)]


def test_links_broadcast_nothing_of_small_files(spark, tmp_path):
    """200,000 rows that a file holds in some 0.1 MB: Spark takes them for small and would send them, repeated for each bucket, to every task."""
    first = "date_add(DATE '1990-01-01', cast(id % 900 AS int))"
    hot(spark, 200000, "id", "'k' AS key", f"{first} AS first_day", f"date_add({first}, 60) AS second_day", f"CASE WHEN id % 4 <> 0 THEN date_add({first}, 90) END AS third_day").coalesce(1).write.parquet(f"{tmp_path}/acts")
    acts = spark.read.parquet(f"{tmp_path}/acts").withColumnRenamed("id", "act_id")
    bills = acts.selectExpr("act_id + 1000000 AS bill_id", "key", "first_day AS day")
    links, near = C.act_links(acts, bills), J.nearest_join(acts.select("act_id", "key", "first_day"), bills, ["key"], ["act_id"], "first_day", "day", 1, ["bill_id"])
    for found in (links, near):
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        got = found.selectExpr("count(*) AS n", "count(DISTINCT act_id) AS ids", "bool_and(bill_id = 1000000 + act_id % 900) AS own").collect()
        assert [tuple(r) for r in got] == [(200000, 200000, True)]
    assert [r["rule"] for r in links.select("rule").distinct().collect()] == ["FIRST"]


def test_acts_of_one_key_and_days_share_an_answer(spark):
    """Equal acts, nulls in their days, an id of two rows and two keys of an act."""
    day = lambda n: None if n is None else DAY + datetime.timedelta(days=n)
    rows = [(1, "a", None, 0, None, None), (2, "a", None, 0, None, None), (3, "a", "thea", 0, None, None), (4, "a", None, 9, None, None), (4, "a", None, 5, None, 0), (5, "a", None, None, None, None), (6, None, "thea", None, 8, None), (7, "camendmentno1", None, 20, None, None), (7, "camendmentno1", None, 30, None, None), (8, "camendmentno1", None, 30, None, None)]
    acts = spark.createDataFrame([(*r[:3], *(day(n) for n in r[3:])) for r in rows], "act_id long, key string, the_key string, first_day date, second_day date, third_day date")
    bills = spark.createDataFrame([(k, key, day(n)) for k, key, n in [(10, "a", 1), (11, "a", 1), (12, "thea", 7), (13, "thea", 8), (14, "a", 8), (15, "camendmentno2", 20), (16, "camendmentno2", 30)]], "bill_id long, key string, day date")
    # 4's first reading in one row goes before its third in the other; 7 has two candidates among its rows.
    want = [(1, 10, "FIRST"), (2, 10, "FIRST"), (3, 10, "FIRST"), (4, 14, "FIRST"), (6, 13, "SECOND"), (8, 16, "LOOSE")]
    assert sorted(tuple(r) for r in C.act_links(acts, bills).collect()) == want


def test_loose_links_need_both_days(spark):
    day = lambda n: DAY + datetime.timedelta(days=n)
    acts = spark.createDataFrame([(1, "aamendmentno1", day(0), None, day(50)), (2, "aamendmentno1", day(0), None, None), (3, "aamendmentno1", None, None, day(51)), (4, "aamendmentno1", day(20), None, day(50))], "act_id long, key string, first_day date, second_day date, third_day date")
    bills = spark.createDataFrame([(7, "aamendmentno2", day(1)), (7, "aamendmentno2", day(49)), (8, "aamendmentno3", day(1)), (9, "aamendmentno3", day(20))], "bill_id long, key string, day date")
    assert sorted(tuple(r) for r in C.act_links(acts, bills).collect()) == [(1, 7, "LOOSE")]
    more = bills.where("bill_id <> 8")
    assert sorted(tuple(r) for r in C.act_links(acts, more).collect()) == [(1, 7, "LOOSE"), (2, 7, "LOOSE")]


def test_wordset_join_counts_without_pairs(spark, tmp_path):
    """60,000 parts and 180,000 customers of one set of words: over 3 billion pairs."""
    from rostrum.plans.registry import QUERIES

    hot(spark, 60000, "id AS p_partkey", "'small RING' AS p_name").write.parquet(str(tmp_path / "part.parquet"))
    hot(spark, 180000, "id AS c_custkey").write.parquet(str(tmp_path / "customer.parquet"))
    got = quick(QUERIES["wordset_join"](spark, str(tmp_path)).groupBy("names").count())
    assert [tuple(r) for r in got] == [(60000, 60000)]


def test_citations_of_one_title_and_day(spark):
    """60,000 citations and as many reports of a title and day: 3.6 billion pairs; a source among two reports links to the other."""
    cited = hot(spark, 60000, "id AS source", "'A b' AS title", "DATE '1990-01-01' AS day")
    reports = hot(spark, 60000, "id + 30000 AS report_id", "'A b' AS title", "DATE '1990-01-01' AS day")
    few = spark.createDataFrame([(1, "C d", DAY), (2, "C d", DAY), (1, "c-d", DAY), (2, "Cd.", DAY), (1, "X", DAY)], "source long, title string, day date")
    held = spark.createDataFrame([(1, "C d", DAY), (2, "C d", DAY), (2, "C d", DAY), (3, "Y", DAY)], "report_id long, title string, day date")
    got = quick(C.link_citations(cited.unionByName(few), reports.unionByName(held), spark.createDataFrame([("X", "Y")], "title string, corrected_title string")).groupBy("title", "source", "target", "rule", "reason").count().where("title <> 'A b' or source = 7"))
    assert sorted(tuple(r)[:5] for r in got) == [("A b", 7, None, "EXACT", "SEVERAL"), ("C d", 1, 2, "EXACT", "LINKED"), ("C d", 2, 1, "EXACT", "LINKED"), ("Cd.", 2, 1, "KEY", "LINKED"), ("X", 1, 3, "CORRECTED", "LINKED"), ("c-d", 1, 2, "KEY", "LINKED")]


def test_bill_sessions_need_no_walk(spark):
    """100,000 keys of few rows, which cost a call of Python each before; sessions equal a walk in order."""
    from rostrum.operators.windows import bill_sessions

    rows = spark.range(400000).selectExpr("id % 100000 AS key", "id", "CASE WHEN id % 97 <> 0 THEN date_add(DATE '1990-01-01', cast(xxhash64(id) % 5 * (1 + id % 3 * 90) AS int)) END AS day", "xxhash64(id, 1) % 4 = 0 AS is_first_reading", "CASE WHEN id % 31 <> 0 THEN xxhash64(id, 2) % 3 = 0 END AS is_passing")
    plan = bill_sessions(rows)
    assert "Pandas" not in plan._jdf.queryExecution().toString()
    got = {r["id"]: r["session"] for r in quick(plan)}
    last_key = None
    for r in sorted(rows.where("key % 50 = 0").collect(), key=lambda r: (r["key"], r["day"] is None, r["day"] or DAY, r["id"])):
        if r["key"] != last_key:
            session, passed, last, last_key = 1, False, r["day"], r["key"]
        elif r["day"] and (((passed or r["is_first_reading"]) and r["day"] > last) or (r["day"] - last).days > 366):
            session, passed = session + 1, False
        passed, last = passed or bool(r["is_passing"]), r["day"]
        assert got[r["id"]] == session


def test_shingle_places_shuffle_whole_numbers(spark):
    """A run costs the shuffle its hash, part and place, no text or struct; null groups and one id in two groups stay apart."""
    text = " ".join(f"w{k}" for k in range(20))
    other = " ".join(f"v{k}" for k in range(14))
    parts = spark.createDataFrame([("a", 1, text), ("b", 1, "x " + text), (None, 2, other), ("b", 3, other[:-3] + "z"), ("b", None, text + " y")], "source string, doc_id long, text string")
    found = J.unique_shingle_places(parts, "source", "doc_id", "text", 12)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted([("b", 1, 0), (None, 2, 2), ("b", 3, 2), ("b", None, 9)], key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_continuations_of_one_title_and_day(spark):
    """60,000 headings and as many reports of a title and day: 3.6 billion pairs; the last part is one report."""
    headings = hot(spark, 60000, "id AS source", "'A b' AS title", "DATE '1990-01-02' AS day", "DATE '1990-01-01' AS cited_day")
    reports = hot(spark, 60000, "id AS report_id", "'a B' AS title", "DATE '1990-01-01' AS day", "CASE WHEN id = 5 THEN 9 ELSE id % 3 END AS part")
    got = quick(C.continuations(headings, reports).groupBy("target").count())
    assert [tuple(r) for r in got] == [(5, 60000)]
    two = headings.where("source < 3").unionByName(headings.where("source = 1").selectExpr("source", "'C' AS title", "day", "cited_day")).unionByName(headings.where("source = 2").selectExpr("source", "'D' AS title", "day", "cited_day"))
    more = reports.unionByName(spark.createDataFrame([(70001, "C", DAY, 9), (70002, "D", DAY, None)], "report_id long, title string, day date, part int"))
    assert [tuple(r) for r in C.continuations(two, more).collect()] == [(0, 5)]


def test_subtitles_are_read_by_pieces(spark):
    """20,000 titles of 2,000 characters; a step a character and copies of a part at each one took minutes."""
    from rostrum.functions import names as N

    text = F.concat(F.repeat(F.lit("word "), 400), F.lit("(a (b) / c)"))
    title, subtitle = N.split_subtitle(F.col("t"))
    rows = spark.range(20000).select(F.concat(F.col("id").cast("string"), text).alias("t")).select(title.alias("title"), subtitle.alias("s"), N.slash_parts(F.concat("t", F.lit(" / ( x/y"))).alias("p"))
    got = quick(rows.groupBy("s", F.length("title").alias("n"), F.size("p").alias("parts")).count(), 40)
    assert sum(r["count"] for r in got) == 20000 and {(r["s"], r["parts"]) for r in got} == {("a (b) / c", 2)}


def test_label_offices_compute_brackets_once(spark):
    """The brackets of a label are sought once for each of its two last groups, not again wherever they are named."""
    from rostrum.operators.documents import label_office

    labels = spark.createDataFrame([("The Minister for X (Mr A)",), ("Mr A (Minister (Health) for X)",), ("Mr A (Whip) (Place)",), ("Mr A (Place)",), (None,), ("(Mr A",)], "t string")
    found = labels.select("t", label_office(F.col("t")).alias("o"))
    assert [r["o"] for r in found.collect()] == ["The Minister for X", "Minister (Health) for X", "Whip", None, None, None]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") <= 2


def test_leave_days_name_each_word_once(spark):
    """Words are classed once, before the walk, which compares numbers: no pattern and no parsed date inside it."""
    from rostrum.operators.leave import leave_intervals

    entries = spark.createDataFrame([("on 30 February and 31 March 1999",), ("28 December to 3 January 1999, and on 12 jun 1999",), ("Mr May, 2 weeks from 5 March 2000",), ("on 29 February",), ("1 | 1850 Maybe",)], "t string")
    found = entries.select("t", leave_intervals(F.col("t"), F.lit("1998-03-01").cast("date")).alias("x"))
    day = datetime.date
    want = [[(day(1999, 3, 31), day(1999, 3, 31))], [(day(1998, 12, 28), day(1999, 1, 3)), (day(1999, 6, 12), day(1999, 6, 12))], [(day(2000, 3, 5), day(2000, 3, 18))], [], []]
    assert [[tuple(x) for x in r["x"]] for r in found.collect()] == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") <= 2 and "gettimestamp" not in plan


def test_token_differences_shuffle_texts(spark):
    """What is shuffled is a text a side, by its key; tokens are never keys of a shuffle."""
    from rostrum.operators.aggregates import token_differences

    old = spark.createDataFrame([(1, "a b b"), (1, "c"), (2, None), (None, "x")], "k long, t string")
    new = spark.createDataFrame([(1, "B c d d"), (3, "e")], "k long, t string")
    found = token_differences(old, new, "k", "t")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted([(1, 2, 2), (3, 0, 1), (None, 1, 0)], key=repr)
    exchanges = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]
    assert exchanges and not any("token" in line for line in exchanges)


def test_division_pairing_holds_no_group(spark):
    """No window buffers a whole group of votes; groups that can't be paired are not numbered."""
    votes = "day date, ayes int, noes int, abstentions int, report_id long, place int, speech_number int, ordinal long"
    said = spark.createDataFrame([(DAY, 1, 1, 0, 5, 1, 1, 1), (DAY, 1, 1, 0, 6, None, 1, 2), (DAY, 2, 2, 0, 7, 1, 1, 3), (DAY, 2, 2, 1, 8, 1, 1, 4), (DAY, 3, 3, 0, 9, 1, 1, 5), (DAY, 4, 4, 0, 9, 1, 1, 6), (DAY, None, 4, 0, 9, 1, 1, 6)], votes)
    kept = spark.createDataFrame([(DAY, 1, 1, 0, 1), (DAY, 1, 1, None, 2), (DAY, 2, 2, 0, 1), (DAY, 2, 2, 0, 2), (DAY, 3, 3, 1, 1), (DAY, 4, 4, 0, 1), (DAY, 4, 4, 0, 2), (DAY, 5, 5, 0, 1), (DAY, None, 4, 0, 1)], "day date, ayes int, noes int, abstentions int, ordinal long")
    found = J.division_pairing(said, kept)
    got = sorted((r["noes"], r["ordinal"], r["status"], r["report_id"]) for r in found.where("ayes is not null").collect())
    assert got == [(1, 1, "PAIRED", 5), (1, 2, "PAIRED", 6), (2, 1, "TIED", None), (2, 2, "TIED", None), (3, 1, "ABSTENTIONS_DIFFER", None), (4, 1, "UNEQUAL_NUMBER", None), (4, 2, "UNEQUAL_NUMBER", None), (5, 1, "NO_MATCHING_DIVISION", None)]
    assert [r["status"] for r in found.where("ayes is null").collect()] == ["NO_MATCHING_DIVISION"]
    assert "unboundedfollowing" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_clean_labels_are_computed_once(spark):
    """The rewrites of a label, which were repeated wherever its clean text is named, stand once in the plan."""
    from rostrum.functions import names as N

    found = spark.createDataFrame([("12. Mr A (Place",), ("*Mr B (C)",), (None,)], "t string").select(N.clean_label(F.col("t")).alias("c"))
    assert [r["c"] for r in found.collect()] == ["Mr A", "Mr B (C)", None]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("bAssoc") == 1
