"""Operators on small rows, and cases their SQL doesn't reach."""

import datetime
import difflib
import json
import random

import pytest
from pyspark.sql import functions as F

from rostrum.functions import dates as D
from rostrum.functions import names as N
from rostrum.operators import aggregates as A
from rostrum.operators import citations as C
from rostrum.operators import documents as X
from rostrum.operators import graph as G
from rostrum.operators import joins as J
from rostrum.operators import matching as M
from rostrum.operators import resolve as R
from rostrum.operators import sampling as P2
from rostrum.operators import sets as S
from rostrum.operators import windows as W
from rostrum.plans import refresh as P
from rostrum.sources import tables as T


def day(text):
    return datetime.date.fromisoformat(text)


def values(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def one(spark, value, *columns):
    row = spark.createDataFrame([(value,)], "x string").select(*columns).first()
    return row[0] if len(columns) == 1 else tuple(row)


def test_names(spark):
    x = F.col("x")
    assert one(spark, "A. B. C. Mohd. Ali", N.normalize_name(x)) == "A.B.C. Mohd Ali"
    assert one(spark, "J.B.  Jeya", N.period_normalize(x)) == "j b jeya"
    assert one(spark, "The Honourable Dr Mr Tan", N.strip_title(x)) == "Tan"
    assert one(spark, "Tan, Ah Kow, Dr", N.invert_name(x)) == "Ah Kow Tan"
    assert one(spark, "Tan Ah Kow", N.invert_name(x)) is None
    assert one(spark, "A B C Mohamad-Ali", N.spelling_normalize(x)) == "ABC Mohamed Ali"
    assert one(spark, "3/85", N.bill_number(x)) == "3/1985"
    assert one(spark, "03/2001", N.bill_number(x)) == "3/2001"
    assert one(spark, "3-2001", N.bill_number(x)) is None
    for title, want in {
        "Title (with (inner) part)": ("Title", "with (inner) part"), "A (b) (c (d (e)))": ("A (b)", "c (d (e))"), "(all of it)": ("(all of it)", None), "Open (a (b)": ("Open (a", "b"), "Closed a)": ("Closed a)", None),
        "No brackets": ("No brackets", None), "Not (last) one": ("Not (last) one", None), "Empty ()": ("Empty", None), "": ("", None),
    }.items():
        assert one(spark, title, *N.split_subtitle(x)) == want
    for printed, want in {"a/b": ["a", "b"], "a (b/c (d/e)) / f": ["a (b/c (d/e))", "f"], "//": [], "a (b / c": ["a (b / c"], "a) / b": ["a)", "b"], "": []}.items():
        assert one(spark, printed, N.slash_parts(x)) == want
    for label, want in {
        "The Minister for Health (Mr A)": "The Minister for Health", "Mr A (Minister (Health) for X)": "Minister (Health) for X", "Dr B (East (Central)) (Parliamentary Secretary)": "Parliamentary Secretary",
        "Ms C (Leader of the House) (North (1))": "Leader of the House", "Mr D (Place)": None, "Mr Speaker": "Mr Speaker", "Mr E (Minister (open)": None,
    }.items():
        assert one(spark, label, X.label_office(x)) == want
    assert one(spark, "The Acting Prime Minister", N.office_class(x)) == "PRIME_MINISTER"
    assert one(spark, "Ang Mo Kio  - GRC", N.fold_place(x)) == "ang mo kio"
    assert one(spark, None, N.title_key(x)) is None


def test_dates(spark):
    df = spark.createDataFrame([(day("2020-01-31"),)], "d date")
    assert df.select(D.duration_end(F.col("d"), F.lit(1), F.lit("month"))).first()[0] is None
    assert df.select(D.duration_end(F.col("d"), F.lit(2), F.lit("week"))).first()[0] == day("2020-02-13")
    assert one(spark, "30-2-2013", D.parse_printed(F.col("x"))) is None
    rows = spark.createDataFrame([(1, day("2020-01-03"), "30", "12"), (2, day("2021-07-01"), "29", "2")], "id int, d date, pd string, pm string")
    assert values(D.nearest_year(rows, ["id"], "d", "pd", "pm").select("id", "nearest"), "id") == [(1, day("2019-12-30")), (2, day("2020-02-29"))]


def test_unique_and_positional(spark):
    right = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("b", 3), ("c", None)], "k string, v int")
    left = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    assert values(J.unique_match_join(left, right, ["k"], "v"), F.col("k").asc_nulls_last()) == [("a", None), ("b", 3), ("c", None), (None, None)]
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1)], "g string, a int")
    b = spark.createDataFrame([("x", 10), ("x", 20), ("y", 1), ("y", 2)], "g string, b int")
    got = J.positional_join(a, b, ["g"], ["a"], ["b"]).select("g", "a", "b", "status")
    assert values(got, "g", "a") == [("x", 1, 10, "PAIRED"), ("x", 2, 20, "PAIRED"), ("y", 1, None, "UNEQUAL_NUMBER")]


def test_party_on_day(spark):
    rows = spark.createDataFrame([(1, "p", day("2020-03-10"), "B"), (2, "q", day("2020-03-10"), "B"), (3, "r", day("2020-03-10"), "B")], "id int, who string, day date, ballot string")
    spans = spark.createDataFrame([("p", day("2020-01-01"), "DAY", False, "X"), ("p", day("2020-05-01"), "DAY", True, "Y"), ("q", day("2020-04-01"), "DAY", False, "Z")], "who string, started_on date, precision string, is_upper_bound boolean, party string")
    got = J.party_on_day(rows, spans, ["id"], "who", "day", "ballot").select("id", "party", "is_uncertain")
    assert values(got, "id") == [(1, "X", True), (2, "B", True), (3, "B", False)]


def test_office_ranges_split_at_gap_and_change(spark):
    days = spark.createDataFrame([(day(f"2020-01-0{k}"),) for k in range(1, 7)], "day date")
    held = spark.createDataFrame([(1, day(f"2020-01-0{k}"), o) for k, o in ((1, "A"), (2, "A"), (3, "B"), (5, "A"), (6, "A"))] + [(None, day("2020-01-01"), "A")], "speaker int, day date, office string")
    got = W.office_ranges(held, days).select("office", "first_day", "last_day", "sittings")
    assert values(got, "first_day") == [("A", day("2020-01-01"), day("2020-01-02"), 2), ("B", day("2020-01-03"), day("2020-01-03"), 1), ("A", day("2020-01-05"), day("2020-01-06"), 2)]


def test_people_refuse_shared_slots(spark):
    speakers = spark.createDataFrame([(1, "Ann Lee", "ann lee", "p1"), (2, "Ann Lee", "ann lee", "p2"), (3, "ANN LEE", "ann lee", "p2"), (4, "Bo", "bo", "p1")], "speaker_id long, name string, name_key string, slot string")
    got = {r.speaker_id: (r.person, r.conflict) for r in G.cluster_people(speakers, spark.createDataFrame([], "a long, b long, kind string")).collect()}
    assert got == {1: (1, True), 2: (1, True), 3: (3, True), 4: (4, False)}
    merged = G.cluster_people(speakers, spark.createDataFrame([(1, 4, "DISTINCT"), (1, 3, "MERGE")], "a long, b long, kind string"))
    assert {r.speaker_id: r.person for r in merged.collect()} == {1: 1, 3: 1, 2: 2, 4: 4}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in G.connected_components(edges).collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, 101: 100}


def test_resolution_tiers(spark):
    people = spark.createDataFrame([(1, "Tan Ah Kow", 10), (1, "Lim Bo Seng", 11), (1, "Ali bin Abu", 12), (1, "Lee A", 13), (1, "Lee B", 14)], "parliament int, name string, person int")
    labels = spark.createDataFrame([(1, x) for x in ("Mr Tan Ah Kow", "Ah Kow Tan", "Lim Bo", "Ali Abu", "Lee", "Kow", "Nobody")], "parliament int, label string")
    got = {r.label: (r.person, r.tier) for r in R.resolve_tiered(labels, R.lookups(people, ["parliament"]), ["parliament"], "label").collect()}
    assert got["Mr Tan Ah Kow"] == (10, "direct")
    assert got["Ah Kow Tan"] == (10, "word_set")
    assert got["Lim Bo"][0] == 11
    assert got["Ali Abu"] == (12, "bin_free")
    assert got["Kow"] == (10, "surname")
    assert "Lee" not in got and "Nobody" not in got


def test_links_and_citations(spark):
    cited = spark.createDataFrame([(1, "Water Bill", day("2020-01-01")), (2, "water bill", day("2020-01-01")), (3, "Fire Bill", day("2020-01-01")), (4, "Fire Bill", day("1999-01-01"))], "source int, title string, day date")
    reports = spark.createDataFrame([(10, "Water Bill", day("2020-01-01")), (11, "Fire Bill", day("2020-01-01")), (12, "Fire Bill", day("2020-01-01"))], "report_id int, title string, day date")
    got = C.link_citations(cited, reports).select("source", "target", "rule", "reason")
    assert values(got, "source") == [(1, 10, "EXACT", "LINKED"), (2, 10, "KEY", "LINKED"), (3, None, "EXACT", "SEVERAL"), (4, None, None, "NO_SITTING")]
    acts = spark.createDataFrame([(1, "waterbill", day("2020-01-02"), None, None)], "act_id int, key string, first_day date, second_day date, third_day date")
    bills = spark.createDataFrame([(7, "waterbill", day("2020-01-01")), (8, "waterbill", day("2019-01-01"))], "bill_id int, key string, day date")
    assert values(C.act_links(acts, bills), "act_id") == [(1, 7, "FIRST")]
    rows = [
        (1, "waterbill", None, "2020-01-02", None, None), (2, "waterbill", None, None, None, "2019-03-01"),
        (3, "fireamendmentbill", None, "2020-05-01", None, "2020-06-01"), (4, "fireamendmentbill", None, "2020-05-01", None, "2020-07-01"), (5, "fireamendmentbill", None, None, None, "2020-06-02"),
        (6, "parksbill", "theparksbill", "2020-08-01", None, None), (7, "treesbill", "thetreesbill", "2020-08-01", None, None), (8, "airbill", None, "2020-09-01", None, None),
    ]
    acts = spark.createDataFrame([(*r[:3], *(d and day(d) for d in r[3:])) for r in rows], "act_id int, key string, the_key string, first_day date, second_day date, third_day date")
    readings = [(7, "waterbill", "2020-01-01"), (8, "waterbill", "2019-03-02"), (9, "firebill", "2020-05-01"), (9, "firebill", "2020-06-01"), (10, "firebill", "2020-05-02"), (11, "theparksbill", "2020-08-02"), (12, "parksbill", "2020-08-01"), (13, "treesbill", "2020-08-01"), (14, "airbill", "2020-09-05")]
    bills = spark.createDataFrame([(i, k, day(d)) for i, k, d in readings], "bill_id int, key string, day date")
    # 3 is near both readings of one bill; 4's third reading is no bill's; 6 is found with its article before the nearer bill without it.
    assert values(C.act_links(acts, bills), "act_id") == [(1, 7, "FIRST"), (2, 8, "THIRD"), (3, 9, "LOOSE"), (5, 9, "LOOSE"), (6, 11, "FIRST"), (7, 13, "FIRST")]
    headings = spark.createDataFrame([(1, "Debate", day("2020-02-02"), day("2020-02-01"))], "source int, title string, day date, cited_day date")
    parts = spark.createDataFrame([(5, "Debate", day("2020-02-01"), 1), (6, "Debate", day("2020-02-01"), 2)], "report_id int, title string, day date, part int")
    assert values(C.continuations(headings, parts), "source") == [(1, 6)]


def test_turns(spark):
    text = "INTRODUCTION OF A BILL\nMr Tan: First words.\nMore words.\n(Applause.)\nstill nobody\nMs Lee: Hello.\nQuestion put, and agreed to."
    rows = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, text string")
    got = [tuple(r)[1:] for r in X.split_turns(X.lines(rows, "id", "text"), "id").orderBy("id", "ordinal").collect()]
    assert got == [(1, None, "HEADING", "INTRODUCTION OF A BILL"), (2, "Mr Tan", "SPEECH", "First words.\nMore words."), (3, None, "CHAMBER_EVENT", "(Applause.)"), (4, None, "SPEECH", "still nobody"), (5, "Ms Lee", "SPEECH", "Hello."), (6, None, "PROCEDURAL", "Question put, and agreed to.")]


def test_html(spark):
    page = "<html><head><title>x</title><script>var a='<p>';</script></head><body><h2>Head</h2><p>One <b>two</b> &amp; three<br>four</p><ul><li>item</li></ul></body></html>"
    rows = spark.createDataFrame([(1, page), (2, None)], "id int, html string")
    assert [r.line for r in X.html_lines(rows, "id", "html").orderBy("place").collect()] == ["## Head", "One **two** & three", "four", "- item"]


def test_checks(spark):
    a = spark.createDataFrame([(1,), (1,)], "x int")
    S.check_equal(a, a)
    with pytest.raises(ValueError):
        S.check_equal(a, a.distinct())
    with pytest.raises(ValueError):
        S.check_unique(a, ["x"])


def test_checksum_ignores_order_and_partitions(spark):
    rows = spark.range(1000).selectExpr("id", "cast(id % 7 AS string) AS s")
    want = A.row_checksum(rows, ["id", "s"]).first()
    assert A.row_checksum(rows.orderBy(F.col("id").desc()).repartition(7), ["id", "s"]).first() == want


def test_sources(spark, tmp_path):
    (tmp_path / "list.json").write_text(json.dumps([{"name": "a", "n": 1}]))
    assert values(T.read_reference_list(spark, str(tmp_path / "list.json"), "name string, n int"), "name") == [("a", 1)]
    (tmp_path / "bad.json").write_text(json.dumps([{"name": "a", "n": "x"}]))
    with pytest.raises(Exception):  # noqa: B017
        T.read_reference_list(spark, str(tmp_path / "bad.json"), "name string, n int").collect()
    bodies = spark.createDataFrame([('{"htmlContent": "<p>a</p>", "extra": "1"}',), ('{"resultHTML": {"content": "<p>b</p>"}}',), ('{"errorCode": "500"}',), ("no json",)], "body string")
    assert [r["shape"] for r in T.parse_bodies(bodies).collect()] == ["OLDER", "NEWER", "ERROR", "UNREADABLE"]
    assert values(T.lost_fields(bodies.limit(3), ["htmlContent", "resultHTML", "errorCode"]), "field") == [("extra", 1)]
    files = spark.createDataFrame([(bytearray(b"%PDF-1.4"),), (bytearray(bytes.fromhex("D0CF11E0A1B11AE1")),), (bytearray(b" <HTML>"),), (bytearray(b""),), (bytearray(b"x"),)], "content binary")
    assert [r[0] for r in files.select(T.sniff_format()).collect()] == ["PDF", "WORD", "HTML", "EMPTY", "UNKNOWN"]


def test_refresh_twice_and_halt(spark, tmp_path):
    store = f"file://{tmp_path}/store"
    body = lambda who: json.dumps({"htmlContent": f"<p>{who}: Good morning.</p><p>Question put, and agreed to.</p>"})
    speakers = spark.createDataFrame([("Mr Tan", 7)], "name string, speaker_id long")
    landing = spark.createDataFrame([("r1", day("2020-01-01"), 13, body("Mr Tan")), ("r2", day("2020-01-02"), 13, json.dumps({"htmlContent": ""}))], "report_id string, sitting_day date, parliament int, body string")
    first = P.refresh(spark, landing, speakers, store, P.Gates({13}), day("2020-01-15"))
    assert (first["status"], first["reports"], first["turns"], first["held"]) == ("SUCCEEDED", 1, 2, 1)
    before = A.row_checksum(spark.read.parquet(f"{store}/turns"), ["report_id", "ordinal", "speaker", "speaker_id", "transcript"]).first()
    second = P.refresh(spark, landing, speakers, store, P.Gates({13}), day("2020-01-15"))
    assert (second["status"], second["reports"]) == ("SUCCEEDED", 0)
    bad = spark.createDataFrame([("r3", day("2020-01-03"), 13, body("Mr Nobody"))], landing.schema)
    assert P.refresh(spark, bad, speakers, store, P.Gates({13}))["status"] == "HALTED"
    late = spark.createDataFrame([("r4", day("2020-01-03"), 99, body("Mr Tan"))], landing.schema)
    assert "99" in P.refresh(spark, late, speakers, store, P.Gates({13}))["note"]
    assert A.row_checksum(spark.read.parquet(f"{store}/turns"), ["report_id", "ordinal", "speaker", "speaker_id", "transcript"]).first() == before
    ledger = spark.read.parquet(f"{store}/ledger")
    assert ledger.count() == 8 and sorted(r.status for r in P.runs(ledger).collect()) == ["HALTED", "HALTED", "SUCCEEDED", "SUCCEEDED"]
    assert not P.is_fresh(ledger).first()[0] and P.is_fresh(ledger.where(F.col("run_id").isin(first["run_id"], second["run_id"])), 2).first()[0]
    extra = spark.createDataFrame([("r5", day("2020-01-03"), 13, json.dumps({"htmlContent": "<p>Mr Tan: Yes.</p>", "newField": "x"}))], landing.schema)
    lost = P.refresh(spark, extra, speakers, store, P.Gates({13}, mapped_fields=["htmlContent", "resultHTML", "errorCode"]))
    assert lost["status"] == "HALTED" and "newField (1)" in lost["note"]
    with pytest.raises(Exception):  # noqa: B017
        P.refresh(spark, landing.drop("parliament").withColumn("report_id", F.concat(F.lit("z"), "report_id")), speakers, store)
    assert [r.status for r in P.runs(spark.read.parquet(f"{store}/ledger")).orderBy("started_at").collect()] == ["SUCCEEDED", "SUCCEEDED", "HALTED", "HALTED", "HALTED", "FAILED"]
    assert P.probe_start(day("2020-01-20"), day("2020-01-21")) == day("2020-01-07")


NAMES = [
    (10, "Ahmad bin Mohammed Rashid"), (11, "Lee Wei Ling"), (12, "Tan Ah Kow"), (13, "Siti Noor binte Yusof"), (14, "Jeyaretnam"), (15, "Goh Keng Swee"), (16, "Toh Chin"), (17, "Smith, John B"),
    (18, "Ong Eng Guan"), (19, "Ong Eng Siong"), (20, "Abdul Rahim Ishak"), (21, "Rajah, T T"), (22, "De Souza, Ann May"), (23, "Low Low Por"), (24, "Low Por"), (25, "Salim bin Mohamed Noor"),
]


def test_a_run_that_died_is_stale(spark):
    rows = [("a", 1, 1, "RUNNING"), ("a", 1, 2, "SUCCEEDED"), ("b", 3, 3, "RUNNING"), ("c", 30, 30, "RUNNING")]
    at = lambda h: datetime.datetime(2020, 1, 1, tzinfo=datetime.timezone.utc) + datetime.timedelta(hours=h)
    ledger = spark.createDataFrame([(i, at(a), at(b), s, 0, 0, "", 0) for i, a, b, s in rows], P.LEDGER)
    assert [r.run_id for r in P.stale_runs(ledger, F.lit(at(31))).collect()] == ["b"]


def test_published_versions(spark, tmp_path):
    """A pointer names the current version; whoever reads the old one still can, and old ones go."""
    path = f"file://{tmp_path}/table"
    with pytest.raises(FileNotFoundError):
        T.read_published(spark, path)
    first = T.publish(spark.range(3), path)
    old = T.read_published(spark, path)
    second = T.publish(spark.range(5), path)
    assert (old.count(), T.read_published(spark, path).count()) == (3, 5) and T.published_version(spark, path) == second != first
    third = T.publish(spark.range(7), path)
    assert T.read_published(spark, path).count() == 7
    left = {p.name for p in (tmp_path / "table").iterdir() if p.name.startswith("v")}
    assert left == {second.rsplit("/", 1)[1], third.rsplit("/", 1)[1]}


def test_every_tier_is_reached(spark):
    """Literal hits and misses of each tier, in the order in which they are tried."""
    people = spark.createDataFrame([(1, name, person) for person, name in NAMES], "p int, name string, person int")
    asked = {
        "Mr Tan Ah Kow": (12, "direct"),
        "Siti Noor Yusof": (13, "bin_free"),
        "Ahmad Bin Mohammed Rashid": (10, "direct"),
        "Kow Ah Tan": (12, "inverted"),  # the last word first
        "John B Smith": (17, "inverted"),
        "B. John Smith": (17, "word_set"),
        "Ling Lee Wei": (11, "word_set"),
        "Low Por Low": (23, "word_set"),
        "Por Low": (24, "word_set"),  # two words are not those of three
        "Por Low Low": (23, "inverted"),
        "Smith John": (17, "word_subset"),  # without the one-letter word
        "Noor Siti": (None, None),  # no other word may be missing
        "Goh Keng": (15, "prefix"),
        "Siti Noor": (13, "prefix"),
        "Ong Eng": (None, None),  # two people's
        "Toh Chin": (16, "direct"),
        "Salim bin Mohamad Noor": (25, "spelling"),
        "Ahmad bin Mohamad Rashid": (None, None),  # the stored name is spelled otherwise too
        "Abdul Tuan Haji Rahim Ishak": (20, "haji_free"),
        "Goh KengSwee": (15, "camel_case"),
        "Jeyaretnam": (14, "direct"),
        "Mr Yusof": (13, "surname"),
        "Eng": (None, None),
        "Chin, Toh": (None, None),  # what is asked is not turned around
        "T T Rajah": (21, "inverted"),
        "Mr Tan Ah Kaw": (12, "direct"),  # by its corrected name
        "The Father of the House": (15, "hand"),
        "Nobody": (None, None),
    }
    labels = spark.createDataFrame([(1, label) for label in asked], "p int, label string")
    corrections = spark.createDataFrame([("Tan Ah Kaw", "Tan Ah Kow")], "printed string, name string")
    read = spark.createDataFrame([(1, "The Father of the House", 15)], "p int, label string, person int")
    tables = R.lookups(people, ["p"]).unionByName(R.hand_list(read, ["p"], "label"))
    got = {r.label: (r.person, r.tier) for r in R.resolve_tiered(labels, tables, ["p"], "label", corrections=corrections).collect()}
    assert {label: got.get(label, (None, None)) for label in asked} == asked


def test_strict_names(spark):
    """Only agreeing hits count; subsets, prefixes and spellings are none."""
    people = spark.createDataFrame([(1, name, person) for person, name in [*NAMES, (30, "Chin Lee Toh"), (31, "Toh Lee Chin")]], "p int, name string, person int")
    asked = {
        "Tan Ah Kow": (12, "direct"),
        "Kow, Tan Ah": (12, "inverted"),
        "Siti Noor Yusof": (13, "bin_free"),
        "Ling Lee Wei": (11, "word_set"),
        "Chin Lee Toh": (None, None),  # one by its name, another turned around
        "Goh Keng": (None, None),
        "Smith John": (None, None),
        "Mr Tan Ah Kaw": (12, "hand"),
        "The Father of the House": (15, "hand"),
        "Lee Wei Ling": (None, None),  # read by hand as someone else
    }
    labels = spark.createDataFrame([(1, label) for label in asked], "p int, label string")
    corrections = spark.createDataFrame([("Tan Ah Kaw", "Tan Ah Kow")], "printed string, name string")
    read = spark.createDataFrame([(1, "The Father of the House", 15), (1, "Lee Wei Ling", 12)], "p int, label string, person int")
    tables = R.lookups(people, ["p"]).unionByName(R.hand_list(read, ["p"], "label"))
    got = {r.label: (r.person, r.tier) for r in R.resolve_strict(labels, tables, ["p"], "label", corrections=corrections).collect()}
    assert {label: got.get(label, (None, None)) for label in asked} == asked


def test_mojibake(spark):
    broken = {"CafÃ© Ã¼ber": "Café über", "â€œQuotedâ€™s": "“Quoted’s", "plain": "plain", "é alone": "é alone", "Ã": "Ã", "ÃŸÃ¤": "ßä", "â€“â€”": "–—", "": ""}
    df = spark.createDataFrame([(k, t) for k, t in enumerate(broken)] + [(99, None)], "id int, text string")
    got = {r.id: r.text for r in M.repair_mojibake(df, "text").collect()}
    assert [got[k] for k in range(len(broken))] == list(broken.values()) and got[99] is None


def test_sequence_diff_rebuilds_the_new_list(spark):
    rng = random.Random(4)
    lists = {k: ([rng.choice("abcd") for _ in range(rng.randint(0, 9))], [rng.choice("abcd") for _ in range(rng.randint(1, 9))]) for k in range(30)}
    old, new = (spark.createDataFrame([(k, n, x) for k, pair in lists.items() for n, x in enumerate(pair[side])], "k int, n int, x string") for side in (0, 1))
    ops = {}
    for r in M.sequence_diff(old, new, "k", "n", "x").collect():
        ops.setdefault(r.k, []).append(r)
    for k, (a, b) in lists.items():
        own = sorted(ops[k], key=lambda r: (r.old_from, r.new_from))
        assert [x for r in own for x in (a[r.old_from : r.old_to] if r.op == "equal" else b[r.new_from : r.new_to])] == b
        assert all(a[r.old_from : r.old_to] == b[r.new_from : r.new_to] for r in own if r.op == "equal")
        assert [(r.old_from, r.old_to) for r in own][0][0] == 0 and own[-1].old_to == len(a)
    simple = spark.createDataFrame([(1, n, x) for n, x in enumerate("abc")], "k int, n int, x string")
    changed = spark.createDataFrame([(1, n, x) for n, x in enumerate("axcd")], "k int, n int, x string")
    assert [(r.op, r.old_from, r.old_to, r.new_from, r.new_to) for r in sorted(M.sequence_diff(simple, changed, "k", "n", "x").collect(), key=lambda r: r.new_from)] == [("equal", 0, 1, 0, 1), ("replace", 1, 2, 1, 2), ("equal", 2, 3, 2, 3), ("insert", 3, 3, 3, 4)]


def test_split_bills_by_brute_force(spark):
    from rostrum.plans.matching import split_bill_merges

    folder = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{folder}/orders.parquet").selectExpr("o_orderkey AS id", "o_custkey AS who", "concat('The Customer ', o_custkey, ' Amendment Bill ', o_orderkey % 3) AS title", "to_date(o_orderdate) AS day", "o_orderstatus AS state").collect()
    pairs = [(a.id, b.id) for a in orders if a.state == "F" for b in orders if b.state == "O" and a.who == b.who and 0 < (b.day - a.day).days <= 800 and difflib.SequenceMatcher(None, a.title, b.title).ratio() >= 0.95]
    once = [(a, b) for a, b in pairs if sum(x == a for x, _ in pairs) == 1 and sum(y == b for _, y in pairs) == 1]
    assert sorted(map(tuple, split_bill_merges(spark, folder).collect())) == sorted(once)


def test_people_by_brute_force(spark):
    """Rows of a name merge in order of their ids unless they share a slot with the cluster so far."""
    rng = random.Random(6)
    rows = [(k, f"N{rng.randrange(6)}", f"s{rng.randrange(9)}") for k in range(60)]
    people = spark.createDataFrame([(k, n, n.lower(), s) for k, n, s in rows], "speaker_id long, name string, name_key string, slot string")
    got = {r.speaker_id: r.person for r in G.cluster_people(people, spark.createDataFrame([], "a long, b long, kind string")).collect()}
    for name in {n for _, n, _ in rows}:
        own = [(k, s) for k, n, s in rows if n == name]
        first, slots = own[0][0], {own[0][1]}
        for k, s in own[1:]:
            want = first if s not in slots else k
            slots |= {s}
            assert got[k] == want
        assert got[first] == first


def test_rendered_pages(spark):
    page = "<html><head><title>no</title></head><body><h2>A  title</h2><p>One <b>bold</b> and <i>thin</i> &amp; more<br>next</p><ul><li>x</li></ul><table><tr><td>1</td><td>2</td></tr></table><script>no()</script></body></html>"
    got = X.html_lines(spark.createDataFrame([(1, page), (2, None), (3, "plain")], "id long, html string"), "id", "html")
    assert values(got, "id", "place") == [(1, 0, "## A title"), (1, 1, "One **bold** and _thin_ & more"), (1, 2, "next"), (1, 3, "- x"), (1, 4, "| 1 | 2"), (3, 0, "plain")]


def test_spans_without_end_and_very_long_ones(spark):
    rows = spark.createDataFrame([(1, day("2020-05-01")), (2, day("1990-01-01")), (3, None)], "id int, day date")
    spans = spark.createDataFrame([("a", day("1980-01-01"), None), ("b", day("2020-01-01"), day("9999-12-31")), ("c", day("1989-12-31"), day("1990-01-01")), ("d", day("2020-05-02"), day("2020-05-03"))], "who string, f date, l date")
    got = J.spans_on_day(rows, spans, "day", "f", "l").select("id", "who")
    assert values(got, "id", "who") == [(1, "a"), (1, "b"), (2, "a"), (2, "c")]


def test_equal_rows_keep_their_party(spark):
    rows = spark.createDataFrame([(1, 7, day("2020-05-01"), "X")] * 2 + [(2, None, day("2020-05-01"), "Y")], "id int, who int, day date, ballot string")
    spans = spark.createDataFrame([(7, day("2020-01-01"), "DAY", False, "P")], "who int, started_on date, precision string, is_upper_bound boolean, party string")
    assert values(J.party_on_day(rows, spans, ["id"], "who", "day", "ballot").select("id", "party"), "id") == [(1, "P"), (1, "P"), (2, "Y")]


def test_procedural_grammar(spark):
    lines = {"Question put, and agreed to.": "PROCEDURAL", "Original Question again proposed.": "PROCEDURAL", "Bill accordingly read a Second time": "PROCEDURAL", "The House divided": "PROCEDURAL", "Resolved, That it be so": "PROCEDURAL", "Order for Second Reading read.": "PROCEDURAL", "I put the question to him.": "SPEECH", "(Applause.)": "CHAMBER_EVENT", "To ask the Minister whether": "DOCUMENT_TEXT", "**Housing**": "HEADING"}
    df = spark.createDataFrame([(t,) for t in lines], "t string")
    assert {r.t: r.k for r in df.select("t", X.classify_kind(F.col("t")).alias("k")).collect()} == lines


def test_labels_by_hand(spark):
    x = F.col("x")
    for raw, want in (("3. Mr Tan Ah Kow:", "Mr Tan Ah Kow"), ("Assoc Prof Lim (NS) :", "Assoc. Prof. Lim"), ("**Dr Goh** –", "Dr Goh"), ("(2) Mr X ( Y )", "Mr X (Y)"), ("Mr A (Minister for", "Mr A"), ("“Mr  B.", "Mr B"), ("Prof.Lee", "Prof. Lee")):
        assert one(spark, raw, N.clean_label(x)) == want
    assert one(spark, "a\x00b\\u0000c\\\\u0000", N.strip_nul(x)) == "abc\\\\u0000"
    assert one(spark, "x5 from=12", S.extract_or_null(x, r"from=(\d+)")) == "12" and one(spark, "none", S.extract_or_null(x, r"from=(\d+)")) is None
    assert one(spark, "The Tax (Amendment No. 2) Act, 1999 (Chapter 5A)", N.bill_title_key(x)) == "taxamendmentno2bill"
    assert one(spark, "THE MINISTER’S *Prime  Minister*", N.office_class(x)) == "MINISTER" and one(spark, "The  Prime_Minister", N.office_class(x)) == "PRIME_MINISTER"


def test_line_and_plan_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\tb"), (2, None), (3, "é")], "id long, text string")
    T.write_lines(df, f"file://{tmp_path}/j", "jsonl", 1)
    files = sorted((tmp_path / "j").glob("*.json"))
    assert sorted(json.loads(x)["id"] for f in files for x in f.read_text().splitlines()) == [1, 2, 3] and len(files) >= 3
    T.write_lines(df, f"file://{tmp_path}/t", "tsv")
    assert spark.read.option("sep", "\t").option("header", True).csv(f"file://{tmp_path}/t").count() == 3
    T.write_plan(df, f"file://{tmp_path}/plan")
    S.check_equal(df, T.read_plan(spark, f"file://{tmp_path}/plan", df))
    with pytest.raises(ValueError, match="not planned"):
        S.check_equal(df.union(df.limit(1)), T.read_plan(spark, f"file://{tmp_path}/plan", df))


def test_distinct_owner_picks(spark):
    frame = spark.createDataFrame([(o, 10 * o + k) for o in range(4) for k in range(3)], "owner int, key int")
    drawn = spark.createDataFrame([(0, 0), (0, 1), (1, 10)], "owner int, key int")
    assert values(P2.distinct_owner_picks(drawn, frame, "owner", "key"), "key") == [(0, 0), (1, 10), (2, 20)]


def test_bodies_and_scratch(spark, tmp_path):
    (tmp_path / "b1").write_text(json.dumps({"htmlContent": "x"}))
    (tmp_path / "b2").write_text("broken")
    got = T.parse_bodies(T.read_bodies(spark, f"file://{tmp_path}"))
    assert sorted((r.shape, r.content) for r in got.collect()) == [("OLDER", "x"), ("UNREADABLE", None)]
    scratch = T.Scratch(spark)
    kept = scratch.save_sorted(spark.range(10), "a-b", ["id"], 2)
    assert kept.count() == 10
    scratch.drop("a-b")
    scratch.clear()
