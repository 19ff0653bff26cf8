"""Printed lists of votes, by literal names."""

import pytest

from rostrum.operators import divisions as D

TWO = """
      AYES                 NOES

  1. Mr Tan Ah Kow.     Dr Lim Bo Seng
  2. Mr Abdul Rahim     Mr Goh
       bin Ishak        Mr Low Por
                          (Somewhere)
  3. Mdm Wee,
"""
THREE = """AYES
Mr A One           Mr B Two           Mr C Three
Mr D Four          Mr E Five          Mr F Six

                             NOES
Mr G Seven         Mr H Eight
                     bin Nine

ABSTENTIONS                           ABSENT
Mr I Ten                              Mr J Eleven
"""
LISTS = {
    1: (TWO, (3, 3, None, None, None), "ACCEPTED"),
    2: (TWO, (3, 2, None, None, None), "COUNTS_DISAGREE"),
    3: (TWO, (3, 3, 1, None, None), "COUNTS_DISAGREE"),
    4: (THREE, (6, 2, 1, None, None), "ACCEPTED"),
    5: (THREE, (6, 2, 1, 1, 0), "ACCEPTED"),
    6: (THREE, (6, 2, 1, 2, None), "COUNTS_DISAGREE"),
    7: (THREE, (6, 2, None, None, None), "COUNTS_DISAGREE"),
    8: ("Mr No Heading\nAYES\nMr A", (1, None, None, None, None), "LAYOUT_UNREADABLE"),
    9: ("AYES\nNOES\n", (0, 0, None, None, None), "NOT_PRINTED"),
    10: ("AYES: 1\nMr A\nNoes (1)\nMr B\nPaired\nMr C\n", (1, 1, 0, None, None), "ACCEPTED"),
    11: ("AYES\nMr A\n" + " " * 600 + "x", (1, None, None, None, None), "LAYOUT_UNREADABLE"),
    12: ("AYES\nMr A\n", (None, None, None, None, None), "COUNTS_DISAGREE"),
    13: ("AYES\n\tMr A\n\tMr B\n\t  Long\n", (2, None, None, None, None), "ACCEPTED"),
}


@pytest.fixture(scope="module")
def read(spark):
    lines = spark.createDataFrame([(k, n, line) for k, (text, _, _) in LISTS.items() for n, line in enumerate(text.split("\n"))], "id int, place int, line string").repartition(3)
    counts = spark.createDataFrame([(k, *c) for k, (_, c, _) in LISTS.items()] + [(99, None, None, None, None, None)], "id int, ayes int, noes int, abstentions int, absent int, paired int")
    return tuple(df.collect() for df in D.division_lists(lines, counts, "id"))


def test_verdicts(read):
    assert {r.id: r.status for r in read[0]} == {k: v for k, (_, _, v) in LISTS.items()} | {99: "NOT_PRINTED"}


def test_names_of_accepted_lists(read):
    got = {}
    for r in sorted(read[1], key=lambda r: (r.id, r.side, r.n)):
        got.setdefault((r.id, r.side), []).append(r.name)
    two = {"AYE": ["Mr Tan Ah Kow", "Mr Abdul Rahim bin Ishak", "Mdm Wee"], "NO": ["Dr Lim Bo Seng", "Mr Goh", "Mr Low Por (Somewhere)"]}
    three = {"AYE": ["Mr A One", "Mr D Four", "Mr B Two", "Mr E Five", "Mr C Three", "Mr F Six"], "NO": ["Mr G Seven", "Mr H Eight bin Nine"], "ABSTAIN": ["Mr I Ten"], "ABSENT": ["Mr J Eleven"]}
    want = {(1, s): v for s, v in two.items()} | {(k, s): v for k in (4, 5) for s, v in three.items()}
    want |= {(10, "AYE"): ["Mr A"], (10, "NO"): ["Mr B"], (10, "PAIRED"): ["Mr C"], (13, "AYE"): ["Mr A", "Mr B Long"]}
    assert got == want
