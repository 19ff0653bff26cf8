"""Turns by literal values, and scans in blocks against walks."""

import random

import pytest
from pyspark.sql import functions as F

from rostrum.operators import scans, turns

REPORT = """# Budget
(Continued from yesterday)
_Order of the day_
The sitting opened in the usual way.
**Mr Tan Ah Kow (Somewhere)**: Sir, I rise to speak.
My second paragraph.
**[Mr Deputy Speaker (Mr Lim) in the Chair]**
**H**ousing is dear to us all.
| Year | **2001** | 5 |
**Mr Lim said that the plans are late** and so they are.
**(Mr Speaker in the Chair)** And it goes on.
Column: 123
3.45 pm
**Miss Wee**:
(In Malay): Tuan Yang di-Pertua, saya setuju.
Question proposed.
I have more to say.
Question put, and agreed to.
Nobody in particular said this.
**Mr Lim said that the plans are late** again.
The Minister for Health (Mr Ong Bee): I reply (In Tamil) to this.
Mr Speaker: Order.
**Mr Goh** rose in his place.
He is still heard.
**Mr Goh** left the Chamber.
Silence fell.
The following question stood in the name of **Dr Yap** –
To ask about ships.
_A title in italics_
**ADJOURNMENT**
Left over.
**The following figures:**
[(proc text) Resolved, That the House do adjourn. (proc text)]
**(Applause)** after the note
**1. Er Chua (In Mandarin)**:
**Hon. Members**: Hear, hear.
**Ms Koh (East** ): Half a bracket."""

WANT = [
    (3, None, "UNCLASSIFIED", "The sitting opened in the usual way.", None),
    (4, "Mr Tan Ah Kow (Somewhere)", "SPEECH", "Sir, I rise to speak.", None),
    (5, "Mr Tan Ah Kow (Somewhere)", "SPEECH", "My second paragraph.", None),
    (7, "Mr Tan Ah Kow (Somewhere)", "SPEECH", "Housing is dear to us all.", None),
    (8, "Mr Tan Ah Kow (Somewhere)", "SPEECH", "| Year | 2001 | 5 |", None),
    (9, "Mr Tan Ah Kow (Somewhere)", "SPEECH", "Mr Lim said that the plans are late and so they are.", None),
    (10, "Mr Tan Ah Kow (Somewhere)", "SPEECH", "And it goes on.", None),
    (14, "Miss Wee", "SPEECH", "Tuan Yang di-Pertua, saya setuju.", "Malay"),
    (15, None, "PROCEDURAL", "Question proposed.", None),
    (16, "Miss Wee", "SPEECH", "I have more to say.", None),
    (17, None, "PROCEDURAL", "Question put, and agreed to.", None),
    (18, None, "UNCLASSIFIED", "Nobody in particular said this.", None),
    (19, "Mr Lim said that the plans are late", "SPEECH", "again.", None),
    (20, "The Minister for Health (Mr Ong Bee)", "SPEECH", "I reply (In Tamil) to this.", None),
    (21, "Mr Speaker", "SPEECH", "Order.", None),
    (22, None, "CHAMBER_EVENT", "Mr Goh rose in his place.", None),
    (23, "Mr Speaker", "SPEECH", "He is still heard.", None),
    (24, None, "CHAMBER_EVENT", "Mr Goh left the Chamber.", None),
    (25, None, "UNCLASSIFIED", "Silence fell.", None),
    (26, None, "PROCEDURAL", "The following question stood in the name of Dr Yap –", None),
    (27, "Dr Yap", "SPEECH", "To ask about ships.", None),
    (28, None, "HEADING", "_A title in italics_", None),
    (30, None, "UNCLASSIFIED", "Left over.", None),
    (31, None, "HEADING", "The following figures:", None),
    (32, None, "PROCEDURAL", "Resolved, That the House do adjourn.", None),
    (33, None, "UNCLASSIFIED", "after the note", None),
    (35, "Hon. Members", "SPEECH", "Hear, hear.", None),
    (36, "Ms Koh (East)", "SPEECH", "Half a bracket.", None),
]


def table(spark, docs):
    return spark.createDataFrame([(k, n, line) for k, text in docs.items() for n, line in enumerate(text.split("\n"))], "id long, place int, line string").repartition(3)


@pytest.mark.parametrize("block", [4, 256])
def test_turns_of_a_report(spark, block):
    docs = {1: REPORT, 2: "No label here.\nNor here.", 3: "", 4: "**Mdm Halimah (In Malay)**:\nQuestion proposed.\nSaya setuju.\nLagi.", 5: "**Mr A**: One.\n**Mr A**: (in Tamil) Two."}
    got = turns.speeches(table(spark, docs), "id", block=block).orderBy("id", "ordinal").collect()
    assert [tuple(r)[2:] for r in got if r.id == 1] == WANT
    assert [r.ordinal for r in got if r.id == 1] == list(range(1, len(WANT) + 1))
    assert [tuple(r)[3:] for r in got if r.id == 4] == [(None, "PROCEDURAL", "Question proposed.", None), ("Mdm Halimah", "SPEECH", "Saya setuju.", None), ("Mdm Halimah", "SPEECH", "Lagi.", None)]
    assert [tuple(r)[3:] for r in got if r.id == 5] == [("Mr A", "SPEECH", "One.", None), ("Mr A", "SPEECH", "Two.", "Tamil")]
    assert {r.id for r in got} == {1, 4, 5}


def test_scans_are_walks(spark):
    rng = random.Random(2)
    maps = [scans.pack([rng.randrange(5) for _ in range(5)]) for _ in range(9)]
    rows = [(k, p, maps[rng.randrange(9)], rng.choice([None, None, p * 10])) for k, n in ((1, 700), (2, 1), (3, 65)) for p in range(n)]
    df = spark.createDataFrame(rows, "k long, p long, f long, m long").repartition(5)
    for block in (4, 256):
        got = {(r.k, r.p): r for r in scans.state_scan(df, "k", "p", "f", 5, 3, block).collect()}
        upto = {(r.k, r.p): r.v for r in scans.last_value(df, "k", "p", "m", "v", False, block).collect()}
        before = {(r.k, r.p): r.v for r in scans.last_value(df, "k", "p", "m", "v", True, block).collect()}
        nth = {(r.k, r.p): r.v for r in scans.number_rows(df.where("m is not null"), "k", "p", "v", block).collect()}
        state, mark, count = {}, {}, {}
        for k, p, f, m in rows:
            old = state.get(k, 3)
            state[k] = f >> 4 * old & 15
            assert (got[k, p].state_before, got[k, p].state_after) == (old, state[k]) and before[k, p] == mark.get(k)
            mark[k] = m if m is not None else mark.get(k)
            assert upto[k, p] == mark[k]
            if m is not None:
                count[k] = count.get(k, 0) + 1
                assert nth[k, p] == count[k]
        assert len(got) == len(rows) == len(upto)


def test_a_hot_report_is_spread(spark):
    """No window holds more than a block of one report."""
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("p"), F.lit(scans.pack([1, 0])).cast("long").alias("f"))
    out = scans.state_scan(df, "k", "p", "f", 2, 0, 64)
    assert out.where("state_after = (p + 1) % 2").count() == 20_000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert all("_block" in line for line in plan.splitlines() if line.strip(" +-:").startswith("Window"))
