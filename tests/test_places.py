"""Printed places against a walk in the order of the reports."""

import random

import pytest

from rostrum.operators import matching as M

REPORTS, SECTIONS = "sitting int, report_id int, number int, title string, subtitle string, content string, is_assent boolean", "sitting int, place int, title string, subtitle string, content string"


def walk(reports, sections):
    out = {}
    for sitting in {r[0] for r in reports}:
        own = [s for s in sections if s[0] == sitting]
        order = sorted((r for r in reports if r[0] == sitting), key=lambda r: (r[2], r[1]))
        fold = lambda t: "".join(c for c in (t or "").lower() if c.isalnum())
        used = set()
        for r in order:
            if r[6] and not r[5]:
                out[r[1]] = (None, "ASSENT_FIRST")
            elif r[5] is not None:
                same = [s[1] for s in own if s[4] == r[5]]
                if len(same) == 1 and same[0] not in used:
                    out[r[1]] = (same[0], "CONTENT")
                    used.add(same[0])
        for r in order:
            if r[1] in out:
                continue
            same = [s for s in own if s[1] not in used and fold(s[2]) == fold(r[3])]
            both = [s for s in same if fold(s[3]) == fold(r[4])]
            pick = (same[0][1], "TITLE") if len(same) == 1 else (both[0][1], "SUBTITLE") if len(same) > 1 and len(both) == 1 else (None, "NOT_PLACED")
            out[r[1]] = pick
            used.add(pick[0])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_places_are_the_walk(spark, seed):
    rng = random.Random(seed)
    pick = lambda xs: rng.choice(xs)
    reports = [(k % 6, k, pick([1, 2, 3, 9]), pick(["A", "a.", "B", None]), pick(["x", "y", "Z-", None]), pick([None, "", "c1", "c2", "c3", f"own{k}"]), pick([True, False, None])) for k in range(160)]
    sections = [(k % 6, k, pick(["A", "B", "b ", None]), pick(["x", "y", "z", "w", None]), pick([None, "c1", "c2", "c4"])) for k in range(90)]
    got = M.printed_places(spark.createDataFrame(reports, REPORTS).repartition(3), spark.createDataFrame(sections, SECTIONS), "sitting").collect()
    want = walk(reports, sections)
    assert {r.report_id: (r.place, r.rule) for r in got} == want and len(got) == 160
    assert {rule for _, rule in want.values()} >= {"CONTENT", "TITLE", "SUBTITLE", "NOT_PLACED", "ASSENT_FIRST"}


def test_pictures_broken_into_lines(spark):
    """An encoder breaks base64 into lines; the whole picture counts, not its first line."""
    import base64
    import hashlib

    from rostrum.operators.documents import inline_pictures

    raw = bytes(range(256)) * 40
    text = "<p><img src=\"data:image/PNG;base64," + base64.encodebytes(raw).decode().replace("\n", "\r\n") + "\" alt=x> <img src=data:image/gif;base64,QUJD alt=y>"
    got = inline_pictures(spark.createDataFrame([(1, text)], "id long, html string"), "id", "html").orderBy("n").collect()
    assert [tuple(r) for r in got] == [(1, 0, "image/png", len(raw), hashlib.sha256(raw).hexdigest()), (1, 1, "image/gif", 3, hashlib.sha256(b"ABC").hexdigest())]
