"""People merged in rounds against a walk in the order of the merges."""

import random

import pytest

from rostrum.operators import graph as G

PEOPLE, DECISIONS = "speaker_id long, name string, name_key string, slot string", "a long, b long, kind string, person_name string"


def walk(rows, decisions):
    """{row: cluster} by one merge after the other."""
    cluster, members = {i: i for i, *_ in rows}, {i: {i} for i, *_ in rows}
    slot = {i: s for i, _, _, s in rows}
    apart = {frozenset(d[:2]) for d in decisions if d[2] == "DISTINCT"}

    def merge(a, b):
        a, b = sorted((cluster[a], cluster[b]))
        if a == b:
            return True
        if any(slot[x] is not None and slot[x] == slot[y] or frozenset((x, y)) in apart for x in members[a] for y in members[b]):
            return False
        for x in members.pop(b):
            cluster[x] = a
            members[a].add(x)
        return True

    for a, b, kind, *_ in decisions:
        if kind == "MERGE" and a in cluster and b in cluster and not merge(a, b):
            raise ValueError
    for column in (1, 2):
        groups = {}
        for r in sorted(rows):
            if r[column] is not None:
                groups.setdefault(r[column], []).append(r[0])
        for _, (hub, *others) in sorted(groups.items(), key=lambda g: g[1][0]):
            for other in others:
                merge(hub, other)
    return cluster


@pytest.mark.parametrize("seed", range(4))
def test_rounds_are_the_walk(spark, seed):
    rng = random.Random(seed)
    n = rng.choice([40, 90])
    rows = []
    for k in range(n):
        name = f"N{min(rng.randrange(14), rng.randrange(14))}"
        rows.append((k * 3 % 101, name, f"k{int(name[1:]) // rng.choice([1, 3])}" if rng.random() < 0.9 else None, f"s{rng.randrange(rng.choice([3, 12]))}" if rng.random() < 0.9 else None))
    ids = [r[0] for r in rows]
    decisions = []
    while len(decisions) < 8:
        a, b = rng.sample(ids, 2)
        more = [*decisions, (a, b, rng.choice(["MERGE", "MERGE", "DISTINCT"]), None)]
        try:
            walk(rows, more)
        except ValueError:
            continue
        decisions = more
    # Decisions that a MERGE before them contradicts are errors; the walk took them in this order.
    people, decided = spark.createDataFrame(rows, PEOPLE).repartition(3), spark.createDataFrame([*decisions, (5000, 5001, "MERGE", None)], DECISIONS)
    try:
        got = {r.speaker_id: r.person for r in G.cluster_people(people, decided).collect()}
    except ValueError:
        apart = [d for d in decisions if d[2] == "DISTINCT"]
        only = walk(rows, [d for d in decisions if d[2] == "MERGE"])
        assert any(only[a] == only[b] for a, b, *_ in apart)
        return
    assert got == walk(rows, decisions)


def test_names_and_bases(spark):
    rows = [(1, "Ann Lee", "ann lee", "p1"), (2, "Ann Lee", "ann lee", "p2"), (3, "ANN LEE", "ann lee", "p2"), (4, "Bo", "bo", "p1"), (5, "A. Lee", "a lee", "p5"), (6, "ANN  LEE", "ann lee", "p6"), (7, None, None, None)]
    decisions = [(1, 5, "MERGE", "Ann Lee the Elder"), (5, None, "NAME", "Dr Ann Lee"), (1, None, "NAME", "Mdm Ann Lee"), (4, None, "NAME", "Bo the First")]
    got = {r.speaker_id: (r.person, r.basis, r.conflict, r.decided_name) for r in G.cluster_people(spark.createDataFrame(rows, PEOPLE), spark.createDataFrame(decisions, DECISIONS)).collect()}
    elder = (1, "key", True, "Mdm Ann Lee")
    assert got == {1: elder, 2: elder, 5: elder, 6: elder, 3: (3, "single", True, None), 4: (4, "single", False, "Bo the First"), 7: (7, "single", False, None)}
    with pytest.raises(ValueError, match="refused"):
        G.cluster_people(spark.createDataFrame(rows, PEOPLE), spark.createDataFrame([(1, 4, "MERGE", None)], DECISIONS)).collect()
    with pytest.raises(ValueError, match="refused"):
        G.cluster_people(spark.createDataFrame(rows, PEOPLE), spark.createDataFrame([(1, 5, "MERGE", None), (5, 1, "DISTINCT", None)], DECISIONS)).collect()
    assert G.cluster_people(spark.createDataFrame([], PEOPLE), spark.createDataFrame([], DECISIONS)).count() == 0


def test_a_hot_name_takes_two_rounds(spark, monkeypatch):
    """A name with a third of all rows: its rows meet in no task, its refusals come at once."""
    rows = [(k, "Tan", "tan", f"s{k % 5}") for k in range(400)] + [(1000 + k, f"N{k}", f"n{k}", "s1") for k in range(800)]
    rounds = []
    plain = G.connected_components
    monkeypatch.setattr(G, "connected_components", lambda edges, scratch, name: rounds.append(name) or plain(edges, scratch, name))
    got = {r.speaker_id: r.person for r in G.cluster_people(spark.createDataFrame(rows, PEOPLE), spark.createDataFrame([], DECISIONS)).collect()}
    assert got == {k: (0 if k < 5 else k) for k, *_ in rows}
    assert rounds == ["merges", "exact-joined-0"]  # the second round has refusals only; nothing is left for the keys
