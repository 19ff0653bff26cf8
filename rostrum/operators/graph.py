"""Components and people."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.sources.tables import Scratch


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of edges (u, v) has one target at most, and no target has one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    seen = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return seen.where("out > 1 or (out = 1 and into = 1)").limit(1).count() == 0


def connected_components(edges: DataFrame, scratch: Scratch | None = None, name: str = "components") -> DataFrame:
    """(node, component) over edges (a, b): the smallest node that is reachable.

    Alternates the large-star and small-star steps of Kiveris et al. (2014) until all that is
    left are stars. Each node's minimum comes from a map-side combined aggregation, so a hub
    does not gather its edges in one task; each round is cut by a written table.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    now, k = scratch.save(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0"), 0
    while not _are_stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        k += 1
        now = scratch.save(small.where("u <> v").distinct(), f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _merge_stars(edges: DataFrame, slots: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(cluster, into): which clusters end up in which, by merging along edges (a, b, rank) in the order of their ranks.

    slots: (cluster, slot). An edge is refused if its clusters share a slot when its turn comes.
    What an edge's turn brings is known early: slots only grow, so an edge whose clusters share
    one now is refused at once; and an edge is accepted at once if no earlier edge at either end
    can change what it meets, that is, if those lead to clusters with no other edge and share no
    slot with its own other end. So each round settles all edges that nothing earlier touches,
    and a name with any number of rows takes two rounds: the first row of each slot, then all
    others' refusals. Rows of one cluster are never gathered: what is kept of them is the least
    rank for each slot.
    """
    edges = scratch.save(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "rank").groupBy("a", "b").agg(F.min("rank").alias("rank")), f"{name}-edges-0")
    moves, k = None, 0
    while True:
        shared = edges.join(slots.withColumnRenamed("cluster", "b"), "b").join(slots.withColumnRenamed("cluster", "a"), ["a", "slot"], "left_semi").select("a", "b").distinct()
        live = scratch.save(edges.join(shared, ["a", "b"], "left_anti"), f"{name}-live-{k}")
        if live.isEmpty():
            break
        ends = live.select(F.col("a").alias("at"), F.col("b").alias("to"), "rank").unionByName(live.select(F.col("b").alias("at"), F.col("a").alias("to"), "rank"))
        alone = ends.groupBy("at").agg(F.count("*").alias("n")).where("n = 1").select(F.col("at").alias("to"), F.lit(True).alias("leaf"))
        # The earliest edge at each end that leads on to others, and for each slot the earliest that brings it.
        leading = ends.join(alone, "to", "left").where("leaf is null").groupBy("at").agg(F.min("rank").alias("first"))
        bringing = ends.join(slots.withColumnRenamed("cluster", "to"), "to").groupBy("at", "slot").agg(F.min(F.struct("rank", "to")).alias("least"))
        sizes = slots.groupBy(F.col("cluster").alias("to")).agg(F.count("*").alias("size"))
        free = bringing.groupBy("at", F.col("least.to").alias("to"), F.col("least.rank").alias("rank")).agg(F.count("*").alias("n")).join(sizes, "to").where("n = size")
        free = free.join(leading, "at", "left").where("first is null or rank <= first").select("at", "to")
        accepted = scratch.save(free.join(free.select(F.col("to").alias("at"), F.col("at").alias("to")), ["at", "to"], "left_semi").where("at < to"), f"{name}-accepted-{k}")
        into = scratch.save(connected_components(accepted.toDF("a", "b"), scratch, f"{name}-joined-{k}").toDF("cluster", "into"), f"{name}-into-{k}")
        moved = lambda df, c: df.join(into.withColumnRenamed("cluster", c), c, "left").withColumn(c, F.coalesce("into", c)).drop("into")  # noqa: E731, B023
        k += 1
        edges = scratch.save(moved(moved(live, "a"), "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "rank").groupBy("a", "b").agg(F.min("rank").alias("rank")), f"{name}-edges-{k}")
        slots = scratch.save(moved(slots, "cluster").distinct(), f"{name}-slots-{k}")
        if moves is None:
            moves = into
        else:
            before = moves.withColumnRenamed("into", "via").join(into.withColumnRenamed("cluster", "via"), "via", "left").select("cluster", F.coalesce("into", "via").alias("into"))
            moves = scratch.save(before.unionByName(into.join(moves, "cluster", "left_anti")), f"{name}-moves-{k}")
    return moves if moves is not None else edges.select(F.col("a").alias("cluster"), F.col("b").alias("into")).limit(0)


def cluster_people(speakers: DataFrame, decisions: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(speaker_id, person, basis, conflict, decided_name) of speakers (speaker_id, name, name_key, slot).

    Rows merge in this order: MERGE decisions (a, b, kind), then equal names, then equal name keys,
    each row with the first of its name, in the order of their ids. A merge is refused when the
    two clusters share a slot (one Parliament and kind of membership) or a DISTINCT decision parts
    two of their rows; a refused decision is an error. person is the least id of a cluster, basis
    the last rule that added to it (`merge`, `exact`, `key`, else `single`), conflict whether one
    of its merges was refused. decided_name comes from decisions with a person_name (NAME, or
    MERGE for its row a): that of the cluster's least row that has one. A row without a slot
    shares none; rows without a name or key merge with nothing. Slots of a DISTINCT pair are kept
    as one more slot of both, so all refusals are alike (see `_merge_stars`).
    """
    scratch = scratch or Scratch(speakers.sparkSession)
    speakers = scratch.save(speakers.select("speaker_id", "name", "name_key", "slot"), "speakers")
    if "person_name" not in decisions.columns:
        decisions = decisions.withColumn("person_name", F.lit(None).cast("string"))
    pair = F.concat_ws(" ", F.lit("apart"), F.least("a", "b"), F.greatest("a", "b"))
    apart = decisions.where("kind = 'DISTINCT'").select(F.explode(F.array("a", "b")).alias("speaker_id"), pair.alias("slot"))
    own = speakers.select("speaker_id", F.coalesce(F.concat(F.lit("slot "), F.col("slot").cast("string")), F.concat(F.lit("row "), F.col("speaker_id").cast("string"))).alias("slot"))
    slots = own.unionByName(apart)
    merges = decisions.where("kind = 'MERGE'").select("a", "b").join(speakers.select(F.col("speaker_id").alias("a")), "a", "left_semi").join(speakers.select(F.col("speaker_id").alias("b")), "b", "left_semi")
    joined = connected_components(merges, scratch, "merges")
    of = scratch.save(speakers.join(joined.withColumnRenamed("node", "speaker_id"), "speaker_id", "left").select("speaker_id", F.coalesce("component", "speaker_id").alias("cluster")), "of-merges")
    merged = joined.select(F.explode(F.array("node", "component")).alias("speaker_id")).distinct()
    refused = slots.distinct().join(merged, "speaker_id", "left_semi").join(of, "speaker_id").groupBy("cluster", "slot").count().where("count > 1").limit(1).collect()
    if refused:
        raise ValueError(f"a decision to merge is refused: the rows of {refused[0].cluster} share {refused[0].slot}")
    basis = joined.select(F.col("component").alias("cluster")).distinct().withColumn("basis", F.lit("merge"))
    conflicts = None
    for rule, column in (("exact", "name"), ("key", "name_key")):
        first = speakers.where(F.col(column).isNotNull()).groupBy(column).agg(F.min("speaker_id").alias("hub"))
        star = speakers.join(first, column).where("speaker_id <> hub").select("hub", F.col("speaker_id").alias("other"))
        ends = star.join(of.toDF("hub", "a"), "hub").join(of.toDF("other", "b"), "other").select("a", "b", F.struct("hub", "other").alias("rank"))
        now = scratch.save(slots.join(of, "speaker_id").select("cluster", "slot").distinct(), f"slots-{rule}")
        into = _merge_stars(ends, now, scratch, rule)
        of = scratch.save(of.join(into, "cluster", "left").select("speaker_id", F.coalesce("into", "cluster").alias("cluster")), f"of-{rule}")
        grown = into.select(F.col("into").alias("cluster")).distinct().withColumn("grown", F.lit(True))
        basis = basis.join(into, "cluster", "left").select(F.coalesce("into", "cluster").alias("cluster"), "basis").distinct().join(grown, "cluster", "full").select("cluster", F.when(F.col("grown"), rule).otherwise(F.col("basis")).alias("basis"))
        basis = scratch.save(basis, f"basis-{rule}")
        # Merges that were refused: the row is still apart from the first of its name.
        own = star.join(of.toDF("hub", "a"), "hub").join(of.toDF("other", "b"), "other").where("a <> b").select(F.explode(F.array("hub", "other")).alias("speaker_id")).distinct()
        conflicts = own if conflicts is None else conflicts.unionByName(own)
    noted = conflicts.distinct().join(of, "speaker_id").select("cluster").distinct().withColumn("conflict", F.lit(True))
    named = decisions.where("person_name is not null and kind in ('MERGE', 'NAME')").select(F.col("a").alias("speaker_id"), "person_name", (F.col("kind") == "NAME").alias("later"))
    named = named.join(of, "speaker_id").groupBy("cluster").agg(F.min_by("person_name", F.struct("speaker_id", ~F.col("later"))).alias("decided_name"))
    rows = of.join(basis, "cluster", "left").join(noted, "cluster", "left").join(named, "cluster", "left")
    return rows.select("speaker_id", F.col("cluster").alias("person"), F.coalesce("basis", F.lit("single")).alias("basis"), F.coalesce("conflict", F.lit(False)).alias("conflict"), "decided_name")
