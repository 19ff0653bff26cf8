"""Scans along a key's rows in order, in blocks, so that a key with very many rows is spread over tasks.

Each scan works inside blocks of `block` places first, sums every block up in one row, scans
these rows in the same way, and hands each block what came before it. A window never holds
more than one block of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

BLOCK = 256
#: Bits of a state in a packed map.
_BITS = 4


def pack(after: list[int]) -> int:
    """A map of states as one number: after[s] is the state that follows s."""
    return sum(t << (_BITS * s) for s, t in enumerate(after))


def follow(moves: Column, state: Column) -> Column:
    """The state that a packed map gives for a state."""
    return F.call_function("shiftright", moves, (state * _BITS).cast("int")).bitwiseAND(F.lit((1 << _BITS) - 1).cast("long")).cast("int")


def compose(later: Column, earlier: Column, states: int) -> Column:
    """The packed map that does `earlier`, then `later`."""
    out = F.lit(0).cast("long")
    for s in range(states):
        out = out + F.call_function("shiftleft", follow(later, follow(earlier, F.lit(s))).cast("long"), F.lit(_BITS * s))
    return out


def _blocks(rows: DataFrame, place: str, block: int) -> DataFrame:
    return rows.withColumn("_block", F.floor(F.col(place) / block).cast("long"))


def _deep(rows: DataFrame, place: str) -> int:
    return rows.agg(F.max(place)).first()[0] or 0


def state_scan(rows: DataFrame, key: str, place: str, moves: str, states: int, start: int = 0, block: int = BLOCK, last: int | None = None) -> DataFrame:
    """rows with state_before and state_after of a finite automaton that reads them in the order of their places.

    moves is a column of packed maps (see `pack`), one a row; places are whole numbers from 0 on,
    each once in a key. Maps compose, so prefixes are doubled inside a block (log2(block) steps
    over one sort) and blocks are composed in the same way. last: the largest place, if known.
    """
    last = _deep(rows, place) if last is None else last
    identity = F.lit(pack(list(range(states)))).cast("long")
    w = W.partitionBy(key, "_block").orderBy(place)
    scanned = _blocks(rows, place, block).withColumn("_f", F.col(moves).cast("long"))
    step = 1
    while step < min(block, last + 1):
        scanned = scanned.withColumn("_e", F.coalesce(F.lag("_f", step).over(w), identity))
        scanned = scanned.withColumn("_f", compose(F.col("_f"), F.col("_e"), states)).drop("_e")
        step *= 2
    scanned = scanned.withColumn("_before", F.coalesce(F.lag("_f").over(w), identity))
    if last < block:
        entry, joined = F.lit(start), scanned
    else:
        whole = scanned.groupBy(key, F.col("_block").alias("_above")).agg(F.max_by("_f", place).alias("_m"))
        # Blocks without rows leave gaps, which don't matter: the scan goes by order.
        above = state_scan(whole, key, "_above", "_m", states, start, block, last // block)
        joined = scanned.join(above.select(key, F.col("_above").alias("_block"), F.col("state_before").alias("_s")), [key, "_block"])
        entry = F.col("_s")
    out = joined.withColumns({"state_before": follow(F.col("_before"), entry), "state_after": follow(F.col("_f"), entry)})
    return out.drop("_block", "_f", "_before", "_s")


def last_value(rows: DataFrame, key: str, place: str, mark: str, name: str, before: bool = False, block: int = BLOCK, last: int | None = None) -> DataFrame:
    """rows with `name`: the last mark that isn't null, up to and with the row, or up to the one before it; places as in `state_scan`."""
    last = _deep(rows, place) if last is None else last
    w = W.partitionBy(key, "_block").orderBy(place).rowsBetween(W.unboundedPreceding, -1 if before else 0)
    scanned = _blocks(rows, place, block).withColumn(name, F.last(mark, ignorenulls=True).over(w))
    if last < block:
        return scanned.drop("_block")
    marked = F.col(mark).isNotNull()
    whole = scanned.groupBy(key, F.col("_block").alias("_above")).agg(F.max_by(F.when(marked, F.col(mark)), F.when(marked, F.col(place))).alias("_marked"))
    above = last_value(whole, key, "_above", "_marked", "_upto", True, block, last // block)
    return scanned.join(above.select(key, F.col("_above").alias("_block"), F.col("_upto").alias("_entry")), [key, "_block"]).withColumn(name, F.coalesce(name, "_entry")).drop("_block", "_entry")


def number_rows(rows: DataFrame, key: str, place: str, name: str, block: int = BLOCK) -> DataFrame:
    """rows with `name`: 1, 2, ... in the order of their places."""
    blocks = _blocks(rows, place, block)
    before = W.partitionBy(key).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    counts = blocks.groupBy(key, "_block").agg(F.count("*").alias("_n")).select(key, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = F.row_number().over(W.partitionBy(key, "_block").orderBy(place))
    return blocks.withColumn("_nth", inside).join(counts, [key, "_block"]).withColumn(name, (F.col("_nth") + F.col("_first")).cast("long")).drop("_block", "_nth", "_first")
