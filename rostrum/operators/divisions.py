"""Lists of votes printed in columns, read by their gutters and accepted or refused as a whole."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Sides by the heading they are printed under.
SIDES = {"AYE": "ayes", "NO": "noes", "ABSTAIN": "abstentions", "ABSENT": "absent", "PAIRED": "paired"}
HEADINGS = {"AYES": "AYE", "NOES": "NO", "ABSTENTIONS": "ABSTAIN", "ABSENT": "ABSENT", "PAIRED": "PAIRED"}
#: Sides whose missing count is not looked at; of the others a missing count is 0.
UNCOUNTED = ("ABSENT", "PAIRED")
#: Characters a line has at most, in words of 64 bits; blank columns that part two columns of names; how far a heading may stand from its column.
WORDS, GUTTER, NEAR = 8, 2, 8


def _heading() -> str:
    return r"(?i)\b(" + "|".join(HEADINGS) + r")\b\.?\s*[:,\-–—]*\s*\(?\d*\)?"


def _is_heading_line(line: Column) -> Column:
    """Nothing but headings, their counts and spaces."""
    return line.rlike(_heading()) & (F.trim(F.regexp_replace(line, _heading(), "")) == "")


def _occupied(line: Column, word: int) -> Column:
    """The bits of the characters in one stretch of 64 that are no blanks."""
    bit = lambda i: F.when(F.substring(line, (i + 1).cast("int"), F.lit(1)).isin("", " "), F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), (i - word * 64).cast("int")))
    return F.when(F.length(line) <= word * 64, F.lit(0).cast("long")).otherwise(F.aggregate(F.sequence(F.lit(word * 64), F.lit(word * 64 + 63)), F.lit(0).cast("long"), lambda a, i: a.bitwiseOR(bit(i))))


def _is_set(position: Column) -> Column:
    """Whether some line of the block has a character there; columns _o0, _o1, ... hold the bits."""
    word = F.element_at(F.array(*(F.col(f"_o{w}") for w in range(WORDS))), F.floor(position / 64).cast("int") + 1)
    return (position >= 0) & (F.call_function("shiftrightunsigned", word, (position % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1)


def list_columns(lines: DataFrame, key: str) -> DataFrame:
    """(key, starts): where the columns of names begin, from 0.

    The characters that are no blanks are or-ed over all lines but the headings, as bits; what
    stays blank in all of them, GUTTER wide or wider, parts two columns. Partial sums combine in
    each task: what is shuffled is a bitmap a list.
    """
    names = lines.where(~_is_heading_line(F.col("line")))
    bits = names.groupBy(key).agg(*(F.bit_or(_occupied(F.col("line"), w)).alias(f"_o{w}") for w in range(WORDS)))
    begins = lambda p: _is_set(p) & reduce(lambda a, b: a & b, [~_is_set(p - k) for k in range(1, GUTTER + 1)])
    return bits.select(key, F.filter(F.sequence(F.lit(0), F.lit(WORDS * 64 - 1)), begins).alias("starts"))


def list_cells(lines: DataFrame, key: str) -> DataFrame:
    """(key, place, col, offset, text, heading): the cells of all lines; heading is the side that a heading cell opens.

    A heading opens its side in the column it stands next to and in those to the right of it, up
    to the next heading of its line; one that stands alone and far from every column, in all.
    """
    wide = lines.select(key, "place", F.regexp_replace(F.rtrim("line"), "\t", " " * 8).alias("line")).where("line <> ''")
    starts = list_columns(wide, key)
    rows = wide.join(starts, key, "left").withColumn("starts", F.coalesce("starts", F.array(F.lit(0))))
    heading = rows.where(_is_heading_line(F.col("line")))
    found = heading.withColumn("_h", F.regexp_extract_all("line", F.lit(_heading()), F.lit(1)))
    # Where each heading stands: the n-th of a line after those before it.
    at = F.aggregate("_h", F.struct(F.lit(1).alias("from"), F.array().cast("array<int>").alias("at")), lambda a, h: F.struct((F.call_function("locate", h, F.col("line"), a["from"]) + F.length(h)).cast("int").alias("from"), F.concat(a["at"], F.array((F.call_function("locate", h, F.col("line"), a["from"]) - 1).cast("int"))).alias("at")), lambda a: a["at"])
    found = found.withColumn("_at", at)
    gap = lambda p: F.array_min(F.transform("starts", lambda s: F.abs(s - p)))
    nearest = lambda p: F.array_position(F.transform("starts", lambda s: F.abs(s - p)), gap(p)).cast("int") - 1
    spans = (F.size("_h") == 1) & (gap(F.get("_at", F.lit(0))) > NEAR)
    each = F.transform(F.arrays_zip("_h", "_at"), lambda x: F.struct(F.when(spans, 0).otherwise(nearest(x["_at"])).alias("col"), F.upper(x["_h"]).alias("side")))
    opened = found.withColumn("_e", each).select(key, "place", F.posexplode("_e").alias("_n", "_x"), F.size("starts").alias("_cols"), F.col("_e"))
    upto = F.coalesce(F.get("_e", F.col("_n") + 1)["col"], F.col("_cols")) - 1
    opened = opened.select(key, "place", F.explode(F.sequence(F.col("_x.col"), F.greatest(upto, F.col("_x.col")))).alias("col"), F.col("_x.side").alias("_side"))
    side = F.create_map(*[F.lit(v) for pair in HEADINGS.items() for v in pair])
    opened = opened.select(key, "place", "col", F.lit(0).alias("offset"), F.lit("").alias("text"), F.element_at(side, F.col("_side")).alias("heading"))
    plain = rows.where(~_is_heading_line(F.col("line")))
    width = F.coalesce(F.get("starts", F.col("col") + 1), F.length("line") + 1) - F.get("starts", F.col("col"))
    cells = plain.select(key, "place", "line", "starts", F.explode(F.sequence(F.lit(0), F.size("starts") - 1)).alias("col"))
    cells = cells.withColumn("_raw", F.when(F.length("line") > F.get("starts", F.col("col")), F.substring(F.col("line"), (F.get("starts", F.col("col")) + 1).cast("int"), width.cast("int")))).where(F.trim("_raw") != "")
    cells = cells.select(key, "place", "col", (F.length("_raw") - F.length(F.ltrim("_raw"))).alias("offset"), F.trim("_raw").alias("text"), F.lit(None).cast("string").alias("heading"))
    return cells.unionByName(opened)


def list_names(lines: DataFrame, key: str) -> DataFrame:
    """(key, side, n, name) of lists (key, place, line); a name under no heading has the side null.

    A cell further in than most of its column's cells under its heading goes on the name above
    it. Numbers before names, periods and commas after them are not theirs. n counts along the
    columns, from the left.
    """
    cells = list_cells(lines, key)
    along = W.partitionBy(key, "col").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    cells = cells.withColumns({"side": F.last("heading", ignorenulls=True).over(along), "_section": F.sum(F.col("heading").isNotNull().cast("int")).over(along)}).where("heading is null")
    usual = cells.groupBy(key, "col", "_section").agg(F.mode("offset", True).alias("_usual"))
    cells = cells.join(usual, [key, "col", "_section"])
    cells = cells.withColumn("_new", (F.col("offset") <= F.col("_usual")).cast("int"))
    section = W.partitionBy(key, "col", "_section").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    cells = cells.withColumn("_name", F.sum("_new").over(section))
    names = cells.groupBy(key, "col", "_section", "_name", "side").agg(F.min("place").alias("_place"), F.array_sort(F.collect_list(F.struct("place", "text"))).alias("_t"))
    text = F.concat_ws(" ", F.transform("_t", lambda x: x["text"]))
    tidy = F.trim(F.regexp_replace(F.regexp_replace(text, r"^\d+[.)]?\s+", ""), r"[\s.,;]+$", ""))
    names = names.withColumn("name", tidy).where(F.col("name").rlike(r"\p{L}"))
    return names.select(key, "side", F.row_number().over(W.partitionBy(key, "side").orderBy("col", "_place")).alias("n"), "name")


def division_lists(lines: DataFrame, counts: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(verdicts, names) of printed lists (key, place, line) and what their divisions print: (key, ayes, noes, abstentions, absent, paired).

    verdicts: (key, status), a row for each division: NOT_PRINTED without a name,
    LAYOUT_UNREADABLE if a name stands under no heading or a line is wider than WORDS * 64,
    COUNTS_DISAGREE if a side has not as many names as its count (a missing count of ayes, noes
    or abstentions is 0, one of absent or paired is not looked at), else ACCEPTED. names: (key,
    side, n, name) of accepted lists only: one wrong count refuses the whole list.
    """
    read = list_names(lines, key)
    found = read.groupBy(key).agg(F.count("*").alias("_names"), F.max(F.col("side").isNull()).alias("_lost"), *(F.count_if(F.col("side") == s).alias(f"_{s}") for s in SIDES))
    wide = lines.where(F.length("line") > WORDS * 64).select(F.col(key), F.lit(True).alias("_wide")).distinct()
    rows = counts.select(key, *SIDES.values()).join(found, key, "left").join(wide, key, "left")
    wrong = reduce(lambda a, b: a | b, [F.col(c).isNotNull() & (F.col(c) != F.col(f"_{s}")) if s in UNCOUNTED else F.coalesce(F.col(c), F.lit(0)) != F.col(f"_{s}") for s, c in SIDES.items()])
    status = F.when(F.coalesce("_names", F.lit(0)) == 0, "NOT_PRINTED").when(F.col("_lost") | F.col("_wide").isNotNull(), "LAYOUT_UNREADABLE").when(wrong, "COUNTS_DISAGREE").otherwise("ACCEPTED")
    verdicts = rows.select(key, status.alias("status"))
    return verdicts, read.join(verdicts.where("status = 'ACCEPTED'").select(key), key, "left_semi")
