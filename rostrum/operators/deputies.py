"""Rows that print an office alone while two people hold it: candidates as bits, narrowed until one is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rostrum.operators.joins import spans_on_day


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), place.cast("int"))


def holders_on_days(days: DataFrame, terms: DataFrame) -> DataFrame:
    """(day, holder, bit, men, everyone, holders): who holds the office on each day, as bits in the order of their numbers.

    terms: holder, first_day, last_day, is_woman; a holder with several terms on a day counts once.
    """
    held = spans_on_day(days.select("day").distinct(), terms, "day", "first_day", "last_day").groupBy("day", "holder").agg(F.bool_or("is_woman").alias("is_woman"))
    held = held.withColumn("bit", _bit(F.row_number().over(W.partitionBy("day").orderBy("holder")) - 1))
    masks = held.groupBy("day").agg(F.coalesce(F.bit_or(F.when(~F.col("is_woman"), F.col("bit"))), F.lit(0)).alias("men"), F.bit_or("bit").alias("everyone"), F.count("*").alias("holders"))
    return held.join(masks, "day")


def resolve_deputies(rows: DataFrame, reports: DataFrame, terms: DataFrame, mentions: DataFrame, size: int = 2) -> DataFrame:
    """rows (id, report, named) with holder and rule: who speaks as the deputy, of those that hold the office on the report's day.

    rows are those that print the office alone; named is the holder whom a note or label before
    the row names, if any. reports: (report, day). mentions: (report, day, holder, is_label), the
    holders whom a report's text names (is_label: in a label), and those whom the day's sitting
    names (report null). Each set of holders is a mask of bits: or-ed over the labels of a report,
    over its text, and over the other texts of the day. A row starts with all `size` holders:

    * other than `size` holders on the day: NO_PAIR; two of them named in the report: SEVERAL_NAMED;
    * one man among them: the label's form is his, unless the woman is named (FORM, else WOMAN_NAMED);
    * else the one named before the row (NAMED), or the only one in the report's labels (LABELLED),
      else UNNAMED; and refused if another text of the day names the other (NAMED_ELSEWHERE).

    A row is linked when one bit is left. Mentions of people who don't hold the office that day
    don't count.
    """
    days = reports.select("report", "day").distinct()
    held = holders_on_days(days, terms).select("day", "holder", "bit", "men", "everyone", "holders")
    said = mentions.join(held, ["day", "holder"])
    own = said.where("report is not null").groupBy("report").agg(F.bit_or("bit").alias("_named"), F.coalesce(F.bit_or(F.when(F.col("is_label"), F.col("bit"))), F.lit(0)).alias("_labelled"))
    # A text of the day names a holder in another text than a report's own if more texts do than that one.
    texts = said.select("day", "bit", F.coalesce(F.col("report").cast("string"), F.lit("the sitting")).alias("_text"), F.col("report")).distinct()
    by_day = texts.groupBy("day", "bit").agg(F.count("*").alias("_texts"))
    here = texts.where("report is not null").select("day", "report", "bit", F.lit(1).alias("_here"))
    elsewhere = days.join(by_day, "day").join(here, ["day", "report", "bit"], "left").where(F.col("_texts") > F.coalesce("_here", F.lit(0))).groupBy("report", "day").agg(F.bit_or("bit").alias("_elsewhere"))
    masks = held.select("day", "men", "everyone", "holders").distinct()
    asked = rows.join(days, "report").join(masks, "day", "left").join(own, "report", "left").join(elsewhere, ["report", "day"], "left")
    asked = asked.join(held.select("day", F.col("holder").alias("named"), F.col("bit").alias("_before")), ["day", "named"], "left")
    asked = asked.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("_named", "_labelled", "_elsewhere", "_before", "men", "holders")})
    one = lambda m: F.bit_count(m) == 1
    form = F.when(F.col("_named").bitwiseAND(F.bitwise_not("men")) == 0, F.col("men")).otherwise(0)
    candidate = F.when(F.col("_before") > 0, F.col("_before")).when(one(F.col("_labelled")), F.col("_labelled")).otherwise(0)
    rivals = F.col("_elsewhere").bitwiseAND(F.bitwise_not(candidate)) != 0
    pair, men = F.col("holders") == size, F.bit_count("men")
    rule = (
        F.when(~pair, "NO_PAIR")
        .when(F.bit_count("_named") > 1, "SEVERAL_NAMED")
        .when(men == 1, F.when(form != 0, "FORM").otherwise("WOMAN_NAMED"))
        .when(men < size, "NO_PAIR")
        .when(candidate == 0, "UNNAMED")
        .when(rivals, "NAMED_ELSEWHERE")
        .when(F.col("_before") > 0, "NAMED")
        .otherwise("LABELLED")
    )
    left = F.when(rule == "FORM", form).when(rule.isin("NAMED", "LABELLED"), candidate)
    found = asked.withColumns({"rule": rule, "_bit": left})
    return found.join(held.select("day", F.col("bit").alias("_bit"), "holder"), ["day", "_bit"], "left").select("id", "report", "holder", "rule")
