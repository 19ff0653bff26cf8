"""Links between reports by printed title and date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rostrum.functions.names import loose_title_key, title_key
from rostrum.operators.joins import nearest_join


def _others(asked: DataFrame, members: DataFrame, by: list[str], name: str) -> DataFrame:
    """asked with n_<name>, how many reports of its group (members: by, report_id) are not its source, and t_<name>, that report if there is one.

    A group is its number of reports and their ends: of two reports the one that is not the
    source is known from them, so reports and citations of a group are never paired.
    """
    size = members.groupBy(*by).agg(F.count_distinct("report_id").alias("_n"), F.min("report_id").alias("_lo"), F.max("report_id").alias("_hi"))
    own = members.select(*by, F.col("report_id").alias("source")).where("source is not null").distinct().withColumn("_own", F.lit(1))
    found = asked.join(size, by, "left").join(own, [*by, "source"], "left")
    n = F.when(F.col("source").isNull(), 0).otherwise(F.coalesce("_n", F.lit(0)) - F.coalesce("_own", F.lit(0)))
    other = F.when(F.col("_lo") == F.col("source"), F.col("_hi")).otherwise(F.col("_lo"))
    return found.withColumns({f"n_{name}": n, f"t_{name}": F.when(n == 1, other)}).drop("_n", "_lo", "_hi", "_own")


def link_citations(cited: DataFrame, reports: DataFrame, corrected: DataFrame | None = None) -> DataFrame:
    """(source, title, day, target, rule, reason) of citations (source, title, day).

    A sitting must exist on the day and the source itself is no target. Just one report of the
    exact title, else (no exact one) just one of the same title key, else one under a corrected
    title; several leave the citation unplaced, with the reason.
    """
    sittings = reports.select("day").distinct().withColumn("_sits", F.lit(True))
    asked = cited.select("source", "title", "day").distinct().withColumn("_key", title_key(F.col("title"))).join(sittings, "day", "left")
    known = reports.select("day", "title", "report_id")
    asked = _others(asked, known, ["day", "title"], "exact")
    asked = _others(asked, known.select("day", title_key(F.col("title")).alias("_key"), "report_id"), ["day", "_key"], "key")
    if corrected is not None:  # a short hand-kept list (title, corrected_title)
        mended = known.withColumnRenamed("title", "corrected_title").join(F.broadcast(corrected.select("title", "corrected_title").distinct()), "corrected_title")
        asked = _others(asked, mended.select("day", "title", "report_id"), ["day", "title"], "mended")
    else:
        asked = asked.withColumns({"n_mended": F.lit(0), "t_mended": F.lit(None).cast(reports.schema["report_id"].dataType)})
    rule = F.when(F.col("n_exact") > 0, "EXACT").when(F.col("n_key") > 0, "KEY").when(F.col("n_mended") > 0, "CORRECTED")
    n = F.when(F.col("n_exact") > 0, F.col("n_exact")).when(F.col("n_key") > 0, F.col("n_key")).otherwise(F.col("n_mended"))
    target = F.when(F.col("n_exact") > 0, F.col("t_exact")).when(F.col("n_key") > 0, F.col("t_key")).otherwise(F.col("t_mended"))
    reason = F.when(F.col("title").isNull() | F.col("day").isNull(), "NOT_PRINTED").when(F.col("_sits").isNull(), "NO_SITTING").when(n == 0, "NO_TITLE").when(n > 1, "SEVERAL").otherwise("LINKED")
    return asked.select("source", "title", "day", F.when((n == 1) & F.col("_sits"), target).alias("target"), rule.alias("rule"), reason.alias("reason"))


#: Types of reports that correct another, and that answer one.
CORRECTING, ANSWERING = ["CLARIFICATION", "WRITTEN_STATEMENT"], "ANSWER"


def link_types(links: DataFrame, correcting: list[str] = CORRECTING, answering: str = ANSWERING) -> DataFrame:
    """links (source, target, source_type, target_type, source_day, target_day) with type CORRECTION, REPLY or null; the first of a kind stays.

    A correcting source corrects a target of its day or before. A source that corrects nothing
    itself is corrected by a correcting target of its day or after. Other answers reply.
    """
    is_correction = F.coalesce(F.col("source_type").isin(correcting), F.lit(False))
    corrects = is_correction & (F.col("source_day") >= F.col("target_day"))
    corrected = ~is_correction & F.col("target_type").isin(correcting) & (F.col("target_day") >= F.col("source_day"))
    typed = links.withColumn("type", F.when(corrects | corrected, "CORRECTION").when(F.col("source_type").startswith(answering), "REPLY"))
    return typed.dropDuplicates(["source", "target", "type"])


def continuations(headings: DataFrame, reports: DataFrame) -> DataFrame:
    """(source, target): a resumed debate's last part on the printed earlier day, known and unique.

    headings: source, title, day, cited_day; reports: report_id, title, day, part.
    """
    earlier = headings.where(F.col("cited_day") < F.col("day")).withColumn("_k", title_key(F.col("title")))
    by = ["_k", "cited_day"]
    # A title's reports of a day are first reduced to their number and the ends of each part, then of the last part.
    parts = reports.groupBy(title_key(F.col("title")).alias("_k"), F.col("day").alias("cited_day"), "part").agg(F.count("*").alias("n"), F.min("report_id").alias("lo"), F.max("report_id").alias("hi"))
    last = F.max(F.struct("part", "lo", "hi"))
    days = parts.groupBy(*by).agg(F.sum("n").alias("n"), F.max(F.col("part").isNull()).alias("unknown"), last.alias("last")).select(*by, "n", "unknown", "last.*")
    w = W.partitionBy("source")
    found = earlier.select("source", *by).join(days, by)
    best = found.withColumns({"_n": F.sum("n").over(w), "_unknown": F.max("unknown").over(w), "_top": F.max("part").over(w)})
    best = best.where((F.col("_n") == 1) | (~F.col("_unknown") & (F.col("part") == F.col("_top"))))
    return best.groupBy("source").agg(F.min("lo").alias("target"), F.max("hi").alias("_max")).where("target = _max").drop("_max")


def _loose_links(asked: DataFrame, bills: DataFrame, by: list[str], most_days: int) -> DataFrame:
    """(by, lo, hi): the ends of the bills that share asked's loose key near the printed days.

    Bills are first reduced to the least and the greatest of each key and day, or of each key and
    set of days (a bill has a few readings); asked meets only those, in the buckets of its days.
    """
    bucket = lambda c: F.floor(F.unix_date(c) / (most_days + 1)).cast("long")
    around = lambda c: F.explode(F.array(*(bucket(F.col(c)) + k for k in (-1, 0, 1))))
    close = lambda day, to: F.abs(F.datediff(day, to)) <= most_days
    ends = lambda lo, hi: (F.min(lo).alias("lo"), F.max(hi).alias("hi"))
    days = bills.where("bill_id is not null and day is not null").select("bill_id", loose_title_key(F.col("key")).alias("k"), "day")
    asked = asked.select(*by, loose_title_key(F.col("key")).alias("k"))
    one = asked.where("first_day is null or third_day is null").withColumn("at", F.coalesce("first_day", "third_day")).where("at is not null")
    single = days.groupBy("k", "day").agg(*ends("bill_id", "bill_id")).withColumn("_b", bucket(F.col("day")))
    found = one.withColumn("_b", around("at")).join(single.hint("merge"), ["k", "_b"]).where(close("day", "at")).select(*by, "lo", "hi")
    both = asked.where("first_day is not null and third_day is not null").withColumn("_b", around("first_day")).withColumn("_c", around("third_day"))
    read = days.groupBy("k", "bill_id").agg(F.sort_array(F.collect_set("day")).alias("read")).groupBy("k", "read").agg(*ends("bill_id", "bill_id"))
    pairs = read.withColumn("day", F.explode("read")).withColumn("later", F.explode("read")).groupBy("k", "day", "later").agg(*ends("lo", "hi"))
    pairs = pairs.withColumns({"_b": bucket(F.col("day")), "_c": bucket(F.col("later"))})
    twice = both.join(pairs.hint("merge"), ["k", "_b", "_c"]).where(close("day", "first_day") & close("later", "third_day")).select(*by, "lo", "hi")
    return found.unionByName(twice).groupBy(*by).agg(*ends("lo", "hi"))


def act_links(acts: DataFrame, bills: DataFrame, most_days: int = 1) -> DataFrame:
    """(act_id, bill_id, rule): the bill of an act by title key and the nearest reading date.

    acts: act_id, key, first_day, second_day, third_day and, if titles may begin with an article,
    the_key (the key with it, null for others); bills: bill_id, key, day, a row for each reading.
    A key is tried with the first, third and second reading dates in that order; then as a loose
    key, which must have just one bill with a reading near the act's first one (its third, if that
    is all it prints) and, if both are printed, near both. All that is done with the_key first,
    then with the key.

    Acts with the same key and days are asked once and meet their answer last. No side of these
    joins is broadcast: rows that the files hold in few bytes would fill the memory.
    """
    days = ["first_day", "second_day", "third_day"]
    by = ["key", *days]
    keys = [F.struct(F.lit(turn).alias("_turn"), F.col(key).alias("key")) for turn, key in enumerate(("the_key", "key")) if key in acts.columns]
    own = acts.select("act_id", *days, F.inline(F.array(*keys))).where("key is not null")
    asked = own.select(*by).distinct()
    readings = [F.struct(F.lit(place).alias("place"), F.lit(rule).alias("rule"), F.col(day).alias("at")) for place, (rule, day) in enumerate((("FIRST", "first_day"), ("THIRD", "third_day"), ("SECOND", "second_day")))]
    left = asked.select(*by, F.inline(F.array(*readings))).where("at is not null")
    hits = nearest_join(left, bills.select("bill_id", "key", "day"), ["key"], [*by, "place"], "at", "day", most_days, ["bill_id"])
    hits = hits.select(*by, F.struct("place", "gap", "bill_id", "rule").alias("hit"))
    loose = _loose_links(asked, bills, by, most_days)
    answers = hits.unionByName(loose, allowMissingColumns=True).groupBy(*by).agg(F.min("hit").alias("hit"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"a.{c}")) for c in by]
    met = own.alias("o").join(answers.hint("merge").alias("a"), same).groupBy("act_id", "_turn").agg(F.min("hit").alias("hit"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    sole = F.when(F.col("lo") == F.col("hi"), F.struct(F.col("lo").alias("bill_id"), F.lit("LOOSE").alias("rule")))
    found = met.withColumn("_h", F.when(F.col("hit").isNotNull(), F.struct("hit.bill_id", "hit.rule")).otherwise(sole)).where("_h is not null")
    return found.groupBy("act_id").agg(F.min_by("_h", "_turn").alias("_h")).select("act_id", "_h.bill_id", "_h.rule")
