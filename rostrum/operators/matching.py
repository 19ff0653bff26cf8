"""Matching of titles and texts: similarity, alignment, printed places, repaired characters."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.operators.joins import mutual_unique


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio; only for pairs that a join has already narrowed down."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else None for x, y in zip(a, b, strict=True)], dtype="float64")


def split_bill_merges(heads: DataFrame, tails: DataFrame, block: str, least_ratio: float = 0.85, most_days: int = 800) -> DataFrame:
    """(head_id, tail_id): an unpassed head and a later passed tail of nearly the same title, each with no other partner.

    heads and tails: id, title, day and a block column in which partners must agree (such as
    the titles' first word), so the ratio is only taken of few pairs.
    """
    a = heads.select(block, F.col("id").alias("head_id"), F.col("title").alias("_a"), F.col("day").alias("_d"))
    b = tails.select(block, F.col("id").alias("tail_id"), F.col("title").alias("_b"), F.col("day").alias("_e"))
    near = a.join(b, block).where((F.datediff("_e", "_d") > 0) & (F.datediff("_e", "_d") <= most_days))
    # Lengths bound the ratio by 2 * min / (a + b), which spares most calls.
    bound = 2 * F.least(F.length("_a"), F.length("_b")) / (F.length("_a") + F.length("_b"))
    return mutual_unique(near.where(bound >= least_ratio).where(similarity("_a", "_b") >= least_ratio), "head_id", "tail_id")


def sequence_diff(old: DataFrame, new: DataFrame, key: str, place: str, item: str) -> DataFrame:
    """(key, op, old_from, old_to, new_from, new_to): how one ordered list of a document becomes the other.

    Items are compared by their sha-256; a document's lists are short and come together.
    """

    def both(df: DataFrame, side: int) -> DataFrame:
        return df.select(key, F.lit(side).alias("side"), F.col(place).cast("int").alias("place"), F.sha2(F.col(item).cast("binary"), 256).alias("h"))

    kind = old.schema[key].dataType.simpleString()

    def diff(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        a, b = (rows.loc[rows["side"] == side, "h"].tolist() for side in (0, 1))
        ops = SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
        return pd.DataFrame([(rows[key].iloc[0], *op) for op in ops], columns=[key, "op", "old_from", "old_to", "new_from", "new_to"])

    return both(old, 0).unionByName(both(new, 1)).groupBy(key).applyInPandas(diff, f"{key} {kind}, op string, old_from int, old_to int, new_from int, new_to int")


@F.pandas_udf(T.StringType())
def _repair(text: pd.Series) -> pd.Series:
    def run(found: re.Match) -> str:
        try:
            return found[0].encode("cp1252").decode("utf-8")
        except UnicodeError:
            return found[0]

    return text.map(lambda t: None if t is None else re.sub(r"[^\x00-\x7f]+", run, t))


def repair_mojibake(rows: DataFrame, text: str) -> DataFrame:
    """rows whose text's runs of non-ASCII characters are read anew as UTF-8 where they were decoded as cp1252.

    Rows in ASCII alone don't go through Python.
    """
    plain = ~F.coalesce(F.col(text).rlike(r"[^\x00-\x7f]"), F.lit(False))
    return rows.where(plain).unionByName(rows.where(~plain).withColumn(text, _repair(F.col(text))))


def printed_places(reports: DataFrame, sections: DataFrame, by: str) -> DataFrame:
    """(report_id, place, rule) of reports (by, report_id, title, subtitle, content[, number, is_assent]) among sections (by, place, title, subtitle, content).

    As if reports took their places one by one in the order of (number, report_id), each section
    once: an assent without a text stands first and has no place (ASSENT_FIRST); a content that
    one section alone has is its first report's (CONTENT). Then, among the sections left: the only
    one with the report's title (TITLE), else the only one with title and subtitle (SUBTITLE), else
    none (NOT_PLACED). As places are consumed, a title may come down to one section, which the
    next report with that title takes whatever its subtitle.

    No walk is needed. Of the n sections of a title those with a subtitle of their own go to the
    first report that has it, in the order of these reports, as long as two or more are left:
    n - 1 at most. If so many went, the last section is that of the first report after them.
    """
    from pyspark.sql.window import Window as W

    fold = lambda c: F.coalesce(F.lower(F.regexp_replace(c, r"(?U)[\W_]+", "")), F.lit(""))
    number = F.col("number") if "number" in reports.columns else F.lit(0)
    assent = F.coalesce(F.col("is_assent"), F.lit(False)) & (F.coalesce("content", F.lit("")) == "") if "is_assent" in reports.columns else F.lit(False)
    content = F.sha2(F.col("content").cast("binary"), 256)
    keys = [F.col(by).alias("_by"), fold(F.col("title")).alias("_title"), fold(F.col("subtitle")).alias("_sub"), content.alias("_content")]
    all_reports = reports.select("report_id", F.struct(number.alias("n"), F.col("report_id").alias("r")).alias("_at"), assent.alias("_assent"), *keys)
    asked, free = all_reports.where("not _assent"), sections.select("place", *keys)
    once = free.where("_content is not null").groupBy("_by", "_content").agg(F.min("place").alias("place"), F.count("*").alias("_n")).where("_n = 1").drop("_n")
    first = asked.where("_content is not null").groupBy("_by", "_content").agg(F.min_by("report_id", "_at").alias("report_id"))
    by_content = first.join(once, ["_by", "_content"]).select("report_id", "_by", "place")
    asked = asked.join(by_content.select("report_id"), "report_id", "left_anti")
    free = free.join(by_content.select("_by", "place"), ["_by", "place"], "left_anti").select("_by", "_title", "_sub", "place")
    sizes = free.groupBy("_by", "_title").agg(F.count("*").alias("_n"))
    own = free.groupBy("_by", "_title", "_sub").agg(F.min("place").alias("place"), F.count("*").alias("_c")).where("_c = 1").drop("_c")
    takers = asked.groupBy("_by", "_title", "_sub").agg(F.min(F.struct("_at", "report_id")).alias("_f")).select("_by", "_title", "_sub", "_f.*").join(own, ["_by", "_title", "_sub"]).join(sizes, ["_by", "_title"])
    takers = takers.withColumn("_k", F.row_number().over(W.partitionBy("_by", "_title").orderBy("_at"))).where("_k < _n")
    gone = takers.groupBy("_by", "_title").agg(F.count("*").alias("_gone"), F.max("_at").alias("_after"))
    left = free.join(takers.select("_by", "place"), ["_by", "place"], "left_anti").groupBy("_by", "_title").agg(F.min("place").alias("place"), F.count("*").alias("_left")).where("_left = 1")
    left = left.join(gone, ["_by", "_title"], "left")
    later = asked.join(left, ["_by", "_title"]).where(F.col("_after").isNull() | (F.col("_at") > F.col("_after")))
    by_title = later.groupBy("_by", "_title").agg(F.min_by(F.struct("report_id", "place"), "_at").alias("_f"))
    found = by_content.select("report_id", "place", F.lit("CONTENT").alias("rule")).unionByName(takers.select("report_id", "place", F.lit("SUBTITLE").alias("rule"))).unionByName(by_title.select("_f.report_id", "_f.place", F.lit("TITLE").alias("rule")))
    return all_reports.select("report_id", "_assent").join(found, "report_id", "left").select("report_id", "place", F.coalesce("rule", F.when(F.col("_assent"), "ASSENT_FIRST").otherwise("NOT_PLACED")).alias("rule"))


def put_to_phrase(text: Column) -> Column:
    """The office after 'asked the' or 'To ask the', up to a comma, 'whether' or a list mark; null without one."""
    found = F.regexp_extract(text, r"(?:asked|[Tt]o ask) the ([A-Z][A-Za-z ,'’&-]*?)(?=\s*(?:\(|:|\b(?:whether|what|how|if|when|why|who|which)\b|$))", 1)
    return F.nullif(F.trim(F.regexp_replace(found, r"[,\s]+$", "")), F.lit(""))


_DAY = r"(\d{1,2}\s+[A-Z][a-z]{2,8}(?:\s+\d{4})?)"
_DASH = r"\s*(?:to|[-–—])\s*"
#: Forms of a printed leave entry, the first that fits: (name, pattern, group of the first date, of the last).
LEAVE_FORMS = [
    ("TABLE_ROW", rf"^\s*\|[^|]+\|\s*{_DAY}\s*\|\s*{_DAY}\s*\|?\s*$", 1, 2),
    ("PROSE_MIXED", rf"{_DAY}{_DASH}{_DAY}\s*(?:,|and|;)\s*(?:on\s+)?\d{{1,2}}\s", 1, 2),
    ("STRUCTURED_LIST", rf"^\s*(?:[-•]|\(?[a-z0-9]{{1,3}}[).])\s.*?{_DAY}{_DASH}{_DAY}", 1, 2),
    ("PROSE_RANGE", rf"{_DAY}{_DASH}{_DAY}", 1, 2),
    ("PROSE_DURATION", rf"(\d+)\s+(day|week|month|year)s?\s+from\s+{_DAY}", 3, 0),
    ("PROSE_DAY_LIST", rf"(?:on\s+)?(\d{{1,2}}(?:\s*,\s*\d{{1,2}})*\s+and\s+\d{{1,2}}\s+[A-Z][a-z]{{2,8}}(?:\s+\d{{4}})?)", 1, 1),
    ("PROSE_SINGLE_DAY", rf"(?:on\s+)?{_DAY}", 1, 1),
]
_DURATION = LEAVE_FORMS[4][1]


def parse_leave(text: Column) -> dict[str, Column]:
    """form, first, last (as printed), number and unit of a leave entry; UNREAD if nothing fits."""
    form, first, last = F.lit("UNREAD"), F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, pattern, a, b in reversed(LEAVE_FORMS):
        hit = text.rlike(pattern)
        form = F.when(hit, name).otherwise(form)
        first = F.when(hit, F.regexp_extract(text, pattern, a)).otherwise(first)
        last = F.when(hit, F.regexp_extract(text, pattern, b) if b else F.lit(None)).otherwise(last)
    lasts = form == "PROSE_DURATION"
    number, unit = (F.regexp_extract(text, _DURATION, g) for g in (1, 2))
    return {"form": form, "first": first, "last": last, "number": F.when(lasts, number.try_cast("int")), "unit": F.when(lasts, unit)}


def asker_sources(sources: list[tuple[str, DataFrame]], report: str, order: str, speaker_id: str, printed: str) -> DataFrame:
    """(report, ordinal, speaker_id, printed, source): the askers that several sources name, each once, by the first source that has them.

    sources in their order of trust (such as the call of the question, its list entry, the
    heading, the bracketed office, the reply), each (report, order, speaker_id, printed). A
    printed name of a person whom another source identifies is theirs.
    """
    from functools import reduce

    from pyspark.sql.window import Window as W

    one = reduce(DataFrame.unionByName, (df.select(report, order, speaker_id, printed, F.lit(k).alias("_rank"), F.lit(name).alias("source")) for k, (name, df) in enumerate(sources)))
    known = one.where(F.col(speaker_id).isNotNull() & F.col(printed).isNotNull()).groupBy(report, printed).agg(F.min(speaker_id).alias("_id"), F.max(speaker_id).alias("_other")).where("_id = _other").drop("_other")
    one = one.join(known, [report, printed], "left").withColumn(speaker_id, F.coalesce(speaker_id, "_id"))
    who = F.coalesce(F.concat(F.lit("#"), F.col(speaker_id).cast("string")), F.col(printed))
    keyed = one.where(who.isNotNull()).withColumn("_who", who)
    best = keyed.withColumn("_n", F.row_number().over(W.partitionBy(report, "_who").orderBy("_rank", order, F.col(printed).asc_nulls_last()))).where("_n = 1")
    return best.select(report, F.row_number().over(W.partitionBy(report).orderBy(order, "_rank", "_who")).alias("ordinal"), speaker_id, printed, "source")


def askers(rows: DataFrame, report: str, order: str, speaker_id: str, printed: str) -> DataFrame:
    """(report, ordinal, speaker_id, printed): the first row of each asker, who is a speaker if known, else a printed name."""
    from pyspark.sql.window import Window as W

    who = F.coalesce(F.concat(F.lit("#"), F.col(speaker_id).cast("string")), F.col(printed))
    keyed = rows.where(who.isNotNull()).withColumn("_who", who)
    first = keyed.withColumn("_n", F.row_number().over(W.partitionBy(report, "_who").orderBy(order))).where("_n = 1")
    return first.withColumn("ordinal", F.row_number().over(W.partitionBy(report).orderBy(order))).select(report, "ordinal", speaker_id, printed)


def participants(turns: DataFrame, report: str, roles: list[tuple[str, Column]]) -> DataFrame:
    """(report, ordinal, speaker, role, first_ordinal): each speaker once for each role they have.

    turns: report, ordinal, speaker; roles in their order, by condition. Ordinals follow the first
    turn, then the roles' order.
    """
    from pyspark.sql.window import Window as W

    marks = F.filter(F.array(*(F.when(c, F.struct(F.lit(k).alias("rank"), F.lit(name).alias("role"))) for k, (name, c) in enumerate(roles))), lambda x: x.isNotNull())
    held = turns.where(F.col("speaker").isNotNull()).select(report, "ordinal", "speaker", F.explode(marks).alias("r"))
    first = held.groupBy(report, "speaker", "r").agg(F.min("ordinal").alias("first_ordinal"))
    order = W.partitionBy(report).orderBy("first_ordinal", "r.rank", "speaker")
    return first.select(report, F.row_number().over(order).alias("ordinal"), "speaker", "r.role", "first_ordinal")


def question_roles(turns: DataFrame, report: str) -> DataFrame:
    """(report, speaker, role, first_ordinal): who does what in a question's report.

    turns: report, ordinal, speaker (null without a label), is_question, for_whom (whose question is
    read), has_office, is_chair. ASKER: whose question it is; READER: who reads another's;
    ABSENT_FILER: an asker who has no turn; CHAIR; ANSWERER: office holders after the first
    question, askers aside; FOLLOW_UP: askers' further turns after the first answer;
    SUPPLEMENTARY: other members' turns after it; UNLABELLED: turns without a speaker. Reports
    without a question have no roles.
    """
    from pyspark.sql.window import Window as W

    whole = W.partitionBy(report)
    asks = F.col("is_question")
    rows = turns.withColumns({"_asker": F.when(asks, F.coalesce("for_whom", "speaker")), "_first": F.min(F.when(asks, F.col("ordinal"))).over(whole)}).where("_first is not null")
    askers = rows.where("_asker is not null").select(report, F.col("_asker").alias("speaker")).distinct().withColumn("_asks", F.lit(True))
    readers = rows.where(asks & F.col("for_whom").isNotNull() & F.col("speaker").isNotNull()).select(report, "speaker").distinct().withColumn("_reads", F.lit(True))
    rows = rows.join(askers, [report, "speaker"], "left").join(readers, [report, "speaker"], "left")
    answers = F.col("has_office") & ~F.col("is_chair") & ~asks & (F.col("ordinal") > F.col("_first")) & F.col("speaker").isNotNull() & F.col("_asks").isNull()
    rows = rows.withColumn("_answered", F.min(F.when(answers, F.col("ordinal"))).over(whole))
    later = F.col("ordinal") > F.col("_answered")
    plain = ~asks & ~F.col("is_chair") & F.col("speaker").isNotNull()
    marks = [
        ("ASKER", asks, F.col("_asker")),
        ("READER", asks & F.col("for_whom").isNotNull(), F.col("speaker")),
        ("CHAIR", F.col("is_chair"), F.col("speaker")),
        ("ANSWERER", answers, F.col("speaker")),
        ("FOLLOW_UP", plain & F.col("_asks").isNotNull() & later, F.col("speaker")),
        ("SUPPLEMENTARY", plain & ~F.col("has_office") & F.col("_asks").isNull() & F.col("_reads").isNull() & later, F.col("speaker")),
        ("UNLABELLED", F.col("speaker").isNull() & ~F.col("is_chair"), F.lit("")),
    ]
    found = F.filter(F.array(*(F.when(c & who.isNotNull(), F.struct(F.lit(name).alias("role"), who.alias("who"))) for name, c, who in marks)), lambda x: x.isNotNull())
    held = rows.select(report, "ordinal", F.explode(found).alias("_m")).groupBy(report, F.col("_m.who").alias("speaker"), F.col("_m.role").alias("role")).agg(F.min("ordinal").alias("first_ordinal"))
    spoken = turns.where("speaker is not null").select(report, "speaker").distinct()
    absent = held.where("role = 'ASKER'").join(spoken, [report, "speaker"], "left_anti").withColumn("role", F.lit("ABSENT_FILER"))
    return held.unionByName(absent)


def question_states(reports: DataFrame, turns: DataFrame, roles: DataFrame, report: str, patterns: dict[str, str]) -> DataFrame:
    """(report, state, ordinal): CORRECTION, URGENT, NOT_ASKED_ALOUD and NOT_A_QUESTION of reports (report, title).

    patterns by name: correction and stood_over are of titles; urgent, absent and not_aloud of
    turns (report, ordinal, transcript), whose first match is the state's ordinal. A question was
    not asked aloud if it stood over, if the asker was absent, or if it has an asker, no answerer
    and a turn that says so. A report without an asker is not a question.
    """
    first = lambda name: F.min(F.when(F.col("transcript").rlike(patterns[name]), F.col("ordinal"))).alias(f"_{name}")
    seen = turns.groupBy(report).agg(*(first(n) for n in ("urgent", "absent", "not_aloud")))
    held = roles.groupBy(report).agg(F.bool_or(F.col("role") == "ASKER").alias("_asked"), F.bool_or(F.col("role") == "ANSWERER").alias("_answered"))
    rows = reports.join(seen, report, "left").join(held, report, "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("_asked", "_answered")})
    stood = F.col("title").rlike(patterns["stood_over"])
    silent = F.when(stood, F.lit(None).cast("int")).otherwise(F.coalesce("_absent", F.when(F.col("_asked") & ~F.col("_answered"), F.col("_not_aloud"))))
    states = [
        ("CORRECTION", F.col("title").rlike(patterns["correction"]), F.lit(None).cast("int")),
        ("URGENT", F.col("_urgent").isNotNull(), F.col("_urgent")),
        ("NOT_ASKED_ALOUD", stood | silent.isNotNull(), silent),
        ("NOT_A_QUESTION", ~F.col("_asked"), F.lit(None).cast("int")),
    ]
    found = F.filter(F.array(*(F.when(c, F.struct(F.lit(name).alias("state"), at.cast("int").alias("ordinal"))) for name, c, at in states)), lambda x: x.isNotNull())
    return rows.select(report, F.explode(found).alias("_s")).select(report, "_s.state", "_s.ordinal")


def footnote_lines(line_rows: DataFrame, key: str, marker: str, body: int) -> DataFrame:
    """line_rows with is_footnote: lines that match the marker and those after them, until a line of body text.

    marker and body (its least length) are what the caller's print uses.
    """
    from pyspark.sql.window import Window as W

    is_marker = F.col("line").rlike(marker)
    mark = F.when(is_marker, F.lit(True)).when(F.length("line") >= body, F.lit(False))
    inside = F.last(mark, ignorenulls=True).over(W.partitionBy(key).orderBy("place").rowsBetween(W.unboundedPreceding, 0))
    return line_rows.withColumn("is_footnote", F.coalesce(inside, F.lit(False)))


def speech_columns(speeches: DataFrame, markers: DataFrame, by: str, most_step: int = 50, heads: DataFrame | None = None) -> DataFrame:
    """speeches (by, id, offset) with printed_column and status: the last marker at or before the offset.

    CONFIRMED if the next different marker is one more; BROKEN_SEQUENCE if it steps back or by
    over most_step; else SKIPPED_COLUMN. heads: (by, first, last), the columns that a report's
    head prints. Before the first marker the column is the head's first if the marker is one more
    (HEAD), else unknown (BEFORE_FIRST). After the last marker it is the marker's (LAST), unless
    the head goes on past it (PAST_LAST) or the step to it was a broken one (BROKEN_SEQUENCE).
    """
    from pyspark.sql.window import Window as W

    w = W.partitionBy(by).orderBy("offset")
    runs = markers.withColumn("_new", F.coalesce(F.col("number") != F.lag("number").over(w), F.lit(True))).where("_new").drop("_new")
    runs = runs.select(by, F.col("offset").alias("_at"), "number", F.lead("number").over(w).alias("_next"), F.lag("number").over(w).alias("_prior"))
    both = speeches.select(by, "offset", F.lit(1).alias("_s"), F.col("id")).unionByName(runs.select(by, F.col("_at").alias("offset"), F.lit(0).alias("_s"), F.struct("number", "_next", "_prior").alias("_m")), allowMissingColumns=True)
    order = W.partitionBy(by).orderBy("offset", "_s")
    seen = both.withColumns({"_first": F.first("_m", ignorenulls=True).over(order.rowsBetween(0, W.unboundedFollowing)), "_m": F.last("_m", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0))}).where("_s = 1")
    heads = heads if heads is not None else seen.select(by, F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last")).limit(0)
    seen = seen.join(heads.select(by, F.col("first").alias("_head"), F.col("last").alias("_end")), by, "left")
    broken = lambda step: (step < 0) | (step > most_step)
    step, into = F.col("_m._next") - F.col("_m.number"), F.col("_m.number") - F.col("_m._prior")
    at_end = F.when(F.col("_end") > F.col("_m.number"), "PAST_LAST").when(broken(into), "BROKEN_SEQUENCE").otherwise("LAST")
    status = F.when(F.col("_m").isNull(), F.when(F.col("_head") == F.col("_first.number") - 1, "HEAD").otherwise("BEFORE_FIRST")).when(step.isNull(), at_end).when(step == 1, "CONFIRMED").when(broken(step), "BROKEN_SEQUENCE").otherwise("SKIPPED_COLUMN")
    return seen.select(by, "id", F.when(status == "HEAD", F.col("_head")).when(status.isin("CONFIRMED", "LAST"), F.col("_m.number")).alias("printed_column"), status.alias("status"))
