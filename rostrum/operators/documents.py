"""Documents to rows: lines, turns, kinds, sections, counts, citations, links."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rostrum.functions.names import _let, last_brackets, squeeze

#: What a line of procedure speaks of, and what is done to it: a small grammar, a parameter of `procedural`.
PROCEDURE_SUBJECTS = ["question", "motion", "amendment", "bill", "clause", "division", "order", "resolution", "schedule", "debate", "sitting", "house", "committee", "council", "assembly"]
PROCEDURE_ACTS = ["put", "proposed", "made", "agreed", "negatived", "carried", "withdrawn", "read", "committed", "considered", "reported", "presented", "taken", "ordered", "divided", "suspended", "resumed", "adjourned"]
PROCEDURE_WORDS = ["resolved", "adjourned accordingly", "thereupon"]


def procedural(subjects: list[str] = PROCEDURE_SUBJECTS, acts: list[str] = PROCEDURE_ACTS, words: list[str] = PROCEDURE_WORDS, between: int = 4) -> str:
    """A pattern of lines such as 'Original Question again put': a subject as first or second word and, a few words on, an act."""
    one = lambda xs: "(?:" + "|".join(xs) + ")"
    return rf"(?i:(?:\w+ )?{one(subjects)}s?,?(?: [\w,]+){{0,{between}}}? {one(acts)}\b|{one(words)}\b)"


PROCEDURAL = [procedural()]
CHAMBER_EVENT = [r"\((?:Applause|Laughter|Interruption|Hon\. Members?[^)]*)\.?\)", r"\[(?:Applause|Laughter|Interruption)[^\]]*\]", r"\[(?:Mr|Mdm) (?:Deputy )?Speaker in the Chair\]"]
#: What an editor adds: where else to look, and in whose name a paper stood. Parameters of `editorial`.
NOTE_OPENINGS = ["please refer to", "see appendix", "see annex", "see also", "reproduced from"]
STANDING_PAPERS = ["motion", "amendment", "question", "notice"]
HEADING = [r"\*\*[^*]+\*\*$", r"#+ ", r"[A-Z][A-Z ,'&-]{8,}$"]
#: How the text of a paper begins: what it does, and to whom or to which place in a document. Parameters of `of_a_paper`.
PAPER_OPENINGS = {"To ask": ["Minister", "Secretary", "Attorney-General"], "That": ["House", "Parliament", "Assembly", "Council"], "In": ["page", "clause", "line", "schedule"]}


def editorial(openings: list[str] = NOTE_OPENINGS, papers: list[str] = STANDING_PAPERS) -> str:
    """A pattern of notes such as '[Please refer to ...]' and '*The motion also stood in the name of ...'."""
    one = lambda xs: "(?:" + "|".join(x.replace(" ", r"\s+") for x in xs) + ")"
    return rf"(?i:[\[(*+#]*\s*(?:{one(openings)}\b|the (?:\w+ )?{one(papers)}s? (?:\w+ )?stood in the names?\b))"


def of_a_paper(openings: dict[str, list[str]] = PAPER_OPENINGS, between: int = 3) -> str:
    """A pattern of lines such as '3. To ask the Prime Minister', '"That this House' and 'In page 4': an opening and, few words on, its object."""
    each = [rf"{verb}\s+(?:[\w-]+\s+){{0,{between}}}?(?:{'|'.join(objects)})s?\b" for verb, objects in openings.items()]
    return r"(?:[\d(][\d.)]*\s+)?[\"“‘]?(?:" + "|".join(each) + ")"


EDITORIAL_NOTE, DOCUMENT_TEXT = [editorial()], [of_a_paper()]
KINDS = [("DOCUMENT_TEXT", DOCUMENT_TEXT), ("EDITORIAL_NOTE", EDITORIAL_NOTE), ("CHAMBER_EVENT", CHAMBER_EVENT), ("PROCEDURAL", PROCEDURAL), ("HEADING", HEADING)]
#: A speaker's label at the start of a line: a title and a name, an office, or bold text, up to a colon.
LABEL = r"^\*{0,2}((?:Mr|Mrs|Ms|Mdm|Miss|Dr|Prof|The|Assoc\.? Prof\.?|Er|Encik|Inche)\b[^:*\n]{1,80}|[A-Z][^:*\n]{1,60})\*{0,2}\s*:\*{0,2}\s*"
LANGUAGE_NOTE = r"(?i)^[_*]*\(\s*[_*]*\s*(?:in|dalam)\s+(\w+)\s*[_*]*\s*\)[_*]*\s*:?\s*"
EVENT = r"[\[(](?:Applause|Laughter|Interruption|Resounding [a-z]+)[^\])]*[\])]"


def lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, place, line), places from 0."""
    return docs.select(key, F.posexplode(F.split(F.col(text), "\n", -1)).alias("place", "line"))


def classify_kind(line: Column, kinds: list[tuple[str, list[str]]] | None = None) -> Column:
    """The first kind one of whose patterns a line begins with; SPEECH otherwise."""
    out = None
    for name, patterns in kinds or KINDS:
        hit = line.rlike(("^(?:" if name == "HEADING" else r"^[\s*_]*(?:") + "|".join(patterns) + ")")
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("SPEECH")


def split_turns(line_rows: DataFrame, key: str, label: str = LABEL, kinds: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """(key, ordinal, speaker, kind, transcript): a label begins a turn, its lines go on to the next.

    Lines of other kinds than speech stand apart, without a speaker, and end the turn. Lines
    before the first label have no speaker. Turns are islands over the running count of
    beginnings, so one sort a document does it all.
    """
    w = W.partitionBy(key).orderBy("place")
    rows = line_rows.where(F.trim("line") != "").withColumn("kind", classify_kind(F.col("line"), kinds))
    rows = rows.withColumn("_label", F.when(F.col("kind") == "SPEECH", F.nullif(F.trim(F.regexp_extract("line", label, 1)), F.lit(""))))
    reset = F.col("kind") != "SPEECH"
    mark = F.when(reset | F.col("_label").isNotNull(), F.struct(F.col("_label").alias("v")))
    rows = rows.withColumns({"speaker": F.last(mark, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))["v"], "_begins": reset | F.col("_label").isNotNull() | F.coalesce(F.lag(reset).over(w), F.lit(True))})
    rows = rows.withColumns({"_turn": F.sum(F.col("_begins").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)), "_text": F.trim(F.when(F.col("_label").isNotNull(), F.regexp_replace("line", label, "")).otherwise(F.col("line")))})
    speaker = F.when(F.col("kind") == "SPEECH", F.col("speaker"))
    turns = rows.groupBy(key, "_turn").agg(F.min("place").alias("_at"), F.first(speaker, ignorenulls=True).alias("speaker"), F.min("kind").alias("kind"), F.array_sort(F.collect_list(F.struct("place", "_text"))).alias("_l"))
    text = F.concat_ws("\n", F.transform("_l", lambda x: x["_text"]))
    return turns.select(key, F.row_number().over(W.partitionBy(key).orderBy("_at")).alias("ordinal"), "speaker", "kind", text.alias("transcript"))


def split_events(rows: DataFrame, keys: list[str], text: str, event: str = EVENT) -> DataFrame:
    """(keys, part, kind, transcript): each paragraph without its bracketed events, then the events in order."""
    events = F.regexp_extract_all(F.col(text), F.lit(f"({event})"), F.lit(1))
    rest = F.trim(F.regexp_replace(F.regexp_replace(F.col(text), r"\s*" + event + r"\s*", " "), r"\s+([.,])", "$1"))
    parts = F.concat(F.array(F.struct(F.lit("SPEECH").alias("kind"), rest.alias("t"))), F.transform(events, lambda e: F.struct(F.lit("CHAMBER_EVENT").alias("kind"), e.alias("t"))))
    return rows.select(*keys, F.posexplode(parts).alias("part", "_p")).select(*keys, "part", "_p.kind", F.col("_p.t").alias("transcript")).where("transcript <> ''")


def language_note(text: Column) -> tuple[Column, Column]:
    """(language, text without its note)."""
    return F.nullif(F.initcap(F.regexp_extract(text, LANGUAGE_NOTE, 1)), F.lit("")), F.regexp_replace(text, LANGUAGE_NOTE, "")


def start_line(line_rows: DataFrame, titles: DataFrame, key: str, title: str, prefix: int = 20) -> DataFrame:
    """(key, start, rule): where the speech begins, by the first rule that a line fits; the first such line, -1 if there is none.

    Letters and digits alone are compared: EQUAL to the title; BARE, to the title without its
    brackets; PREFIX, begins with the title's first `prefix` characters; PART, a line of at
    least so many that the title begins with; HOLDS the title; ENDS the title; else BOLD.
    """
    fold = lambda c: F.lower(F.regexp_replace(c, r"[^0-9A-Za-z]+", ""))
    joined = line_rows.join(titles.select(key, fold(F.col(title)).alias("_t"), fold(F.regexp_replace(F.col(title), r"\([^()]*\)", "")).alias("_b")), key)
    f, t, long = fold(F.col("line")), F.col("_t"), F.length("_t") >= prefix
    rules = [
        ("EQUAL", (f == t) & (t != "")),
        ("BARE", (f == F.col("_b")) & (F.col("_b") != "")),
        ("PREFIX", long & f.startswith(F.substring("_t", 1, prefix))),
        ("PART", (F.length(f) >= prefix) & t.startswith(f)),
        ("HOLDS", long & f.contains(t)),
        ("ENDS", (F.length(f) >= prefix) & t.endswith(f)),
        ("BOLD", F.col("line").rlike(r"^\*\*[^*]+\*\*")),
    ]
    found = joined.groupBy(key).agg(*(F.min(F.when(c, F.col("place"))).alias(n) for n, c in rules))
    rule = F.coalesce(*(F.when(F.col(n).isNotNull(), F.lit(n)) for n, _ in rules))
    return found.select(key, (F.coalesce(*(F.col(n) for n, _ in rules), F.lit(-1))).cast("int").alias("start"), rule.alias("rule"))


def section_lines(line_rows: DataFrame, key: str, header: str, end: str) -> DataFrame:
    """Lines between a header line and the next line that ends a section: (key, section, place, line)."""
    w = W.partitionBy(key).orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    head, stop = F.col("line").rlike(header), F.col("line").rlike(end)
    marked = line_rows.withColumns({"_head": head, "section": F.sum(head.cast("int")).over(w), "_open": F.last(F.when(head, True).when(stop, False), ignorenulls=True).over(w)})
    return marked.where(F.col("_open") & ~F.col("_head")).select(key, "section", "place", "line")


def parse_entries(line_rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, entry, name, place_name, office) of lines such as 'Mr A B (Place), Minister; Ms C D (Place).'"""
    entries = F.filter(F.transform(F.split(F.col("line"), r"[;|]"), lambda x: F.trim(F.regexp_replace(x, r"[.\s]+$", ""))), lambda x: x != "")
    rows = line_rows.select(*keys, F.posexplode(entries).alias("entry", "_e"))
    part = lambda g: F.nullif(F.trim(F.regexp_extract("_e", r"^([^(,]*)(?:\(([^)]*)\))?\s*(?:,\s*(.*))?$", g)), F.lit(""))
    return rows.select(*keys, "entry", part(1).alias("name"), part(2).alias("place_name"), part(3).alias("office"))


def parse_counts(text: Column) -> dict[str, Column]:
    """Counts of a division line ('Ayes, 12; Noes, 3; Abstentions, 1') or of a spoken total ('there are 12 Ayes')."""
    sides = {"ayes": "ayes?", "noes": "noes?", "abstentions": "abstentions?", "absent": "absent"}
    out = {}
    for name, label in sides.items():
        after = F.regexp_extract(text, rf"(?i)\b{label}\b[\s,:.\-–—]{{0,4}}(\d+)", 1)
        before = F.regexp_extract(text, rf"(?i)\b(\d+)\s+[\"“']?{label}\b", 1)
        out[name] = F.coalesce(F.nullif(after, F.lit("")), F.nullif(before, F.lit(""))).try_cast("int")
    return out


def division_names(line_rows: DataFrame, key: str, header: str = r"(?i)^\s*(ayes|noes|abstentions|absent)\b[^A-Za-z0-9]*(\d+)?") -> DataFrame:
    """(key, side, n, name) of lists printed in columns under the headers of their sides.

    Names stand side by side, parted by two or more spaces, a bar or a semicolon; a line without
    letters or of one side's header holds none.
    """
    w = W.partitionBy(key).orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    side = F.nullif(F.lower(F.regexp_extract("line", header, 1)), F.lit(""))
    rows = line_rows.withColumns({"_head": side, "side": F.last(side, ignorenulls=True).over(w)}).where(F.col("side").isNotNull() & F.col("_head").isNull())
    cells = F.filter(F.transform(F.split("line", r"\s{2,}|\s*[|;]\s*"), lambda c: F.trim(F.regexp_replace(c, r"[.,]+$", ""))), lambda c: c.rlike("[A-Za-z]"))
    names = rows.select(key, "side", "place", F.posexplode(cells).alias("_c", "name"))
    return names.select(key, "side", F.row_number().over(W.partitionBy(key, "side").orderBy("place", "_c")).alias("n"), "name")


def resumed_day(heading: Column) -> Column:
    """The day that a resumption heading cites, as '[Debate resumed from 3 May 2018]' or 'Order read for resumption of debate (2 March 1999)'."""
    printed = F.regexp_extract(heading, r"(?i)\bresum(?:ed|ption)\b.*?\b(\d{1,2}(?:st|nd|rd|th)?\s+[A-Za-z]+,?\s+\d{4})", 1)
    tidy = squeeze(F.regexp_replace(F.regexp_replace(printed, r"(?<=\d)(?:st|nd|rd|th)", ""), ",", " "))
    return F.coalesce(F.try_to_date(tidy, "d MMMM yyyy"), F.try_to_date(tidy, "d MMM yyyy"))


def history_fields(text: Column) -> dict[str, Column]:
    """title, first_reading, third_reading, assent and commencement of one block of a statute's history."""

    def day(label: str) -> Column:
        return F.try_to_date(squeeze(F.regexp_extract(text, rf"(?im)^\s*{label}\s*:?\s*(\d{{1,2}}\s+[A-Za-z]+\s+\d{{4}})", 1)), "d MMMM yyyy")

    return {
        "title": F.nullif(squeeze(F.regexp_extract(text, r"^\s*\d+\.\s+([^\n]*)", 1)), F.lit("")),
        "first_reading": day("(?:date of )?first reading"),
        "third_reading": day("(?:date of )?(?:second and )?third reading"),
        "assent": day("(?:date of )?assent"),
        "commencement": day("(?:date of )?commencement"),
    }


#: Words that tell an office from a name or a place.
OFFICE_WORDS = ["minister", "secretary", "speaker", "whip", "leader", "attorney", "chairman", "president", "mayor"]


def label_office(label: Column, words: list[str] = OFFICE_WORDS) -> Column:
    """The office that a speaker's label prints: before the brackets of 'Minister for X (Mr A)', or inside those of 'Mr A (Minister (Health) for X)'.

    Brackets may hold others; of several groups in a row the last that names an office counts.
    """
    is_office = lambda c: c.rlike(r"(?i)\b(?:" + "|".join(words) + r")\b")

    def named(last: Column, previous: Column) -> Column:
        bare = F.coalesce(previous["before"], last["before"], F.trim(label))
        plain = F.when(~bare.contains("("), bare)
        return F.when(is_office(plain), F.trim(plain)).when(is_office(last["inside"]), last["inside"]).when(is_office(previous["inside"]), previous["inside"])

    return _let(last_brackets(label), lambda last: _let(last_brackets(last["before"]), lambda previous: named(last, previous)))


def citations(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, n, title, day) of notes '[Please refer to "Title", Official Report, 3 May 2018, Vol 94, ...]'."""
    notes = F.regexp_extract_all(F.col(text), F.lit(r"(?i)\[\s*Please\s+refer\s+to(.*?)\]"), F.lit(1))
    found = rows.select(*keys, F.posexplode(notes).alias("n", "_note"))
    day = F.regexp_extract("_note", r"(?i)Official\s+Report[,\s]+(\d{1,2}(?:st|nd|rd|th)?\s+[A-Za-z]+[,\s]+\d{4})", 1)
    tidy = F.regexp_replace(F.regexp_replace(day, r"(?i)(\d)(?:st|nd|rd|th)\b", "$1"), r"[,\s]+", " ")
    titles = F.regexp_extract_all("_note", F.lit("[\"“]([^\"”]+)[\"”]"), F.lit(1))
    return found.select(*keys, "n", F.explode_outer(titles).alias("title"), F.coalesce(F.try_to_date(tidy, "d MMMM yyyy"), F.try_to_date(tidy, "d MMM yyyy")).alias("day"))


def links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, n, href, shape): FILE, ANCHOR, ABSOLUTE or RELATIVE."""
    found = pages.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(r"(?i)<a\s[^>]*?href=\"([^\"]*)\""), F.lit(1))).alias("n", "href"))
    shape = F.when(F.col("href").rlike(r"(?i)\.(?:pdf|docx?|xlsx?)$"), "FILE").when(F.col("href").startswith("#"), "ANCHOR").when(F.col("href").rlike("^https?://"), "ABSOLUTE").otherwise("RELATIVE")
    return found.withColumn("shape", shape)


#: A data address; in a quoted src its base64 may be broken into lines, as encoders do after 76 characters.
_PICTURE = r"(?i)((?<=\bsrc\s{0,9}=\s{0,9}[\"'])data:image/[a-z+]+;base64,[A-Za-z0-9+/=\s]+|data:image/[a-z+]+;base64,[A-Za-z0-9+/=]+)"


def inline_pictures(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, n, media_type, bytes, sha256) of base64 data addresses, also of those broken into lines."""
    found = pages.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(_PICTURE), F.lit(1))).alias("n", "_d"))
    data = F.unbase64(F.regexp_extract("_d", r"(?s)base64,(.*)$", 1))
    return found.select(key, "n", F.lower(F.regexp_extract("_d", r"(?i)^data:(image/[a-z+]+)", 1)).alias("media_type"), F.length(data).alias("bytes"), F.sha2(data, 256).alias("sha256"))


def override_range(rows: DataFrame, key: str, order: str, column: str, starts: Column, ends: Column, value: Column) -> DataFrame:
    """rows whose column is replaced from the first row that `starts` holds for to the first from there on that `ends` holds for."""
    first = F.min(F.when(starts, F.col(order))).over(W.partitionBy(key))
    a = rows.withColumn("_from", first)
    last = F.min(F.when(ends & (F.col(order) >= F.col("_from")), F.col(order))).over(W.partitionBy(key))
    b = a.withColumn("_to", last)
    inside = F.coalesce(F.col(order).between(F.col("_from"), F.col("_to")), F.lit(False))
    return b.withColumn(column, F.when(inside, value).otherwise(F.col(column))).drop("_from", "_to")


def join_cut_paragraphs(line_rows: DataFrame, key: str, marker: str = r"^\s*(?:Column|Page):?\s*\d+\s*$") -> DataFrame:
    """(key, place, line): paragraphs that a page or column marker cut are joined; the markers go.

    A line goes on after a marker if it doesn't end a sentence and the next begins in lower case.
    """
    w = W.partitionBy(key).orderBy("place")
    rows = line_rows.where(F.trim("line") != "").withColumn("_marker", F.col("line").rlike(marker))
    rows = rows.withColumn("_after", F.coalesce(F.lag("_marker").over(w), F.lit(False))).where(~F.col("_marker"))
    before = F.lag("line").over(w)
    goes_on = F.col("_after") & before.isNotNull() & ~before.rlike(r"[.!?:;\"”)]\s*$") & F.col("line").rlike(r"^\s*[a-z(]")
    rows = rows.withColumn("_new", (~F.coalesce(goes_on, F.lit(False))).cast("int")).withColumn("_p", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    joined = rows.groupBy(key, "_p").agg(F.min("place").alias("place"), F.array_sort(F.collect_list(F.struct("place", "line"))).alias("_l"))
    return joined.select(key, "place", F.concat_ws(" ", F.transform("_l", lambda x: F.trim(x["line"]))).alias("line"))


class _Renderer(HTMLParser):
    """HTML to lines of light markup: headings, bold, italics, list items, table rows."""

    BLOCKS = {"p", "div", "li", "tr", "table", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "br", "section", "article", "header", "footer", "nav", "body", "pre", "blockquote"}
    SILENT = {"script", "style", "title", "head"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[str] = []
        self.now: list[str] = []
        self.silent = 0

    def flush(self) -> None:
        text = " ".join("".join(self.now).split())
        if text:
            self.lines.append(text)
        self.now = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.silent += tag in self.SILENT
        if tag in self.BLOCKS:
            self.flush()
        if tag[0] == "h" and tag[1:].isdigit():
            self.now.append("#" * int(tag[1:]) + " ")
        elif tag in ("b", "strong"):
            self.now.append("**")
        elif tag in ("i", "em"):
            self.now.append("_")
        elif tag == "li":
            self.now.append("- ")
        elif tag in ("td", "th"):
            self.now.append(" | ")

    def handle_endtag(self, tag: str) -> None:
        self.silent -= tag in self.SILENT and self.silent > 0
        if tag in ("b", "strong"):
            self.now.append("**")
        elif tag in ("i", "em"):
            self.now.append("_")
        if tag in self.BLOCKS:
            self.flush()

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.now.append(data)


def html_lines(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, place, line) of the rendered page; a null page has no lines."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, page in zip(batch[key], batch[html], strict=True):
                renderer = _Renderer()
                renderer.feed(page or "")
                renderer.close()
                renderer.flush()
                rows += [(k, n, line) for n, line in enumerate(renderer.lines)]
            yield pd.DataFrame(rows, columns=[key, "place", "line"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(run, f"{key} {kind}, place int, line string")


def listing_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, row, cells): the cells of each table row of a listing page, without markup."""
    rows = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    found = pages.select(key, F.posexplode(rows).alias("row", "_r"))
    cells = F.regexp_extract_all("_r", F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1))
    plain = F.transform(cells, lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]*>", " "), r"\s+", " ")))
    return found.select(key, "row", plain.alias("cells")).where(F.size("cells") > 0)


def history_entries(line_rows: DataFrame, key: str) -> DataFrame:
    """(key, number, text): the numbered blocks of a printed history.

    A block begins where the next number in turn is printed, from 1 on, and goes on to the one
    after it; other numbers inside a block belong to its text.
    """
    w = W.partitionBy(key).orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    printed = line_rows.withColumn("_n", F.nullif(F.regexp_extract("line", r"^\s*(\d+)\.\s", 1), F.lit("")).cast("int"))
    # The numbers that come in turn, found by one walk over a document's few numbered lines.
    numbers = F.array_sort(F.collect_list(F.when(F.col("_n").isNotNull(), F.struct("place", "_n"))))
    none = F.array().cast("array<struct<place:int,number:int>>")
    turn = lambda found, x: F.when(x["_n"] == F.size(found) + 1, F.concat(found, F.array(F.struct(x["place"].cast("int").alias("place"), x["_n"].alias("number"))))).otherwise(found)
    begins = printed.groupBy(key).agg(F.aggregate(numbers, none, turn).alias("_b")).select(key, F.inline("_b"))
    rows = line_rows.join(begins, [key, "place"], "left").withColumn("number", F.last("number", ignorenulls=True).over(w)).where("number is not null")
    blocks = rows.groupBy(key, "number").agg(F.array_sort(F.collect_list(F.struct("place", "line"))).alias("_l"))
    return blocks.select(key, "number", F.concat_ws("\n", F.transform("_l", lambda x: x["line"])).alias("text"))


# How an archived page marks its entries, and what stands before their dates.
ENTRY_CLASS, SAT_ON = "indv-votes", "sitting on"


def index_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, n, label, day, href, format) of an index page in either layout.

    A live page is JSON text with `data: [{description, date, file}]`; an archived one is HTML
    whose entries are blocks of the class ENTRY_CLASS with a heading or link text, a date after
    SAT_ON and a link. Rows without a link are left out.
    """
    live = "struct<data: array<struct<description: string, date: string, file: string>>>"
    day = lambda c: F.coalesce(F.try_to_date(c, "d-M-yyyy"), F.try_to_date(c, "d MMMM yyyy"), F.try_to_date(c, "d MMM yyyy"))
    kind = lambda c: F.upper(F.regexp_extract(c, r"\.([A-Za-z0-9]+)(?:[?#].*)?$", 1))
    is_live = F.col(html).rlike(r"^\s*\{")
    a = pages.where(is_live).select(key, F.posexplode(F.from_json(F.col(html), live)["data"]).alias("n", "_e"))
    a = a.select(key, "n", F.col("_e.description").alias("label"), day(F.col("_e.date")).alias("day"), F.col("_e.file").alias("href"))
    blocks = F.filter(F.split(F.col(html), rf"(?i)<div\s+class=\"{ENTRY_CLASS}\"[^>]*>"), lambda x, i: i > 0)
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]*>", " "), r"\s+", " "))
    b = pages.where(~is_live).select(key, F.posexplode(blocks).alias("n", "_e"))
    label = F.coalesce(*(F.nullif(plain(F.regexp_extract("_e", p, 1)), F.lit("")) for p in (r"(?is)<h5[^>]*>(.*?)</h5>", r"(?is)<a\s[^>]*>\s*<span[^>]*>(.*?)</span>")))
    sat = F.regexp_extract(plain(F.col("_e")), rf"(?i){SAT_ON}\s+(?:\w+day,?\s+)?(\d{{1,2}} [A-Za-z]+ \d{{4}})", 1)
    b = b.select(key, "n", label.alias("label"), day(sat).alias("day"), F.regexp_extract("_e", r"(?i)<a\s[^>]*?href=\"([^\"]*)\"", 1).alias("href"))
    both = a.unionByName(b).where(F.coalesce("href", F.lit("")) != "")
    return both.withColumn("format", kind(F.col("href")))


def gazette_fields(text: Column) -> dict[str, Column]:
    """title, bill_number, first_reading, passing, act_number of the first pages of a bill or an act in the gazette.

    The title is what is printed above the line 'Bill No. n/yyyy'; without that line all are null.
    """
    number = r"(?im)^\s*Bill\s+No\.?\s*(\d+)\s*/\s*(\d{2,4})\.?\s*$"
    known = text.rlike(number)
    above = squeeze(F.regexp_extract(text, r"(?is)^(.*?)\bBill\s+No\b", 1))
    def day(words: str) -> Column:
        pattern = rf"(?is){words}[^.]*?\b(\d{{1,2}})(?:st|nd|rd|th)?\s+([A-Z][a-z]+),?\s+(\d{{4}})"
        return F.try_to_date(F.concat_ws(" ", *(F.nullif(F.regexp_extract(text, pattern, g), F.lit("")) for g in (1, 2, 3))), "d MMMM yyyy")

    act = r"(?i)\bAct\s+(?:No\.?\s*)?(\d+)\s+of\s+(\d{4})"
    fields = {
        "title": F.nullif(above, F.lit("")),
        "bill_number": F.concat_ws("/", F.regexp_extract(text, number, 1), F.regexp_extract(text, number, 2)),
        "first_reading": day(r"read\s+the\s+first\s+time"),
        "passing": day(r"passed"),
        "act_number": F.when(text.rlike(act), F.concat_ws("/", F.regexp_extract(text, act, 1), F.regexp_extract(text, act, 2))),
    }
    return {name: F.when(known, value) for name, value in fields.items()}


def align_rows(rows: DataFrame, texts: DataFrame, key: str, order: str, item: str, text: str, width: int = 35, least: int = 10) -> DataFrame:
    """(key, order, position): where each row's first `width` characters are found in the document, from 0; null if nowhere.

    Rows are sought in their order, each after the one found before it. Spaces are single and
    asterisks gone on both sides; keys shorter than `least` are not sought. A document's keys
    are short, so they are one array beside its text.
    """
    flat = lambda c: squeeze(F.translate(c, "*", ""))
    keys = rows.select(key, F.struct(F.col(order).alias("o"), F.substring(flat(F.col(item)), 1, width).alias("k")).alias("_k"))
    keys = keys.groupBy(key).agg(F.array_sort(F.collect_list("_k")).alias("_ks"))
    kind = rows.schema[order].dataType.simpleString()
    start = F.struct(F.lit(1).alias("at"), F.array().cast(f"array<struct<o:{kind},position:int>>").alias("found"))

    def step(acc: Column, x: Column) -> Column:
        at = F.when(F.length(x["k"]) >= least, F.call_function("locate", x["k"], F.col("_t"), acc["at"])).otherwise(0)
        return F.struct(F.when(at > 0, at + 1).otherwise(acc["at"]).alias("at"), F.concat(acc["found"], F.array(F.struct(x["o"].alias("o"), F.when(at > 0, at - 1).alias("position")))).alias("found"))

    joined = keys.join(texts.select(key, flat(F.col(text)).alias("_t")), key, "left")
    return joined.select(key, F.inline(F.aggregate("_ks", start, step, lambda acc: acc["found"]))).withColumnRenamed("o", order)


def collapse_single(turns: DataFrame, key: str) -> DataFrame:
    """turns (key, ordinal, speaker, kind, transcript) of documents with one speaker as one speech; other kinds stay apart.

    In a document whose speeches have just one distinct speaker, runs of speech between rows of
    other kinds are joined and credited to that speaker; other documents stay as they are.
    """
    who = turns.where("kind = 'SPEECH'").groupBy(key).agg(F.min("speaker").alias("_a"), F.max("speaker").alias("_b"))
    one = turns.join(who.where("_a = _b").select(key, F.col("_a").alias("_one")), key, "left")
    w = W.partitionBy(key).orderBy("ordinal")
    joins = F.col("_one").isNotNull() & (F.col("kind") == "SPEECH") & (F.lag("kind").over(w) == "SPEECH")
    rows = one.withColumn("_new", (~F.coalesce(joins, F.lit(False))).cast("int"))
    rows = rows.withColumn("_run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    runs = rows.groupBy(key, "_run").agg(F.first("_one").alias("_one"), F.min("kind").alias("kind"), F.min("speaker").alias("speaker"), F.array_sort(F.collect_list(F.struct("ordinal", "transcript"))).alias("_l"))
    speaker = F.when(F.col("kind") == "SPEECH", F.coalesce("_one", "speaker"))
    return runs.select(key, F.col("_run").cast("int").alias("ordinal"), speaker.alias("speaker"), "kind", F.concat_ws("\n", F.transform("_l", lambda x: x["transcript"])).alias("transcript"))


def join_wrapped_lines(line_rows: DataFrame, key: str, share: float = 0.6, least: int = 20) -> DataFrame:
    """(key, place, line): lines that the print wrapped are joined.

    In a paragraph (lines between blank ones) a line goes on in the next if it is at least
    `share` of the paragraph's longest and `least` characters long; a hyphen at its end goes.
    """
    w = W.partitionBy(key).orderBy("place")
    rows = line_rows.withColumn("line", F.trim("line")).withColumn("_p", F.sum((F.col("line") == "").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0))).where("line <> ''")
    rows = rows.withColumn("_long", F.max(F.length("line")).over(W.partitionBy(key, "_p")))
    inside = W.partitionBy(key, "_p").orderBy("place")
    before = F.lag(F.length("line")).over(inside)
    rows = rows.withColumn("_new", (~F.coalesce((before >= least) & (before >= F.col("_long") * share), F.lit(False))).cast("int"))
    rows = rows.withColumn("_r", F.sum("_new").over(inside.rowsBetween(W.unboundedPreceding, 0)))
    runs = rows.groupBy(key, "_p", "_r").agg(F.min("place").alias("place"), F.array_sort(F.collect_list(F.struct("place", "line"))).alias("_l"))
    text = F.concat_ws(" ", F.transform("_l", lambda x: x["line"]))
    return runs.select(key, "place", F.regexp_replace(text, r"(?<=\p{Ll})- (?=\p{Ll})", "").alias("line"))
