"""Lines of a report to speeches: classes of lines, and an automaton over them.

What a line means hangs on what came before it only through one of three states: PREAMBLE (no
speaker yet), OPEN (someone is speaking) and CLOSED (nobody is). So each line's class is a map of
states, the maps are composed by a scan (`scans.state_scan`), and then every line knows its state
without a walk of the document: lines of one report may lie in many tasks.

Marks: `**bold**`, `_italic_`, `# heading`, cells parted by `|`, and `(proc text) ... (proc text)`
around procedure.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.functions.names import squeeze
from rostrum.operators import scans
from rostrum.operators.documents import classify_kind, language_note
from rostrum.sources.tables import Scratch

PREAMBLE, OPEN, CLOSED = 0, 1, 2

#: class of a line -> (state after PREAMBLE, OPEN, CLOSED; what becomes of the line in each of them).
#: TEXT goes on for who is speaking, LABEL begins a turn, ALONE stands without a speaker, NONE leaves no row.
CLASSES: dict[str, tuple[tuple[int, int, int], tuple[str, str, str]]] = {
    "SKIPPED": ((PREAMBLE, OPEN, CLOSED), ("NONE", "NONE", "NONE")),
    "BRACKETED": ((PREAMBLE, OPEN, CLOSED), ("NONE", "TEXT", "TEXT")),
    "ITALIC": ((PREAMBLE, OPEN, CLOSED), ("NONE", "ALONE", "ALONE")),
    "TEXT": ((PREAMBLE, OPEN, CLOSED), ("TEXT", "TEXT", "TEXT")),
    "TABLE": ((PREAMBLE, OPEN, CLOSED), ("NONE", "TEXT", "TEXT")),
    "DROP_CAPITAL": ((PREAMBLE, OPEN, CLOSED), ("TEXT", "TEXT", "TEXT")),
    "CHAIR": ((PREAMBLE, OPEN, CLOSED), ("NONE", "TEXT", "NONE")),
    "LABEL": ((OPEN, OPEN, OPEN), ("LABEL", "LABEL", "LABEL")),
    "FRAGMENT": ((OPEN, OPEN, OPEN), ("LABEL", "TEXT", "LABEL")),
    "LEAD_IN": ((OPEN, OPEN, OPEN), ("ALONE", "ALONE", "ALONE")),
    "PROCEDURE": ((PREAMBLE, CLOSED, CLOSED), ("ALONE", "ALONE", "ALONE")),
    "PROCEDURE_GOES_ON": ((PREAMBLE, OPEN, CLOSED), ("ALONE", "ALONE", "ALONE")),
    "HEADING": ((PREAMBLE, OPEN, CLOSED), ("ALONE", "ALONE", "ALONE")),
    "BOUNDARY": ((PREAMBLE, CLOSED, CLOSED), ("NONE", "NONE", "NONE")),
    "NOTE": ((PREAMBLE, CLOSED, CLOSED), ("TEXT", "TEXT_ALONE", "TEXT")),
    "DIRECTION": ((CLOSED, OPEN, CLOSED), ("ALONE", "ALONE", "ALONE")),
    "DIRECTION_ENDS": ((CLOSED, CLOSED, CLOSED), ("ALONE", "ALONE", "ALONE")),
}

@dataclass(frozen=True)
class Grammar:
    """The words by which lines are told apart: a parameter of `line_classes`."""

    titles: list[str] = field(default_factory=lambda: ["Mr", "Mrs", "Ms", "Miss", "Mdm", "Madam", "Dr", "Prof", "Assoc Prof", "Er", "Encik", "Inche", "Tuan", "Haji"])
    roles: list[str] = field(default_factory=lambda: ["Speaker", "Deputy Speaker", "Chairman", "Deputy Chairman", "Clerk", "Minister", "Prime Minister", "Secretary", "Attorney-General", "President", "Leader"])
    groups: list[str] = field(default_factory=lambda: ["Hon. Members", "hon. Members", "Members", "An hon. Member", "Some hon. Members"])
    reporting: list[str] = field(default_factory=lambda: ["said", "says", "asked", "mentioned", "spoke", "told", "raised", "suggested", "has", "had", "was", "is"])
    particles: list[str] = field(default_factory=lambda: ["bin", "binte", "binti", "s/o", "d/o", "and", "of", "for", "the", "de", "van"])
    directions: list[str] = field(default_factory=lambda: ["rose in his place", "rose in her place", "rose", "indicated assent", "indicated dissent"])
    ending_directions: list[str] = field(default_factory=lambda: ["resumed his seat", "resumed her seat", "left the Chamber", "entered the Chamber", "took his seat", "took her seat"])
    keeping_acts: list[str] = field(default_factory=lambda: ["proposed", "made"])
    lead_ins: list[str] = field(default_factory=lambda: ["The following question stood in the name of", "The following questions stood in the name of"])
    #: Headings that end a turn; other headings stand inside a member's speech.
    boundaries: list[str] = field(default_factory=lambda: ["ADJOURNMENT", "ADJOURNMENT OF DEBATE", "ADJOURNMENT TO A DATE TO BE FIXED", "ADJOURNMENT SINE DIE", "REARRANGEMENT OF ORDER OF BUSINESS", "COMMITTEE OF SUPPLY"])


def _one(words: list[str]) -> str:
    return "(?:" + "|".join(w.replace(".", r"\.") for w in sorted(words, key=lambda w: (-len(w), w))) + ")"


_LETTER = r"\p{L}"


def line_classes(lines: DataFrame, line: str = "line", grammar: Grammar | None = None, longest: int = 100) -> DataFrame:
    """lines with class, name (whom the line names, if it is a label or a lead-in) and text (what is left to be said or recorded).

    A line's first bold run is a label if no letters stand before it (but a question's number and
    a language note may). Of such lines: notes of who is in the chair; cells of a table, unless a
    person's label ends in a colon before the first bar; lead-ins of questions; fragments (a
    person's title followed by words of a sentence); one or two capital letters, with which a
    paragraph begins; notes in brackets; stage directions; headings; and labels, which are names
    with a title, offices, groups of members and whatever text follows, up to `longest` characters. Others are procedure,
    lead-ins and labels in plain print (an office with a name in brackets, the chair), titles that
    stand before the first speech, and text.
    """
    g = grammar or Grammar()
    titled = rf"^{_one(g.titles)}\b"
    stripped = F.trim(F.col(line))
    rows = lines.withColumn("_l", F.regexp_replace(stripped, r"^\*\*\s*\*\*\s*", ""))
    rows = rows.withColumns({"_bold": F.regexp_extract("_l", r"\*\*([^*]+)\*\*", 1), "_plain": F.trim(F.replace("_l", F.lit("**"), F.lit("")))})
    rows = rows.withColumns({"_head": F.regexp_extract("_l", r"^(.*?)\*\*[^*]+\*\*", 1), "_tail": F.regexp_extract("_l", r"\*\*[^*]+\*\*(.*)$", 1)})
    note_before, head = language_note(F.trim("_head"))
    rows = rows.withColumn("_lead", F.regexp_replace(head, r"^\s*\d+\\?\.?\s*", ""))
    # A bracket that the bold left open closes it, wherever the print has put its end.
    opened = (F.length(F.translate("_bold", "(", "")) < F.length(F.translate("_bold", ")", ""))) & (F.col("_bold") != "")
    label = F.trim(F.regexp_replace(F.trim("_bold"), r":\s*$", ""))
    label = F.when(opened, F.concat(label, F.lit(")"))).otherwise(label)
    colon = F.col("_bold").rlike(r":\s*$") | F.col("_tail").rlike(r"^\s*\)?\s*:")
    rest = F.trim(F.regexp_replace(F.trim("_tail"), r"^\)?\s*:?\s*", ""))
    rest = F.when(opened | F.col("_tail").rlike(r"^\s*:"), rest).otherwise(F.trim("_tail"))
    rows = rows.withColumns({"_name": label, "_colon": colon, "_rest": rest})
    label_note, bare_name = F.nullif(F.initcap(F.regexp_extract("_name", r"\(\s*(?i:in|dalam)\s+(\w+)\s*\)\s*$", 1)), F.lit("")), F.trim(F.regexp_replace("_name", r"\(\s*(?i:in|dalam)\s+\w+\s*\)\s*$", ""))
    rows = rows.withColumns({"_name": F.when(bare_name != "", F.regexp_replace(F.regexp_replace(bare_name, r"^\d+\\?\.\s+", ""), rf"^({_one(g.titles)})(?=\p{{Lu}}\p{{Ll}})", "$1 ")).otherwise(F.col("_name")), "_note": F.coalesce(note_before, label_note)})

    l, name, tail = F.col("_l"), F.col("_name"), F.col("_rest")  # noqa: E741
    lone = F.trim(F.translate(l, "*_#", "   "))
    is_bold = (F.col("_bold") != "") & ~F.col("_lead").rlike(_LETTER) & F.col("_bold").rlike(_LETTER)
    drop_capital = name.rlike(r"^[\"“'‘]?\p{Lu}\p{L}?$") & ~name.isin(g.titles) & ~F.col("_colon")
    person = name.rlike(titled) | name.rlike(rf"^The {_one(g.roles)}\b") | name.rlike(rf"^(?:{_one(g.titles)} )?{_one(g.roles)}\b") | name.rlike(rf"^{_one(g.groups)}$")
    words = F.filter(F.split(F.regexp_replace(name, r"\([^)]*\)?", ""), r"\s+"), lambda w: w.rlike(r"^\p{Ll}") & ~w.isin(g.particles))
    fragment = name.rlike(titled) & ~F.col("_colon") & ((F.size(words) >= 3) | F.exists(words, lambda w: w.isin(g.reporting)) | name.rlike(r"['’]s\b"))
    in_chair = r"^[\[(]?.{1,80}\bin the [Cc]hair\W*$"
    direction = rf"^[\s_*]*(?:and \*\*[^*]+\*\* )?(?:again |later |then )?{{}}[\s_*.–—-]*$"
    kind = classify_kind(l)
    procedure = kind == "PROCEDURAL"
    keeping = F.lower(l).rlike(rf"^[\s*_]*(?:\w+ )?question,? (?:again )?{_one(g.keeping_acts)}\b")
    proc = F.regexp_extract(l, r"^\W*\(proc text\)\s*(.*?)\s*\(proc text\)\W*$", 1)
    plain_lead = rf"^{_one(g.lead_ins)}\s+(\p{{Lu}}[^*]*?)\s*:?[\s–—-]*$"
    bold_lead = rf"^{_one(g.lead_ins)}\s+\*\*([^*]+)\*\*[\s–—-]*$"
    role_label = rf"^(?:The )?{_one(g.roles)}[^():]{{0,60}}\({_one(g.titles)} [^()]{{2,50}}\)(?:\s*\([^()]*\))*"
    plain_label = rf"^({role_label[1:]}|{_one(['Mr', 'Mdm', 'Madam'])} (?:Deputy )?Speaker|{_one(g.titles)} [^:*()]{{2,60}}\(\s*(?i:in|dalam)\s+\w+\s*\))\s*:\s*(.*)$"

    def case(rules: list[tuple[Column, str]]) -> Column:
        out = None
        for c, v in rules:
            out = F.when(c, v) if out is None else out.when(c, v)
        return out

    skipped = (lone == "") | lone.rlike(r"^(?:Column|Page):?\s*\d+$") | lone.rlike(r"^\(?\d{1,2}[.:]\d{2}\s*(?:[ap]\.?\s?m\.?)\)?$")
    bold_rules = [
        (F.col("_plain").rlike(in_chair) & l.rlike(r"^\*\*[\[(]"), "SKIPPED"),
        (name.rlike(in_chair) | l.rlike(r"^\*\*[\[(][^*]*\bin the [Cc]hair\W*\*\*"), "CHAIR"),
        (l.contains("|") & ~(person & F.col("_colon") & ~F.concat(F.col("_head"), F.col("_bold")).contains("|") & ~F.col("_tail").rlike(r"^\s*\|")), "TABLE"),
        (fragment, "FRAGMENT"),
        (drop_capital, "DROP_CAPITAL"),
        (name.rlike(r"^\(.*\)$"), "NOTE"),
        (tail.rlike(direction.format(_one(g.ending_directions))), "DIRECTION_ENDS"),
        (tail.rlike(direction.format(_one(g.directions))), "DIRECTION"),
        (F.col("_plain").isin(g.boundaries), "BOUNDARY"),
        (~person & keeping, "PROCEDURE_GOES_ON"),
        (~person & procedure, "PROCEDURE"),
        (~person & ((l.rlike("^#+ ") & (tail != "")) | tail.rlike(r"(?i)^_?\(cont") | ((tail == "") & F.col("_colon"))), "HEADING"),
        (~person & (tail == ""), "SKIPPED"),
        (~person & (F.length(name) > longest), "TEXT"),
    ]
    plain_rules = [
        (l.rlike("^#+ "), "SKIPPED"),
        (l.rlike(plain_lead) | l.rlike(bold_lead), "LEAD_IN"),
        (l.rlike(plain_label), "LABEL"),
        (keeping, "PROCEDURE_GOES_ON"),
        (procedure, "PROCEDURE"),
        (l.rlike(r"^_[^_]+_$"), "ITALIC"),
        (l.rlike(r"^[*_\s]*\(.*\)[*_\s]*$"), "BRACKETED"),
    ]
    found = case([(skipped, "SKIPPED"), (proc != "", F.when(F.lower(proc).rlike(rf"^(?:\w+ )?question,? (?:again )?{_one(g.keeping_acts)}\b"), "PROCEDURE_GOES_ON").otherwise("PROCEDURE")), (l.rlike(bold_lead), "LEAD_IN"), (is_bold, case(bold_rules).otherwise("LABEL"))]).otherwise(case(plain_rules).otherwise("TEXT"))
    rows = rows.withColumn("class", found)
    plain = F.col("class").isin("LABEL") & ~is_bold
    plain_name = F.regexp_extract(l, plain_label, 1)
    plain_note = F.nullif(F.initcap(F.regexp_extract(plain_name, r"\(\s*(?i:in|dalam)\s+(\w+)\s*\)\s*$", 1)), F.lit(""))
    named = (
        F.when(plain, F.trim(F.regexp_replace(plain_name, r"\(\s*(?i:in|dalam)\s+\w+\s*\)\s*$", "")))
        .when(F.col("class") == "LEAD_IN", F.when(l.rlike(bold_lead), F.regexp_extract(l, bold_lead, 1)).otherwise(F.regexp_extract(l, plain_lead, 1)))
        .when(F.col("class").isin("LABEL", "FRAGMENT"), name)
    )
    text = (
        F.when(plain, F.regexp_extract(l, plain_label, 2))
        .when(proc != "", proc)
        .when(F.col("class") == "DROP_CAPITAL", F.concat("_head", F.trim("_bold"), "_tail"))
        .when(F.col("class").isin("CHAIR", "LABEL", "NOTE"), tail)
        .otherwise(F.col("_plain"))
    )
    return rows.withColumns({"name": F.trim(F.regexp_replace(named, r"[\s–—-]+$", "")), "text": F.trim(text), "language": F.when(F.col("class") == "LABEL", F.coalesce("_note", plain_note)), "_tail": F.when(F.col("class") == "FRAGMENT", tail)}).drop("_l", "_bold", "_plain", "_head", "_lead", "_name", "_colon", "_rest", "_note")


def speeches(lines: DataFrame, key: str, grammar: Grammar | None = None, block: int = scans.BLOCK, scratch: Scratch | None = None) -> DataFrame:
    """(key, ordinal, place, speaker, kind, transcript, language) of rows (key, place, line), places from 0.

    A row for each line that says or records something. What stands before the first label is
    kept, without a speaker, if a label follows; a report without one has no rows (see
    `collapse_single` for those). Lines without a speaker have the kind that their text shows, or
    UNCLASSIFIED. A note of the language goes with the row it introduces, also from a label
    without text. Empty texts leave no row.
    """
    scratch = scratch or Scratch(lines.sparkSession)
    rows = scratch.save(line_classes(lines.select(key, "place", "line"), "line", grammar).drop("line"), f"classes-{key}")
    last = rows.agg(F.max("place")).first()[0] or 0
    moves, acts = {c: scans.pack(list(m)) for c, (m, _) in CLASSES.items()}, {c: list(a) for c, (_, a) in CLASSES.items()}
    given = lambda table: F.element_at(F.create_map(*[x for c, v in table.items() for x in (F.lit(c), F.lit(v))]), F.col("class"))
    leaving = [c for c, (m, _) in CLASSES.items() if m[PREAMBLE] != PREAMBLE]
    labelled = rows.where(F.col("class").isin(leaving)).select(key).distinct()
    rows = scans.state_scan(rows.join(labelled, key, "left_semi").withColumn("_moves", given(moves).cast("long")), key, "place", "_moves", 3, PREAMBLE, block, last)
    rows = rows.withColumn("_act", F.get(given(acts), F.col("state_before")))
    begins = F.col("_act") == "LABEL"
    rows = rows.withColumn("text", F.when((F.col("class") == "FRAGMENT") & begins, F.col("_tail")).otherwise(F.col("text")))
    bare = F.when(begins & (F.col("text") == ""), F.struct(F.col("place").alias("place"), F.col("language").alias("language")))
    rows = rows.withColumn("_mark", F.when(begins | (F.col("class") == "LEAD_IN"), F.struct("name", bare.alias("bare"))))
    rows = scans.last_value(rows, key, "place", "_mark", "_who", False, block, last)
    note, rest = language_note(F.col("text"))
    shown = classify_kind(F.col("text"))
    speaks = begins | ((F.col("_act") == "TEXT") & (F.col("state_before") == OPEN))
    by_class = {"DIRECTION": "CHAMBER_EVENT", "DIRECTION_ENDS": "CHAMBER_EVENT", "PROCEDURE": "PROCEDURAL", "PROCEDURE_GOES_ON": "PROCEDURAL", "LEAD_IN": "PROCEDURAL", "HEADING": "HEADING", "ITALIC": "HEADING"}
    by_text = F.when(F.col("class").isin("TEXT", "BRACKETED") & shown.isin("PROCEDURAL", "CHAMBER_EVENT", "EDITORIAL_NOTE"), shown).when(speaks, "SPEECH").when(shown == "SPEECH", "UNCLASSIFIED").otherwise(shown)
    rows = rows.withColumns({"kind": F.coalesce(given(by_class), by_text), "transcript": squeeze(F.replace(rest, F.lit("**"), F.lit(""))), "_note": F.coalesce(note, F.when(begins, F.col("language")))})
    rows = rows.withColumn("_kept", F.when((F.col("_act") != "NONE") & (F.col("transcript") != ""), F.col("place")))
    rows = scans.last_value(rows, key, "place", "_kept", "_row_before", True, block, last).where(F.col("_kept").isNotNull())
    speech = F.col("kind") == "SPEECH"
    first = speech & (F.coalesce("_row_before", F.lit(-1)) < F.col("_who.bare.place"))
    rows = rows.withColumns({"speaker": F.when(speech, F.col("_who.name")), "language": F.coalesce("_note", F.when(first, F.col("_who.bare.language")))})
    return scans.number_rows(rows.select(key, "place", "speaker", "kind", "transcript", "language"), key, "place", "ordinal", block).select(key, "ordinal", "place", "speaker", "kind", "transcript", "language")
