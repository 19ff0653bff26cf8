"""Scalar functions and document operators over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.functions import dates as D
from rostrum.functions import names as N
from rostrum.operators import documents as X
from rostrum.plans.registry import query, rows

# Expressions that both engines read the same way.
_ROMAN = "concat(chr(65 + CAST(c_custkey % 26 AS INT)), '. ', chr(65 + CAST(c_custkey % 7 AS INT)), '. ', chr(66 + CAST(c_custkey % 5 AS INT)), '. Mohd. ', c_name)"


@query("SELECT c_custkey, chr((65 + c_custkey % 26)::INT) || '.' || chr((65 + c_custkey % 7)::INT) || '.' || chr((66 + c_custkey % 5)::INT) || '. Mohd ' || c_name AS name FROM customer")
def normalize_name(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "customer", "c_custkey", f"{_ROMAN} AS raw").select("c_custkey", N.normalize_name(F.col("raw")).alias("name"))


_DOTTED = "concat(chr(65 + CAST(c_custkey % 26 AS INT)), '.', chr(65 + CAST(c_custkey % 7 AS INT)), '.  ', c_name, ' ', c_mktsegment)"


@query("SELECT c_custkey, lower(chr((65 + c_custkey % 26)::INT) || ' ' || chr((65 + c_custkey % 7)::INT) || ' ' || c_name || ' ' || c_mktsegment) AS name FROM customer")
def period_normalize(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "customer", "c_custkey", f"{_DOTTED} AS raw").select("c_custkey", N.period_normalize(F.col("raw")).alias("name"))


_MALAY = "CASE c_custkey % 4 WHEN 0 THEN concat('Ahmad Bin ', c_name) WHEN 1 THEN concat('Siti binte ', c_name, ' bin Ali') WHEN 2 THEN concat('Abdul Haji ', c_name) ELSE concat('Mohamad-Tuan Hj. ', c_name) END"


@query("""
SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Ahmad ' || c_name WHEN 1 THEN 'Siti ' || c_name || ' Ali' WHEN 2 THEN 'Abdul Haji ' || c_name ELSE 'Mohamad-Tuan Hj. ' || c_name END AS bin_free,
  CASE c_custkey % 4 WHEN 0 THEN 'Ahmad Bin ' || c_name WHEN 1 THEN 'Siti binte ' || c_name || ' bin Ali' WHEN 2 THEN 'Abdul ' || c_name ELSE 'Mohamad-Tuan ' || c_name END AS haji_free,
  CASE c_custkey % 4 WHEN 0 THEN 'Ahmad Bin ' || c_name WHEN 1 THEN 'Siti binte ' || c_name || ' bin Ali' WHEN 2 THEN 'Abdul Haji ' || c_name ELSE 'Mohamed Tuan Hj. ' || c_name END AS spelling FROM customer
""")
def name_particles(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("n")
    return rows(spark, d, "customer", "c_custkey", f"{_MALAY} AS n").select("c_custkey", N.strip_bin(n).alias("bin_free"), N.strip_middle_haji(n).alias("haji_free"), N.spelling_normalize(n).alias("spelling"))


_TITLED = "concat(CASE c_custkey % 6 WHEN 0 THEN 'Mr ' WHEN 1 THEN 'Assoc. Prof. Dr ' WHEN 2 THEN 'The Hon. BG (NS) ' WHEN 3 THEN 'Tun Dato Haji ' WHEN 4 THEN 'Mister ' ELSE '' END, c_name)"


@query("SELECT c_custkey, CASE WHEN c_custkey % 6 = 4 THEN 'Mister ' ELSE '' END || c_name AS name FROM customer")
def strip_title(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "customer", "c_custkey", f"{_TITLED} AS raw").select("c_custkey", N.strip_title(F.col("raw")).alias("name"))


_INVERTED = "CASE c_custkey % 3 WHEN 0 THEN concat(c_name, ', Anna, Dr') WHEN 1 THEN concat(c_name, ', Mr Bo') ELSE c_name END"


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Anna ' || c_name WHEN 1 THEN 'Bo ' || c_name END AS name FROM customer")
def invert_name(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "customer", "c_custkey", f"{_INVERTED} AS raw").select("c_custkey", N.invert_name(F.col("raw")).alias("name"))


_LABEL = "concat(CASE c_custkey % 3 WHEN 0 THEN '12. ' WHEN 1 THEN '..' ELSE '“' END, 'Mr ', c_name, CASE c_custkey % 4 WHEN 0 THEN ' (NS)  X:' WHEN 1 THEN ' (Minister ' WHEN 2 THEN ' – ' ELSE ' ' END)"


@query("SELECT c_custkey, concat('Mr ', c_name, CASE WHEN c_custkey % 4 = 0 THEN ' X' ELSE '' END) AS label FROM customer")
def clean_label(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "customer", "c_custkey", f"{_LABEL} AS raw").select("c_custkey", N.clean_label(F.col("raw")).alias("label"))


_TITLE = "concat(CASE p_partkey % 2 WHEN 0 THEN 'The ' ELSE '' END, p_name, ' (Amendment No. 2)', CASE p_partkey % 3 WHEN 0 THEN ' Act 1999' WHEN 1 THEN ' Bill' ELSE ' Ordinance (Chapter 12A)' END)"


@query("""
WITH k AS (SELECT p_partkey, lower(replace(p_name, ' ', '')) || 'amendmentno2' AS k, CASE p_partkey % 2 WHEN 0 THEN 'the' ELSE '' END AS a, CASE p_partkey % 3 WHEN 0 THEN 'act1999' WHEN 1 THEN 'bill' ELSE 'ordinancechapter12a' END AS z FROM part)
SELECT p_partkey, a || k || z AS title_key, k || 'bill' AS bill_key, replace(k, 'amendmentno2', '') || 'bill' AS loose_key FROM k
""")
def title_key(spark: SparkSession, d: str) -> DataFrame:
    t = rows(spark, d, "part", "p_partkey", f"{_TITLE} AS t")
    keyed = t.select("p_partkey", N.title_key(F.col("t")).alias("title_key"), N.bill_title_key(F.col("t")).alias("bill_key"))
    return keyed.withColumn("loose_key", N.loose_title_key(F.col("bill_key")))


_NUMBER = "concat(CASE WHEN o_orderkey % 5 = 0 THEN '00' ELSE '' END, CAST(o_orderkey % 97 AS STRING), '/', CASE o_orderkey % 3 WHEN 0 THEN CAST(1955 + o_orderkey % 60 AS STRING) WHEN 1 THEN right(CAST(1000 + o_orderkey % 100 AS STRING), 2) ELSE 'x' END)"


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN concat(o_orderkey % 97, '/', 1955 + o_orderkey % 60) WHEN 1 THEN concat(o_orderkey % 97, '/', CASE WHEN o_orderkey % 100 >= 50 THEN 1900 ELSE 2000 END + o_orderkey % 100) END AS number FROM orders")
def bill_number(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "orders", "o_orderkey", f"{_NUMBER} AS raw").select("o_orderkey", N.bill_number(F.col("raw")).alias("number"))


_HEADER = "CASE p_partkey % 6 WHEN 0 THEN concat(p_name, ' (', p_type, ')') WHEN 1 THEN concat(p_name, ' (', p_type, ' (', p_brand, ') end)') WHEN 2 THEN concat(p_name, ' (one (two (', p_brand, ') / b))  ') WHEN 3 THEN concat(p_name, ' (open (', p_brand, ')') WHEN 4 THEN concat(p_name, ' ', p_brand, ')') ELSE p_name END"


@query("""
SELECT p_partkey, CASE p_partkey % 6 WHEN 3 THEN p_name || ' (open' WHEN 4 THEN p_name || ' ' || p_brand || ')' ELSE p_name END AS title,
  CASE p_partkey % 6 WHEN 0 THEN p_type WHEN 1 THEN p_type || ' (' || p_brand || ') end' WHEN 2 THEN 'one (two (' || p_brand || ') / b)' WHEN 3 THEN p_brand END AS subtitle, p_name || '|' || p_type || ' (a/b (c/d))|' || p_brand AS parts FROM part
""")
def split_subtitle(spark: SparkSession, d: str) -> DataFrame:
    """Brackets in brackets, brackets that don't balance, and parts between slashes outside brackets."""
    title, subtitle = N.split_subtitle(F.col("raw"))
    part = rows(spark, d, "part", "p_partkey", f"{_HEADER} AS raw", "concat(p_name, ' / ', p_type, ' (a/b (c/d)) / / ', p_brand) AS listed")
    return part.select("p_partkey", title.alias("title"), subtitle.alias("subtitle"), F.array_join(N.slash_parts(F.col("listed")), "|").alias("parts"))


@query(r"SELECT doc_id, length(regexp_replace(text, '[\s*_\\#|]+', '', 'g')) AS chars FROM documents")
def countable_chars(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "documents", "doc_id", "text").select("doc_id", N.countable_chars(F.col("text")).cast("long").alias("chars"))


#: Printed offices and their classes.
_OFFICES = [
    ("The Prime Minister", "PRIME_MINISTER"), ("The Acting Prime Minister and Minister for Law", "PRIME_MINISTER"), ("Deputy Prime Minister", "DEPUTY_PRIME_MINISTER"), ("The Deputy Prime_Minister and Minister for Home Affairs", "DEPUTY_PRIME_MINISTER"),
    ("Minister for Trade", "MINISTER"), ("Minister for X and Minister of State for Y", "MINISTER"), ("The Minister, Prime Minister’s Office", "MINISTER"), ("Second Minister for *Finance*", "MINISTER"),
    ("Senior Minister of State for Law", "SENIOR_MINISTER_OF_STATE"), ("Minister of State", "MINISTER_OF_STATE"), ("Minister of State to the Prime Minister", "MINISTER_OF_STATE"), ("The SeniorMinister of State", "SENIOR_MINISTER_OF_STATE"),
    ("Senior Parliamentary Secretary to the Minister for Health", "SENIOR_PARLIAMENTARY_SECRETARY"), ("Parliamentary Secretary to the Minister", "PARLIAMENTARY_SECRETARY"), ("Parliamentary Secretary to the Minister for Law and Minister for Arts", "PARLIAMENTARY_SECRETARY"), ("Parliamentary Secretary to the Minister for Law and Second Minister", "MINISTER"), ("Parliamentary Secretary, Ministry of Law", "PARLIAMENTARY_SECRETARY"),
    ("Chief Minister", "OTHER"), ("Assistant Minister for Education", "OTHER"), ("Permanent Secretary, Ministry of Law", "OTHER"), ("Leader of the House", "OTHER"),
]
_OFFICE = f"CASE s_suppkey % {len(_OFFICES)} " + " ".join(f"WHEN {k} THEN '{printed}'" for k, (printed, _) in enumerate(_OFFICES)) + " END"


@query(f"SELECT s_suppkey, CASE s_suppkey % {len(_OFFICES)} " + " ".join(f"WHEN {k} THEN '{kind}'" for k, (_, kind) in enumerate(_OFFICES)) + " END AS class FROM supplier")
def office_class(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "supplier", "s_suppkey", f"{_OFFICE} AS office").select("s_suppkey", N.office_class(F.col("office")).alias("class"))


@query("SELECT p_partkey, CASE split_part(p_name, ' ', 1) WHEN 'red' THEN 'red' WHEN 'blue' THEN 'blue' WHEN 'small' THEN 'small' END AS found, CASE WHEN split_part(p_name, ' ', 1) IN ('red', 'blue', 'small') THEN split_part(p_name, ' ', 2) ELSE p_name END AS rest FROM part")
def closed_vocab(spark: SparkSession, d: str) -> DataFrame:
    found, rest = N.closed_vocabulary(F.col("p_name"), ["red", "blue", "small"])
    return rows(spark, d, "part", "p_partkey", "p_name").select("p_partkey", found.alias("found"), rest.alias("rest"))


_UNEVEN = "length(text) - length(replace(text, '{}', '')) <> length(text) - length(replace(text, '{}', ''))"


@query(rf"SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z]\d')) AS letter_digit, len(regexp_extract_all(text, '!!')) AS bangs, len(regexp_extract_all(text, '&[a-z]+;')) AS entities, concat_ws(';', CASE WHEN {_UNEVEN.format('“', '”')} THEN 'unbalanced double quotes' END, CASE WHEN {_UNEVEN.format('(', ')')} THEN 'unbalanced parentheses' END) AS pairs FROM documents")
def char_audit(spark: SparkSession, d: str) -> DataFrame:
    counts = N.fault_counts(F.col("text"), {"letter_digit": r"[A-Za-z]\d", "bangs": "!!", "entities": "&[a-z]+;"})
    docs = rows(spark, d, "documents", "doc_id", "text")
    return docs.select("doc_id", *(c.cast("long").alias(n) for n, c in counts.items()), N.unbalanced_pairs(F.col("text")).alias("pairs"))


@query("SELECT user_id, count(*) AS n FROM (SELECT user_id, upper(event_type) || ' - east  SMC' AS place FROM events) WHERE lower(replace(regexp_replace(place, ' SMC$', ''), ' - east ', ' east')) <> 'view east' GROUP BY 1")
def folded_key_mismatch(spark: SparkSession, d: str) -> DataFrame:
    e = rows(spark, d, "events", "user_id", "concat(upper(event_type), ' - east  SMC') AS place")
    return e.where(N.fold_place(F.col("place")) != "view east").groupBy("user_id").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT lower(c_mktsegment) || '|' || o_orderdate::DATE || '|' || CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE (o_orderdate::DATE + 5)::VARCHAR END AS period_key FROM orders JOIN customer ON o_custkey = c_custkey")
def period_key(spark: SparkSession, d: str) -> DataFrame:
    orders = rows(spark, d, "orders", "o_custkey AS c_custkey", "to_date(o_orderdate) AS start", "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE date_add(to_date(o_orderdate), 5) END AS end")
    joined = orders.join(rows(spark, d, "customer", "c_custkey", "c_mktsegment"), "c_custkey")
    return joined.select(F.concat_ws("|", F.lower("c_mktsegment"), F.col("start").cast("string"), F.coalesce(F.col("end").cast("string"), F.lit("open"))).alias("period_key")).distinct()


# Dates ------------------------------------------------------------------------------------------

_PRINTED = "concat(CAST(1 + o_orderkey % 31 AS STRING), '-', CAST(1 + o_custkey % 12 AS STRING), '-', CAST(1990 + o_orderkey % 30 AS STRING))"


@query("SELECT o_orderkey, try_cast((1990 + o_orderkey % 30)::VARCHAR || '-' || (1 + o_custkey % 12)::VARCHAR || '-' || (1 + o_orderkey % 31)::VARCHAR AS DATE) AS day, concat(((1990 + o_orderkey % 30) // 10 * 10)::VARCHAR, 's') AS decade FROM orders")
def parse_dates(spark: SparkSession, d: str) -> DataFrame:
    printed = rows(spark, d, "orders", "o_orderkey", f"{_PRINTED} AS printed", "1990 + o_orderkey % 30 AS y")
    return printed.select("o_orderkey", D.parse_printed(F.col("printed")).alias("day"), D.decade_label(F.make_date("y", F.lit(6), F.lit(1))).alias("decade"))


@query("SELECT o_orderkey, CASE WHEN day < start THEN (start - day) WHEN e IS NOT NULL AND day > e THEN (day - e) ELSE 0 END AS gap, day >= start AND day <= coalesce(e, start + 31) AS covers FROM (SELECT o_orderkey, o_orderdate::DATE AS day, o_orderdate::DATE + (o_custkey % 50 - 25)::INT AS start, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate::DATE + (o_custkey % 50 - 20)::INT END AS e FROM orders)")
def interval_cover(spark: SparkSession, d: str) -> DataFrame:
    r = rows(spark, d, "orders", "o_orderkey", "to_date(o_orderdate) AS day", "date_add(to_date(o_orderdate), cast(o_custkey % 50 - 25 AS INT)) AS start", "CASE WHEN o_orderkey % 4 <> 0 THEN date_add(to_date(o_orderdate), cast(o_custkey % 50 - 20 AS INT)) END AS e")
    return r.select("o_orderkey", D.interval_gap(F.col("day"), F.col("start"), F.col("e")).alias("gap"), D.covers(F.col("day"), F.col("start"), F.col("e")).alias("covers"))


@query("""
SELECT o_orderkey, CASE unit WHEN 'day' THEN day + (n - 1) WHEN 'week' THEN day + (7 * n - 1) ELSE CASE WHEN day(day + to_months(m)) = day(day) THEN (day + to_months(m))::DATE - 1 END END::DATE AS last_day
FROM (SELECT *, CASE WHEN unit = 'year' THEN 12 * n ELSE n END AS m FROM (SELECT o_orderkey, o_orderdate::DATE AS day, 1 + (o_orderkey % 14)::INT AS n, CASE o_custkey % 4 WHEN 0 THEN 'day' WHEN 1 THEN 'week' WHEN 2 THEN 'month' ELSE 'year' END AS unit FROM orders))
""")
def duration_end(spark: SparkSession, d: str) -> DataFrame:
    r = rows(spark, d, "orders", "o_orderkey", "to_date(o_orderdate) AS day", "1 + cast(o_orderkey % 14 AS INT) AS n", "CASE o_custkey % 4 WHEN 0 THEN 'day' WHEN 1 THEN 'week' WHEN 2 THEN 'month' ELSE 'year' END AS unit")
    return r.select("o_orderkey", D.duration_end(F.col("day"), F.col("n"), F.col("unit")).alias("last_day"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 99 ELSE CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END END AS parliament FROM orders")
def coalesce_map(spark: SparkSession, d: str) -> DataFrame:
    r = rows(spark, d, "orders", "o_orderkey", "o_orderstatus", "CASE WHEN o_orderkey % 3 = 0 THEN 99 END AS p")
    return r.select("o_orderkey", D.coalesce_map(F.col("p"), F.col("o_orderstatus"), {"F": 1, "O": 2}).alias("parliament"))


@query("""
WITH e AS (SELECT min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders)
SELECT greatest(m::DATE, a) AS first_day, least((m + INTERVAL 1 MONTH)::DATE - 1, b) AS last_day FROM (SELECT a, b, unnest(range(date_trunc('month', a)::TIMESTAMP, (b + 1)::TIMESTAMP, INTERVAL 1 MONTH)) AS m FROM e)
""")
def month_windows(spark: SparkSession, d: str) -> DataFrame:
    from rostrum.sources.tables import month_windows as windows

    return windows(rows(spark, d, "orders", "to_date(o_orderdate) AS day"), "day")


# JSON and lists ---------------------------------------------------------------------------------


@query("SELECT event_id, (props::JSON ->> 'k')::INT AS k, len(json_keys(props::JSON)) AS n FROM events")
def json_list(spark: SparkSession, d: str) -> DataFrame:
    e = rows(spark, d, "events", "event_id", "props")
    return e.select("event_id", F.from_json("props", "k int")["k"].alias("k"), F.size(F.json_object_keys("props")).cast("long").alias("n"))


@query("SELECT conv_id, turn, unnest(list_filter(list_transform(string_split(text, ','), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')) AS name FROM conversations")
def split_names(spark: SparkSession, d: str) -> DataFrame:
    c = rows(spark, d, "conversations", "conv_id", "turn", "text")
    return c.select("conv_id", "turn", F.explode(N.split_names(F.col("text"), ",")).alias("name"))


# Documents --------------------------------------------------------------------------------------

_LINES = "SELECT conv_id, unnest(ls) AS line, (generate_subscripts(ls, 1) - 1)::INT AS place FROM (SELECT conv_id, string_split(t, chr(10)) AS ls FROM ({source}))"
#: A record made of a conversation: labels before turns, notes and events between them.
_RECORD_TURN = "concat(CASE WHEN turn % 4 = 2 THEN 'Question put, and agreed to.\n' WHEN turn % 5 = 4 THEN '(Applause.)\n' ELSE '' END, CASE role WHEN 'user' THEN 'Mr User: ' WHEN 'assistant' THEN 'The Assistant: ' ELSE '' END, replace(text, ':', ' '))"


def _records(spark: SparkSession, d: str) -> DataFrame:
    turns = rows(spark, d, "conversations", "conv_id", "turn", f"{_RECORD_TURN} AS t")
    joined = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "t"))).alias("a"))
    return joined.select("conv_id", F.concat_ws("\n", F.transform("a", lambda x: x["t"])).alias("text"))


_RECORD_SQL = f"SELECT conv_id, string_agg({_RECORD_TURN}, chr(10) ORDER BY turn) AS t FROM conversations GROUP BY 1".replace("'Question put, and agreed to.\n'", "'Question put, and agreed to.' || chr(10)").replace("'(Applause.)\n'", "'(Applause.)' || chr(10)")
_TRIMMED = r"regexp_replace({}, '^ +| +$', '', 'g')"


@query(f"{_LINES.format(source=_RECORD_SQL)}")
def document_lines(spark: SparkSession, d: str) -> DataFrame:
    return X.lines(_records(spark, d), "conv_id", "text")


_KIND_SQL = r"CASE WHEN regexp_matches(line, '^[\s*_]*Question (?:put|proposed|again proposed)') THEN 'PROCEDURAL' WHEN regexp_matches(line, '^[\s*_]*\(Applause\.\)') THEN 'CHAMBER_EVENT' WHEN regexp_matches(line, '^(?:#+ |[A-Z][A-Z ,''&-]{8,}$)') THEN 'HEADING' ELSE 'SPEECH' END"


@query(f"SELECT conv_id, place, {_KIND_SQL} AS kind FROM ({_LINES.format(source=_RECORD_SQL)})")
def classify_kind(spark: SparkSession, d: str) -> DataFrame:
    return X.lines(_records(spark, d), "conv_id", "text").select("conv_id", "place", X.classify_kind(F.col("line")).alias("kind"))


@query(rf"""
WITH l AS (SELECT conv_id, place, line, {_KIND_SQL} AS kind FROM ({_LINES.format(source=_RECORD_SQL)}) WHERE trim(line) <> ''),
m AS (SELECT *, CASE WHEN kind = 'SPEECH' THEN CASE WHEN line LIKE 'Mr User: %' THEN 'Mr User' WHEN line LIKE 'The Assistant: %' THEN 'The Assistant' END END AS label FROM l),
b AS (SELECT *, kind <> 'SPEECH' OR label IS NOT NULL OR coalesce(lag(kind) OVER w <> 'SPEECH', true) AS begins, max(CASE WHEN kind <> 'SPEECH' OR label IS NOT NULL THEN place END) OVER w AS label_place FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY place)),
t AS (SELECT b.*, sum(begins::INT) OVER (PARTITION BY conv_id ORDER BY place) AS turn FROM b),
s AS (SELECT t.conv_id, turn, min(t.place) AS first_place, min(CASE WHEN t.kind = 'SPEECH' THEN m.label END) AS speaker, min(t.kind) AS kind, string_agg({_TRIMMED.format("CASE WHEN t.label IS NULL THEN t.line ELSE regexp_replace(t.line, '^(Mr User|The Assistant)[ ]*:[ ]*', '') END")}, chr(10) ORDER BY t.place) AS transcript
  FROM t LEFT JOIN m ON m.conv_id = t.conv_id AND m.place = t.label_place GROUP BY 1, 2)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY first_place) AS ordinal, speaker, kind, transcript FROM s
""")
def split_turns(spark: SparkSession, d: str) -> DataFrame:
    return X.split_turns(X.lines(_records(spark, d), "conv_id", "text"), "conv_id")


_EVENTFUL = "concat('(in Tamil) ', CASE WHEN turn % 3 = 0 THEN '[Applause.] ' ELSE '' END, role, ' speaks (Laughter) on ', CAST(turn AS STRING), ' matters.', CASE WHEN turn % 2 = 0 THEN ' (Interruption.)' ELSE '' END)"


@query(f"""
WITH c AS (SELECT conv_id, turn, regexp_extract_all(t, '[\\[(](?:Applause|Laughter|Interruption)[^\\])]*[\\])]') AS e, trim(regexp_replace(t, '\\s*[\\[(](?:Applause|Laughter|Interruption)[^\\])]*[\\])]\\s*', ' ', 'g')) AS rest FROM (SELECT conv_id, turn, {_EVENTFUL} AS t FROM conversations)),
p AS (SELECT conv_id, turn, [rest] || e AS parts FROM c)
SELECT conv_id, turn, (i - 1)::INT AS part, CASE WHEN i = 1 THEN 'SPEECH' ELSE 'CHAMBER_EVENT' END AS kind, parts[i] AS transcript FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM p)
""")
def split_events(spark: SparkSession, d: str) -> DataFrame:
    return X.split_events(rows(spark, d, "conversations", "conv_id", "turn", f"{_EVENTFUL} AS t"), ["conv_id", "turn"], "t")


@query("SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'Mandarin' END AS language, CASE WHEN turn % 2 = 0 THEN ltrim(text) ELSE text END AS transcript FROM conversations")
def language_note(spark: SparkSession, d: str) -> DataFrame:
    c = rows(spark, d, "conversations", "conv_id", "turn", "CASE WHEN turn % 2 = 0 THEN concat('_(In MANDARIN)_: ', text) ELSE text END AS t")
    language, rest = X.language_note(F.col("t"))
    return c.select("conv_id", "turn", language.alias("language"), rest.alias("transcript"))


@query(f"""
WITH l AS ({_LINES.format(source=_RECORD_SQL)}), t AS (SELECT conv_id, lower(regexp_replace(CASE WHEN conv_id % 2 = 0 THEN 'Question put and agreed to' ELSE 'The Assistant' END, '[^0-9A-Za-z]+', '', 'g')) AS t FROM conversations GROUP BY 1, 2),
f AS (SELECT l.conv_id, place, lower(regexp_replace(line, '[^0-9A-Za-z]+', '', 'g')) AS f, t FROM l JOIN t ON l.conv_id = t.conv_id),
m AS (SELECT conv_id, min(place) FILTER (f = t) AS a, min(place) FILTER (length(t) >= 20 AND starts_with(f, t[:20])) AS b FROM f GROUP BY 1)
SELECT conv_id, coalesce(a, b, -1)::INT AS start, CASE WHEN a IS NOT NULL THEN 'EQUAL' WHEN b IS NOT NULL THEN 'PREFIX' END AS rule FROM m
""")
def start_line(spark: SparkSession, d: str) -> DataFrame:
    records = _records(spark, d)
    titles = records.select("conv_id", F.when(F.col("conv_id") % 2 == 0, "Question put and agreed to").otherwise("The Assistant").alias("title"))
    return X.start_line(X.lines(records, "conv_id", "text"), titles, "conv_id", "title")


@query(f"""
WITH l AS ({_LINES.format(source=_RECORD_SQL)}), w AS (SELECT *, sum((line LIKE '(Applause%')::INT) OVER (PARTITION BY conv_id ORDER BY place) AS section, max(CASE WHEN line LIKE '(Applause%' THEN place END) OVER (PARTITION BY conv_id ORDER BY place) AS h, max(CASE WHEN line LIKE 'Question put%' THEN place END) OVER (PARTITION BY conv_id ORDER BY place) AS e FROM l)
SELECT conv_id, section::BIGINT AS section, place, line FROM w WHERE h IS NOT NULL AND place > h AND (e IS NULL OR e < h)
""")
def section_lines(spark: SparkSession, d: str) -> DataFrame:
    return X.section_lines(X.lines(_records(spark, d), "conv_id", "text"), "conv_id", r"^\(Applause", r"^Question put")


_ENTRIES = "concat('Mr ', c_name, ' (Place ', CAST(c_nationkey AS STRING), '), Minister for ', c_mktsegment, '; Ms Lee; Dr Tan, Whip.')"


@query("""
SELECT c_custkey, e.entry, e.name, e.place_name, e.office FROM customer, LATERAL (SELECT 0 AS entry, 'Mr ' || c_name AS name, 'Place ' || c_nationkey AS place_name, 'Minister for ' || c_mktsegment AS office UNION ALL SELECT 1, 'Ms Lee', NULL, NULL UNION ALL SELECT 2, 'Dr Tan', NULL, 'Whip') e
""")
def parse_entries(spark: SparkSession, d: str) -> DataFrame:
    return X.parse_entries(rows(spark, d, "customer", "c_custkey", f"{_ENTRIES} AS line"), ["c_custkey"])


_COUNTS = "CASE o_orderkey % 3 WHEN 0 THEN concat('The House divided: Ayes, ', o_orderkey % 90, '; Noes, ', o_custkey % 40, '; Abstentions, ', o_orderkey % 4, '.') WHEN 1 THEN concat('There are ', o_orderkey % 90, ' \"Ayes\" and ', o_custkey % 40, ' Noes.') ELSE 'No counts here.' END"


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN o_orderkey % 90 END AS ayes, CASE WHEN o_orderkey % 3 < 2 THEN o_custkey % 40 END AS noes, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 4 END AS abstentions, NULL::INT AS absent FROM orders")
def parse_counts(spark: SparkSession, d: str) -> DataFrame:
    r = rows(spark, d, "orders", "o_orderkey", f"{_COUNTS} AS t")
    return r.select("o_orderkey", *(c.alias(n) for n, c in X.parse_counts(F.col("t")).items()))


@query("SELECT l_orderkey, count(*) AS names, max(printed) AS printed, CASE WHEN count(*) = max(printed) THEN 'ACCEPTED' ELSE 'COUNTS_DISAGREE' END AS verdict FROM (SELECT l_orderkey, 1 + l_orderkey % 6 AS printed FROM lineitem) GROUP BY 1")
def counts_agree(spark: SparkSession, d: str) -> DataFrame:
    found = rows(spark, d, "lineitem", "l_orderkey", "1 + l_orderkey % 6 AS printed").groupBy("l_orderkey").agg(F.count("*").alias("names"), F.max("printed").alias("printed"))
    return found.withColumn("verdict", F.when(F.col("names") == F.col("printed"), "ACCEPTED").otherwise("COUNTS_DISAGREE"))


_NOTE = "concat('[Please refer to \"', p_name, '\" and \"', p_type, '\", Official Report, ', CAST(1 + p_partkey % 31 AS STRING), 'st June 20', CAST(10 + p_size % 14 AS STRING), ', Vol 94.]')"


@query("SELECT p_partkey, 0 AS n, title, try_cast('20' || (10 + p_size % 14) || '-06-' || (1 + p_partkey % 31) AS DATE) AS day FROM (SELECT p_partkey, p_size, unnest([p_name, p_type]) AS title FROM part)")
def extract_citations(spark: SparkSession, d: str) -> DataFrame:
    return X.citations(rows(spark, d, "part", "p_partkey", f"{_NOTE} AS t"), ["p_partkey"], "t")


@query(r"""
WITH h AS (SELECT page_id, regexp_extract_all(html, '(?i)<a\s[^>]*?href="([^"]*)"', 1) AS l FROM pages), u AS (SELECT page_id, unnest(l) AS href, (generate_subscripts(l, 1) - 1)::INT AS n FROM h)
SELECT page_id, n, href, CASE WHEN regexp_matches(href, '(?i)\.(?:pdf|docx?|xlsx?)$') THEN 'FILE' WHEN href LIKE '#%' THEN 'ANCHOR' WHEN regexp_matches(href, '^https?://') THEN 'ABSOLUTE' ELSE 'RELATIVE' END AS shape FROM u
""")
def extract_links(spark: SparkSession, d: str) -> DataFrame:
    return X.links(rows(spark, d, "pages", "page_id", "html"), "page_id", "html")


_PICTURE = "concat('<img src=\"data:image/PNG;base64,', base64({}), '\"><p>', url, '</p>')"


@query("SELECT page_id, 0 AS n, 'image/png' AS media_type, octet_length(encode(url)) AS bytes, sha256(url) AS sha256 FROM pages")
def inline_images(spark: SparkSession, d: str) -> DataFrame:
    return X.inline_pictures(rows(spark, d, "pages", "page_id", f"{_PICTURE.format('cast(url AS BINARY)')} AS html"), "page_id", "html")


@query("""
WITH c AS (SELECT conv_id, turn, role, min(turn) FILTER (role = 'assistant') OVER (PARTITION BY conv_id) AS a FROM conversations), b AS (SELECT *, min(turn) FILTER (turn >= a AND turn % 3 = 0) OVER (PARTITION BY conv_id) AS z FROM c)
SELECT conv_id, turn, CASE WHEN turn BETWEEN a AND z THEN 'credited' ELSE role END AS role FROM b
""")
def override_range(spark: SparkSession, d: str) -> DataFrame:
    return X.override_range(rows(spark, d, "conversations", "conv_id", "turn", "role"), "conv_id", "turn", "role", F.col("role") == "assistant", F.col("turn") % 3 == 0, F.lit("credited"))


@query()
def html_lines(spark: SparkSession, d: str) -> DataFrame:
    return X.html_lines(rows(spark, d, "pages", "page_id", "html"), "page_id", "html")


_LISTING = "concat('<table><tr><th>No.</th><th>Title</th></tr><tr class=\"x\"><td>', CAST(page_id AS STRING), '</td><td><a href=\"', url, '\">The  <b>', split_part(url, '/', 3), '</b> Act</a></td></tr></table>')"


@query("SELECT page_id, 0 AS row, 'No.|Title' AS cells FROM pages UNION ALL SELECT page_id, 1, page_id || '|The ' || split_part(url, '/', 3) || ' Act' FROM pages")
def listing_rows(spark: SparkSession, d: str) -> DataFrame:
    return X.listing_rows(rows(spark, d, "pages", "page_id", f"{_LISTING} AS html"), "page_id", "html").select("page_id", "row", F.concat_ws("|", "cells").alias("cells"))


@query(f"SELECT conv_id, place * 3 AS place, 'Word x y ' || line AS line FROM (SELECT conv_id, place, regexp_replace(line, '^ +| +$', '', 'g') AS line FROM ({_LINES.format(source=_RECORD_SQL)}) WHERE trim(line) <> '')")
def join_cut_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Each line is cut after its first words by a column marker, and joined again."""
    cut = X.lines(_records(spark, d), "conv_id", "text").where(F.trim("line") != "")
    parts = F.array(F.lit("Word x"), F.lit("Column: 12"), F.concat(F.lit("y "), F.trim("line")))
    broken = cut.select("conv_id", "place", F.posexplode(parts).alias("k", "line")).select("conv_id", (F.col("place") * 3 + F.col("k")).alias("place"), "line")
    return X.join_cut_paragraphs(broken, "conv_id")


@query("SELECT conv_id, turn + 1 AS number, (turn + 1) || '. Act ' || turn || chr(10) || 'Date: ' || role || chr(10) || CASE WHEN turn > 0 THEN '1. a line of its own' ELSE '7. a line of its own' END AS text FROM conversations")
def history_entries(spark: SparkSession, d: str) -> DataFrame:
    """Blocks with numbered lines of their own inside."""
    inner = "CASE WHEN turn > 0 THEN '1. a line of its own' ELSE '7. a line of its own' END"
    turns = rows(spark, d, "conversations", "conv_id", "turn", f"concat(turn + 1, '. Act ', turn, chr(10), 'Date: ', role, chr(10), {inner}) AS t")
    text = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "t"))).alias("a")).select("conv_id", F.concat_ws("\n", F.transform("a", lambda x: x["t"])).alias("text"))
    return X.history_entries(X.lines(text, "conv_id", "text"), "conv_id")


_NULS = "concat('{\"a\": \"', split_part(url, '/', 3), chr(92), 'u0000x', chr(92), chr(92), 'u0000\"}')"


@query("SELECT page_id, concat('{\"a\": \"', split_part(url, '/', 3), 'x', chr(92), chr(92), 'u0000\"}') AS body FROM pages")
def nul_strip(spark: SparkSession, d: str) -> DataFrame:
    """An escaped NUL goes; an escaped backslash before u0000 stays."""
    return rows(spark, d, "pages", "page_id", f"{_NULS} AS body").select("page_id", N.strip_nul(F.col("body")).alias("body"))


_MARKED = "concat('<p class=\"a\">**', split_part(url, '/', 3), '**<br/>_and_  &lt;b&gt; &amp;amp; ', page_id, '</p>')"


@query("SELECT page_id, concat(split_part(url, '/', 3), ' and <b> &amp; ', page_id) AS text FROM pages")
def diff_text(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "pages", "page_id", f"{_MARKED} AS t").select("page_id", N.diff_text(F.col("t")).alias("text"))


_GAZETTE = "concat('REPUBLIC\n', upper(url), '\n BILL\nBill No. ', page_id + 1, '/', 1990 + page_id % 30, '.\nRead the first time on the ', 1 + page_id % 28, 'th March, ', 1990 + page_id % 30, '.\n', CASE WHEN page_id % 2 = 0 THEN concat('Passed by Parliament on ', 1 + page_id % 28, ' May ', 1990 + page_id % 30, '. Act ', page_id + 2, ' of ', 1990 + page_id % 30) ELSE '' END)"


@query("""
SELECT page_id, CASE WHEN page_id % 9 <> 4 THEN 'REPUBLIC ' || upper(url) || ' BILL' END AS title, CASE WHEN page_id % 9 <> 4 THEN (page_id + 1) || '/' || y END AS bill_number, CASE WHEN page_id % 9 <> 4 THEN make_date(y, 3, d) END AS first_reading,
  CASE WHEN page_id % 9 <> 4 AND page_id % 2 = 0 THEN make_date(y, 5, d) END AS passing, CASE WHEN page_id % 9 <> 4 AND page_id % 2 = 0 THEN (page_id + 2) || '/' || y END AS act_number
FROM (SELECT *, (1990 + page_id % 30)::INT AS y, (1 + page_id % 28)::INT AS d FROM pages)
""")
def gazette_fields(spark: SparkSession, d: str) -> DataFrame:
    r = rows(spark, d, "pages", "page_id", f"CASE WHEN page_id % 9 <> 4 THEN {_GAZETTE} ELSE 'No number here.' END AS t")
    return r.select("page_id", *(c.alias(n) for n, c in X.gazette_fields(F.col("t")).items()))


_INDEX = "CASE WHEN page_id % 2 = 0 THEN concat('{\"data\": [{\"description\": \"Minutes ', page_id, '\", \"date\": \"', 1 + page_id % 28, '-5-2019\", \"file\": \"m', page_id, '.pdf\"}, {\"description\": \"none\"}]}') ELSE concat('<div class=\"indv-votes\"><h5>Votes ', page_id, '</h5><p>Sitting on Monday, ', 1 + page_id % 28, ' May 2001</p><a href=\"v', page_id, '.doc\">x</a></div><div class=\"indv-votes\"><a href=\"w.pdf?a=1\"><span>Last</span></a></div>') END"


@query("""
SELECT page_id, 0 AS n, 'Minutes ' || page_id AS label, make_date(2019, 5, (1 + page_id % 28)::INT) AS day, 'm' || page_id || '.pdf' AS href, 'PDF' AS format FROM pages WHERE page_id % 2 = 0
UNION ALL SELECT page_id, 0, 'Votes ' || page_id, make_date(2001, 5, (1 + page_id % 28)::INT), 'v' || page_id || '.doc', 'DOC' FROM pages WHERE page_id % 2 = 1
UNION ALL SELECT page_id, 1, 'Last', NULL, 'w.pdf?a=1', 'PDF' FROM pages WHERE page_id % 2 = 1
""")
def index_pages(spark: SparkSession, d: str) -> DataFrame:
    """Both layouts."""
    return X.index_rows(rows(spark, d, "pages", "page_id", f"{_INDEX} AS html"), "page_id", "html")


@query("""
WITH t AS (SELECT conv_id, turn, (sum(17 + length(turn::VARCHAR) + length(conv_id::VARCHAR)) OVER (PARTITION BY conv_id ORDER BY turn) - (17 + length(turn::VARCHAR) + length(conv_id::VARCHAR)))::INT AS begins FROM conversations)
SELECT conv_id, turn, CASE WHEN turn % 5 <> 4 THEN begins END AS position FROM t
""")
def text_alignment(spark: SparkSession, d: str) -> DataFrame:
    """Turns are found one after the other in their conversation's text; those that are not in it are skipped."""
    turns = rows(spark, d, "conversations", "conv_id", "turn", "concat('*Turn*  number ', turn, ' of ', conv_id) AS t")
    text = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "t"))).alias("a")).select("conv_id", F.concat_ws("\n", F.transform("a", lambda x: x["t"])).alias("text"))
    sought = turns.withColumn("t", F.when(F.col("turn") % 5 == 4, F.concat(F.lit("other "), "t")).otherwise(F.col("t")))
    return X.align_rows(sought, text, "conv_id", "turn", "t", "text")


@query(f"""
WITH l AS (SELECT conv_id, place, regexp_replace(line, '^ +| +$', '', 'g') AS line FROM ({_LINES.format(source=_RECORD_SQL)})), p AS (SELECT *, sum((line = '')::INT) OVER (PARTITION BY conv_id ORDER BY place) AS p FROM l),
m AS (SELECT *, max(length(line)) OVER (PARTITION BY conv_id, p) AS longest, lag(length(line)) OVER (PARTITION BY conv_id, p ORDER BY place) AS before FROM p WHERE line <> ''),
r AS (SELECT *, sum((NOT coalesce(before >= 20 AND before >= longest * 0.6, false))::INT) OVER (PARTITION BY conv_id, p ORDER BY place) AS r FROM m)
SELECT conv_id, min(place) AS place, regexp_replace(string_agg(line, ' ' ORDER BY place), '([a-zà-ÿß])- ([a-zà-ÿ])', '\\1\\2', 'g') AS line FROM r GROUP BY conv_id, p, r
""")
def wrapped_lines(spark: SparkSession, d: str) -> DataFrame:
    return X.join_wrapped_lines(X.lines(_records(spark, d), "conv_id", "text"), "conv_id")


_ONE_TURNS = "conv_id", "turn AS ordinal", "CASE WHEN turn % 4 = 3 THEN NULL WHEN conv_id % 2 = 0 THEN 'only' ELSE role END AS speaker", "CASE WHEN turn % 4 = 3 THEN 'PROCEDURAL' ELSE 'SPEECH' END AS kind", "text AS transcript"


@query(f"""
WITH t AS (SELECT {", ".join(_ONE_TURNS)} FROM conversations), w AS (SELECT conv_id, min(speaker) = max(speaker) AS one, min(speaker) AS who FROM t WHERE kind = 'SPEECH' GROUP BY 1),
j AS (SELECT t.*, one, who, NOT coalesce(one AND kind = 'SPEECH' AND lag(kind) OVER (PARTITION BY t.conv_id ORDER BY ordinal) = 'SPEECH', false) AS new FROM t LEFT JOIN w ON t.conv_id = w.conv_id),
r AS (SELECT *, sum(new::INT) OVER (PARTITION BY conv_id ORDER BY ordinal) AS r FROM j)
SELECT conv_id, r::INT AS ordinal, CASE WHEN min(kind) = 'SPEECH' THEN coalesce(CASE WHEN bool_or(one) THEN min(who) END, min(speaker)) END AS speaker, min(kind) AS kind, string_agg(transcript, chr(10) ORDER BY ordinal) AS transcript FROM r GROUP BY conv_id, r
""")
def single_speaker(spark: SparkSession, d: str) -> DataFrame:
    return X.collapse_single(rows(spark, d, "conversations", *_ONE_TURNS), "conv_id")


_LIST = "concat('AYES, ', 1 + c_custkey % 3 + c_custkey % 2, chr(10), 'Mr ', c_name, '   Dr Lim', CASE WHEN c_custkey % 3 > 0 THEN concat(chr(10), 'Ms Goh') ELSE '' END, CASE WHEN c_custkey % 3 > 1 THEN ' | Mdm Ho.' ELSE '' END, chr(10), 'Noes:', chr(10), 'Er Chua; ', c_mktsegment, chr(10), '-----', chr(10), 'Absent 0')"


def _lists(spark: SparkSession, d: str) -> DataFrame:
    return X.lines(rows(spark, d, "customer", "c_custkey", f"{_LIST} AS t"), "c_custkey", "t")


@query("""
SELECT c_custkey, 'ayes' AS side, 1 AS n, 'Mr ' || c_name AS name FROM customer UNION ALL SELECT c_custkey, 'ayes', 2, 'Dr Lim' FROM customer UNION ALL SELECT c_custkey, 'ayes', 3, 'Ms Goh' FROM customer WHERE c_custkey % 3 > 0 UNION ALL SELECT c_custkey, 'ayes', 4, 'Mdm Ho' FROM customer WHERE c_custkey % 3 > 1
UNION ALL SELECT c_custkey, 'noes', 1, 'Er Chua' FROM customer UNION ALL SELECT c_custkey, 'noes', 2, c_mktsegment FROM customer
""")
def division_names(spark: SparkSession, d: str) -> DataFrame:
    return X.division_names(_lists(spark, d), "c_custkey")


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN make_date((1980 + o_custkey % 30)::INT, 5, (1 + o_orderkey % 28)::INT) WHEN 1 THEN make_date((1980 + o_custkey % 30)::INT, 3, (1 + o_orderkey % 28)::INT) END AS resumed FROM orders")
def resumption_headings(spark: SparkSession, d: str) -> DataFrame:
    heading = "CASE o_orderkey % 3 WHEN 0 THEN concat('[Debate resumed from ', 1 + o_orderkey % 28, 'th May, ', 1980 + o_custkey % 30, ']') WHEN 1 THEN concat('Order read for resumption of debate (', 1 + o_orderkey % 28, ' Mar ', 1980 + o_custkey % 30, ').') ELSE concat('Read on ', 1 + o_orderkey % 28, ' May 1999') END AS t"
    return rows(spark, d, "orders", "o_orderkey", heading).select("o_orderkey", X.resumed_day(F.col("t")).alias("resumed"))


@query("SELECT p_partkey, p_name || ' Act' AS title, make_date(1990, 3, (1 + p_partkey % 28)::INT) AS first_reading, CASE WHEN p_partkey % 2 = 0 THEN make_date(1990, 4, (1 + p_partkey % 28)::INT) END AS third_reading, CASE WHEN p_partkey % 3 = 0 THEN make_date(1990, 5, 1) END AS assent, make_date(1991, 1, 1) AS commencement FROM part")
def history_fields(spark: SparkSession, d: str) -> DataFrame:
    text = "concat(p_partkey, '. ', p_name, '  Act', chr(10), 'Date of First Reading: ', 1 + p_partkey % 28, ' March 1990', chr(10), CASE WHEN p_partkey % 2 = 0 THEN concat('Second and Third Reading : ', 1 + p_partkey % 28, ' April 1990', chr(10)) ELSE '' END, CASE WHEN p_partkey % 3 = 0 THEN concat('Date of Assent: 1 May 1990', chr(10)) ELSE '' END, 'Commencement  1 January 1991') AS t"
    return rows(spark, d, "part", "p_partkey", text).select("p_partkey", *(c.alias(n) for n, c in X.history_fields(F.col("t")).items()))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'The Minister for ' || c_mktsegment WHEN 1 THEN 'Parliamentary Secretary' END AS office FROM customer")
def label_offices(spark: SparkSession, d: str) -> DataFrame:
    label = "CASE c_custkey % 4 WHEN 0 THEN concat('The Minister for ', c_mktsegment, ' (Mr ', c_name, ')') WHEN 1 THEN concat('Dr ', c_name, ' (Parliamentary Secretary)') WHEN 2 THEN concat('Ms ', c_name, ' (Place)') ELSE c_name END AS t"
    return rows(spark, d, "customer", "c_custkey", label).select("c_custkey", X.label_office(F.col("t")).alias("office"))
