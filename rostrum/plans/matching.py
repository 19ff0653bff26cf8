"""Matching, places, askers and columns over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.functions import names as N
from rostrum.operators import joins as J
from rostrum.operators import matching as M
from rostrum.operators import resolve as R
from rostrum.plans.registry import query, rows


@query("""
WITH m AS (SELECT conv_id, turn * 100 AS started, role AS holder FROM conversations WHERE turn % 3 = 0)
SELECT c.conv_id, c.turn, c.turn * 100 + 50 AS offset, started, holder FROM conversations c ASOF LEFT JOIN m ON c.conv_id = m.conv_id AND c.turn * 100 + 50 >= m.started
""")
def asof_offset(spark: SparkSession, d: str) -> DataFrame:
    marks = rows(spark, d, "conversations", "conv_id", "turn * 100 AS started", "role AS holder", where="turn % 3 = 0")
    return J.asof_join(rows(spark, d, "conversations", "conv_id", "turn", "turn * 100 + 50 AS offset"), marks, ["conv_id"], "offset", "started", ["holder"])


@query("SELECT doc_id, CASE WHEN length(text) - length(replace(text, '“', '')) <> length(text) - length(replace(text, '”', '')) THEN CASE WHEN length(text) - length(replace(text, '(', '')) <> length(text) - length(replace(text, ')', '')) THEN 'unbalanced double quotes;unbalanced parentheses' ELSE 'unbalanced double quotes' END WHEN length(text) - length(replace(text, '(', '')) <> length(text) - length(replace(text, ')', '')) THEN 'unbalanced parentheses' ELSE '' END AS pairs FROM (SELECT doc_id, concat('(“', text, CASE WHEN doc_id % 2 = 0 THEN ')' ELSE '”' END) AS text FROM documents)")
def unbalanced_pairs(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "documents", "doc_id", "concat('(“', text, CASE WHEN doc_id % 2 = 0 THEN ')' ELSE '”' END) AS text").select("doc_id", N.unbalanced_pairs(F.col("text")).alias("pairs"))


@query()
def split_bill_merges(spark: SparkSession, d: str) -> DataFrame:
    bills = rows(spark, d, "orders", "o_orderkey AS id", "o_custkey", "concat('The Customer ', o_custkey, ' Amendment Bill ', o_orderkey % 3) AS title", "to_date(o_orderdate) AS day", "o_orderstatus")
    return M.split_bill_merges(bills.where("o_orderstatus = 'F'"), bills.where("o_orderstatus = 'O'"), "o_custkey", 0.95)


@query()
def sequence_diff(spark: SparkSession, d: str) -> DataFrame:
    old = rows(spark, d, "conversations", "conv_id", "turn", "text")
    new = rows(spark, d, "conversations", "conv_id", "turn", "CASE WHEN turn % 4 = 2 THEN upper(text) ELSE text END AS text", where="turn % 5 <> 3")
    return M.sequence_diff(old, new, "conv_id", "turn", "text")


_BROKEN = "concat(text, ' CafÃ© â€“ naÃ¯ve é')"


@query("SELECT doc_id, text || ' Café – naïve é' AS text FROM documents")
def mojibake(spark: SparkSession, d: str) -> DataFrame:
    """Every text gets letters and a dash whose UTF-8 was read as cp1252, and one letter that is in order."""
    return M.repair_mojibake(rows(spark, d, "documents", "doc_id", f"{_BROKEN} AS text"), "text")


_PLACED_REPORTS = ["conv_id // 4 AS sitting", "conv_id * 100 + turn AS report_id", "(turn * 5 + conv_id * 3) % 7 AS number", "'T' || conv_id % 2 || turn % 3 AS title", "'s' || turn % 4 AS subtitle", "CASE WHEN turn % 7 = 3 THEN NULL ELSE text || CASE WHEN turn % 5 = 0 THEN '' ELSE 'x' END END AS content", "turn % 7 = 3 AND conv_id % 2 = 0 AS is_assent"]
_PLACED_SECTIONS = ["conv_id // 4 AS sitting", "conv_id * 100 + turn AS place", "'t' || conv_id % 2 || '.' || turn % 3 AS title", "'S' || turn % 5 AS subtitle", "text AS content"]


@query(f"""
WITH RECURSIVE r AS (SELECT *, row_number() OVER (PARTITION BY sitting ORDER BY number, report_id) AS n FROM (SELECT {", ".join(_PLACED_REPORTS)} FROM conversations)), s AS (SELECT {", ".join(_PLACED_SECTIONS)} FROM conversations),
o AS (SELECT sitting, content, min(place) AS place FROM s WHERE content IS NOT NULL GROUP BY 1, 2 HAVING count(*) = 1),
c AS (SELECT r.sitting, arg_min(report_id, n) AS report_id, o.place FROM r JOIN o ON r.sitting = o.sitting AND r.content = o.content WHERE NOT (is_assent AND coalesce(r.content, '') = '') GROUP BY r.sitting, o.place),
k AS (SELECT s.sitting, list({{'place': s.place, 'title': lower(replace(s.title, '.', '')), 'sub': lower(s.subtitle)}}) AS free FROM s LEFT JOIN c ON s.sitting = c.sitting AND s.place = c.place WHERE c.place IS NULL GROUP BY 1),
a AS (SELECT r.sitting, report_id, lower(title) AS title, subtitle AS sub, row_number() OVER (PARTITION BY r.sitting ORDER BY n) AS n FROM r WHERE report_id NOT IN (SELECT report_id FROM c) AND NOT (is_assent AND coalesce(content, '') = '')),
w AS (SELECT sitting, 0::BIGINT AS n, NULL::BIGINT AS report_id, free, NULL::BIGINT AS place, NULL::VARCHAR AS rule FROM k
  UNION ALL SELECT sitting, n, report_id, list_filter(free, lambda x: place IS NULL OR x.place <> place), place, CASE WHEN place IS NULL THEN 'NOT_PLACED' WHEN len(same) = 1 THEN 'TITLE' ELSE 'SUBTITLE' END
  FROM (SELECT *, CASE WHEN len(same) = 1 THEN same[1].place WHEN len(pair) = 1 THEN pair[1].place END AS place FROM (SELECT *, list_filter(same, lambda x: x.sub = asked) AS pair
    FROM (SELECT w.sitting, a.n, a.report_id, w.free, a.sub AS asked, list_filter(w.free, lambda x: x.title = a.title) AS same FROM w JOIN a ON a.sitting = w.sitting AND a.n = w.n + 1)))),
f AS (SELECT report_id, place, 'CONTENT' AS rule FROM c UNION ALL SELECT report_id, place, rule FROM w WHERE n > 0)
SELECT r.report_id, f.place, coalesce(f.rule, CASE WHEN is_assent AND content IS NULL THEN 'ASSENT_FIRST' ELSE 'NOT_PLACED' END) AS rule FROM r LEFT JOIN f ON r.report_id = f.report_id
""")
def printed_place(spark: SparkSession, d: str) -> DataFrame:
    """Reports of sittings that take their places in order; the SQL walks them one by one."""
    spark_sql = lambda cs: [c.replace("//", "div").replace("'T' || conv_id % 2 || turn % 3", "concat('T', conv_id % 2, turn % 3)").replace("'s' || turn % 4", "concat('s', turn % 4)").replace("'t' || conv_id % 2 || '.' || turn % 3", "concat('t', conv_id % 2, '.', turn % 3)").replace("'S' || turn % 5", "concat('S', turn % 5)") for c in cs]
    return M.printed_places(rows(spark, d, "conversations", *spark_sql(_PLACED_REPORTS)), rows(spark, d, "conversations", *spark_sql(_PLACED_SECTIONS)), "sitting")


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'Minister for ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) WHEN 1 THEN 'Prime Minister' END AS office FROM orders JOIN customer ON o_custkey = c_custkey")
def put_to_phrase(spark: SparkSession, d: str) -> DataFrame:
    asked = "CASE o_orderkey % 3 WHEN 0 THEN concat('Mr Tan asked the Minister for ', initcap(c_mktsegment), ' (a) whether') WHEN 1 THEN 'To ask the Prime Minister whether it is so' ELSE 'No question.' END AS t"
    joined = rows(spark, d, "orders", "o_orderkey", "o_custkey AS c_custkey").join(rows(spark, d, "customer", "c_custkey", "c_mktsegment"), "c_custkey").selectExpr("o_orderkey", asked)
    return joined.select("o_orderkey", M.put_to_phrase(F.col("t")).alias("office"))


@query("""
SELECT o_orderkey, CASE k WHEN 0 THEN 'PROSE_RANGE' WHEN 1 THEN 'PROSE_DURATION' WHEN 2 THEN 'PROSE_SINGLE_DAY' WHEN 3 THEN 'UNREAD' WHEN 4 THEN 'TABLE_ROW' WHEN 5 THEN 'STRUCTURED_LIST' WHEN 6 THEN 'PROSE_DAY_LIST' ELSE 'PROSE_MIXED' END AS form,
  CASE WHEN k = 6 THEN '1, 2 and ' || p WHEN k <> 3 THEN p END AS first, CASE WHEN k IN (0, 4, 5, 7) THEN '9 May 1999' WHEN k = 2 THEN p WHEN k = 6 THEN '1, 2 and ' || p END AS last, CASE WHEN k = 1 THEN 3 END AS number, CASE WHEN k = 1 THEN 'week' END AS unit
FROM (SELECT o_orderkey, o_orderkey % 8 AS k, (1 + o_orderkey % 28) || ' March ' || (1970 + o_custkey % 40) AS p FROM orders)
""")
def leave_entries(spark: SparkSession, d: str) -> DataFrame:
    p = "concat(1 + o_orderkey % 28, ' March ', 1970 + o_custkey % 40)"
    forms = [f"concat('Mr Tan, from ', {p}, ' to 9 May 1999')", f"concat('3 weeks from ', {p})", f"concat('on ', {p}, '.')", "'until further notice'", f"concat('| Mr Tan | ', {p}, ' | 9 May 1999 |')", f"concat('(a) Mr Tan: ', {p}, ' - 9 May 1999')", f"concat('on 1, 2 and ', {p})", f"concat('Mr Tan, ', {p}, ' to 9 May 1999 and on 12 June 1999')"]
    text = "CASE o_orderkey % 8 " + " ".join(f"WHEN {k} THEN {form}" for k, form in enumerate(forms)) + " END AS t"
    r = rows(spark, d, "orders", "o_orderkey", text)
    return r.select("o_orderkey", *(c.alias(n) for n, c in M.parse_leave(F.col("t")).items()))


@query("""
WITH k AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN turn % 4 END AS speaker_id, role AS printed, coalesce('#' || CASE WHEN turn % 2 = 0 THEN turn % 4 END, role) AS who FROM conversations),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id, who ORDER BY turn) AS n FROM k)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS ordinal, speaker_id, printed FROM f WHERE n = 1
""")
def report_askers(spark: SparkSession, d: str) -> DataFrame:
    r = rows(spark, d, "conversations", "conv_id", "turn", "CASE WHEN turn % 2 = 0 THEN turn % 4 END AS speaker_id", "role AS printed")
    return M.askers(r, "conv_id", "turn", "speaker_id", "printed")


@query("""
WITH h AS (SELECT conv_id, role AS speaker, min(turn) AS first_ordinal, 0 AS rank, 'ASKER' AS role FROM conversations WHERE turn = 0 GROUP BY 1, 2 UNION ALL SELECT conv_id, role, min(turn), 1, 'SUPPLEMENTARY' FROM conversations WHERE length(text) < 200 GROUP BY 1, 2 UNION ALL SELECT conv_id, role, min(turn), 2, 'ANSWERER' FROM conversations WHERE turn % 2 = 1 GROUP BY 1, 2)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY first_ordinal, rank, speaker) AS ordinal, speaker, role, first_ordinal FROM h
""")
def report_participants(spark: SparkSession, d: str) -> DataFrame:
    turns = rows(spark, d, "conversations", "conv_id", "turn AS ordinal", "role AS speaker", "length(text) AS size")
    roles = [("ASKER", F.col("ordinal") == 0), ("SUPPLEMENTARY", F.col("size") < 200), ("ANSWERER", F.col("ordinal") % 2 == 1)]
    return M.participants(turns, "conv_id", roles)


@query("""
WITH l AS (SELECT conv_id, turn AS place, CASE WHEN turn % 3 = 1 THEN '* A note' ELSE text END AS line FROM conversations), s AS (SELECT *, max(CASE WHEN line LIKE '* %' THEN place END) OVER w AS m, max(CASE WHEN NOT line LIKE '* %' AND length(line) >= 120 THEN place END) OVER w AS b FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY place))
SELECT conv_id, place, m IS NOT NULL AND (b IS NULL OR b < m) AS is_footnote FROM s
""")
def footnotes(spark: SparkSession, d: str) -> DataFrame:
    return M.footnote_lines(rows(spark, d, "conversations", "conv_id", "turn AS place", "CASE WHEN turn % 3 = 1 THEN '* A note' ELSE text END AS line"), "conv_id", r"^[*†‡]\s+\S", 120).select("conv_id", "place", "is_footnote")


@query("""
WITH m AS (SELECT conv_id, turn * 100 AS pos, turn + CASE WHEN conv_id % 3 = 0 AND turn > 3 THEN 60 WHEN conv_id % 4 = 1 AND turn > 2 THEN 1 ELSE 0 END AS number FROM conversations WHERE turn > 0),
n AS (SELECT *, lead(number) OVER w AS nxt, number - lag(number) OVER w AS came FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
h AS (SELECT DISTINCT conv_id, CASE WHEN conv_id % 2 = 0 THEN 0 ELSE 7 END AS head, CASE WHEN conv_id % 5 = 0 THEN 1000 ELSE 0 END AS last, max(turn) OVER (PARTITION BY conv_id) > 0 AS marked FROM conversations),
s AS (SELECT c.conv_id, c.turn AS id, n.number, n.nxt - n.number AS step, n.came, n.pos FROM conversations c ASOF LEFT JOIN n ON c.conv_id = n.conv_id AND c.turn * 100 + 30 >= n.pos),
t AS (SELECT s.*, head, CASE WHEN pos IS NULL THEN CASE WHEN marked AND head = 0 THEN 'HEAD' ELSE 'BEFORE_FIRST' END WHEN step IS NULL THEN CASE WHEN last > number THEN 'PAST_LAST' WHEN came < 0 OR came > 50 THEN 'BROKEN_SEQUENCE' ELSE 'LAST' END WHEN step = 1 THEN 'CONFIRMED' WHEN step < 0 OR step > 50 THEN 'BROKEN_SEQUENCE' ELSE 'SKIPPED_COLUMN' END AS status FROM s JOIN h USING (conv_id))
SELECT conv_id, id, CASE WHEN status = 'HEAD' THEN head WHEN status IN ('CONFIRMED', 'LAST') THEN number END AS printed_column, status FROM t
""")
def speech_columns(spark: SparkSession, d: str) -> DataFrame:
    markers = rows(spark, d, "conversations", "conv_id", "turn * 100 AS offset", "turn + CASE WHEN conv_id % 3 = 0 AND turn > 3 THEN 60 WHEN conv_id % 4 = 1 AND turn > 2 THEN 1 ELSE 0 END AS number", where="turn > 0")
    heads = rows(spark, d, "conversations", "conv_id", "CASE WHEN conv_id % 2 = 0 THEN 0 ELSE 7 END AS first", "CASE WHEN conv_id % 5 = 0 THEN 1000 ELSE 0 END AS last").distinct()
    return M.speech_columns(rows(spark, d, "conversations", "conv_id", "turn AS id", "turn * 100 + 30 AS offset"), markers, "conv_id", heads=heads)


@query("""
WITH u AS (SELECT c_nationkey AS parliament, c_name AS name, c_custkey AS person FROM customer WHERE c_nationkey > 0), l AS (SELECT c_nationkey AS parliament, c_name AS label FROM customer UNION ALL SELECT 0, c_name FROM customer WHERE c_nationkey IN (2, 3)),
a AS (SELECT DISTINCT parliament, label, parliament AS asked, 0 AS priority FROM l UNION ALL SELECT DISTINCT 0, label, k, k FROM l, (SELECT unnest([1, 2, 3]) AS k) WHERE parliament = 0)
SELECT a.parliament, label, arg_min(person, priority) AS person FROM a JOIN u ON a.asked = u.parliament AND a.label = u.name GROUP BY 1, 2
""")
def parliament_fallback(spark: SparkSession, d: str) -> DataFrame:
    people = rows(spark, d, "customer", "c_nationkey AS asked", "c_name AS name", "c_custkey AS person", where="c_nationkey > 0")
    own = rows(spark, d, "customer", "c_nationkey AS parliament", "c_name AS label")
    labels = own.unionByName(rows(spark, d, "customer", "0 AS parliament", "c_name AS label", where="c_nationkey IN (2, 3)"))
    asked = R.with_fallbacks(labels, "parliament", {0: [1, 2, 3]})
    hits = R.resolve_tiered(asked, R.lookups(people, ["asked"]), ["asked"], "label")
    return asked.join(hits, ["asked", "label"]).groupBy("parliament", "label").agg(F.min_by("person", "priority").alias("person"))


_ROLE_TURNS = "conv_id", "turn AS ordinal", "CASE WHEN turn % 5 <> 3 THEN concat(role, turn % 3) END AS speaker", "turn % 4 = 0 AND conv_id % 7 <> 0 AS is_question", "CASE WHEN turn % 8 = 4 THEN concat('filer', conv_id % 5) WHEN turn % 8 = 0 AND conv_id % 3 = 0 THEN 'assistant1' END AS for_whom", "role = 'assistant' AS has_office", "turn % 7 = 6 AS is_chair"
_ROLES_SQL = f"""
t AS (SELECT {", ".join(_ROLE_TURNS)} FROM conversations),
f AS (SELECT *, CASE WHEN is_question THEN coalesce(for_whom, speaker) END AS asker, min(ordinal) FILTER (is_question) OVER (PARTITION BY conv_id) AS q FROM t),
k AS (SELECT DISTINCT conv_id, asker AS speaker FROM f WHERE asker IS NOT NULL), rd AS (SELECT DISTINCT conv_id, speaker FROM f WHERE is_question AND for_whom IS NOT NULL AND speaker IS NOT NULL),
g AS (SELECT f.*, k.speaker IS NOT NULL AS asks, rd.speaker IS NOT NULL AS reads FROM f LEFT JOIN k ON f.conv_id = k.conv_id AND f.speaker = k.speaker LEFT JOIN rd ON f.conv_id = rd.conv_id AND f.speaker = rd.speaker WHERE q IS NOT NULL),
h AS (SELECT *, has_office AND NOT is_chair AND NOT is_question AND ordinal > q AND speaker IS NOT NULL AND NOT asks AS answers FROM g), i AS (SELECT *, min(ordinal) FILTER (answers) OVER (PARTITION BY conv_id) AS a FROM h),
m AS (
  SELECT conv_id, asker AS speaker, 'ASKER' AS role, ordinal FROM i WHERE is_question AND asker IS NOT NULL UNION ALL SELECT conv_id, speaker, 'READER', ordinal FROM i WHERE is_question AND for_whom IS NOT NULL AND speaker IS NOT NULL
  UNION ALL SELECT conv_id, speaker, 'CHAIR', ordinal FROM i WHERE is_chair AND speaker IS NOT NULL UNION ALL SELECT conv_id, speaker, 'ANSWERER', ordinal FROM i WHERE answers
  UNION ALL SELECT conv_id, speaker, 'FOLLOW_UP', ordinal FROM i WHERE NOT is_question AND NOT is_chair AND speaker IS NOT NULL AND asks AND ordinal > a
  UNION ALL SELECT conv_id, speaker, 'SUPPLEMENTARY', ordinal FROM i WHERE NOT is_question AND NOT is_chair AND speaker IS NOT NULL AND NOT has_office AND NOT asks AND NOT reads AND ordinal > a
  UNION ALL SELECT conv_id, '', 'UNLABELLED', ordinal FROM i WHERE speaker IS NULL AND NOT is_chair
), r AS (SELECT conv_id, speaker, role, min(ordinal) AS first_ordinal FROM m GROUP BY 1, 2, 3),
roles AS (SELECT * FROM r UNION ALL SELECT conv_id, speaker, 'ABSENT_FILER', first_ordinal FROM r WHERE role = 'ASKER' AND NOT EXISTS (SELECT 1 FROM t WHERE t.conv_id = r.conv_id AND t.speaker = r.speaker))
"""


@query(f"WITH {_ROLES_SQL} SELECT * FROM roles")
def question_roles(spark: SparkSession, d: str) -> DataFrame:
    """All eight roles, some of them of one speaker."""
    return M.question_roles(rows(spark, d, "conversations", *_ROLE_TURNS), "conv_id")


_STATE_TEXT = "CASE WHEN turn = 1 AND conv_id % 4 = 1 THEN 'By private notice, the Member asked' WHEN turn = 2 AND conv_id % 5 = 2 THEN 'The Member was absent when called' WHEN turn = 3 THEN 'The answer is in writing' ELSE text END"


@query(f"""
WITH {_ROLES_SQL}, s AS (SELECT conv_id, turn, {_STATE_TEXT} AS transcript FROM conversations),
p AS (SELECT conv_id, min(turn) FILTER (transcript LIKE '%private notice%') AS u, min(turn) FILTER (transcript LIKE '%absent when called%') AS ab, min(turn) FILTER (transcript LIKE '%in writing%') AS w FROM s GROUP BY 1),
v AS (SELECT p.*, coalesce(bool_or(role = 'ASKER'), false) AS asked, coalesce(bool_or(role = 'ANSWERER'), false) AS answered FROM p LEFT JOIN roles ON p.conv_id = roles.conv_id GROUP BY ALL),
x AS (SELECT *, CASE WHEN conv_id % 6 <> 1 THEN coalesce(ab, CASE WHEN asked AND NOT answered THEN w END) END AS silent FROM v)
SELECT conv_id, 'CORRECTION' AS state, NULL::INT AS ordinal FROM x WHERE conv_id % 6 = 0 UNION ALL SELECT conv_id, 'URGENT', u::INT FROM x WHERE u IS NOT NULL
UNION ALL SELECT conv_id, 'NOT_ASKED_ALOUD', silent::INT FROM x WHERE conv_id % 6 = 1 OR silent IS NOT NULL UNION ALL SELECT conv_id, 'NOT_A_QUESTION', NULL FROM x WHERE NOT asked
""")
def question_states(spark: SparkSession, d: str) -> DataFrame:
    turns = rows(spark, d, "conversations", *_ROLE_TURNS)
    titles = rows(spark, d, "conversations", "conv_id", "CASE conv_id % 6 WHEN 0 THEN 'CORRECTION BY WRITTEN STATEMENT' WHEN 1 THEN 'QUESTIONS STOOD OVER' ELSE 'Housing' END AS title").distinct()
    patterns = {"correction": "(?i)^correction", "stood_over": "(?i)stood over", "urgent": "private notice", "absent": "absent when called", "not_aloud": "in writing"}
    texts = rows(spark, d, "conversations", "conv_id", "turn AS ordinal", f"{_STATE_TEXT} AS transcript")
    return M.question_states(titles, texts, M.question_roles(turns, "conv_id"), "conv_id", patterns)


@query("""
WITH s AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN turn % 4 END AS speaker_id, 'name' || turn % 4 AS printed, 0 AS k, 'call' AS source FROM conversations WHERE turn % 2 = 0
  UNION ALL SELECT conv_id, turn, NULL, 'name' || turn % 6, 1, 'list' FROM conversations UNION ALL SELECT conv_id, turn, 7, NULL, 2, 'heading' FROM conversations WHERE turn = 1),
k AS (SELECT conv_id, printed, min(speaker_id) AS id FROM s WHERE speaker_id IS NOT NULL AND printed IS NOT NULL GROUP BY 1, 2 HAVING min(speaker_id) = max(speaker_id)),
j AS (SELECT s.conv_id, turn, coalesce(speaker_id, id) AS speaker_id, s.printed, k, source FROM s LEFT JOIN k ON s.conv_id = k.conv_id AND s.printed = k.printed),
w AS (SELECT *, coalesce('#' || speaker_id, printed) AS who FROM j), r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, who ORDER BY k, turn, printed NULLS LAST) AS n FROM w)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, k, who) AS ordinal, speaker_id, printed, source FROM r WHERE n = 1
""")
def asker_sources(spark: SparkSession, d: str) -> DataFrame:
    call = rows(spark, d, "conversations", "conv_id", "turn", "CASE WHEN turn % 3 = 0 THEN turn % 4 END AS speaker_id", "concat('name', turn % 4) AS printed", where="turn % 2 = 0")
    listed = rows(spark, d, "conversations", "conv_id", "turn", "CAST(NULL AS BIGINT) AS speaker_id", "concat('name', turn % 6) AS printed")
    heading = rows(spark, d, "conversations", "conv_id", "turn", "CAST(7 AS BIGINT) AS speaker_id", "CAST(NULL AS STRING) AS printed", where="turn = 1")
    return M.asker_sources([("call", call), ("list", listed), ("heading", heading)], "conv_id", "turn", "speaker_id", "printed")


@query("""
WITH c AS (SELECT conv_id, turn, 'Turn ' || turn || ' of ' || conv_id || ' ' || role AS t, CASE WHEN turn % 2 = 0 THEN 'Column: ' || (100 + turn) || ' ' ELSE '' END AS m FROM conversations),
n AS (SELECT conv_id, turn, 100 + max(CASE WHEN turn % 2 = 0 THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS number, max(turn) OVER (PARTITION BY conv_id) AS last FROM c)
SELECT conv_id, turn AS id, CASE WHEN last - last % 2 = number - 100 THEN number END AS printed_column, CASE WHEN last - last % 2 = number - 100 THEN 'LAST' ELSE 'SKIPPED_COLUMN' END AS status FROM n
""")
def columns_by_search(spark: SparkSession, d: str) -> DataFrame:
    """Speeches are sought in their document's text, and so are the printed columns before them."""
    from rostrum.operators import documents as X

    turns = rows(spark, d, "conversations", "conv_id", "turn", "concat('Turn ', turn, ' of ', conv_id, ' ', role) AS t", "concat('Column: ', 100 + turn) AS m", "CASE WHEN turn % 2 = 0 THEN concat('Column: ', 100 + turn, ' ') ELSE '' END AS before")
    text = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.concat("before", "t").alias("t")))).alias("a")).select("conv_id", F.concat_ws(" ", F.transform("a", lambda x: x["t"])).alias("text"))
    speeches = X.align_rows(turns, text, "conv_id", "turn", "t", "text").select("conv_id", F.col("turn").alias("id"), F.col("position").alias("offset"))
    marks = X.align_rows(turns.where("before <> ''"), text, "conv_id", "turn", "m", "text").select("conv_id", F.col("position").alias("offset"), (F.col("turn") + 100).alias("number"))
    return M.speech_columns(speeches, marks, "conv_id")
