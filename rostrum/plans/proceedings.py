"""Turns, division lists, people in rounds and what else reads whole reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.operators import documents as X
from rostrum.operators import turns as T
from rostrum.plans.registry import query, rows

#: A line for each rule of the turns, planted among the lines of conversations:
#: (line, states after, what becomes of it in each state, name, text, kind of a row that nobody speaks).
_PLANTS = [
    ("**Mr A{} (Place)**: Sir.", "OOO", "LLL", "Mr A{} (Place)", "Sir.", ""),
    ("**[Mr Speaker in the Chair]**", "POC", "---", "", "", ""),
    ("**(Mr Chair in the Chair)** goes on", "POC", "-T-", "", "goes on", "UNCLASSIFIED"),
    ("**H**ear this", "POC", "TTT", "", "Hear this", "UNCLASSIFIED"),
    ("| **a** | b |", "POC", "-TT", "", "| a | b |", "UNCLASSIFIED"),
    ("**Mr B said that all is well** today", "OOO", "LTL", "Mr B said that all is well", "Mr B said that all is well today", ""),
    ("Question proposed.", "POC", "AAA", "", "Question proposed.", "PROCEDURAL"),
    ("Question put, and agreed to.", "PCC", "AAA", "", "Question put, and agreed to.", "PROCEDURAL"),
    ("The following question stood in the name of **Dr C{}** –", "OOO", "AAA", "Dr C{}", "The following question stood in the name of Dr C{} –", "PROCEDURAL"),
    ("**Mr D** rose in his place.", "COC", "AAA", "", "Mr D rose in his place.", "CHAMBER_EVENT"),
    ("**Mr D** left the Chamber.", "CCC", "AAA", "", "Mr D left the Chamber.", "CHAMBER_EVENT"),
    ("**ADJOURNMENT**", "PCC", "---", "", "", ""),
    ("**The figures:**", "POC", "AAA", "", "The figures:", "HEADING"),
    ("**(Note)** after it", "PCC", "TXT", "", "after it", "UNCLASSIFIED"),
    ("Mr Speaker: Order.", "OOO", "LLL", "Mr Speaker", "Order.", ""),
    ("(as printed)", "POC", "-TT", "", "(as printed)", "UNCLASSIFIED"),
    ("_In italics_", "POC", "-AA", "", "_In italics_", "HEADING"),
    ("Column: 12", "POC", "---", "", "", ""),
]
_CASE = " ".join(f"WHEN {k} THEN replace('{line}', '{{}}', CAST(turn AS STRING))" for k, (line, *_) in enumerate(_PLANTS))
_PLANT = "(conv_id * 5 + turn * 7 + {} * 11 + 17) % 18"
_VALUES = ", ".join("(" + ", ".join([str(k), *(f"'{v}'" for v in plant[1:])]) + ")" for k, plant in enumerate(_PLANTS))


@query(f"""
WITH RECURSIVE v(k, moves, acts, name, said, kind) AS (VALUES {_VALUES}),
t AS (SELECT conv_id, turn, 0 AS j, {_PLANT.format(0)} AS k, CAST(NULL AS VARCHAR) AS line FROM conversations UNION ALL SELECT conv_id, turn, 1000000, {_PLANT.format(1)}, NULL FROM conversations
  UNION ALL SELECT conv_id, turn, i, NULL, 'Sir, ' || trim(parts[i]) FROM (SELECT conv_id, turn, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS parts FROM conversations))),
l AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, j) - 1 AS place, coalesce(moves, 'POC') AS moves, coalesce(acts, 'TTT') AS acts, replace(name, '{{}}', turn::VARCHAR) AS name,
  CASE WHEN line IS NULL THEN replace(said, '{{}}', turn::VARCHAR) ELSE trim(regexp_replace(line, '\\s+', ' ', 'g')) END AS said, coalesce(kind, 'UNCLASSIFIED') AS kind, t.k FROM t LEFT JOIN v ON t.k = v.k),
w AS (SELECT l.*, 'P' AS before, substr(moves, 1, 1) AS after, substr(acts, 1, 1) AS act, CASE WHEN substr(acts, 1, 1) = 'L' OR k = 8 THEN name END AS who FROM l WHERE place = 0
  UNION ALL SELECT l.*, w.after, substr(l.moves, strpos('POC', w.after), 1), substr(l.acts, strpos('POC', w.after), 1), CASE WHEN substr(l.acts, strpos('POC', w.after), 1) = 'L' OR l.k = 8 THEN l.name ELSE w.who END FROM w JOIN l ON l.conv_id = w.conv_id AND l.place = w.place + 1),
s AS (SELECT conv_id, place, CASE WHEN act = 'L' OR (act = 'T' AND before = 'O') THEN who END AS speaker, CASE WHEN act = 'L' OR (act = 'T' AND before = 'O') THEN 'SPEECH' ELSE kind END AS kind,
  CASE WHEN act = 'L' AND k = 5 THEN 'today' ELSE said END AS transcript FROM w WHERE act <> '-' AND conv_id IN (SELECT conv_id FROM w WHERE after <> 'P'))
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS ordinal, CAST(place AS INTEGER) AS place, speaker, kind, transcript FROM s
""")
def turn_machine(spark: SparkSession, d: str) -> DataFrame:
    """Whole conversations as reports, a line of every rule before and after each turn's text."""
    source = rows(spark, d, "conversations", "conv_id", "turn", "text")
    plant = lambda j: F.expr(f"CASE {_PLANT.format(j)} {_CASE} END")
    said = F.transform(F.split("text", "\n", -1), lambda x: F.concat(F.lit("Sir, "), F.trim(x)))
    turns = source.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.concat(F.array(plant(0)), said, F.array(plant(1))).alias("l")))).alias("t"))
    lines = turns.select("conv_id", F.posexplode(F.flatten(F.transform("t", lambda x: x["l"]))).alias("place", "line"))
    return T.speeches(lines, "conv_id").drop("language")


# Lists of votes ---------------------------------------------------------------------------------

#: Lists of twelve names: in two columns (a side each) or three (the first two are ayes); every fifth name goes on in a line of its own, further in.
_LISTED = "c_custkey - c_custkey % 12 AS list", "c_custkey % 12 AS n", "concat('Mr ', c_name) AS name", "c_custkey % 5 = 0 AS wraps", "c_custkey % 24 < 12 AS two"
_COUNTED = """
p AS (SELECT c_custkey - c_custkey % 12 AS list, c_custkey % 12 AS n, 'Mr ' || c_name || CASE WHEN c_custkey % 5 = 0 THEN ' bin Long' ELSE '' END AS name, c_custkey % 24 < 12 AS two FROM customer),
s AS (SELECT *, CASE WHEN CASE WHEN two THEN n % 2 < 1 ELSE n % 3 < 2 END THEN 'AYE' ELSE 'NO' END AS side, CASE WHEN two THEN n % 2 ELSE n % 3 END AS col FROM p),
c AS (SELECT list, count(*) FILTER (side = 'AYE') AS a, count(*) FILTER (side = 'NO') AS o FROM s GROUP BY 1),
d AS (SELECT list, a, o, CASE list // 12 % 4 WHEN 1 THEN a + 1 ELSE a END AS ayes, CASE list // 12 % 4 WHEN 2 THEN NULL ELSE o END AS noes, CASE list // 12 % 4 WHEN 3 THEN 1 END AS abstentions FROM c),
v AS (SELECT list, CASE WHEN a = ayes AND o = coalesce(noes, 0) AND abstentions IS NULL THEN 'ACCEPTED' ELSE 'COUNTS_DISAGREE' END AS status FROM d)
"""


def _divisions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    from rostrum.operators import divisions as V

    people = rows(spark, d, "customer", *_LISTED)
    wide = F.when(F.col("two"), 2).otherwise(3)
    cells = people.select("list", "two", F.floor(F.col("n") / wide).alias("row"), (F.col("n") % wide).alias("col"), F.rpad("name", 34, " ").alias("a"), F.rpad(F.when(F.col("wraps"), "     bin Long").otherwise(""), 34, " ").alias("b"))
    line = lambda c: F.concat(*(F.coalesce(F.max(F.when(F.col("col") == k, F.col(c))), F.lit(" " * 34)) for k in range(3)))
    body = cells.groupBy("list", "two", "row").agg(line("a").alias("a"), line("b").alias("b"))
    lines = body.select("list", F.explode(F.array(F.struct((F.col("row") * 2 + 1).cast("int").alias("place"), F.col("a").alias("line")), F.struct((F.col("row") * 2 + 2).cast("int").alias("place"), F.col("b").alias("line")))).alias("x")).select("list", "x.*")
    head = people.select("list", "two").distinct().select("list", F.lit(0).alias("place"), F.when(F.col("two"), F.concat(F.rpad(F.lit("AYES"), 34, " "), F.lit("NOES"))).otherwise(F.concat(F.rpad(F.lit("AYES"), 68, " "), F.lit("NOES"))).alias("line"))
    side = F.when(F.when(F.col("two"), F.col("n") % 2 < 1).otherwise(F.col("n") % 3 < 2), "AYE").otherwise("NO")
    counts = people.withColumn("side", side).groupBy("list").agg(F.count_if(F.col("side") == "AYE").alias("a"), F.count_if(F.col("side") == "NO").alias("o"), F.floor(F.col("list") / 12 % 4).alias("k"))
    counts = counts.select("list", F.when(F.col("k") == 1, F.col("a") + 1).otherwise(F.col("a")).alias("ayes"), F.when(F.col("k") != 2, F.col("o")).alias("noes"), F.when(F.col("k") == 3, 1).alias("abstentions"), F.lit(None).cast("int").alias("absent"), F.lit(None).cast("int").alias("paired"))
    return V.division_lists(lines.unionByName(head), counts, "list")


@query(f"WITH {_COUNTED} SELECT list, status FROM v")
def division_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Lists in two and three columns with wrapped names, against right counts, one too many, a missing one and one for no list."""
    return _divisions(spark, d)[0]


@query(f"WITH {_COUNTED} SELECT s.list, side, row_number() OVER (PARTITION BY s.list, side ORDER BY col, n) AS n, name FROM s JOIN v ON s.list = v.list WHERE status = 'ACCEPTED'")
def division_columns(spark: SparkSession, d: str) -> DataFrame:
    """The names of the lists that are accepted."""
    return _divisions(spark, d)[1]


# Days of leave ----------------------------------------------------------------------------------

_LEAVE = [
    "concat('Mr Tan, from ', {d}, ' March ', {y}, ' to 9 May ', {y})", "concat('3 weeks from ', {d}, ' March ', {y})", "concat('on ', {d}, ' March ', {y}, '.')", "'until further notice'", "concat('| Mr Tan | ', {d}, ' March ', {y}, ' | 9 May ', {y}, ' |')",
    "concat('(a) Mr Tan: ', {d}, ' March - 9 May ', {y})", "concat('12. Miss Goh, on 1, 2 and ', {d}, ' March ', {y})", "concat('Mr Tan, ', {d}, ' December to 3 January ', {y}, ' and on 12 June ', {y})", "concat('on ', {d}, ' March')",
]


@query("""
WITH o AS (SELECT o_orderkey, o_orderkey % 9 AS k, (1 + o_orderkey % 28)::INT AS d, (1970 + o_custkey % 40)::INT AS y, o_orderdate::DATE AS near FROM orders),
i AS (
  SELECT o_orderkey, 1 AS n, make_date(y, 3, d) AS first, make_date(y, 5, 9) AS last FROM o WHERE k IN (0, 4, 5) UNION ALL SELECT o_orderkey, 1, make_date(y, 3, d), make_date(y, 3, d) + 20 FROM o WHERE k = 1 UNION ALL SELECT o_orderkey, 1, make_date(y, 3, d), make_date(y, 3, d) FROM o WHERE k = 2
  UNION ALL SELECT o_orderkey, 1, make_date(y, 3, 1), make_date(y, 3, 1) FROM o WHERE k = 6 UNION ALL SELECT o_orderkey, 2, make_date(y, 3, 2), make_date(y, 3, 2) FROM o WHERE k = 6 UNION ALL SELECT o_orderkey, 3, make_date(y, 3, d), make_date(y, 3, d) FROM o WHERE k = 6
  UNION ALL SELECT o_orderkey, 1, make_date(y - 1, 12, d), make_date(y, 1, 3) FROM o WHERE k = 7 UNION ALL SELECT o_orderkey, 2, make_date(y, 6, 12), make_date(y, 6, 12) FROM o WHERE k = 7
  UNION ALL SELECT o_orderkey, 1, best, best FROM (SELECT o_orderkey, arg_min(c, abs(c - near)) AS best, count(*) FILTER (abs(c - near) = least_gap) AS ties FROM (SELECT *, min(abs(c - near)) OVER (PARTITION BY o_orderkey) AS least_gap FROM (SELECT o_orderkey, near, make_date((year(near) + g)::INT, 3, d) AS c FROM o, (SELECT unnest([-1, 0, 1]) AS g) WHERE k = 8)) GROUP BY 1) WHERE ties = 1
) SELECT o_orderkey, n::INT AS n, first, last FROM i
""")
def leave_days(spark: SparkSession, d: str) -> DataFrame:
    """All printed forms: ranges, durations, lists, tables, a month or year carried from the right, a range over New Year, a list after a range, no year."""
    from rostrum.operators.leave import leave_intervals

    day, year = "1 + o_orderkey % 28", "1970 + o_custkey % 40"
    text = "CASE o_orderkey % 9 " + " ".join(f"WHEN {k} THEN {form.format(d=day, y=year)}" for k, form in enumerate(_LEAVE)) + " END AS t"
    entries = rows(spark, d, "orders", "o_orderkey", text, "to_date(o_orderdate) AS near")
    found = entries.select("o_orderkey", F.posexplode(leave_intervals(F.col("t"), F.col("near"))).alias("p", "x"))
    return found.select("o_orderkey", (F.col("p") + 1).alias("n"), "x.first", "x.last")


# Deputies ---------------------------------------------------------------------------------------


@query("""
WITH p AS (SELECT n_nationkey AS holder, DATE '1992-01-01' + (n_nationkey * 110)::INT AS a, DATE '1992-01-01' + (n_nationkey * 110 + 210)::INT AS b, n_nationkey % 4 = 1 AS woman FROM nation),
r AS (SELECT o_orderkey AS report, o_orderdate::DATE AS day, CASE WHEN o_orderkey % 5 = 0 THEN (o_orderdate::DATE - DATE '1992-01-01') // 110 END AS named FROM orders),
h AS (SELECT DISTINCT day, holder, woman FROM r JOIN p ON day BETWEEN a AND b), g AS (SELECT day, count(*) AS size, count(*) FILTER (NOT woman) AS men, min(holder) FILTER (NOT woman) AS man FROM h GROUP BY 1),
m AS (SELECT report, day, holder, is_label FROM (SELECT o_orderkey AS report, o_orderdate::DATE AS day, (o_orderdate::DATE - DATE '1992-01-01') // 110 - o_custkey % 2 AS holder, o_custkey % 3 = 0 AS is_label FROM orders WHERE o_orderkey % 3 > 0) JOIN h USING (day, holder)),
o AS (SELECT report, count(DISTINCT holder) AS n, min(holder) AS one, count(DISTINCT holder) FILTER (is_label) AS labels, min(holder) FILTER (is_label) AS label FROM m GROUP BY 1),
t AS (SELECT r.report, r.day, coalesce(size, 0) AS size, men, man, coalesce(n, 0) AS n, one, CASE WHEN h.holder IS NOT NULL THEN named WHEN labels = 1 THEN label END AS candidate, h.holder IS NOT NULL AS by_name FROM r LEFT JOIN g USING (day) LEFT JOIN o USING (report) LEFT JOIN h ON h.day = r.day AND h.holder = named),
e AS (SELECT t.*, EXISTS (SELECT 1 FROM m WHERE m.day = t.day AND m.report <> t.report AND m.holder <> t.candidate) AS rival FROM t),
f AS (SELECT *, CASE WHEN size <> 2 THEN 'NO_PAIR' WHEN n > 1 THEN 'SEVERAL_NAMED' WHEN men = 1 THEN CASE WHEN n = 0 OR one = man THEN 'FORM' ELSE 'WOMAN_NAMED' END WHEN men < 2 THEN 'NO_PAIR' WHEN candidate IS NULL THEN 'UNNAMED' WHEN rival THEN 'NAMED_ELSEWHERE' WHEN by_name THEN 'NAMED' ELSE 'LABELLED' END AS rule FROM e)
SELECT report, CASE rule WHEN 'FORM' THEN man WHEN 'NAMED' THEN candidate WHEN 'LABELLED' THEN candidate END AS holder, rule FROM f
""")
def deputies(spark: SparkSession, d: str) -> DataFrame:
    """Who presides where two hold the office: every order a report with one row, nations the holders."""
    from rostrum.operators.deputies import resolve_deputies

    began = "datediff(to_date(o_orderdate), DATE '1992-01-01') div 110"
    terms = rows(spark, d, "nation", "n_nationkey AS holder", "date_add(DATE '1992-01-01', cast(n_nationkey * 110 AS INT)) AS first_day", "date_add(DATE '1992-01-01', cast(n_nationkey * 110 + 210 AS INT)) AS last_day", "n_nationkey % 4 = 1 AS is_woman")
    reports = rows(spark, d, "orders", "o_orderkey AS report", "to_date(o_orderdate) AS day", "o_orderkey AS id", f"CASE WHEN o_orderkey % 5 = 0 THEN {began} END AS named")
    mentions = rows(spark, d, "orders", "o_orderkey AS report", "to_date(o_orderdate) AS day", f"{began} - o_custkey % 2 AS holder", "o_custkey % 3 = 0 AS is_label", where="o_orderkey % 3 > 0")
    return resolve_deputies(reports.select("id", "report", "named"), reports.select("report", "day"), terms, mentions).select("report", "holder", "rule")
