"""Components, resolution and links between reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.functions import names as N
from rostrum.operators import graph as G
from rostrum.operators import resolve as R
from rostrum.plans.registry import query, rows


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS a, o_custkey % 37 * 1000 + o_orderkey % 11 + 100000 AS b FROM orders), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS node, a AS seen FROM u UNION SELECT r.node, u.b FROM r JOIN u ON r.seen = u.a)
SELECT node, min(seen) AS component FROM r GROUP BY 1 HAVING min(seen) <> node
""")
def connected_components(spark: SparkSession, d: str) -> DataFrame:
    edges = rows(spark, d, "orders", "o_custkey AS a", "o_custkey % 37 * 1000 + o_orderkey % 11 + 100000 AS b")
    return G.connected_components(edges)


_LABELS = "CASE c_custkey % 4 WHEN 0 THEN concat('Mr ', c_name) WHEN 1 THEN concat('The Hon. Dr ', upper(c_name)) WHEN 2 THEN c_name ELSE concat('Assoc Prof Er ', c_name, '  ') END"


@query("""
WITH p AS (SELECT c_nationkey AS parliament, c_name AS name, c_custkey AS person FROM customer WHERE c_custkey % 5 <> 0),
u AS (SELECT parliament, lower(name) AS k, min(person) AS person FROM p GROUP BY 1, 2 HAVING min(person) = max(person)),
l AS (SELECT DISTINCT c_nationkey AS parliament, CASE c_custkey % 4 WHEN 0 THEN concat('Mr ', c_name) WHEN 1 THEN concat('The Hon. Dr ', upper(c_name)) WHEN 2 THEN c_name ELSE concat('Assoc Prof Er ', c_name, '  ') END AS label FROM customer)
SELECT l.parliament, l.label, u.person, 'direct' AS tier FROM l JOIN u ON l.parliament = u.parliament AND u.k = lower(trim(regexp_replace(l.label, '^(Mr |The Hon. Dr |Assoc Prof Er )', '')))
""")
def tiered_name_resolution(spark: SparkSession, d: str) -> DataFrame:
    people = rows(spark, d, "customer", "c_nationkey AS parliament", "c_name AS name", "c_custkey AS person", where="c_custkey % 5 <> 0")
    labels = rows(spark, d, "customer", "c_nationkey AS parliament", f"{_LABELS} AS label")
    return R.resolve_tiered(labels, R.lookups(people, ["parliament"]), ["parliament"], "label")


_TWO_WORDS = "concat(split(p_name, ' ')[1], ' ', p_type, ' ', split(p_name, ' ')[0])"


@query("""
WITH p AS (SELECT p_brand AS parliament, string_split(lower(p_name || ' ' || p_type), ' ') AS w, p_partkey AS person FROM part),
f AS (SELECT parliament, person, 'whole' AS kind, array_to_string(w, ' ') AS k FROM p UNION ALL SELECT parliament, person, 'set', len(w)::VARCHAR || ' ' || array_to_string(list_sort(list_distinct(w)), ' ') FROM p
  UNION ALL SELECT parliament, person, 'turned', w[len(w)] || ' ' || array_to_string(w[2:len(w) - 1], ' ') || ' ' || w[1] FROM p),
u AS (SELECT parliament, kind, k, min(person) AS person FROM f GROUP BY 1, 2, 3 HAVING min(person) = max(person)),
l AS (SELECT DISTINCT p_brand AS parliament, concat(string_split(p_name, ' ')[2], ' ', p_type, ' ', string_split(p_name, ' ')[1]) AS label FROM part),
a AS (SELECT parliament, label, string_split(lower(label), ' ') AS w FROM l),
t AS (SELECT parliament, label, 'whole' AS kind, array_to_string(w, ' ') AS k FROM a UNION ALL SELECT parliament, label, 'turned', array_to_string(w, ' ') FROM a UNION ALL SELECT parliament, label, 'set', len(w)::VARCHAR || ' ' || array_to_string(list_sort(list_distinct(w)), ' ') FROM a)
SELECT t.parliament, t.label, min(u.person) AS person FROM t JOIN u ON t.parliament = u.parliament AND t.kind = u.kind AND t.k = u.k GROUP BY 1, 2 HAVING min(u.person) = max(u.person)
""")
def strict_resolution(spark: SparkSession, d: str) -> DataFrame:
    people = rows(spark, d, "part", "p_brand AS parliament", "concat(p_name, ' ', p_type) AS name", "p_partkey AS person")
    labels = rows(spark, d, "part", "p_brand AS parliament", f"{_TWO_WORDS} AS label")
    return R.resolve_strict(labels, R.lookups(people, ["parliament"]), ["parliament"], "label").select("parliament", "label", "person")


@query("""
WITH s AS (SELECT c_custkey AS speaker_id, c_mktsegment || ' ' || c_nationkey AS name, c_custkey % 9 AS slot FROM customer),
r AS (SELECT *, min(speaker_id) OVER (PARTITION BY name) AS hub, row_number() OVER (PARTITION BY name, slot ORDER BY speaker_id) AS nth FROM s),
p AS (SELECT speaker_id, name, nth, hub, CASE WHEN nth = 1 THEN hub ELSE speaker_id END AS person FROM r),
c AS (SELECT *, max(nth) OVER (PARTITION BY name) AS most, count(*) OVER (PARTITION BY person) AS rows FROM p)
SELECT speaker_id, person, nth > 1 OR most > 1 AS conflict, CASE WHEN rows > 1 THEN 'exact' ELSE 'single' END AS basis FROM c
""")
def person_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Rows of one name merge with its first row, the first of each slot only."""
    speakers = rows(spark, d, "customer", "c_custkey AS speaker_id", "concat(c_mktsegment, ' ', c_nationkey) AS name", "cast(c_custkey % 9 AS string) AS slot")
    decisions = spark.createDataFrame([(0, 2, "DISTINCT")], "a long, b long, kind string")
    return G.cluster_people(speakers.withColumn("name_key", N.lookup_key(F.col("name"))), decisions).drop("decided_name")


@query("""
WITH s AS (SELECT o_orderkey AS source, o_custkey % 50 AS title, o_orderdate::DATE AS cited FROM orders WHERE o_orderstatus = 'F'),
t AS (SELECT o_orderkey AS target, o_custkey % 50 AS title, o_orderdate::DATE AS day FROM orders WHERE o_orderstatus <> 'F'),
sittings AS (SELECT DISTINCT day FROM t),
c AS (SELECT source, cited, count(DISTINCT target) AS n, min(target) AS target FROM s LEFT JOIN t ON s.title = t.title AND s.cited = t.day GROUP BY 1, 2)
SELECT source, CASE WHEN n = 1 THEN c.target END AS target, CASE WHEN sittings.day IS NULL THEN 'NO_SITTING' WHEN n = 0 THEN 'NO_TITLE' WHEN n > 1 THEN 'SEVERAL' ELSE 'LINKED' END AS reason FROM c LEFT JOIN sittings ON sittings.day = cited
""")
def link_by_title_date(spark: SparkSession, d: str) -> DataFrame:
    from rostrum.operators.citations import link_citations

    cited = rows(spark, d, "orders", "o_orderkey AS source", "cast(o_custkey % 50 AS string) AS title", "to_date(o_orderdate) AS day", where="o_orderstatus = 'F'")
    reports = rows(spark, d, "orders", "o_orderkey AS report_id", "cast(o_custkey % 50 AS string) AS title", "to_date(o_orderdate) AS day", where="o_orderstatus <> 'F'")
    return link_citations(cited, reports).select("source", "target", "reason")


@query("SELECT s_suppkey, p_name AS title, p_partkey FROM (SELECT s_suppkey, p_partkey, p_name, count(*) OVER (PARTITION BY s_suppkey) AS n, count(*) OVER (PARTITION BY p_partkey) AS m FROM supplier JOIN part ON s_suppkey = p_partkey % 100 AND p_size = s_nationkey + 1) WHERE n = 1 AND m = 1")
def law_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Numbers claimed by two laws are given to neither."""
    from rostrum.operators.joins import mutual_unique

    part = rows(spark, d, "part", "p_partkey", "p_name AS title", "p_partkey % 100 AS s_suppkey", "p_size")
    pairs = part.join(rows(spark, d, "supplier", "s_suppkey", "s_nationkey + 1 AS p_size"), ["s_suppkey", "p_size"])
    return pairs.join(mutual_unique(pairs, "s_suppkey", "p_partkey"), ["s_suppkey", "p_partkey"]).select("s_suppkey", "title", "p_partkey")


@query("""
WITH a AS (SELECT p_partkey AS act_id, p_type AS key, d, d + 60 AS second, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE d + 90 END AS third FROM (SELECT *, DATE '1990-01-01' + (p_partkey % 900)::INT AS d FROM part)),
b AS (SELECT p_partkey + 100000 AS bill_id, p_type AS key, DATE '1990-01-01' + ((p_partkey * 7) % 900)::INT AS day FROM part),
n AS (SELECT act_id, bill_id, abs(day - near) AS gap, rule, k FROM (SELECT act_id, key, d AS near, 'FIRST' AS rule, 0 AS k FROM a UNION ALL SELECT act_id, key, third, 'THIRD', 1 FROM a WHERE third IS NOT NULL UNION ALL SELECT act_id, key, second, 'SECOND', 2 FROM a) x JOIN b ON x.key = b.key AND abs(day - near) <= 1),
r AS (SELECT *, row_number() OVER (PARTITION BY act_id ORDER BY k, gap, bill_id) AS r FROM n)
SELECT act_id, bill_id, rule FROM r WHERE r = 1
""")
def act_linkage(spark: SparkSession, d: str) -> DataFrame:
    """Acts find their bills by title key and the nearest of three readings."""
    from rostrum.operators.citations import act_links

    first = "date_add(DATE '1990-01-01', cast(p_partkey % 900 AS INT))"
    acts = rows(spark, d, "part", "p_partkey AS act_id", "p_type AS key", f"{first} AS first_day", f"date_add({first}, 60) AS second_day", f"CASE WHEN p_partkey % 4 <> 0 THEN date_add({first}, 90) END AS third_day")
    bills = rows(spark, d, "part", "p_partkey + 100000 AS bill_id", "p_type AS key", "date_add(DATE '1990-01-01', cast((p_partkey * 7) % 900 AS INT)) AS day")
    return act_links(acts, bills)


@query("""
WITH h AS (SELECT o_orderkey AS source, o_custkey % 90 AS title, o_orderdate::DATE AS day, o_orderdate::DATE - (o_orderkey % 9 - 1)::INT AS cited_day FROM orders),
r AS (SELECT o_orderkey AS report_id, o_custkey % 90 AS title, o_orderdate::DATE AS day, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 6 END AS part FROM orders),
f AS (SELECT source, report_id, part, count(*) OVER w AS n, bool_or(part IS NULL) OVER w AS unknown, max(part) OVER w AS top FROM h JOIN r ON h.title = r.title AND h.cited_day = r.day WHERE h.cited_day < h.day WINDOW w AS (PARTITION BY source))
SELECT source, min(report_id) AS target FROM f WHERE n = 1 OR (NOT unknown AND part = top) GROUP BY 1 HAVING min(report_id) = max(report_id)
""")
def continuation_links(spark: SparkSession, d: str) -> DataFrame:
    from rostrum.operators.citations import continuations

    headings = rows(spark, d, "orders", "o_orderkey AS source", "cast(o_custkey % 90 AS string) AS title", "to_date(o_orderdate) AS day", "date_sub(to_date(o_orderdate), cast(o_orderkey % 9 - 1 AS INT)) AS cited_day")
    reports = rows(spark, d, "orders", "o_orderkey AS report_id", "cast(o_custkey % 90 AS string) AS title", "to_date(o_orderdate) AS day", "CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 6 END AS part")
    return continuations(headings, reports)


#: The type of a link by its source's type, its target's, and whether the source's day is before, on or after the target's.
_LINK_TYPES = {
    ("CLARIFICATION", "CLARIFICATION"): (None, "CORRECTION", "CORRECTION"), ("CLARIFICATION", "WRITTEN_STATEMENT"): (None, "CORRECTION", "CORRECTION"), ("CLARIFICATION", "ANSWER_ORAL"): (None, "CORRECTION", "CORRECTION"), ("CLARIFICATION", "DEBATE"): (None, "CORRECTION", "CORRECTION"),
    ("WRITTEN_STATEMENT", "CLARIFICATION"): (None, "CORRECTION", "CORRECTION"), ("WRITTEN_STATEMENT", "WRITTEN_STATEMENT"): (None, "CORRECTION", "CORRECTION"), ("WRITTEN_STATEMENT", "ANSWER_ORAL"): (None, "CORRECTION", "CORRECTION"), ("WRITTEN_STATEMENT", "DEBATE"): (None, "CORRECTION", "CORRECTION"),
    ("ANSWER_ORAL", "CLARIFICATION"): ("CORRECTION", "CORRECTION", "REPLY"), ("ANSWER_ORAL", "WRITTEN_STATEMENT"): ("CORRECTION", "CORRECTION", "REPLY"), ("ANSWER_ORAL", "ANSWER_ORAL"): ("REPLY", "REPLY", "REPLY"), ("ANSWER_ORAL", "DEBATE"): ("REPLY", "REPLY", "REPLY"),
    ("DEBATE", "CLARIFICATION"): ("CORRECTION", "CORRECTION", None), ("DEBATE", "WRITTEN_STATEMENT"): ("CORRECTION", "CORRECTION", None), ("DEBATE", "ANSWER_ORAL"): (None, None, None), ("DEBATE", "DEBATE"): (None, None, None),
}
_TYPE_ROWS = ", ".join(f"('{a}', '{b}', {k - 1}, " + (f"'{t}')" if t else "NULL)") for (a, b), types in _LINK_TYPES.items() for k, t in enumerate(types))
_TYPE_OF = "CASE {0} % 4 WHEN 0 THEN 'CLARIFICATION' WHEN 1 THEN 'ANSWER_ORAL' WHEN 2 THEN 'WRITTEN_STATEMENT' ELSE 'DEBATE' END"


@query(f"""
WITH k(a, b, way, type) AS (VALUES {_TYPE_ROWS}), l AS (SELECT l_orderkey AS source, l_suppkey AS target, {_TYPE_OF.format("l_orderkey")} AS a, {_TYPE_OF.format("l_suppkey")} AS b, sign(l_orderkey % 50 - l_suppkey % 50)::INT AS way FROM lineitem)
SELECT DISTINCT source, target, type FROM l JOIN k USING (a, b, way)
""")
def link_types(spark: SparkSession, d: str) -> DataFrame:
    from rostrum.operators.citations import link_types as types

    days = [f"date_add(DATE '1990-01-01', cast({c} % 50 AS INT)) AS {n}_day" for n, c in (("source", "l_orderkey"), ("target", "l_suppkey"))]
    links = rows(spark, d, "lineitem", "l_orderkey AS source", "l_suppkey AS target", f"{_TYPE_OF.format('l_orderkey')} AS source_type", f"{_TYPE_OF.format('l_suppkey')} AS target_type", *days)
    return types(links).select("source", "target", "type")


_PRINTED = "CASE o_orderkey % 7 WHEN 0 THEN 'Mr Speaker' WHEN 1 THEN 'The Clerk' WHEN 2 THEN concat('Mr Deputy Speaker (Mr ', c_name, ')') WHEN 3 THEN 'The Attorney' WHEN 4 THEN concat('The Minister for ', c_mktsegment, ' (Mr ', c_name, ')') WHEN 5 THEN concat('12. Dr ', c_name, ' (Place):') ELSE concat('*', c_name) END"


def _printed_labels(spark: SparkSession, d: str) -> DataFrame:
    orders = rows(spark, d, "orders", "o_orderkey", "o_custkey AS c_custkey", "to_date(o_orderdate) AS day")
    return orders.join(rows(spark, d, "customer", "c_custkey", "c_name", "c_nationkey AS parliament", "c_mktsegment"), "c_custkey").selectExpr("parliament", f"{_PRINTED} AS label", "day")


@query(f"""
WITH p AS (SELECT c_nationkey AS parliament, c_name, c_custkey AS person FROM customer), c AS (SELECT parliament, min(person) AS person FROM p GROUP BY 1), n AS (SELECT parliament, max(person) AS person FROM p GROUP BY 1),
l AS (SELECT DISTINCT c_nationkey AS parliament, {_PRINTED} AS label, o_orderdate::DATE AS day, o_orderkey % 7 AS k, CASE WHEN o_orderkey % 7 IN (2, 4, 5) THEN c_custkey END AS own FROM orders JOIN customer ON o_custkey = c_custkey),
h AS (SELECT l.*, CASE WHEN day < DATE '1995-06-01' THEN 1 WHEN day >= DATE '1996-01-01' THEN 2 END AS held FROM l)
SELECT parliament, label, day, CASE k WHEN 0 THEN CASE held WHEN 1 THEN (SELECT person FROM c WHERE c.parliament = h.parliament AND h.parliament = 3) WHEN 2 THEN (SELECT person FROM c WHERE c.parliament = h.parliament AND h.parliament = 4) END
  WHEN 3 THEN (SELECT person FROM n WHERE n.parliament = h.parliament) ELSE own END AS person,
  CASE k WHEN 0 THEN 'HELD_ON_DAY' WHEN 2 THEN 'CHAIR_NAMED' WHEN 3 THEN 'ROLE' WHEN 4 THEN 'BRACKET' WHEN 5 THEN 'BRACKET' ELSE 'NON_SPEAKER' END AS rule FROM h
""")
def label_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Chairs by date and by name, roles, offices with a name in brackets, names with a place in brackets, and labels of no speaker."""
    people = rows(spark, d, "customer", "c_nationkey AS parliament", "c_name AS name", "c_custkey AS person")
    least = lambda n: people.where(f"parliament = {n}").agg(F.min_by("name", "person").alias("holder"))
    held = least(3).selectExpr("'Mr Speaker' AS label", "DATE '1900-01-01' AS first_day", "DATE '1995-05-31' AS last_day", "holder")
    held = held.unionByName(least(4).selectExpr("'Mr Speaker' AS label", "DATE '1996-01-01' AS first_day", "CAST(NULL AS DATE) AS last_day", "holder"))
    held = held.unionByName(spark.range(1).selectExpr("'Mr Deputy Speaker' AS label", "DATE '2100-01-01' AS first_day", "CAST(NULL AS DATE) AS last_day", "'nobody yet' AS holder"))
    roles = people.groupBy("parliament").agg(F.max_by("name", "person").alias("holder")).withColumn("label", F.lit("The Attorney"))
    return R.resolve_labels(_printed_labels(spark, d), R.lookups(people, ["parliament"]), held, roles, ["The Clerk"], "parliament", "label", "day").drop("tier")


@query("""
WITH t AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN turn END AS person FROM conversations), c AS (SELECT conv_id, min(turn) + 1000 AS p FROM t WHERE turn % 5 = 1 GROUP BY 1 HAVING count(*) = 1),
d AS (SELECT conv_id % 10 AS g, min(2000 + conv_id) AS p FROM t WHERE turn = 4 GROUP BY 1 HAVING count(DISTINCT conv_id) = 1)
SELECT t.conv_id, turn, coalesce(person, c.p, d.p) AS person, CASE WHEN person IS NOT NULL THEN 'label' WHEN c.p IS NOT NULL THEN 'chairman' WHEN d.p IS NOT NULL THEN 'sitting' END AS linked_by
FROM t LEFT JOIN c ON t.conv_id = c.conv_id LEFT JOIN d ON t.conv_id % 10 = d.g
""")
def context_passes(spark: SparkSession, d: str) -> DataFrame:
    """A report's chairman, then a sitting's deputy, each for what is still unlinked; two candidates give none."""
    turns = rows(spark, d, "conversations", "conv_id", "turn", "conv_id % 10 AS g", "CASE WHEN turn % 3 = 0 THEN turn END AS person")
    chairman = turns.where("turn % 5 = 1").selectExpr("conv_id", "turn + 1000 AS person")
    sitting = turns.where("turn = 4").selectExpr("g", "2000 + conv_id AS person")
    return R.context_passes(turns, [("chairman", chairman, ["conv_id"]), ("sitting", sitting, ["g"])]).select("conv_id", "turn", "person", "linked_by")
