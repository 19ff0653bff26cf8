"""Ordered, as-of, nearest and positional operators over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.functions import dates as D
from rostrum.operators import joins as J
from rostrum.operators import sets as S
from rostrum.operators import windows as W
from rostrum.plans.registry import query, rows

_TURN = ["turn"]


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ordinal FROM events")
def ordinal_numbering(spark: SparkSession, d: str) -> DataFrame:
    return W.number(rows(spark, d, "events", "user_id", "event_id", "ts"), ["user_id"], [F.col("ts"), F.col("event_id")]).drop("ts")


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def keep_first(spark: SparkSession, d: str) -> DataFrame:
    return W.keep_first(rows(spark, d, "events", "user_id", "event_type", "event_id", "ts"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).drop("ts")


@query("SELECT user_id, day, min(event_id) AS event_id, bool_or(flag) AS flag FROM (SELECT user_id, ts::DATE AS day, event_id, event_type IN ('view', 'click') AS flag FROM events) GROUP BY 1, 2")
def prefer_present(spark: SparkSession, d: str) -> DataFrame:
    return W.prefer_present(rows(spark, d, "events", "user_id", "to_date(ts) AS day", "event_id", "event_type IN ('view', 'click') AS flag"), ["user_id", "day"], "flag", "event_id")


@query("SELECT conv_id, turn, role, lead(role) OVER w AS next_role, lead(turn) OVER w AS next_turn FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def next_row(spark: SparkSession, d: str) -> DataFrame:
    return W.with_next(rows(spark, d, "conversations", "conv_id", "turn", "role"), ["conv_id"], _TURN, ["role", "turn"])


_ISLANDS = """
days AS (SELECT day, row_number() OVER (ORDER BY day) AS place FROM (SELECT DISTINCT ts::DATE AS day FROM events)),
a AS (SELECT DISTINCT user_id, event_type, ts::DATE AS day FROM events WHERE {where}),
r AS (SELECT user_id, event_type, day, place - row_number() OVER (PARTITION BY user_id, event_type ORDER BY place) AS g FROM a JOIN days USING (day)),
{name} AS (SELECT user_id, event_type, min(day) AS first_day, max(day) AS last_day, count(*) AS sittings FROM r GROUP BY user_id, event_type, g)
"""


def _ranges(spark: SparkSession, d: str, where: str = "true") -> DataFrame:
    seen = rows(spark, d, "events", "user_id", "event_type", "to_date(ts) AS day")
    return W.office_ranges(seen.where(where), seen.select("day"), "user_id", "day", "event_type")


@query(f"WITH {_ISLANDS.format(where='true', name='o')} SELECT * FROM o")
def office_ranges(spark: SparkSession, d: str) -> DataFrame:
    return _ranges(spark, d)


@query(f"""
WITH {_ISLANDS.format(where="ts < TIMESTAMP '2024-01-15'", name="s")}, {_ISLANDS.replace("days AS (", "days2 AS (").replace("JOIN days USING", "JOIN days2 USING").replace("a AS (SELECT DISTINCT user_id", "a2 AS (SELECT DISTINCT user_id").replace("r AS (SELECT user_id", "r2 AS (SELECT user_id").replace("FROM a JOIN", "FROM a2 JOIN").replace("FROM r GROUP", "FROM r2 GROUP").format(where="ts >= TIMESTAMP '2024-01-15'", name="n")},
l AS (SELECT user_id, arg_max(event_type, (last_day, event_type)) AS o, max(last_day) AS l FROM s GROUP BY 1), lf AS (SELECT l.*, s.first_day AS f FROM l JOIN s ON l.user_id = s.user_id AND l.o = s.event_type AND l.l = s.last_day),
k AS (SELECT n.*, row_number() OVER (PARTITION BY n.user_id ORDER BY n.first_day, n.event_type) AS k, lag_day FROM n LEFT JOIN (SELECT day, lag(day) OVER (ORDER BY day) AS lag_day FROM days) ON day = first_day)
SELECT k.user_id, event_type, first_day, last_day, sittings, CASE WHEN k = 1 AND o = event_type AND l = lag_day THEN 'EXTEND' ELSE 'INSERT' END AS action, CASE WHEN k = 1 AND o = event_type AND l = lag_day THEN f END AS extends_first FROM k LEFT JOIN lf ON k.user_id = lf.user_id
""")
def extend_ranges(spark: SparkSession, d: str) -> DataFrame:
    days = rows(spark, d, "events", "to_date(ts) AS day")
    return W.extend_ranges(_ranges(spark, d, "day < DATE '2024-01-15'"), _ranges(spark, d, "day >= DATE '2024-01-15'"), days, "user_id", "event_type")


@query("SELECT o_custkey, o_orderkey, sum(n) OVER (PARTITION BY o_custkey ORDER BY day, o_orderkey ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM (SELECT o_custkey, o_orderkey, o_orderdate::DATE AS day, CASE WHEN o_orderdate::DATE - lag(o_orderdate::DATE) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) <= 200 THEN 0 ELSE 1 END AS n FROM orders)")
def gap_sessions(spark: SparkSession, d: str) -> DataFrame:
    return W.gap_sessions(rows(spark, d, "orders", "o_custkey", "o_orderkey", "to_date(o_orderdate) AS day"), ["o_custkey"], "day", 200, ["o_orderkey"]).drop("day")


@query("""
WITH RECURSIVE o AS (SELECT o_custkey AS key, o_orderkey AS id, o_orderdate::DATE AS day, o_orderpriority = '1-URGENT' AS first, o_orderstatus = 'F' AS passing, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders),
w AS (
  SELECT key, id, day, r, 1 AS session, passing AS passed FROM o WHERE r = 1
  UNION ALL
  SELECT o.key, o.id, o.day, o.r, w.session + n.new, CASE WHEN n.new = 1 THEN o.passing ELSE w.passed OR o.passing END
  FROM w JOIN o ON o.key = w.key AND o.r = w.r + 1, LATERAL (SELECT CASE WHEN ((w.passed OR o.first) AND o.day > w.day) OR o.day - w.day > 366 THEN 1 ELSE 0 END AS new) AS n
)
SELECT key, id, session FROM w
""")
def bill_sessions(spark: SparkSession, d: str) -> DataFrame:
    bills = rows(spark, d, "orders", "o_custkey AS key", "o_orderkey AS id", "to_date(o_orderdate) AS day", "o_orderpriority = '1-URGENT' AS is_first_reading", "o_orderstatus = 'F' AS is_passing")
    return W.bill_sessions(bills).select("key", "id", "session")


_NAMED = "CASE WHEN role = 'system' OR turn % 4 = 1 THEN concat(role, turn) END"


@query(f"SELECT conv_id, turn, last_value({_NAMED} IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS speaker FROM conversations")
def forward_fill(spark: SparkSession, d: str) -> DataFrame:
    return W.forward_fill(rows(spark, d, "conversations", "conv_id", "turn", f"{_NAMED} AS label"), ["conv_id"], _TURN, "label", "speaker").drop("label")


@query(f"""
WITH c AS (SELECT conv_id, turn, {_NAMED} AS label, turn % 5 = 3 AS reset FROM conversations),
m AS (SELECT *, max(CASE WHEN reset OR label IS NOT NULL THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS at FROM c)
SELECT m.conv_id, m.turn, CASE WHEN NOT c.reset THEN c.label END AS speaker FROM m LEFT JOIN c ON c.conv_id = m.conv_id AND c.turn = m.at
""")
def carried_holder(spark: SparkSession, d: str) -> DataFrame:
    return W.fill_until_reset(rows(spark, d, "conversations", "conv_id", "turn", f"{_NAMED} AS label"), ["conv_id"], _TURN, "label", F.col("turn") % 5 == 3, "speaker").drop("label")


@query(f"SELECT conv_id, turn, first_value({_NAMED} IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS signer FROM conversations")
def backfill_signer(spark: SparkSession, d: str) -> DataFrame:
    return W.backfill(rows(spark, d, "conversations", "conv_id", "turn", f"{_NAMED} AS label"), ["conv_id"], _TURN, "label", "signer").drop("label")


@query(f"SELECT conv_id, turn, last_value({_NAMED} IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bound_before, first_value({_NAMED} IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS bound_after FROM conversations")
def bracket_bounds(spark: SparkSession, d: str) -> DataFrame:
    return W.bracket_bounds(rows(spark, d, "conversations", "conv_id", "turn", f"{_NAMED} AS label"), ["conv_id"], _TURN, "label").drop("label")


@query("SELECT conv_id, turn, sum(n) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM (SELECT conv_id, turn, CASE WHEN length(text) // 200 IS NOT DISTINCT FROM lag(length(text) // 200) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS n FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))")
def run_lengths(spark: SparkSession, d: str) -> DataFrame:
    return W.run_lengths(rows(spark, d, "conversations", "conv_id", "turn", "length(text) div 200 AS size"), ["conv_id"], _TURN, "size").drop("size")


_COLUMN = "CASE WHEN (conv_id * 7 + turn) % 5 = 0 THEN turn * 3 ELSE turn + conv_id END"


@query(f"SELECT conv_id, turn, c, CASE WHEN lag(c) OVER w + 2 = lead(c) OVER w AND c <> lag(c) OVER w + 1 THEN lag(c) OVER w + 1 END AS suggested FROM (SELECT conv_id, turn, {_COLUMN} AS c FROM conversations) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def sequence_repair(spark: SparkSession, d: str) -> DataFrame:
    return W.sequence_repair(rows(spark, d, "conversations", "conv_id", "turn", f"{_COLUMN} AS c"), ["conv_id"], _TURN, "c")


@query(f"SELECT conv_id, min(c) AS low, max(c) AS high, coalesce(bool_or(s < 0 OR s > 50), false) AS is_broken FROM (SELECT conv_id, c, c - lag(c) OVER (PARTITION BY conv_id ORDER BY turn) AS s FROM (SELECT conv_id, turn, {_COLUMN} AS c FROM conversations)) GROUP BY 1")
def monotone_range(spark: SparkSession, d: str) -> DataFrame:
    return W.monotone(rows(spark, d, "conversations", "conv_id", "turn", f"{_COLUMN} AS c"), ["conv_id"], _TURN, "c")


@query("SELECT o_custkey, o_orderkey, CASE WHEN is_total AND nxt - o_orderkey <= 4000 THEN nxt END AS total_order FROM (SELECT o_custkey, o_orderkey, o_orderstatus, lead(o_orderkey) OVER w AS nxt, lead(o_orderstatus = 'O') OVER w AS is_total FROM orders WHERE o_orderstatus IN ('F', 'O') WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)) WHERE o_orderstatus = 'F'")
def bounded_merge(spark: SparkSession, d: str) -> DataFrame:
    return W.bounded_merge(rows(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], "o_orderkey", F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O", 4000).select("o_custkey", "o_orderkey", "total_order")


# As-of, range and nearest joins -----------------------------------------------------------------

_LINE = ["l_orderkey", "l_partkey", "l_suppkey", "to_date(l_shipdate) AS day"]


@query("""
WITH m AS (SELECT o_custkey % 100 AS l_suppkey, o_orderdate::DATE AS started_on, max(o_orderpriority) AS priority FROM orders GROUP BY 1, 2)
SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate::DATE AS day, started_on, priority FROM lineitem l ASOF LEFT JOIN m ON l.l_suppkey = m.l_suppkey AND l.l_shipdate::DATE >= m.started_on
""".replace("l_suppkey, l_shipdate", "l.l_suppkey, l_shipdate"))
def asof_join(spark: SparkSession, d: str) -> DataFrame:
    marks = rows(spark, d, "orders", "o_custkey % 100 AS l_suppkey", "to_date(o_orderdate) AS started_on", "o_orderpriority AS priority")
    return J.asof_join(rows(spark, d, "lineitem", *_LINE), marks, ["l_suppkey"], "day", "started_on", ["priority"])


_SPAN = ["s_suppkey % 40 AS user_id", "CAST(date_add(DATE '2024-01-01', CAST(s_suppkey * 7 % 45 AS INT)) AS DATE) AS started_on", "CASE WHEN s_suppkey % 3 = 0 THEN 'MONTH' ELSE 'DAY' END AS precision", "s_suppkey % 4 = 0 AS is_upper_bound", "s_name AS party"]


@query("""
WITH s AS (SELECT s_suppkey % 40 AS user_id, DATE '2024-01-01' + (s_suppkey * 7 % 45)::INT AS started_on, s_suppkey % 3 = 0 AS is_month, s_suppkey % 4 = 0 AS is_upper_bound, s_name AS party FROM supplier),
e AS (SELECT event_id, user_id, ts::DATE AS day, event_type AS ballot FROM events),
f AS (SELECT event_id, e.user_id, day, ballot, count(started_on) AS n, max(CASE WHEN started_on <= day THEN struct_pack(a := started_on, b := party) END) AS now, min(CASE WHEN started_on > day THEN struct_pack(a := started_on, b := is_upper_bound) END) AS nxt, coalesce(bool_or(is_month AND date_trunc('month', started_on) = date_trunc('month', day)), false) AS mo
  FROM e LEFT JOIN s ON e.user_id = s.user_id GROUP BY ALL)
SELECT event_id, user_id, day, ballot, CASE WHEN now IS NULL THEN ballot ELSE now.b END AS party, CASE WHEN n = 0 THEN false WHEN now IS NULL THEN true ELSE mo OR coalesce(nxt.b, false) END AS is_uncertain FROM f
""")
def asof_party(spark: SparkSession, d: str) -> DataFrame:
    events = rows(spark, d, "events", "event_id", "user_id", "to_date(ts) AS day", "event_type AS ballot")
    return J.party_on_day(events, rows(spark, d, "supplier", *_SPAN), ["event_id"], "user_id", "day", "ballot")


@query("""
WITH h AS (SELECT s_name AS holder, DATE '1995-01-01' + (s_suppkey * 20)::INT AS first_day, DATE '1995-01-01' + (s_suppkey * 20 + 25)::INT AS last_day FROM supplier)
SELECT o_orderkey, o_orderdate::DATE AS day, CASE WHEN count(DISTINCT holder) = 1 THEN min(holder) END AS holder FROM orders LEFT JOIN h ON o_orderdate::DATE BETWEEN first_day AND last_day GROUP BY 1, 2
""")
def holder_on_date(spark: SparkSession, d: str) -> DataFrame:
    holders = rows(spark, d, "supplier", "s_name AS holder", "date_add(DATE '1995-01-01', cast(s_suppkey * 20 AS INT)) AS first_day", "date_add(DATE '1995-01-01', cast(s_suppkey * 20 + 25 AS INT)) AS last_day")
    return J.holder_on_day(rows(spark, d, "orders", "o_orderkey", "to_date(o_orderdate) AS day"), holders, ["o_orderkey"], "day", "first_day", "last_day", "holder")


@query("""
WITH m AS (SELECT l_orderkey, l_partkey, l_shipdate::DATE AS shipped, l_suppkey FROM lineitem),
n AS (SELECT o_orderkey, o_orderdate::DATE AS day, l_orderkey, l_partkey, shipped, abs(shipped - o_orderdate::DATE) AS gap FROM orders JOIN m ON o_custkey % 100 = l_suppkey WHERE abs(shipped - o_orderdate::DATE) <= 1)
SELECT o_orderkey, day, l_orderkey, l_partkey, shipped, gap FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY gap, l_orderkey, l_partkey, shipped) AS r FROM n) WHERE r = 1
""")
def nearest_date_join(spark: SparkSession, d: str) -> DataFrame:
    orders = rows(spark, d, "orders", "o_orderkey", "o_custkey % 100 AS k", "to_date(o_orderdate) AS day")
    lines = rows(spark, d, "lineitem", "l_suppkey AS k", "l_orderkey", "l_partkey", "to_date(l_shipdate) AS shipped")
    return J.nearest_join(orders, lines, ["k"], ["o_orderkey"], "day", "shipped", 1, ["l_orderkey", "l_partkey", "shipped"]).drop("k")


@query("""
WITH o AS (SELECT o_orderkey, (o_orderdate + to_days((o_orderkey % 400)::INT))::DATE AS day, day(o_orderdate)::VARCHAR AS pd, month(o_orderdate)::VARCHAR AS pm FROM orders),
c AS (SELECT o.*, try_cast((year(day) + k)::VARCHAR || '-' || pm || '-' || pd AS DATE) AS x FROM o, (SELECT unnest([-1, 0, 1]) AS k)),
g AS (SELECT *, abs(x - day) AS gap, min(abs(x - day)) OVER (PARTITION BY o_orderkey) AS least FROM c)
SELECT o_orderkey, day, CASE WHEN count(*) FILTER (gap = least) = 1 THEN min(x) FILTER (gap = least) END AS nearest FROM g GROUP BY 1, 2
""")
def nearest_year(spark: SparkSession, d: str) -> DataFrame:
    printed = rows(spark, d, "orders", "o_orderkey", "date_add(to_date(o_orderdate), cast(o_orderkey % 400 AS INT)) AS day", "cast(day(o_orderdate) AS string) AS pd", "cast(month(o_orderdate) AS string) AS pm")
    return D.nearest_year(printed, ["o_orderkey"], "day", "pd", "pm").drop("pd", "pm")


@query("""
WITH w AS (SELECT o_custkey, o_orderkey AS bill, o_orderdate::DATE AS first_day FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT o.o_orderkey, CASE WHEN count(DISTINCT bill) = 1 THEN min(bill) END AS bill FROM orders o LEFT JOIN w ON o.o_custkey = w.o_custkey AND o.o_orderdate::DATE BETWEEN first_day - 45 AND first_day + 30 WHERE o.o_orderstatus = 'P' GROUP BY 1
""")
def slack_window_join(spark: SparkSession, d: str) -> DataFrame:
    bills = rows(spark, d, "orders", "o_custkey", "o_orderkey AS bill", "date_sub(to_date(o_orderdate), 45) AS first_day", "date_add(to_date(o_orderdate), 30) AS last_day", where="o_orderpriority = '1-URGENT'")
    reports = rows(spark, d, "orders", "o_orderkey", "o_custkey", "to_date(o_orderdate) AS day", where="o_orderstatus = 'P'")
    return J.holder_on_day(reports, bills, ["o_orderkey"], "day", "first_day", "last_day", "bill", ["o_custkey"]).select("o_orderkey", "bill")


# Unique and positional joins --------------------------------------------------------------------


@query("SELECT p_partkey, p_name, CASE WHEN u.n = 1 THEN u.b END AS brand FROM part JOIN (SELECT p_name AS k, p_size AS s, count(DISTINCT p_brand) AS n, min(p_brand) AS b FROM part GROUP BY 1, 2) u ON p_name = k AND p_size = s")
def unique_match_join(spark: SparkSession, d: str) -> DataFrame:
    part = rows(spark, d, "part", "p_partkey", "p_name", "p_size", "p_brand AS brand")
    return J.unique_match_join(part.drop("brand"), part, ["p_name", "p_size"], "brand").drop("p_size")


_PAIRS = "CASE WHEN c_custkey % 3 = 0 THEN c_custkey ELSE c_custkey - c_custkey % 2 END AS bill", "CASE WHEN c_custkey % 5 = 0 THEN c_custkey % 100 ELSE c_custkey END AS number"


@query(f"WITH p AS (SELECT DISTINCT {', '.join(_PAIRS)} FROM customer) SELECT bill, number FROM p WHERE bill IN (SELECT bill FROM p GROUP BY 1 HAVING count(*) = 1) AND number IN (SELECT number FROM p GROUP BY 1 HAVING count(*) = 1)")
def mutual_unique_assignment(spark: SparkSession, d: str) -> DataFrame:
    return J.mutual_unique(rows(spark, d, "customer", *_PAIRS), "bill", "number")


_PROCEEDINGS = ["l_shipdate::DATE AS day", "l_linenumber AS ayes", "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_suppkey % 3 END AS noes", "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_partkey % 2 END AS abstentions", "l_orderkey AS report_id", "l_suppkey AS place", "l_linenumber AS speech_number", "l_orderkey * 100000 + l_partkey AS ordinal"]
_MINUTES = ["o_orderdate::DATE AS day", "o_orderkey % 7 + 1 AS ayes", "o_custkey % 3 AS noes", "o_orderkey % 2 AS abstentions", "o_orderkey AS ordinal"]


@query(f"""
WITH p AS (SELECT * FROM (SELECT {", ".join(_PROCEEDINGS)} FROM lineitem) WHERE noes IS NOT NULL), m AS (SELECT {", ".join(_MINUTES)} FROM orders),
pn AS (SELECT *, row_number() OVER (PARTITION BY day, ayes, noes ORDER BY place, speech_number, ordinal) AS n, count(*) OVER (PARTITION BY day, ayes, noes) AS size FROM p),
t AS (SELECT day, ayes, noes, max(x > 1) AS tied, max(size) AS size FROM (SELECT day, ayes, noes, place, speech_number, count(DISTINCT report_id) AS x, max(size) AS size FROM pn GROUP BY ALL) GROUP BY ALL),
mn AS (SELECT *, row_number() OVER (PARTITION BY day, ayes, noes ORDER BY ordinal) AS n, count(*) OVER (PARTITION BY day, ayes, noes) AS own FROM m),
j AS (SELECT mn.day, mn.ayes, mn.noes, mn.ordinal, own, t.tied, t.size, pn.report_id, pn.ordinal AS p_ordinal, max(coalesce(mn.abstentions <> pn.abstentions, false)) OVER (PARTITION BY mn.day, mn.ayes, mn.noes) AS differ
  FROM mn LEFT JOIN pn ON mn.day = pn.day AND mn.ayes = pn.ayes AND mn.noes = pn.noes AND mn.n = pn.n LEFT JOIN t ON mn.day = t.day AND mn.ayes = t.ayes AND mn.noes = t.noes),
s AS (SELECT *, CASE WHEN size IS NULL THEN 'NO_MATCHING_DIVISION' WHEN tied THEN 'TIED' WHEN size <> own THEN 'UNEQUAL_NUMBER' WHEN differ THEN 'ABSTENTIONS_DIFFER' ELSE 'PAIRED' END AS status FROM j)
SELECT day, ayes, noes, ordinal, status, CASE WHEN status = 'PAIRED' THEN report_id END AS report_id, CASE WHEN status = 'PAIRED' THEN p_ordinal END AS p_ordinal FROM s
""")
def positional_pairing(spark: SparkSession, d: str) -> DataFrame:
    spark_sql = lambda columns: [c.replace("::DATE", "").replace("l_shipdate", "to_date(l_shipdate)").replace("o_orderdate", "to_date(o_orderdate)") for c in columns]
    return J.division_pairing(rows(spark, d, "lineitem", *spark_sql(_PROCEEDINGS)), rows(spark, d, "orders", *spark_sql(_MINUTES)))


@query("""
WITH a AS (SELECT o_custkey, o_orderkey AS filled, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS c FROM orders WHERE o_orderstatus = 'F'),
b AS (SELECT o_custkey, o_orderkey AS opened, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS c FROM orders WHERE o_orderstatus = 'O')
SELECT a.o_custkey, filled, opened FROM a JOIN b ON a.o_custkey = b.o_custkey AND a.n = b.n AND a.c = b.c
""")
def nth_occurrence_join(spark: SparkSession, d: str) -> DataFrame:
    left = rows(spark, d, "orders", "o_custkey", "o_orderkey AS filled", "o_orderdate", where="o_orderstatus = 'F'")
    right = rows(spark, d, "orders", "o_custkey", "o_orderkey AS opened", "o_orderdate AS opened_on", where="o_orderstatus = 'O'")
    return J.nth_occurrence_join(left, right, ["o_custkey"], [F.col("o_orderdate"), F.col("filled")], [F.col("opened_on"), F.col("opened")]).select("o_custkey", "filled", "opened")


@query("SELECT a.p_partkey, count(*) AS names FROM part a JOIN (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Ring small' WHEN 1 THEN 'bolt  blue' ELSE 'widget red widget' END AS name FROM customer) b ON list_sort(list_distinct(list_filter(string_split_regex(lower(p_name), '\\s+'), lambda x: x <> ''))) = list_sort(list_distinct(list_filter(string_split_regex(lower(name), '\\s+'), lambda x: x <> ''))) AND len(list_filter(string_split_regex(p_name, '\\s+'), lambda x: x <> '')) = len(list_filter(string_split_regex(name, '\\s+'), lambda x: x <> '')) GROUP BY 1")
def wordset_join(spark: SparkSession, d: str) -> DataFrame:
    names = rows(spark, d, "customer", "c_custkey", "CASE c_custkey % 3 WHEN 0 THEN 'Ring small' WHEN 1 THEN 'bolt  blue' ELSE 'widget red widget' END AS name")
    part = rows(spark, d, "part", "p_partkey", "p_name").withColumn("k", J.word_set(F.col("p_name")))
    found = names.groupBy(J.word_set(F.col("name")).alias("k")).agg(F.count("*").alias("n"))  # pairs are counted, not built
    return part.join(found, "k").groupBy("p_partkey").agg(F.sum("n").alias("names"))


@query(r"""
WITH n AS (SELECT p_brand, p_partkey, string_split_regex(lower(p_name || ' ' || p_type || ' ' || p_size), '\s+') AS w FROM part),
p AS (SELECT p_brand, p_partkey, array_to_string(w[1:k], ' ') AS prefix FROM (SELECT p_brand, p_partkey, w, unnest(range(2, len(w))) AS k FROM n WHERE len(w) > 2))
SELECT p_brand, prefix, min(p_partkey) AS p_partkey FROM p GROUP BY 1, 2 HAVING min(p_partkey) = max(p_partkey)
""")
def unique_prefix_join(spark: SparkSession, d: str) -> DataFrame:
    names = rows(spark, d, "part", "p_brand", "p_partkey", "concat(p_name, ' ', p_type, ' ', p_size) AS name")
    return J.unique_prefixes(names, ["p_brand"], "name", "p_partkey")


@query(r"""
WITH w AS (SELECT source, doc_id, list_filter(string_split_regex(text, '[ \t\n\r\f\v]+'), lambda x: x <> '') AS w FROM documents),
r AS (SELECT source, doc_id, i - 1 AS place, array_to_string(w[i : i + 11], ' ') AS run FROM (SELECT source, doc_id, w, unnest(range(1, len(w) - 10)) AS i FROM w WHERE len(w) >= 12)),
u AS (SELECT min(source) AS source, min(doc_id) AS doc_id, min(place) AS place FROM r GROUP BY run HAVING count(*) = 1)
SELECT source, doc_id, min(place)::INT AS place FROM u GROUP BY 1, 2
""")
def unique_shingle_place(spark: SparkSession, d: str) -> DataFrame:
    return J.unique_shingle_places(rows(spark, d, "documents", "source", "doc_id", "text"), "source", "doc_id", "text", 12)


@query("""
WITH e AS (SELECT user_id, ts::DATE AS day, event_type FROM events), asked AS (SELECT DISTINCT user_id, day + 1 AS day FROM e),
p AS (SELECT user_id, day, bool_or(event_type <> 'error') AS f FROM e WHERE event_type IN ('error', 'view') GROUP BY 1, 2), l AS (SELECT DISTINCT day FROM e WHERE day <> DATE '2024-01-10')
SELECT a.user_id, a.day, CASE WHEN f THEN 'PRESENT' WHEN f IS NOT NULL THEN 'ABSENT' WHEN l.day IS NOT NULL THEN 'UNLISTED' ELSE 'NO_LIST' END AS status FROM asked a LEFT JOIN p ON a.user_id = p.user_id AND a.day = p.day LEFT JOIN l ON a.day = l.day
""")
def presence_status(spark: SparkSession, d: str) -> DataFrame:
    e = rows(spark, d, "events", "user_id", "to_date(ts) AS day", "event_type")
    asked = e.select("user_id", F.date_add("day", 1).alias("day")).distinct()
    present = e.where("event_type IN ('error', 'view')").select("user_id", "day", (F.col("event_type") != "error").alias("flag"))
    return J.presence_status(asked, present, e.where("day <> DATE '2024-01-10'"), "day", "user_id", "flag")


# Increments -------------------------------------------------------------------------------------


@query("SELECT min(ts)::DATE AS first_day, max(ts)::DATE AS latest, least(max(ts)::DATE + 1, DATE '2024-02-05' - 14) AS probe_from, count(*) FILTER (ts::DATE >= least((SELECT max(ts)::DATE + 1 FROM events), DATE '2024-02-05' - 14)) AS to_recheck FROM events")
def high_water_mark(spark: SparkSession, d: str) -> DataFrame:
    days = rows(spark, d, "events", "to_date(ts) AS day")
    mark = days.agg(F.min("day").alias("first_day"), F.max("day").alias("latest")).select("*", F.least(F.date_add("latest", 1), F.date_sub(F.lit("2024-02-05").cast("date"), 14)).alias("probe_from"))
    return days.join(F.broadcast(mark), days["day"] >= F.col("probe_from"), "right").groupBy("first_day", "latest", "probe_from").agg(F.count("day").alias("to_recheck"))


@query("WITH s AS (SELECT user_id, max(ts)::DATE AS latest FROM events WHERE event_id % 2 = 0 GROUP BY 1) SELECT e.event_id, e.ts::DATE AS day, latest FROM events e JOIN s USING (user_id) WHERE e.event_id % 2 = 1 AND e.ts::DATE < latest - 20")
def late_rows(spark: SparkSession, d: str) -> DataFrame:
    e = rows(spark, d, "events", "event_id", "user_id", "to_date(ts) AS day")
    latest = e.where("event_id % 2 = 0").groupBy("user_id").agg(F.max("day").alias("latest"))
    return e.where("event_id % 2 = 1").join(latest, "user_id").where(F.col("day") < F.date_sub("latest", 20)).select("event_id", "day", "latest")


@query("SELECT user_id, bool_and(event_type <> 'error') AS all_succeeded, count(*) AS n FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 4 GROUP BY 1")
def last_n_all(spark: SparkSession, d: str) -> DataFrame:
    last = W.number(rows(spark, d, "events", "user_id", "event_type", "ts", "event_id"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], "r").where("r <= 4")
    return last.groupBy("user_id").agg(F.bool_and(F.col("event_type") != "error").alias("all_succeeded"), F.count("*").alias("n"))


@query("SELECT day::DATE AS day, coalesce(n, 0) AS n FROM (SELECT unnest(range((SELECT min(ts)::DATE FROM events)::TIMESTAMP, ((SELECT max(ts)::DATE FROM events) + 3)::TIMESTAMP, INTERVAL 1 DAY)) AS day) s LEFT JOIN (SELECT ts::DATE AS d, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1) e ON s.day::DATE = d")
def date_spine(spark: SparkSession, d: str) -> DataFrame:
    e = rows(spark, d, "events", "to_date(ts) AS day", "event_type", "user_id")
    ends = e.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    spine = ends.select(F.explode(F.sequence("a", F.date_add("b", 2))).alias("day"))
    counts = e.where("event_type = 'error'").groupBy("day").agg(F.count("*").alias("n"))
    return spine.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


_PLACED = "CASE WHEN o_orderkey % 3 = 0 AND o_orderdate < DATE '1997-01-01' THEN 'stored' ELSE 'load' END"


@query(f"""
WITH RECURSIVE o AS (SELECT o_custkey % 400 AS key, o_orderkey AS id, o_orderdate::DATE AS day, o_orderkey % 17 <> 5 AS word, o_orderpriority = '1-URGENT' AS first, o_orderstatus = 'F' AS passing, {_PLACED} AS side FROM orders),
b AS (SELECT key, o_bill AS bill_id, min(id) AS first_id, min(day) AS first_day, max(day) AS last_day, bool_or(passing) AS passed FROM (SELECT *, key * 10 + id % 2 AS o_bill FROM o WHERE side = 'stored') GROUP BY 1, 2),
l AS (SELECT * FROM b WHERE last_day = (SELECT max(last_day) FROM b c WHERE c.key = b.key)), s AS (SELECT key, count(*) AS n, min(bill_id) AS bill_id, min(first_id) AS first_id, min(first_day) AS first_day, min(last_day) AS last_day, bool_or(passed) AS passed FROM l GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY day, id) AS r FROM o WHERE side = 'load' AND word AND key NOT IN (SELECT key FROM s WHERE n > 1)),
w AS (
  SELECT DISTINCT r.key, NULL::BIGINT AS id, 0::BIGINT AS r, s.bill_id AS bill, 0 AS number, s.first_id, s.first_day, s.last_day, coalesce(s.passed, false) AS passed, NULL::VARCHAR AS reason FROM r LEFT JOIN s ON r.key = s.key
  UNION ALL
  SELECT key, rid, rr, CASE WHEN reason IS NOT NULL OR NOT new THEN bill END, CASE WHEN reason IS NULL AND new THEN number + 1 ELSE number END, first_id, CASE WHEN reason IS NULL AND new THEN day ELSE first_day END, CASE WHEN reason IS NULL THEN day ELSE last_day END, CASE WHEN reason IS NOT NULL THEN passed WHEN new THEN passing ELSE passed OR passing END, reason
  FROM (SELECT *, CASE WHEN last_day IS NOT NULL AND day < last_day THEN 'DATED_BEFORE_OPEN_BILL' WHEN NOT new AND bill IS NOT NULL AND day = first_day AND rid < first_id THEN 'SORTS_BELOW_STORED_KEY' END AS reason
    FROM (SELECT w.key, w.bill, w.number, w.first_id, w.first_day, w.last_day, w.passed, r.id AS rid, r.r AS rr, r.day, r.passing, w.last_day IS NULL OR ((w.passed OR r.first) AND r.day > w.last_day) OR r.day - w.last_day > 366 AS new FROM w JOIN r ON r.key = w.key AND r.r = w.r + 1))
)
SELECT key, id, CASE WHEN reason IS NULL THEN bill END AS bill_id, CASE WHEN reason IS NULL AND bill IS NULL THEN number END AS new_bill, reason FROM w WHERE id IS NOT NULL
UNION ALL SELECT key, id, NULL, NULL, CASE WHEN word THEN 'TWO_BILLS_SHARE_LATEST_DATE' ELSE 'NO_BILL_WORD' END FROM o WHERE side = 'load' AND (NOT word OR key IN (SELECT key FROM s WHERE n > 1))
""")
def bill_placement(spark: SparkSession, d: str) -> DataFrame:
    """A load of reports against the bills that earlier ones made."""
    bills = rows(spark, d, "orders", "o_custkey % 400 AS key", "o_orderkey AS id", "to_date(o_orderdate) AS day", "o_orderkey % 17 <> 5 AS has_bill_word", "o_orderpriority = '1-URGENT' AS is_first_reading", "o_orderstatus = 'F' AS is_passing", f"{_PLACED} AS side")
    old = bills.where("side = 'stored'").groupBy("key", (F.col("key") * 10 + F.col("id") % 2).alias("bill_id"))
    stored = old.agg(F.min("id").alias("first_id"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.bool_or("is_passing").alias("is_passed"))
    return W.place_reports(bills.where("side = 'load'").drop("side"), stored)


@query("SELECT l_suppkey, l_orderkey, l_linenumber, previous FROM (SELECT l_suppkey, l_orderkey, l_linenumber, lag(l_partkey) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS previous, l_partkey FROM lineitem) WHERE previous >= l_partkey")
def order_violations(spark: SparkSession, d: str) -> DataFrame:
    lines = rows(spark, d, "lineitem", "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "struct(l_orderkey, l_linenumber, l_partkey) AS place")
    return S.order_violations(lines, ["l_suppkey"], "place", "l_partkey").select("l_suppkey", "l_orderkey", "l_linenumber", "previous")


@query("SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O'")
def set_intersection(spark: SparkSession, d: str) -> DataFrame:
    o = rows(spark, d, "orders", "o_custkey", "o_orderpriority", "o_orderstatus")
    return S.intersection(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'O'"), ["o_custkey", "o_orderpriority"])


@query("""
SELECT o_orderkey, CASE WHEN year(day) >= 2011 THEN 4 WHEN year(day) >= 1990 THEN 9 WHEN year(day) >= 1967 THEN 18 ELSE 35 END AS most_days, day < make_date(y, 1, 1) OR day > make_date(y + 1, 1, 31) AS misprinted
FROM (SELECT o_orderkey, (o_orderdate::DATE + ((o_custkey % 70 - 40) * 365)::INT) AS day, (year(o_orderdate) + o_custkey % 70 - 40 - o_orderkey % 3)::INT AS y FROM orders)
""")
def publication_windows(spark: SparkSession, d: str) -> DataFrame:
    r = rows(spark, d, "orders", "o_orderkey", "date_add(to_date(o_orderdate), cast((o_custkey % 70 - 40) * 365 AS INT)) AS day", "concat(o_orderkey % 40 + 1, '/', year(o_orderdate) + o_custkey % 70 - 40 - o_orderkey % 3) AS number")
    return r.select("o_orderkey", D.publication_days(F.col("day")).alias("most_days"), D.is_misprinted(F.col("number"), F.col("day")).alias("misprinted"))


@query("SELECT o_orderkey AS report_id, (DATE '1998-01-20' - o_orderdate::DATE) BETWEEN 13 AND 14 AS is_alert_due FROM orders WHERE o_orderkey % 3 < 2")
def held_reports(spark: SparkSession, d: str) -> DataFrame:
    """Reports whose text has not come yet, and whether that is due for an alert."""
    import datetime

    from rostrum.plans.refresh import held_rows

    bodies = rows(spark, d, "orders", "o_orderkey AS report_id", "to_date(o_orderdate) AS sitting_day", "CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'text' END AS content")
    return held_rows(bodies, datetime.date(1998, 1, 20)).select("report_id", "is_alert_due")
