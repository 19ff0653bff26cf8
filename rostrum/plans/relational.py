"""Joins, aggregates and sets over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.operators import aggregates as A
from rostrum.operators import sets as S
from rostrum.plans.registry import query, rows


@query("SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def fk_join(spark: SparkSession, d: str) -> DataFrame:
    orders = rows(spark, d, "orders", "o_orderkey", "o_custkey AS c_custkey")
    customer = rows(spark, d, "customer", "c_custkey", "c_name", "c_nationkey AS n_nationkey")
    places = rows(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey AS r_regionkey").join(rows(spark, d, "region"), "r_regionkey")
    return orders.join(customer, "c_custkey").join(places, "n_nationkey").select("o_orderkey", "c_name", "n_name", "r_name")


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice < 2000)")
def semi_anti_frame(spark: SparkSession, d: str) -> DataFrame:
    held = lambda where: rows(spark, d, "orders", "o_custkey AS c_custkey", where=where)
    frame = rows(spark, d, "customer", "c_custkey", "c_name").join(held("o_orderstatus = 'F'"), "c_custkey", "left_semi")
    return frame.join(held("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'"), "c_custkey", "left_anti").join(held("o_totalprice < 2000"), "c_custkey", "left_anti")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN (SELECT l_orderkey AS k, min(l_linenumber) AS m FROM lineitem GROUP BY 1) ON l_orderkey = k WHERE l_linenumber > m")
def above_group_min(spark: SparkSession, d: str) -> DataFrame:
    return A.above_group_min(rows(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"], "l_linenumber")


@query("SELECT o_orderstatus, o_orderpriority, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1, 2, 3")
def group_count(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "orders", "o_orderstatus", "o_orderpriority", "year(o_orderdate) AS y").groupBy("o_orderstatus", "o_orderpriority", "y").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS filled, count(*) FILTER (o_totalprice > 100000) AS large, count(*) FILTER (o_orderstatus = 'P' AND o_totalprice > 100000) AS large_p FROM orders")
def conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    large = F.col("o_totalprice") > 100000
    return A.conditional_counts(rows(spark, d, "orders", "o_orderstatus", "o_totalprice"), {"filled": F.col("o_orderstatus") == "F", "large": large, "large_p": (F.col("o_orderstatus") == "P") & large})


@query("SELECT (year(o_orderdate) // 10 * 10)::INT AS decade, count(*) AS n, count(DISTINCT o_custkey) AS customers, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day FROM orders GROUP BY 1")
def decade_counts(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "orders", "o_custkey", "to_date(o_orderdate) AS day").groupBy(A.decade(F.col("day")).alias("decade")).agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@query(r"SELECT doc_id, source FROM documents WHERE regexp_matches(text, '(?i)\bthe\b') AND NOT regexp_matches(text, '!!') AND NOT regexp_matches(text, '\|')")
def regex_include_exclude(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "documents", "doc_id", "source", "text").where(S.include_exclude(F.col("text"), r"(?i)\bthe\b", ["!!", r"\|"])).drop("text")


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RING%' OR p_name ILIKE 'blue%' OR p_name ILIKE '%t'")
def ilike_any(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "part", "p_partkey", "p_name").where(S.ilike_any(F.col("p_name"), ["%RING%", "blue%", "%t"]))


_PLACE = "CASE WHEN event_id % 3 = 0 THEN upper(event_type) || '  GRC' WHEN event_id % 7 = 0 THEN 'Nominated' ELSE event_type || ' smc' END"


@query(rf"""
WITH e AS (SELECT user_id, ts::DATE AS day, {_PLACE} AS place FROM events),
k AS (SELECT user_id, day, place, lower(regexp_replace(trim(regexp_replace(place, '[\s-]+', ' ', 'g')), '(?i) (?:GRC|SMC)$', '')) AS place_key FROM e WHERE place <> 'Nominated')
SELECT user_id, place_key, arg_min(place, (day, place)) AS place_name, min(day) AS first_day, max(day) AS last_day, count(DISTINCT day) AS sittings FROM k GROUP BY 1, 2
""")
def seat_holding(spark: SparkSession, d: str) -> DataFrame:
    return A.seat_holdings(rows(spark, d, "events", "user_id", "to_date(ts) AS day", f"{_PLACE} AS place"), "user_id", "place", "day")


_SPOKEN = "CASE WHEN turn % 3 = 0 THEN NULL ELSE concat(upper(role), ' ', turn) END"


@query(f"SELECT conv_id, role, arg_min(label, turn) FILTER (label IS NOT NULL) AS first_label, count(*) AS n FROM (SELECT conv_id, role, turn, {_SPOKEN} AS label FROM conversations) GROUP BY 1, 2 HAVING count(label) > 0")
def first_label_and_count(spark: SparkSession, d: str) -> DataFrame:
    return A.first_label_and_count(rows(spark, d, "conversations", "conv_id", "role", "turn", f"{_SPOKEN} AS label"), ["conv_id", "role"], "label", "turn")


@query(f"SELECT conv_id, role, count(*) AS n FROM (SELECT conv_id, role, turn, {_SPOKEN} AS label FROM conversations) GROUP BY 1, 2 HAVING count(label) = 0")
def credited_only(spark: SparkSession, d: str) -> DataFrame:
    return A.credited_only(rows(spark, d, "conversations", "conv_id", "role", f"{_SPOKEN} AS label"), ["conv_id", "role"], "label")


_VOTE = ["l_orderkey AS division_id", "CASE WHEN l_linestatus = 'F' THEN 'MINUTES' ELSE 'PROCEEDINGS' END AS source", "CASE l_returnflag WHEN 'A' THEN 'AYE' WHEN 'N' THEN 'NO' ELSE CASE WHEN l_linenumber % 2 = 0 THEN 'ABSTAIN' ELSE 'ABSENT' END END AS choice", "CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_suppkey % 5 END AS party", "l_discount > 0.05 AS is_uncertain"]


@query(f"""
WITH v AS (SELECT {", ".join(_VOTE)} FROM lineitem),
s AS (SELECT o_orderkey AS division_id, CASE WHEN o_orderstatus <> 'O' THEN 'MINUTES' WHEN o_orderpriority <> '5-LOW' THEN 'PROCEEDINGS' END AS source FROM orders)
SELECT division_id, source, choice, party, count(*) AS votes, sum(is_uncertain::INT)::BIGINT AS uncertain FROM v JOIN s USING (division_id, source) WHERE choice <> 'ABSENT' GROUP BY 1, 2, 3, 4
""")
def party_counts(spark: SparkSession, d: str) -> DataFrame:
    sources = rows(spark, d, "orders", "o_orderkey AS division_id", "o_orderstatus <> 'O' AS minutes_stored", "o_orderpriority <> '5-LOW' AS proceedings_stored")
    return A.party_counts(rows(spark, d, "lineitem", *_VOTE), sources)


_SPEECH = ["conv_id % 4 AS parliament", "role", "text", "CASE WHEN turn % 5 = 4 THEN NULL WHEN turn % 7 = 3 THEN '(note)' WHEN turn % 6 = 5 THEN 'Hon. Members' ELSE role END AS label", "CASE WHEN conv_id % 3 = 0 THEN NULL ELSE conv_id END AS speaker_id"]
_CATEGORY = "CASE WHEN label IS NULL AND speaker_id IS NULL THEN 'no_speaker' WHEN label IS NULL THEN 'credited' WHEN regexp_matches(label, '(?i)hon\\.? members?') OR label LIKE '(%' OR label LIKE '\\_%' ESCAPE '\\' THEN 'adr_excluded' WHEN speaker_id IS NULL THEN 'named_unlinked' ELSE 'linked' END"
_FIGURES = f"WITH c AS (SELECT parliament, role, {_CATEGORY} AS category, length(regexp_replace(text, '[\\s*_\\\\#|]+', '', 'g')) AS chars FROM (SELECT {', '.join(_SPEECH)} FROM conversations))"
_SUMS = ", ".join([f"count(*) FILTER (category = '{c}') AS {c}_rows" for c in A.CATEGORIES] + [f"coalesce(sum(chars) FILTER (category = '{c}'), 0)::BIGINT AS {c}_chars" for c in A.CATEGORIES])


def _figures(spark: SparkSession, d: str, by: list[str]) -> DataFrame:
    return A.attribution_figures(rows(spark, d, "conversations", *_SPEECH), by, "text", F.col("label"), F.col("speaker_id"))


@query(f"{_FIGURES} SELECT parliament, {_SUMS} FROM c GROUP BY 1")
def attribution_figures(spark: SparkSession, d: str) -> DataFrame:
    return _figures(spark, d, ["parliament"])


_RATES = "round(linked_rows / nullif(linked_rows + named_unlinked_rows, 0), 6) AS label_rate, round((linked_rows + credited_rows) / nullif({rows}, 0), 6) AS row_rate, round((linked_chars + credited_chars) / nullif({chars}, 0), 6) AS text_rate".format(rows=" + ".join(f"{c}_rows" for c in A.CATEGORIES), chars=" + ".join(f"{c}_chars" for c in A.CATEGORIES))


@query(f"{_FIGURES}, f AS (SELECT parliament, {_SUMS} FROM c GROUP BY 1) SELECT parliament, {_RATES} FROM f")
def attribution_rates(spark: SparkSession, d: str) -> DataFrame:
    return A.attribution_rates(_figures(spark, d, ["parliament"]), ["parliament"])


@query(f"{_FIGURES} SELECT parliament, role, count(*) AS n, sum(chars)::BIGINT AS chars, count(*) FILTER (category = 'linked') AS linked FROM c GROUP BY GROUPING SETS ((parliament), (parliament, role))")
def attribution_rollup(spark: SparkSession, d: str) -> DataFrame:
    from rostrum.functions.names import countable_chars

    speeches = rows(spark, d, "conversations", *_SPEECH)
    speeches = speeches.select("parliament", "role", A.speech_category(F.col("label"), F.col("speaker_id")).alias("category"), countable_chars(F.col("text")).alias("chars"))
    sets = [[F.col("parliament")], [F.col("parliament"), F.col("role")]]
    return speeches.groupingSets(sets, "parliament", "role").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"), F.count(F.when(F.col("category") == "linked", 1)).alias("linked"))


@query("WITH c AS (SELECT event_type, ts::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2), m AS (SELECT event_type, median(n) AS median FROM c GROUP BY 1) SELECT event_type, day, n, median FROM c JOIN m USING (event_type) WHERE n < 0.9 * median")
def short_vs_median(spark: SparkSession, d: str) -> DataFrame:
    counts = rows(spark, d, "events", "event_type", "to_date(ts) AS day").groupBy("event_type", "day").agg(F.count("*").alias("n"))
    return A.short_against_median(counts, ["event_type"], "n", 0.9).select("event_type", "day", "n", "median")


@query("SELECT user_id, event_type, n FROM (SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, max(ts) DESC, length(event_type) DESC, event_type DESC) AS r FROM events GROUP BY 1, 2) WHERE r = 1")
def canonical_name(spark: SparkSession, d: str) -> DataFrame:
    return A.canonical_value(rows(spark, d, "events", "user_id", "event_type", "ts"), ["user_id"], "event_type", "ts")


@query("SELECT o_custkey, n FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ORDER BY n DESC, o_custkey LIMIT 20")
def most_common(spark: SparkSession, d: str) -> DataFrame:
    return A.most_common(rows(spark, d, "orders", "o_custkey"), "o_custkey", 20)


@query("SELECT count(*) AS n, md5(string_agg(md5(n_nationkey::VARCHAR || '|' || n_name || '|' || n_regionkey::VARCHAR), '' ORDER BY n_nationkey)) AS hash FROM nation")
def table_hash(spark: SparkSession, d: str) -> DataFrame:
    return A.table_hash(rows(spark, d, "nation"), ["n_nationkey", "n_name", "n_regionkey"], "n_nationkey")


@query("SELECT count(*) AS n, sum(('0x' || substr(h, 1, 16))::UBIGINT::HUGEINT)::VARCHAR AS high, sum(('0x' || substr(h, 17, 16))::UBIGINT::HUGEINT)::VARCHAR AS low FROM (SELECT md5(o_orderkey::VARCHAR || '|' || o_custkey::VARCHAR || '|' || o_orderstatus) AS h FROM orders)")
def row_checksum(spark: SparkSession, d: str) -> DataFrame:
    return A.row_checksum(rows(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"])


@query("SELECT sha256(string_agg(c_custkey::VARCHAR, chr(10) ORDER BY c_custkey)) AS hash FROM customer")
def frame_hash(spark: SparkSession, d: str) -> DataFrame:
    return A.frame_hash(rows(spark, d, "customer", "c_custkey"), "c_custkey")


_TOKENS = r"SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) AS token, {sign} AS d FROM ({source})"


@query(f"""
WITH t AS (SELECT doc_id, token, sum(d) AS d FROM ({_TOKENS.format(sign=-1, source="SELECT doc_id, text FROM documents")} UNION ALL {_TOKENS.format(sign=1, source="SELECT doc_id + 1 AS doc_id, text FROM documents")}) GROUP BY 1, 2 HAVING sum(d) <> 0)
SELECT doc_id, coalesce(sum(-d) FILTER (d < 0), 0)::BIGINT AS lost, coalesce(sum(d) FILTER (d > 0), 0)::BIGINT AS gained FROM t GROUP BY 1
""")
def token_bag_diff(spark: SparkSession, d: str) -> DataFrame:
    return A.token_differences(rows(spark, d, "documents", "doc_id", "text"), rows(spark, d, "documents", "doc_id + 1 AS doc_id", "text"), "doc_id", "text")


@query("SELECT source, count(*) AS n, count(*) FILTER (quality = 1) AS matched, round(avg((quality = 1)::INT), 6) AS rate FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def match_rate(spark: SparkSession, d: str) -> DataFrame:
    joined = rows(spark, d, "documents", "doc_id", "source").join(rows(spark, d, "labels", "doc_id", "quality"), "doc_id")
    return A.match_rate(joined, ["source"], F.col("quality") == 1)


@query("""
WITH c AS (SELECT p_name, count(*) AS n FROM part GROUP BY 1), r AS (SELECT p_name, n, row_number() OVER (ORDER BY n DESC, p_name) AS k, count(*) OVER () AS a FROM c)
SELECT string_agg(p_name || ' (' || n || ')', ', ' ORDER BY k) || CASE WHEN max(a) > 20 THEN ' and ' || (max(a) - 20) || ' more' ELSE '' END AS labels FROM r WHERE k <= 20
""")
def capped_label_list(spark: SparkSession, d: str) -> DataFrame:
    return A.capped_label_list(rows(spark, d, "part", "p_name"), "p_name")


# Sets and writes --------------------------------------------------------------------------------

_STORED, _PLANNED = "o_orderdate < TIMESTAMP '1999-01-01'", "o_orderdate >= TIMESTAMP '1997-01-01'"
_CHANGED = "CASE WHEN o_orderkey % 10 = 0 THEN 'X' WHEN o_orderkey % 15 = 0 THEN NULL ELSE o_orderstatus END"


def _stored(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus AS status", where=_STORED)


def _planned(spark: SparkSession, d: str) -> DataFrame:
    return rows(spark, d, "orders", "o_orderkey", "o_custkey", f"{_CHANGED} AS status", where=_PLANNED)


_SETS = f"WITH s AS (SELECT o_orderkey, o_custkey, o_orderstatus AS status FROM orders WHERE {_STORED}), p AS (SELECT o_orderkey, o_custkey, {_CHANGED} AS status FROM orders WHERE {_PLANNED})"


@query(f"{_SETS} SELECT coalesce(s.o_orderkey, p.o_orderkey) AS o_orderkey, CASE WHEN s.o_orderkey IS NULL THEN 'ADD' WHEN p.o_orderkey IS NULL THEN 'DELETE' WHEN s.status IS NOT DISTINCT FROM p.status THEN 'KEEP' ELSE 'UPDATE' END AS action FROM s FULL JOIN p ON s.o_orderkey = p.o_orderkey")
def plan_diff(spark: SparkSession, d: str) -> DataFrame:
    return S.plan_diff(_stored(spark, d), _planned(spark, d), ["o_orderkey"], ["status"])


@query(f"{_SETS} SELECT s.o_orderkey, s.o_custkey, CASE WHEN p.o_orderkey IS NOT NULL THEN p.status ELSE s.status END AS status FROM s LEFT JOIN p ON s.o_orderkey = p.o_orderkey")
def keyed_update(spark: SparkSession, d: str) -> DataFrame:
    return S.keyed_update(_stored(spark, d), _planned(spark, d), "o_orderkey", ["status"])


@query(f"{_SETS} SELECT s.o_orderkey, s.o_custkey, CASE WHEN p.o_orderkey IS NOT NULL AND s.status IS NOT DISTINCT FROM CASE WHEN s.o_custkey % 2 = 0 THEN 'F' END THEN p.status ELSE s.status END AS status, p.o_orderkey IS NOT NULL AND s.status IS NOT DISTINCT FROM CASE WHEN s.o_custkey % 2 = 0 THEN 'F' END AS applied FROM s LEFT JOIN p ON s.o_orderkey = p.o_orderkey")
def guarded_update(spark: SparkSession, d: str) -> DataFrame:
    updates = _planned(spark, d).selectExpr("o_orderkey", "CASE WHEN o_custkey % 2 = 0 THEN 'F' END AS before", "status AS after")
    return S.guarded_update(_stored(spark, d), updates, "o_orderkey", "status")


@query(f"{_SETS} SELECT s.o_orderkey, s.o_custkey, CASE WHEN p.o_orderkey IS NOT NULL AND s.status = 'O' THEN p.status ELSE s.status END AS status FROM s LEFT JOIN p ON s.o_orderkey = p.o_orderkey")
def state_guarded_update(spark: SparkSession, d: str) -> DataFrame:
    return S.state_update(_stored(spark, d), _planned(spark, d), "o_orderkey", "status", "O", ["status"])


@query(f"{_SETS} SELECT p.o_orderkey, p.o_custkey, coalesce(p.status, s.status) AS status FROM p LEFT JOIN s ON s.o_orderkey = p.o_orderkey")
def coalesce_fill(spark: SparkSession, d: str) -> DataFrame:
    return S.coalesce_fill(_planned(spark, d), _stored(spark, d), "o_orderkey", ["status"])


@query(f"{_SETS} SELECT p.* FROM p WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = p.o_orderkey)")
def anti_join_load(spark: SparkSession, d: str) -> DataFrame:
    return S.anti_join_load(_planned(spark, d), _stored(spark, d), ["o_orderkey"])


@query(f"{_SETS} SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM p WHERE s.o_custkey = p.o_custkey) UNION ALL SELECT * FROM p")
def replace_by_key(spark: SparkSession, d: str) -> DataFrame:
    return S.replace_by_key(_stored(spark, d), _planned(spark, d), ["o_custkey"])


@query(f"{_SETS}, a AS (SELECT o_custkey, count(*) AS n FROM s GROUP BY 1), b AS (SELECT o_custkey, count(*) AS n FROM p GROUP BY 1) SELECT o_custkey, a.n AS left_value, b.n AS right_value, CASE WHEN b.n IS NULL THEN 'ONLY_LEFT' WHEN a.n IS NULL THEN 'ONLY_RIGHT' WHEN a.n = b.n THEN 'SAME' ELSE 'DIFFERENT' END AS verdict FROM a FULL JOIN b USING (o_custkey)")
def table_diff(spark: SparkSession, d: str) -> DataFrame:
    count = lambda df: df.groupBy("o_custkey").agg(F.count("*").alias("n"))
    return S.table_diff(count(_stored(spark, d)), count(_planned(spark, d)), "o_custkey", "n")


_BOUNDS = "SELECT o_custkey, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day, count(*) AS sittings FROM orders WHERE {} GROUP BY 1"


@query(f"""
WITH s AS ({_BOUNDS.format("o_orderdate < TIMESTAMP '1998-01-01'")}), n AS ({_BOUNDS.format("o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-07-01'")})
SELECT o_custkey, least(s.first_day, n.first_day) AS first_day, greatest(s.last_day, n.last_day) AS last_day, greatest(s.sittings, n.sittings) AS sittings,
  CASE WHEN s.first_day IS NULL THEN 'ADD' WHEN s.first_day <= coalesce(n.first_day, s.first_day) AND s.last_day >= coalesce(n.last_day, s.last_day) AND s.sittings >= coalesce(n.sittings, 0) THEN 'KEEP' ELSE 'WIDEN' END AS action
FROM s FULL JOIN n USING (o_custkey)
""")
def widen_bounds(spark: SparkSession, d: str) -> DataFrame:
    bounds = lambda where: rows(spark, d, "orders", "o_custkey", "to_date(o_orderdate) AS day", where=where).groupBy("o_custkey").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("sittings"))
    return A.widen_bounds(bounds("o_orderdate < TIMESTAMP '1998-01-01'"), bounds("o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-07-01'"), ["o_custkey"])


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'large' WHEN o_orderstatus = 'F' THEN o_orderpriority WHEN o_orderstatus = 'O' THEN 'open' END AS value, CASE WHEN o_totalprice > 400000 THEN 'price' WHEN o_orderstatus = 'F' THEN 'filled' WHEN o_orderstatus = 'O' THEN 'status' END AS rule FROM orders")
def rule_cascade(spark: SparkSession, d: str) -> DataFrame:
    from rostrum.operators.joins import rule_cascade as cascade

    value, rule = cascade([("price", F.col("o_totalprice") > 400000, F.lit("large")), ("filled", F.col("o_orderstatus") == "F", F.col("o_orderpriority")), ("status", F.col("o_orderstatus") == "O", F.lit("open"))])
    return rows(spark, d, "orders").select("o_orderkey", value.alias("value"), rule.alias("rule"))


@query("SELECT c_custkey, CASE WHEN c_acctbal > 9000 THEN 'rich' WHEN c_mktsegment = 'BUILDING' THEN 'builder' WHEN c_nationkey < 5 THEN 'near' END AS linked, CASE WHEN c_acctbal > 9000 THEN 'balance' WHEN c_mktsegment = 'BUILDING' THEN 'segment' WHEN c_nationkey < 5 THEN 'nation' END AS linked_by FROM customer")
def pass_coalesce(spark: SparkSession, d: str) -> DataFrame:
    passes = [("balance", F.when(F.col("c_acctbal") > 9000, "rich")), ("segment", F.when(F.col("c_mktsegment") == "BUILDING", "builder")), ("nation", F.when(F.col("c_nationkey") < 5, "near"))]
    return S.pass_coalesce(rows(spark, d, "customer"), passes).select("c_custkey", "linked", "linked_by")


@query("SELECT o_orderstatus, '{\"n\":' || count(*) || ',\"customers\":' || count(DISTINCT o_custkey) || '}' AS json FROM orders GROUP BY 1")
def figures_json(spark: SparkSession, d: str) -> DataFrame:
    figures = rows(spark, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"))
    return A.group_json(figures, ["o_orderstatus"], ["n", "customers"])
