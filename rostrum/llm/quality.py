"""Quality rules kept as a ledger of bits.

Every rule is evaluated once a document: the ledger holds the measurements and a bitmask of
the rules that failed. Policies are versioned masks; a document is kept if no bit of the
policy's mask is set, so a new policy never reads texts again. Ablations (what would be kept
without rule r) are counts over the distinct bitmasks. Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, UPPER, WORD, Scratch, documents, text_of, word_count

SYMBOLS = "#*$%&|<>"
#: Rule name -> condition of failing, over the measurements. The place in the list is the bit.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("short_words", "2 * word_chars < 5 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("upper_case", "2 * n_upper > word_chars"),
]
BIT = {name: k for k, (name, _) in enumerate(RULES)}
#: Versioned policies: the rules whose failure drops a document.
POLICIES: dict[str, list[str]] = {
    "base": ["few_words", "repeated_windows"],
    "v1": ["few_words", "repeated_windows", "symbols", "repeated_lines"],
    "v2": [name for name, _ in RULES],
}


def mask_of(rules: list[str]) -> int:
    return sum(1 << BIT[name] for name in rules)


def repeat_words(text: Column) -> Column:
    """How many words lie in a 3-word window that occurs twice or more in the text.

    Windows are hashed to 64 bits; sorting (hash, position) brings equal windows together, in
    texts of any length.
    """
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))

    def of_words(w: Column) -> Column:
        n = F.size(w) - 2
        hashes = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(n < 2, F.lit(0)).otherwise(_let(_sorted_windows(hashes), _covered))

    return _let(words, of_words).cast("long")


def _let(value: Column, body) -> Column:  # noqa: ANN001
    """body of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sorted_windows(hashes: Column) -> Column:
    return F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))


def _covered(p: Column) -> Column:
    """The number of words in windows whose hash a neighbour in the sorted array has too."""

    def same(x: Column, y: Column) -> Column:
        return F.coalesce(x["h"] == y["h"], F.lit(False))

    found = F.filter(p, lambda x, i: same(x, F.get(p, i + 1)) | (F.when(i > 0, same(x, F.get(p, i - 1))).otherwise(F.lit(False))))
    places = F.sort_array(F.transform(found, lambda x: x["i"]))
    return _let(places, lambda q: F.aggregate(q, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")), lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n")), lambda acc: acc["n"]))


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, measurements, fail_bits), one row for each row of docs.

    A null or empty text has no words and one line. Rows are judged one by one: repeated rows
    and null ids get rows of their own, an empty table none. Texts are measured whole, whatever
    their length (one row's words are an array in memory). Other columns of docs are ignored.
    """
    text = text_of()
    has_word = lambda line: F.length(F.btrim(line, F.lit(SPACES))) > 0
    lines = docs.select("doc_id", text.alias("text")).select("*", F.split("text", "\n", -1).alias("lines"))
    full = F.filter("lines", has_word)
    plain = F.translate("text", SPACES, "")
    measured = lines.select(
        "doc_id",
        word_count(F.col("text")).alias("n_words"),
        F.length(plain).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(full) - F.size(F.array_distinct(full))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("text")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.length("text") - F.length(F.translate("text", UPPER, ""))).cast("long").alias("n_upper"),
    )
    bits = sum((F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, rule) in enumerate(RULES)), F.lit(0))
    return measured.withColumn("fail_bits", bits.cast("int"))


def apply_policy(rows: DataFrame, version: str) -> DataFrame:
    """Ledger rows with policy, kept and base_failed, the verdict of the base rules alone.

    Bits alone decide, so what null, empty or long texts come to was settled in the ledger;
    rows that repeat or have no id are judged one by one, other columns pass through, an empty
    ledger stays empty.
    """
    hit = lambda name: F.col("fail_bits").bitwiseAND(F.lit(mask_of(POLICIES[name]))) != 0
    return rows.withColumns({"base_failed": hit("base"), "policy": F.lit(version), "kept": ~hit("base") & ~hit(version)})


def ablations(rows: DataFrame) -> DataFrame:
    """(policy, rule, kept, kept_without, dropped_only_by): documents kept under each policy, and without each of its rules.

    Rows are first counted by bitmask (2**rules groups at most), so nothing larger is shuffled.
    Every row of the ledger counts, repeated ones and those without an id too; other columns are
    ignored, an empty ledger gives no rows.
    """
    spark = rows.sparkSession
    counts = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    masks = spark.createDataFrame([(v, r, mask_of(rules), 1 << BIT[r]) for v, rules in POLICIES.items() for r in rules], "policy string, rule string, mask int, bit int")
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    # A fixed list of masks beside at most 2**rules counts: neither grows with the documents.
    return counts.crossJoin(F.broadcast(masks)).groupBy("policy", "rule").agg(
        F.sum(F.when(hit == 0, F.col("n")).otherwise(0)).alias("kept"),
        F.sum(F.when(hit.bitwiseAND(F.bitwise_not(F.col("bit"))) == 0, F.col("n")).otherwise(0)).alias("kept_without"),
        F.sum(F.when(hit == F.col("bit"), F.col("n")).otherwise(0)).alias("dropped_only_by"),
    )


def op10_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = apply_policy(ledger(documents(spark, sf_dir)), "v2")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits", "policy")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy costs, from the ledger's bits alone."""
    return ablations(ledger(documents(spark, sf_dir)))


def quality_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, policy, kept) of every version, applied to one ledger."""
    rows = Scratch(spark).save(ledger(documents(spark, sf_dir)).select("doc_id", "fail_bits"), "ledger")
    verdicts = [apply_policy(rows, version).select("doc_id", "policy", "kept") for version in POLICIES]
    return reduce(DataFrame.unionByName, verdicts)


_BITS = " + ".join(f"CASE WHEN {rule} THEN {1 << k} ELSE 0 END" for k, (_, rule) in enumerate(RULES))
_LEDGER = rf"""
base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c
  FROM (SELECT r, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM base))
), rep AS (
  SELECT r, count(DISTINCT i + k) AS n FROM win, (SELECT unnest([0, 1, 2]) AS k) WHERE c > 1 GROUP BY r
), m AS (
  SELECT b.r, doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
    string_split(t, chr(10)) AS lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM base b LEFT JOIN rep ON b.r = rep.r
), d AS (
  SELECT *, len(lines)::BIGINT AS n_lines, list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS f FROM m
), e AS (
  SELECT *, (len(f) - len(list_distinct(f)))::BIGINT AS n_dup_lines FROM d
), l AS (SELECT *, ({_BITS})::INTEGER AS fail_bits FROM e)
"""
_SQL = f"""
WITH {_LEDGER}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & {mask_of(POLICIES["base"])}) <> 0 AS base_failed,
  (fail_bits & {mask_of(POLICIES["v2"]) | mask_of(POLICIES["base"])}) = 0 AS kept, fail_bits, 'v2' AS policy
FROM l
"""
_POLICY_ROWS = ", ".join(f"('{v}', '{r}', {mask_of(rules)}, {1 << BIT[r]})" for v, rules in POLICIES.items() for r in rules)
_ABLATIONS_SQL = f"""
WITH {_LEDGER}
SELECT policy, rule, count(*) FILTER (fail_bits & mask = 0) AS kept, count(*) FILTER (fail_bits & mask & ~bit = 0) AS kept_without,
  count(*) FILTER (fail_bits & mask = bit) AS dropped_only_by
FROM l, (VALUES {_POLICY_ROWS}) AS p(policy, rule, mask, bit) GROUP BY policy, rule
"""
_POLICIES_SQL = f"""
WITH {_LEDGER}
SELECT doc_id, policy, (fail_bits & mask) = 0 AS kept
FROM l, (VALUES {", ".join(f"('{v}', {mask_of(rules) | mask_of(POLICIES['base'])})" for v, rules in POLICIES.items())}) AS p(policy, mask)
"""
QUERIES = {"op10_quality_ledger": op10_quality_ledger, "quality_ablations": quality_ablations, "quality_policies": quality_policies}
ORACLE = {"op10_quality_ledger": _SQL, "quality_ablations": _ABLATIONS_SQL, "quality_policies": _POLICIES_SQL}
