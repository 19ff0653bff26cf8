"""Line dedup over levelled sorted runs of line hashes.

A run is a table of (h1, h2, docs, newest): a 128-bit hash of a line's key, the number of
documents that hold the line and the largest id among them, bucketed and sorted by hash. The
documents come in batches, largest ids first. Each batch is merge-anti-joined with the runs,
which drops the hashes that they have settled (found in enough documents, newest known), and
the rest becomes a run of level 0. Two runs of a level are merged into one run of the next, so
a hash is rewritten once a level. Runs have the same buckets, so neither anti-joins nor merges
(full outer merge joins) shuffle them or sort them again. Only DataFrame functions are used.

A line is dropped only from `enough` documents on, so a hash that the runs hold but have not
settled is counted on: its entries are summed when runs merge.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, Scratch, ascii_lower, documents, marks_of, split_by_marks, text_of


def line_key(line: Column) -> Column:
    """The line without white space at both ends."""
    return F.btrim(line, F.lit(SPACES))


def _hashes(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"))


def line_hashes(docs: DataFrame, min_chars: int = 40) -> DataFrame:
    """(doc_id, h1, h2), each once: the keys of at least min_chars code points of each document with an id.

    Rows that share an id are one document, so hashes are made distinct in the row and then over rows.
    """
    keys = F.transform(F.split(ascii_lower(text_of()), "\n", -1), line_key)
    hashes = F.array_distinct(F.transform(F.filter(keys, lambda k: F.length(k) >= min_chars), _hashes))
    return docs.where("doc_id IS NOT NULL").select("doc_id", F.explode(hashes).alias("h")).select("doc_id", "h.h1", "h.h2").distinct()


@contextmanager
def _sorted_scans(spark: SparkSession) -> Iterator[None]:
    """While this holds, plans take the order of a bucket's one file as given, so merges of runs don't sort again."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class LineRuns:
    """The levelled index. Runs are bucketed, sorted tables in the shared folder; the driver holds their names only.

    Batches must come in descending order of doc_id. An entry's newest is then final once it is
    in, and a hash is settled as soon as some run alone counts `enough` documents for it.
    """

    def __init__(self, scratch: Scratch, enough: int = 5) -> None:
        self.scratch, self.enough = scratch, enough
        self.levels: dict[int, list[tuple[str, DataFrame]]] = defaultdict(list)
        self.made = 0
        self.buckets = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))

    def _runs(self) -> list[DataFrame]:
        return [run for level in self.levels.values() for _, run in level]

    def _write(self, run: DataFrame, level: int) -> None:
        self.made += 1
        name = f"run-{level}-{self.made}"
        with _sorted_scans(self.scratch.spark):
            self.levels[level].append((name, self.scratch.save_sorted(run, name, ["h1", "h2"], self.buckets)))

    def unsettled(self, batch: DataFrame) -> DataFrame:
        """The rows of a batch whose hash no run has settled: one merge anti-join a run, by its order and buckets."""
        for run in self._runs():
            batch = batch.join(run.where(F.col("docs") >= self.enough).select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        return batch

    def add(self, hashes: DataFrame) -> None:
        """Adds a batch (doc_id, h1, h2), a row once for each document, whose ids are below those of earlier batches."""
        batch = hashes.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("newest"))
        self._write(self.unsettled(batch), 0)
        level = 0
        while len(self.levels[level]) > 1:
            self._merge(self.levels.pop(level), level + 1)
            level += 1

    def _merge(self, pair: list[tuple[str, DataFrame]], to: int) -> None:
        self._write(merged(*(run for _, run in pair)), to)
        self.scratch.drop(*(name for name, _ in pair))

    def common(self) -> DataFrame:
        """(h1, h2, newest) of the hashes that are found in enough documents. Compacts the runs to one."""
        while sum(map(len, self.levels.values())) > 1:
            low = sorted(level for level, runs in self.levels.items() if runs)[:2]
            self._merge([pair for level in low for pair in self.levels.pop(level)], low[-1] + 1)
        return self._runs()[0].where(F.col("docs") >= self.enough).select("h1", "h2", "newest")


def merged(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two runs as one."""
    docs = F.coalesce(a["docs"], F.lit(0)) + F.coalesce(b["docs"], F.lit(0))
    return a.join(b.hint("merge"), ["h1", "h2"], "full_outer").select("h1", "h2", docs.alias("docs"), F.greatest(a["newest"], b["newest"]).alias("newest"))


def batch_bounds(docs: DataFrame, batches: int | None = None) -> list[int]:
    """Ids that cut the documents into batches of about equal number; two, and from 1.5 million documents on more of them, up to 64."""
    marks = [k / 64 for k in range(1, 64)]
    n, found = docs.agg(F.count("doc_id"), F.percentile_approx("doc_id", marks)).first()
    batches = batches or max(2, min(64, n >> 19))
    return sorted({found[round(64 * k / batches) - 1] for k in range(1, batches)}) if found else []


def line_drops(docs: DataFrame, scratch: Scratch, min_chars: int, min_docs: int, batches: int | None) -> DataFrame:
    """(doc_id, drop): for documents that lose lines, the hashes (h1, h2) of these lines."""
    bounds = batch_bounds(docs, batches)
    batch = sum((F.when(F.col("doc_id") > bound, 1).otherwise(0) for bound in bounds), F.lit(0))
    hashes = line_hashes(docs, min_chars).withColumn("batch", batch)
    hashes.write.partitionBy("batch").parquet(f"{scratch.root}/hashes")
    hashes = scratch.load("hashes", hashes)
    index = LineRuns(scratch, min_docs)
    for k in range(len(bounds), -1, -1):  # a stored batch is a folder, so each is read once
        index.add(hashes.where(F.col("batch") == k).select("doc_id", "h1", "h2"))
    common = scratch.save(index.common(), "common")
    scratch.drop(*(name for level in index.levels.values() for name, _ in level))
    found = hashes.select("doc_id", "h1", "h2").join(common.hint("merge"), ["h1", "h2"]).where("doc_id <> newest")
    return scratch.save(found.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("drop")), "drops")


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int | None = None, scratch: Scratch | None = None) -> DataFrame:
    """docs with kept_text, n_lines and n_dropped, one row for each row of docs.

    A line's key is the line stripped of ASCII white space, A-Z in lower case. Keys of at least
    min_chars code points found in at least min_docs documents lose their lines everywhere but
    in the largest doc_id that holds them; the other lines stay, joined by newlines.

    A null text counts as one empty line and is kept as an empty text. Rows without an id keep
    all lines and count for none. Rows that share an id count as one document: all their lines
    belong to it, and of a repeated row each copy gets the same result. A document may hold a
    line many times; all of them go or stay. Long texts are taken whole (a row's lines are one
    array). An empty table gives no rows. Columns of docs named kept_text, n_lines or n_dropped
    are replaced, all others stay. Only texts that may lose a line are shuffled.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    docs = docs.drop("kept_text", "n_lines", "n_dropped")
    drops = line_drops(docs, scratch, min_chars, min_docs, batches)
    marks = scratch.save(marks_of(drops.select("doc_id")), "marks")
    some, untouched = split_by_marks(docs, marks)
    drops = drops.withColumnRenamed("drop", "_drop").withColumnRenamed("doc_id", "_doc_id").hint("merge")  # one way at every size
    joined = some.join(drops, some["doc_id"] == drops["_doc_id"], "left").drop("_doc_id")
    lines = F.split(text_of(), "\n", -1)
    n = F.size(lines).cast("long")
    keep = F.filter(lines, lambda line: ~F.array_contains(F.col("_drop"), _hashes(line_key(ascii_lower(line)))))
    joined = joined.withColumn("_lines", F.when(F.col("_drop").isNotNull(), keep))
    changed = joined.select(
        *docs.columns,
        F.when(F.col("_drop").isNull(), text_of()).otherwise(F.concat_ws("\n", "_lines")).alias("kept_text"),
        n.alias("n_lines"),
        F.when(F.col("_drop").isNull(), F.lit(0)).otherwise(n - F.size("_lines")).cast("long").alias("n_dropped"),
    )
    return changed.unionByName(untouched.select(*docs.columns, text_of().alias("kept_text"), n.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped")))


def op5_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


LINE_SQL = r"""
  SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {docs}))
"""
_SQL = f"""
WITH lines AS ({LINE_SQL.format(docs="documents")}), common AS (
  SELECT k, max(doc_id) AS newest FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
)
SELECT doc_id, count(*) AS n_lines, count(newest) FILTER (doc_id <> newest) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (newest IS NULL OR doc_id = newest), '')) AS kept_sha256
FROM lines LEFT JOIN common ON lines.k = common.k GROUP BY doc_id
"""
QUERIES, ORACLE = {"op5_line_runs": op5_line_runs}, {"op5_line_runs": _SQL}
