"""Reading and publishing tables."""

from __future__ import annotations

import re
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a folder; filters and columns reach its scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Scratch:
    """Tables that cut lineage, written to the shared folder the cluster names in spark.checkpoint.dir.

    The setting is read from the session. Only where it is unset and the master is local (tests,
    one machine) a temporary folder takes its place; on a cluster that is an error, as executors
    don't share such folders. Tables are Parquet, so later reads prune columns. What nobody
    dropped is removed when the driver's JVM ends.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = f"file://{tempfile.gettempdir()}/rostrum-scratch"
        self.id = uuid.uuid4().hex
        self.root = f"{base.rstrip('/')}/rostrum-{self.id}"
        fs, path = self._path("")
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def _path(self, name: str):  # noqa: ANN202
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path.getFileSystem(context._jsc.hadoopConfiguration()), path

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.load(name, df)

    def save_sorted(self, df: DataFrame, name: str, keys: list[str], buckets: int) -> DataFrame:
        """A table in buckets of the keys' hash, each sorted by the keys: merges and joins by them need no shuffle."""
        table = f"rostrum_{self.id}_{re.sub('[^a-z0-9]', '_', name)}"
        df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{self.root}/{name}").saveAsTable(table)
        return self.spark.table(table)

    def load(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        """Frees tables that no later plan reads."""
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS rostrum_{self.id}_{re.sub('[^a-z0-9]', '_', name)}")
            fs, path = self._path(name)
            fs.delete(path, True)

    def clear(self) -> None:
        fs, path = self._path("")
        fs.delete(path, True)


def read_reference_list(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A hand-kept JSON list; a file that doesn't fit its schema fails the read."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """Landed response bodies, one a file: (path, body)."""
    return spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("path"), F.col("value").alias("body"))


#: The shapes in which a document body arrives; the first that yields a text is taken.
BODY_SCHEMA = "htmlContent string, errorCode string, resultHTML struct<content: string, title: string, sittingDate: string>"


def parse_bodies(bodies: DataFrame) -> DataFrame:
    """bodies with content, shape (OLDER, NEWER, ERROR, UNREADABLE) read from their structure."""
    read = F.from_json("body", BODY_SCHEMA, {"mode": "PERMISSIVE"})
    shape = F.when(F.col("_b.errorCode").isNotNull(), "ERROR").when(F.col("_b.resultHTML.content").isNotNull(), "NEWER").when(F.col("_b.htmlContent").isNotNull(), "OLDER").otherwise("UNREADABLE")
    return bodies.withColumn("_b", read).select(*bodies.columns, F.coalesce("_b.resultHTML.content", "_b.htmlContent").alias("content"), shape.alias("shape"))


def lost_fields(bodies: DataFrame, mapped: list[str]) -> DataFrame:
    """(field, bodies): top-level fields with a value that no mapped column takes; a run halts if there are any."""
    fields = F.explode(F.from_json("body", "map<string, string>"))
    found = bodies.select(fields.alias("field", "value")).where(F.col("value").isNotNull() & ~F.col("field").isin(mapped))
    return found.groupBy("field").agg(F.count("*").alias("bodies"))


def sniff_format(content: str = "content") -> Column:
    """PDF, WORD, HTML, EMPTY or UNKNOWN by the first bytes of a binary column."""
    first = F.hex(F.substring(F.col(content), 1, 8))
    return (
        F.when(F.coalesce(F.octet_length(content), F.lit(0)) == 0, "EMPTY")
        .when(first.startswith("25504446"), "PDF")
        .when(first.startswith("D0CF11E0A1B11AE1"), "WORD")
        .when(F.lower(F.decode(F.substring(F.col(content), 1, 200), "ISO-8859-1")).rlike(r"^\s*<(!doctype|html)"), "HTML")
        .otherwise("UNKNOWN")
    )


def month_windows(days: DataFrame, day: str) -> DataFrame:
    """(first_day, last_day): the calendar months from the least to the latest day of a table, clipped at its ends."""
    ends = days.agg(F.min(day).alias("a"), F.max(day).alias("b")).where("a is not null")
    months = ends.select("a", "b", F.explode(F.sequence(F.trunc("a", "MM"), F.trunc("b", "MM"), F.expr("interval 1 month"))).alias("month"))
    return months.select(F.greatest("month", "a").alias("first_day"), F.least(F.last_day("month"), F.col("b")).alias("last_day"))


#: The file of a published table that names its current version.
CURRENT = "CURRENT"


def _files(spark: SparkSession, path: str):  # noqa: ANN202
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    return hadoop, root, root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def published_version(spark: SparkSession, path: str) -> str | None:
    """The folder of a published table's current version; None if nothing is published."""
    hadoop, root, fs = _files(spark, path)
    pointer = hadoop.Path(root, CURRENT)
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return f"{path}/{bytes(stream.readAllBytes()).decode()}"
    finally:
        stream.close()


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a published table."""
    version = published_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(version)


def publish(df: DataFrame, path: str, keep: int = 2) -> str:
    """Writes a new version of a table and makes it the current one; returns its folder.

    Versions are folders of their own and never change. A small file names the current one; it
    is written beside the old and renamed over it in one step, so at any time readers find a
    whole version, the old or the new, and one who has begun to read goes on with what they
    have. The last `keep` versions stay.
    """
    spark = df.sparkSession
    version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{path}/{version}")
    hadoop, root, fs = _files(spark, path)
    pointer, beside = hadoop.Path(root, CURRENT), hadoop.Path(root, f".{version}")
    stream = fs.create(beside, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    context = hadoop.FileContext.getFileContext(root.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(beside, pointer, options)
    old = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("v"))
    for name in old[: -keep if keep else len(old)]:
        if name != version:
            fs.delete(hadoop.Path(root, name), True)
    return f"{path}/{version}"


def write_lines(df: DataFrame, path: str, form: str = "jsonl", rows_a_file: int = 0) -> None:
    """Rows as JSON lines (form jsonl) or tab-separated values with a header (tsv); rows_a_file cuts them into packets."""
    writer = df.write.mode("overwrite")
    if rows_a_file:
        writer = writer.option("maxRecordsPerFile", rows_a_file)
    if form == "jsonl":
        writer.option("ignoreNullFields", False).json(path)
    else:
        writer.option("sep", "\t").option("header", True).csv(path)


def write_plan(df: DataFrame, path: str) -> None:
    """A plan file: the rows that a later write must find as they were planned."""
    df.write.mode("overwrite").json(path)


def read_plan(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows of a plan file in the schema of `like`; compare with sets.check_equal before writing."""
    return spark.read.schema(like.schema).option("mode", "FAILFAST").json(path)


def append_new(new: DataFrame, stored_path: str, keys: list[str]) -> None:
    """Appends the rows whose keys are not stored yet."""
    spark = new.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stored_path)
    if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        new = new.join(spark.read.parquet(stored_path).select(keys), keys, "left_anti")
    new.write.mode("append").parquet(stored_path)
