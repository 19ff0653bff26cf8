"""What the corpus operators share: scratch tables, text rules, word hashing over Arrow buffers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rostrum.sources.tables import Scratch  # noqa: F401

#: ASCII white space: the separators of every word rule in this subpackage.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """A text without null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is; lower() is the same and faster where all is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    """The number of words as a long; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# Hashing words of many texts at once ------------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTES = np.random.default_rng(20_240_501).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
SLICE = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BACK)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def separators(extra: str = "") -> np.ndarray:
    table = np.zeros(256, bool)
    table[list((SPACES + extra).encode())] = True
    return table


def fold_table() -> np.ndarray:
    """Hash values of bytes, A-Z as a-z."""
    table = _BYTES.copy()
    table[65:91] = table[97:123]
    return table


def word_hashes(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray, fold: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words of the texts data[offsets[i]:offsets[i + 1]].

    Returns (hash of each word, where each text's words begin, first byte, end byte). A word's
    hash is a polynomial in random values of its bytes, taken from running sums modulo 2**64.
    """
    n = len(data)
    ends_at = np.zeros(n + 1, bool)
    ends_at[offsets] = True
    in_word = ~apart[data]
    before = np.zeros(n, bool)
    before[1:] = in_word[:-1]
    after = np.zeros(n, bool)
    after[:-1] = in_word[1:]
    starts = np.flatnonzero(in_word & (~before | ends_at[:n]))
    ends = np.flatnonzero(in_word & (~after | ends_at[1:])) + 1
    up, back = _power(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(fold[data] * up[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * back[starts]), np.searchsorted(starts, offsets), starts, ends


def text_slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of about that many bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, side="right")) - 1)
        yield row, end, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def release_memory() -> None:
    """Gives freed memory back to the system: Python workers live on from stage to stage and keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim is not None:
        trim(0)


def arrow_map(df: DataFrame, each: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | StructType, done: Callable[[], None] | None = None) -> DataFrame:
    """each over every Arrow batch of a partition; a batch may give several. done drops what the worker need not keep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from each(batch)
        batch = None
        if done is not None:
            done()
        release_memory()

    return df.mapInArrow(run, schema)


def finite_vector(column: str) -> Column:
    """Whether a vector is there and holds neither null nor NaN nor an infinity."""
    entry = lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False))
    return F.col(column).isNotNull() & F.coalesce(F.forall(column, entry), F.lit(False))


def usual_length(vectors: DataFrame, column: str) -> tuple[int, int]:
    """(number of vectors of the most frequent length, that length); of two as frequent, the longer; (0, 0) without any."""
    sizes = vectors.groupBy(F.size(column).alias("entries")).agg(F.count("*").alias("rows"))
    top = sizes.where("entries > 0").agg(F.max(F.struct("rows", "entries")).alias("top")).first().top
    return (int(top.rows), int(top.entries)) if top else (0, 0)


def most_frequent(counts: DataFrame, n: str, most: int) -> DataFrame:
    """Rows of counts with the highest n, about `most` of them (all, if there are fewer).

    Rows are counted by steps of n, sixteenths of an octave; unlike a sorted limit, which takes
    so many rows from every partition to the driver, only some hundred numbers go there. The
    step that would pass `most` is cut by a hash of the whole row, so it gives its share however
    many rows are in it, the same ones under any partitioning.
    """
    step = F.floor(F.log2(F.col(n)) * 16)
    left, least, share = most, None, 1.0
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).collect(), key=lambda r: -r.step):
        least, share = r.step, min(1.0, left / r.rows)
        left -= r.rows
        if left <= 0:
            break
    if least is None:
        return counts.limit(0)
    chance = F.shiftrightunsigned(F.xxhash64(*counts.columns), 11) / F.lit(float(1 << 53))
    return counts.where((step > least) | ((step == least) & (chance < share)))


#: Places of a bitmap of keys: 2 MB at any input size.
MARKS = 1 << 24


def _place(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(MARKS))


def marks_of(keys: DataFrame) -> DataFrame:
    """(word, marks): a bitmap with the places of all keys, the only column, set; 64 places a row."""
    return keys.select(_place(keys.columns[0]).alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("marks"))


def split_by_marks(rows: DataFrame, marks: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be marked, rows whose key certainly is not or is null); the bitmap's size is fixed, so it is broadcast.

    What a join by the key must shuffle are the first ones alone. Keys have the type of the marked ones.
    """
    # Longer than all columns' names, so they clash with none.
    p, word, marked = (f"{name}{'_' * max(map(len, rows.columns))}" for name in ("p", "word", "marks"))
    joined = rows.withColumn(p, _place(key)).join(F.broadcast(marks.toDF(word, marked)), F.shiftright(p, 6) == F.col(word), "left")
    hit = F.col(key).isNotNull() & F.coalesce(F.expr(f"shiftright({marked}, cast({p} & 63 AS int)) & 1 = 1"), F.lit(False))
    return joined.where(hit).select(rows.columns), joined.where(~hit).select(rows.columns)


def may_match(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is among those of `keys`, and few others: what a join of the two must shuffle."""
    return split_by_marks(rows, marks_of(keys.select(key)), key)[0]


def numbered(rows: DataFrame, scratch: Scratch, name: str, run: int = 1 << 16) -> DataFrame:
    """rows with nth: 0, 1, ... among the rows that are equal in all columns, however they are dealt.

    Equal rows are counted before the shuffle and dealt out again by `run`, so a row that makes
    up a third of the table is spread like all others.
    """
    counted = scratch.save(rows.groupBy(*rows.columns).agg(F.count("*").alias("_n")), name)
    few = counted.where(F.col("_n") <= run).withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    runs = counted.where(F.col("_n") > run).withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(run).cast("long"))))
    many = runs.repartition("_from", *rows.columns).withColumn("nth", F.explode(F.sequence("_from", F.least(F.col("_from") + run, F.col("_n")) - 1)))
    return few.select(*rows.columns, "nth").unionByName(many.select(*rows.columns, "nth"))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
