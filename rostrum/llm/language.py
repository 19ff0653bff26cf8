"""Language by a convolutional network over bytes.

A text's UTF-8 bytes are cut into windows of a fixed length, the last one filled up. Filters of
several widths slide over a window, each filter keeps its largest response, and a softmax over
these gives the window's chances of each language. A text's chances are the mean over all its
windows, weighted by their bytes. A filter of width w over one-hot bytes is w tables of 256 rows,
so applying it is w lookups a byte. The network is trained in numpy on windows of a bounded
sample of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, documents, text_slices

#: Bytes of a window, widths of the filters and how many there are of each.
WINDOW, WIDTHS, FILTERS = 256, (2, 3, 4), 16
#: About how many different texts of each language the network is fitted on, and how many windows of each text; documented bounds.
FIT_TEXTS, FIT_WINDOWS = 1_000, 4
#: What fills up windows: a byte value that no table has weights for.
FILL = 256
#: Windows that go through the filters at a time.
AT_ONCE = 64
UNDETERMINED = "und"


@dataclass
class Network:
    """languages by code point; tables[w]: (width, 257, filters); bias of all filters; weights and offsets of the softmax."""

    languages: list[str]
    tables: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray

    def params(self) -> list[np.ndarray]:
        return [*self.tables, self.bias, self.weights, self.offsets]


def start(languages: list[str], widths: tuple[int, ...] = WIDTHS, filters: int = FILTERS, seed: int = 1) -> Network:
    rng = np.random.default_rng(seed)
    tables = [rng.normal(0, 0.3 / np.sqrt(w), (w, FILL + 1, filters)).astype(np.float32) for w in widths]
    for t in tables:
        t[:, FILL] = 0
    many = filters * len(widths)
    return Network(languages, tables, np.zeros(many, np.float32), rng.normal(0, 1 / np.sqrt(many), (many, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))


def responses(net: Network, windows: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """The largest response of each filter in each window and, if asked for, where it begins."""
    out, at = [], []
    for table in net.tables:
        width, span = len(table), windows.shape[1] - len(table) + 1
        y = table[0][windows[:, :span]]
        for k in range(1, width):
            y += table[k][windows[:, k : k + span]]
        if places:
            where = y.argmax(1)
            at.append(where)
            out.append(np.take_along_axis(y, where[:, None], 1)[:, 0])
        else:
            out.append(y.max(1))
    return np.concatenate(out, 1) + net.bias, np.concatenate(at, 1) if places else None


def chances(net: Network, top: np.ndarray) -> np.ndarray:
    z = np.maximum(top, 0) @ net.weights + net.offsets
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def gradients(net: Network, windows: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """The mean negative log chance of the labels and its gradients, in the order of params()."""
    n = len(windows)
    top, where = responses(net, windows, places=True)
    p = chances(net, top)
    loss = -float(np.log(np.maximum(p[np.arange(n), label], 1e-30)).mean())
    p[np.arange(n), label] -= 1
    p /= n
    hidden = np.maximum(top, 0)
    back = (p @ net.weights.T) * (top > 0)
    tables, begin = [], 0
    for table in net.tables:
        width, filters = len(table), table.shape[2]
        own, first = back[:, begin : begin + filters], where[:, begin : begin + filters]
        grad = np.zeros_like(table)
        for k in range(width):
            byte = np.take_along_axis(windows, first + k, 1)
            cells = byte.astype(np.int64) * filters + np.arange(filters)
            grad[k] = np.bincount(cells.ravel(), own.ravel(), (FILL + 1) * filters).reshape(FILL + 1, filters)
        grad[:, FILL] = 0
        tables.append(grad)
        begin += filters
    return loss, [*tables, back.sum(0), hidden.T @ p, p.sum(0)]


def fit_network(languages: list[str], windows: np.ndarray, label: np.ndarray, epochs: int = 20, batch: int = 64, rate: float = 0.01, seed: int = 1) -> Network:
    """Adam over shuffled windows, languages alike in weight; half of each batch's windows are cut short, so that short texts are known too."""
    net, rng = start(languages, seed=seed), np.random.default_rng(seed)
    params = net.params()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    share = np.bincount(label, minlength=len(languages))
    chance = (1 / np.maximum(share, 1))[label]
    chance = chance / chance.sum() if len(label) else chance
    for step in range(1, (epochs * len(label)) // batch + 1 + bool(len(label))):
        own = rng.choice(len(label), batch, p=chance)
        x = windows[own].copy()
        short = np.where(rng.random(batch) < 0.5, np.exp(rng.uniform(np.log(8), np.log(WINDOW), batch)).astype(int), WINDOW)
        x[np.arange(WINDOW) >= short[:, None]] = FILL
        slope = rate * min(1.0, 2 * (1 - step * batch / (epochs * len(label) + batch)))
        for p, g, a, b in zip(params, gradients(net, x, label[own])[1], first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= (slope * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, text of each, bytes in each) of the texts data[offsets[i]:offsets[i + 1]]; an empty text has none."""
    count = -(-np.diff(offsets) // WINDOW)
    text = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[:-1][text] + nth * WINDOW
    size = np.minimum(WINDOW, offsets[1:][text] - begin)
    inside = np.arange(WINDOW) < size[:, None]
    at = np.minimum(begin[:, None] + np.arange(WINDOW), max(0, len(data) - 1))
    windows = np.where(inside, data[at].astype(np.int16), np.int16(FILL)) if len(data) else np.zeros((0, WINDOW), np.int16)
    return windows, text, size


def text_chances(net: Network, texts: pa.Array) -> np.ndarray:
    """The chances of each language for whole texts; all alike for null and empty ones."""
    if not net.languages:
        return np.zeros((len(texts), 0))
    out = [np.zeros((0, len(net.languages)))]
    for begin, end, data, offsets in text_slices(texts, 1 << 18):
        total = np.zeros((end - begin, len(net.languages)))
        # A long text alone makes a slice: its windows go through in runs.
        for at in range(0, len(data), run) if end - begin == 1 and len(data) > (run := WINDOW << 10) else [None]:
            windows, text, size = cut_windows(data, offsets) if at is None else cut_windows(data[at : at + run], np.array([0, min(run, len(data) - at)]))
            p = [chances(net, responses(net, windows[k : k + AT_ONCE])[0]) for k in range(0, len(windows), AT_ONCE)]
            np.add.at(total, text, np.concatenate([np.zeros((0, total.shape[1])), *p]) * size[:, None])
        weight = total.sum(1, keepdims=True)
        out.append(np.where(weight > 0, total / np.maximum(weight, 1e-30), 1 / len(net.languages)))
    return np.concatenate(out)


def fitted_texts(docs: DataFrame, wanted: Column, fit_texts: int = FIT_TEXTS) -> DataFrame:
    """Different texts (lang, text) of rows with a language for which `wanted` holds: about fit_texts of each language, or all if there are fewer.

    A hash of the text chooses them, so copies don't count and the bound holds however often one text occurs.
    """
    key = F.xxhash64(F.lit("fit"), "text")
    rows = docs.where(wanted).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where("lang is not null and text <> ''").withColumn("key", key)
    counts = {r.lang: r["count"] for r in rows.select("lang", "key").distinct().groupBy("lang").count().collect()}
    share = F.create_map(*[v for lang, n in sorted(counts.items()) for v in (F.lit(lang), F.lit(fit_texts / n))]) if counts else F.create_map(F.lit(""), F.lit(0.0))
    chance = F.shiftrightunsigned("key", 11) / F.lit(float(1 << 53))
    return rows.where(chance < F.try_element_at(share, F.col("lang"))).dropDuplicates(["lang", "key"]).select("lang", "key", "text")


def train(docs: DataFrame, wanted: Column, fit_texts: int = FIT_TEXTS, fit_windows: int = FIT_WINDOWS) -> Network:
    """The network of the rows of docs with a language for which `wanted` holds.

    Fitted on about fit_texts different texts of each language, on at most fit_windows windows
    of each, spread over the whole text; that many windows are all that the driver gets. Rows
    without a language, null and empty texts are not learned from; copies of a text are learned
    once. Without any the network knows no language. Other columns are ignored.
    """

    def some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, kept = [], []
        row = 0
        for begin, end, data, offsets in text_slices(batch.column(2)):
            windows, text, _ = cut_windows(data, offsets)
            count = np.bincount(text, minlength=end - begin)
            nth = np.arange(len(text)) - (np.cumsum(count) - count)[text]
            # The first window of each of so many equal parts of the text.
            part = nth * fit_windows // count[text]
            new = (nth == 0) | (part != (nth - 1) * fit_windows // count[text])
            kept += [w.tobytes() for w in windows[new]]
            rows.append(text[new] + row)
            row += end - begin
        own = np.concatenate([np.zeros(0, np.int64), *rows])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), batch.column(1).take(pa.array(own)), pa.array(kept, pa.binary())], ["lang", "key", "window"])

    got = arrow_map(fitted_texts(docs, wanted, fit_texts), some, "lang string, key long, window binary").toPandas()
    if not len(got):
        return start([])
    got["window"] = [bytes(w) for w in got["window"]]
    got = got.sort_values(["lang", "key", "window"], kind="stable")
    languages = sorted(set(got["lang"]))
    return fit_network(languages, np.frombuffer(b"".join(got["window"]), np.int16).reshape(-1, WINDOW), np.searchsorted(languages, got["lang"].to_numpy(str)))


def identify(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, lang_pred, score): the likeliest language of every whole text and its chance, a row for each row of docs.

    Texts that are null, empty or without a letter are `und` with score 0; so are all texts if
    the network knows no language. Of languages as likely the first by code point is taken. The
    prediction depends on the text alone, so repeated rows and rows without an id are treated
    like all others; long texts are read whole. Other columns are ignored, an empty table gives
    no rows.
    """
    known = pa.array([*net.languages, UNDETERMINED])

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        p = text_chances(net, batch.column(1))
        letter = batch.column(2).to_numpy(zero_copy_only=False) & bool(net.languages)
        best = p.argmax(1) if net.languages else np.zeros(len(p), int)
        score = p[np.arange(len(p)), best] if net.languages else np.zeros(len(p))
        yield pa.RecordBatch.from_arrays([batch.column(0), known.take(pa.array(np.where(letter, best, len(net.languages)))), pa.array(np.where(letter, score, 0.0))], ["doc_id", "lang_pred", "score"])

    text = F.col("text").cast("string")
    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letter")), each, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; a row without an id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op13_byte_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    net = train(docs, ~held_out(F.col("doc_id")))
    return identify(docs, net).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES, ORACLE = {"op13_byte_convolution": op13_byte_convolution}, {}
