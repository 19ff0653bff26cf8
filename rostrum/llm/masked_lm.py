"""Masked pseudo-likelihood from a bidirectional window network, trained in numpy.

The network predicts a token from its neighbours on both sides. Embeddings of the tokens in the
window pass a hidden layer to a hierarchical softmax: a Huffman tree over the ids, each inner
node a logistic unit that sees the hidden layer. Frequent words have ids of their own; rarer
words share ids by hash, and such a word's chance is its id's times its share of the id's
occurrences, from the counts of the whole corpus. So P(word | both sides) is a proper
distribution over all words that occur, at the cost of a dozen units a word. A document's score
is the sum of the conditional log-probabilities of all its words.

The nodes' biases start at the corpus frequencies, so the untrained network is the unigram
model. Training deals documents to shards by hash, as many as the corpus has tokens for; each
shard trains one network with every position once as the target, in an order that follows from
the documents, and Spark averages the networks as arrays in a tree over the shards. The result
does not depend on how the input is partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, documents, fold_table, most_frequent, separators, signed, text_slices, word_hashes

#: Words with an id of their own at most, the most frequent ones; the others share SPARE ids by hash.
VOCABULARY, SPARE = 32_768, 4_096
#: Neighbours on each side, embedding and hidden widths.
SIDE, WIDTH, HIDDEN = 2, 8, 16
#: Nodes next to the root, which are worked on as a matrix, for all tokens at once.
TOP = 32
#: Rounds of averaging, tokens of a shard in a round, tokens that are mixed before they are cut to steps.
ROUNDS, SHARD, POOL = 2, 1 << 21, 1 << 16
#: Tokens that are scored at once.
BLOCK = 8192
#: Least and most tokens of a step (a shard's steps grow as it goes on) and step size.
STEPS, RATE = (1024, 8192), 0.25
_APART, _FOLD = separators(), fold_table()
_IDS = VOCABULARY + SPARE


class Tree(NamedTuple):
    """Ways from the root to the ids, nodes in the order of the counts below them; bias: the log odds of side 1 by count.

    top: each id's sides (1 or -1, 0 where its way does not pass) at the first TOP nodes; the
    rest of its way is nodes[begin[i] : begin[i] + length[i]], with their sides.
    """

    top: np.ndarray
    nodes: np.ndarray
    sides: np.ndarray
    begin: np.ndarray
    length: np.ndarray
    bias: np.ndarray

    def ways(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nodes, sides) of ids below the top, one way after the other, and their lengths."""
        length = self.length[ids]
        first = np.cumsum(length) - length
        at = np.arange(length.sum()) + np.repeat(self.begin[ids] - first, length)
        return np.take(self.nodes, at), np.take(self.sides, at), length


def huffman(counts: np.ndarray) -> Tree:
    """The tree of the ids that have a count; the others have no way."""
    n = len(counts)
    heap = [(float(c), i) for i, c in enumerate(counts) if c > 0]
    heapify(heap)
    made: list[tuple[float, int, float, int]] = []
    while len(heap) > 1:
        (a, i), (b, j) = heappop(heap), heappop(heap)
        made.append((a, i, b, j))
        heappush(heap, (a + b, n + len(made) - 1))
    # Nodes are made by growing counts, so their order reversed has the root first.
    up, side, bias = np.full(2 * n, -1), np.zeros(2 * n, np.int8), np.zeros(n, np.float32)
    for k, (a, i, b, j) in enumerate(made):
        up[i] = up[j] = n + k
        side[i], side[j] = 1, -1
        bias[len(made) - 1 - k] = np.log(a / b)
    top, nodes, sides, begin = np.zeros((n, TOP), np.int8), [], [], [0]
    for i in range(n):
        at = i
        while up[at] >= 0:
            node = len(made) - 1 - (up[at] - n)
            if node < TOP:
                top[i, node] = side[at]
            else:
                nodes.append(node)
                sides.append(side[at])
            at = up[at]
        begin.append(len(nodes))
    begin = np.array(begin, np.int64)
    return Tree(top, np.array(nodes, np.int64), np.array(sides, np.float32), begin[:-1], np.diff(begin), bias)


class Vocabulary(NamedTuple):
    """hashes: sorted, with ids in their order; spare: the shared ids by the low bits of the hash; counts: of each id; tree: of the ids."""

    hashes: np.ndarray
    ids: np.ndarray
    spare: np.ndarray
    counts: np.ndarray
    tree: Tree

    def look_up(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id of each word, whether it is a shared one)."""
        shared = self.spare[(words & np.uint64(SPARE - 1)).astype(np.int64)]
        if not len(self.hashes):
            return shared, np.ones(len(words), bool)
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        rare = self.hashes[at] != words
        return np.where(rare, shared, self.ids[at]), rare


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of all documents, by hash: a table that grows with the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # partial sums of a batch, 10,000 texts or fewer
            words, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for _, _, data, offsets in text_slices(batch.column(0)):
                found, n = np.unique(word_hashes(data, offsets, _APART, _FOLD)[0], return_counts=True)
                words.append(found)
                counts.append(n)
            found, inverse = np.unique(np.concatenate(words), return_inverse=True)
            n = np.bincount(inverse, np.concatenate(counts), len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed(found)), pa.array(n)], ["word", "n"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_vocabulary(words: DataFrame) -> Vocabulary:
    """Ids in order of frequency from all counts (word, n); the driver gets VOCABULARY + SPARE rows at most."""
    top = sorted(most_frequent(words, "n", VOCABULARY).collect(), key=lambda r: (-r.n, r.word))[:VOCABULARY]
    hashes = np.array([r.word for r in top], np.int64).view(np.uint64)
    counts = np.zeros(_IDS)
    counts[SPARE : SPARE + len(top)] = [r.n for r in top]
    # The shared ids by hash: the sums of all words less those of the words that have their own.
    for r in words.groupBy(F.expr(f"word & {SPARE - 1}").alias("spare")).agg(F.sum("n").alias("n")).collect():
        counts[r.spare] = r.n
    np.subtract.at(counts, (hashes & np.uint64(SPARE - 1)).astype(np.int64), counts[SPARE : SPARE + len(top)])
    np.maximum(counts[:SPARE], 0.5, out=counts[:SPARE])  # a chance for words that the corpus doesn't hold
    order = np.argsort(-counts, kind="stable")
    ids = np.empty(_IDS, np.int64)
    ids[order] = np.arange(_IDS)
    by = np.argsort(hashes)
    return Vocabulary(hashes[by], ids[SPARE + by], ids[:SPARE], counts[order], huffman(counts[order]))


def tokenized(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, deal, ids, rare, times, row): ids of all words in order; rare words by hash, with how often; deal: a hash of the row."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a size fixed by the constants above

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        for begin, end, data, offsets in text_slices(batch.column(2)):
            words, at, _, _ = word_hashes(data, offsets, _APART, _FOLD)
            ids, shared = vocabulary.look_up(words)
            own = [np.unique(words[a:b][shared[a:b]], return_counts=True) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(begin, end - begin),
                    batch.column(1).slice(begin, end - begin),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array([signed(w) for w, _ in own], pa.list_(pa.int64())),
                    pa.array([n for _, n in own], pa.list_(pa.int64())),
                ],
                ["doc_id", "deal", "ids", "rare", "times"],
            )

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", text).alias("deal"), text.alias("text"))
    # Numbers of rows hold once they are written: read a saved table.
    return arrow_map(rows, each, "doc_id long, deal long, ids array<int>, rare array<long>, times array<long>").withColumn("row", F.monotonically_increasing_id())


# The network ------------------------------------------------------------------------------------


def start(vocabulary: Vocabulary, seed: int = 1) -> list[np.ndarray]:
    """Embeddings; hidden weights and bias; weights and bias of the tree's nodes."""
    rng = np.random.default_rng(seed)
    inputs = 2 * SIDE * WIDTH
    draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
    return [draw(0.5, _IDS + 1, WIDTH), draw(inputs**-0.5, inputs, HIDDEN), draw(0, HIDDEN), draw(0, _IDS, HIDDEN), vocabulary.tree.bias.copy()]


def windows(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The SIDE neighbours before and after every token; beyond a text's ends is the id after all others."""
    n = len(tokens)
    # The texts one after the other with SIDE such ids before, between and after them.
    place = np.arange(n) + np.repeat(np.arange(1, len(offsets)) * SIDE, np.diff(offsets))
    apart = np.full(n + len(offsets) * SIDE, _IDS, np.int32)
    apart[place] = tokens
    out = np.empty((n, 2 * SIDE), np.int32)
    for k, step in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        out[:, k] = np.take(apart, place + step)
    return out


def _hidden(net: list[np.ndarray], context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.take(net[0], context, 0).reshape(len(context), -1)
    h = x @ net[1]
    h += net[2]
    return x, np.tanh(h, out=h)


def _by_way(tree: Tree, ids: np.ndarray) -> np.ndarray:
    """The order of ids by falling length of their ways below the top, as `_levels` needs it."""
    return np.argsort(-np.take(tree.length, ids).astype(np.int16), kind="stable")


def _top(net: list[np.ndarray], tree: Tree, h: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sides, logits toward the ids) at the top nodes, a row for each token."""
    sides = np.take(tree.top, ids, 0).astype(np.float32)
    z = h @ net[3][:TOP].T
    z += net[4][:TOP]
    z *= sides
    return sides, z


def _levels(net: list[np.ndarray], tree: Tree, h: np.ndarray, ids: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(nodes, sides, the nodes' weights, logits toward the ids) of each level below the top.

    Ids are in the order of `_by_way`, so those whose ways reach a level are the first so many.
    """
    begin = np.take(tree.begin, ids)
    for level, n in enumerate(np.cumsum(np.bincount(np.take(tree.length, ids))[:0:-1])[::-1]):
        at = begin[:n] + level
        nodes, sides = np.take(tree.nodes, at), np.take(tree.sides, at)
        w = np.take(net[3], nodes, 0)
        z = np.einsum("ij,ij->i", w, h[:n])
        z += np.take(net[4], nodes)
        z *= sides
        yield nodes, sides, w, z


def _costs(z: np.ndarray) -> np.ndarray:
    """-log of the chances of logits, in place."""
    np.maximum(z, -60, out=z)
    np.negative(z, out=z)
    np.exp(z, out=z)
    z += 1
    return np.log(z, out=z)


def _slopes(z: np.ndarray, sides: np.ndarray, n: int) -> np.ndarray:
    """The gradient of the mean of n costs by the nodes' own logits, in place of z."""
    np.minimum(z, 60, out=z)
    np.exp(z, out=z)
    z += 1
    np.divide(sides, z, out=z)
    z *= np.float32(-1 / n)
    return z


def log_probabilities(net: list[np.ndarray], tree: Tree, tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """log P(id | both sides) of every token."""
    out = np.empty(len(tokens))
    context = windows(tokens, offsets)
    for a in range(0, len(tokens), BLOCK):
        order = _by_way(tree, tokens[a : a + BLOCK]) + a
        ids = np.take(tokens, order)
        h = _hidden(net, np.take(context, order, 0))[1]
        sides, z = _top(net, tree, h, ids)
        costs = np.einsum("ij,ij->i", _costs(z), np.abs(sides, out=sides)).astype(np.float64)
        for _, _, _, z in _levels(net, tree, h, ids):
            costs[: len(z)] += _costs(z)
        out[order] = -costs
    return out


def _places(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct ids, the number among them of each)."""
    used = np.zeros(_IDS + 1, np.int64)
    used[at] = 1
    seen = np.flatnonzero(used)
    used[seen] = np.arange(len(seen))
    return seen, used[at]


def _move(p: np.ndarray, squares: np.ndarray, at: np.ndarray | slice, d: np.ndarray, rate: float) -> None:
    """An AdaGrad step of the parameters at these places; d is used up."""
    rows = (lambda a: a[at]) if isinstance(at, slice) else (lambda a: np.take(a, at, 0))
    s = np.multiply(d, d)
    s += rows(squares)
    squares[at] = s
    np.sqrt(s, out=s)
    s += np.float32(1e-8)
    d *= np.float32(rate)
    d /= s
    p[at] = np.subtract(rows(p), d, out=d)


def train_step(net: list[np.ndarray], squares: list[np.ndarray], tree: Tree, context: np.ndarray, ids: np.ndarray, rate: float = RATE) -> None:
    """One AdaGrad step in place, on the mean of -log P. Only what the step has seen has a gradient and moves."""
    n = len(ids)
    order = _by_way(tree, ids)
    ids, context = np.take(ids, order), np.take(context, order, 0)
    x, h = _hidden(net, context)
    sides, z = _top(net, tree, h, ids)
    d = _slopes(z, sides, n)
    dh = d @ net[3][:TOP]
    grads = [(np.s_[:TOP], d.T @ h, d.sum(0))]
    ways, slopes = [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
    for nodes, sides, w, z in _levels(net, tree, h, ids):
        g = _slopes(z, sides, n)
        w *= g[:, None]
        dh[: len(g)] += w
        ways.append(nodes)
        slopes.append(g)
    seen, inverse = _places(np.concatenate(ways))
    g = np.concatenate(slopes, dtype=np.float64)
    # Sums by place, one dimension after the other, each side by side in memory, which is how numpy counts fastest.
    dw, own = np.empty((len(seen), HIDDEN), np.float32), np.empty(len(g))
    for k, values in enumerate(np.ascontiguousarray(h.T)):
        np.concatenate([values[: len(each)] for each in slopes], out=own)
        own *= g
        dw[:, k] = np.bincount(inverse, own, len(seen))
    grads.append((seen, dw, np.bincount(inverse, g, len(seen)).astype(np.float32)))
    for at, dw, db in grads:
        _move(net[3], squares[3], at, dw, rate)
        _move(net[4], squares[4], at, db, rate)
    dh *= 1 - h * h
    dx = (net[1] @ dh.T).reshape(2 * SIDE, WIDTH, n)
    for k, d in ((1, x.T @ dh), (2, dh.sum(0))):
        _move(net[k], squares[k], np.s_[:], d, rate)
    seen, inverse = _places(context.T.ravel())
    de = np.empty((len(seen), WIDTH), np.float32)
    for k in range(WIDTH):
        de[:, k] = np.bincount(inverse, dx[:, k].ravel(), len(seen))
    _move(net[0], squares[0], seen, de, rate)


# Training ---------------------------------------------------------------------------------------


class _Shard:
    """Trains one network on the documents of one shard, in the order they come."""

    def __init__(self, number: int, begun: list[np.ndarray], tree: Tree, seed: int) -> None:
        self.number, self.begun, self.tree = number, begun, tree
        self.net = [p.copy() for p in begun]
        self.squares = [np.full_like(p, 1e-5) for p in begun]
        self.rng = np.random.default_rng([seed, number])
        self.seen = 0
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.pool = 0
        self.used, self.nodes = np.zeros(_IDS + 1, bool), np.zeros(_IDS, bool)

    def add(self, tokens: np.ndarray, offsets: np.ndarray) -> None:
        self.waiting.append((windows(tokens, offsets), tokens))
        self.pool += len(tokens)
        if self.pool >= POOL:
            self.learn()

    def learn(self) -> None:
        if not self.pool:
            return
        context, ids = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
        self.waiting, self.pool = [], 0
        order = self.rng.permutation(len(ids))
        at = 0
        while at < len(ids):
            step = order[at : at + int(np.clip(self.seen // 32, *STEPS))]
            train_step(self.net, self.squares, self.tree, context[step], ids[step])
            self.seen, at = self.seen + len(step), at + len(step)
        self.used[context.ravel()] = True
        ids = np.unique(ids)
        self.nodes[self.tree.ways(ids)[0]] = True
        self.nodes[:TOP] |= self.tree.top[ids].any(0)

    def moved(self) -> np.ndarray:
        """What the sums over shards need: weighted moves of all parameters, then the weights by embedding and by node."""
        self.learn()
        moves = [(a - b).ravel() * np.float32(self.seen) for a, b in zip(self.net, self.begun, strict=True)]
        return np.concatenate([*moves, self.used * np.float32(self.seen), self.nodes * np.float32(self.seen), [np.float32(self.seen)]]).astype(np.float32)


def averaged(net: list[np.ndarray], sums: np.ndarray) -> list[np.ndarray]:
    """net moved by the means over the shards; embeddings and nodes by the means over the shards that have seen them."""
    used, nodes, seen = sums[-2 * _IDS - 2 : -_IDS - 1], sums[-_IDS - 1 : -1], sums[-1]
    weights = [used[:, None], seen, seen, nodes[:, None], nodes]
    out, at = [], 0
    for p, w in zip(net, weights, strict=True):
        out.append((p + sums[at : at + p.size].reshape(p.shape) / np.maximum(w, 1)).astype(np.float32))
        at += p.size
    return out


def _adder(kind: type):  # noqa: ANN202
    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        arrays = [np.frombuffer(data, kind) for data in rows.sort_values("shard")["data"]]
        total = np.zeros(len(arrays[0]))
        for own in arrays:
            total += own
        return pd.DataFrame({"shard": [key[0]], "chunk": [key[1]], "data": [total.tobytes()]})

    return add


def tree_sum(parts: DataFrame, shards: int, name: str, scratch: Scratch, fan: int = 16, chunk: int = 1 << 16) -> np.ndarray:
    """The sum of the arrays of rows (shard, chunk, data), fan shards at a time, in the order of their numbers.

    Shards give single precision, sums are in double.
    """
    level, kind = 0, np.float32
    while shards > 1:
        parts = scratch.save(parts.groupBy(F.expr(f"shard div {fan}").cast("int").alias("shard"), "chunk").applyInPandas(_adder(kind), "shard int, chunk int, data binary"), f"{name}-{level}")
        shards, level, kind = -(-shards // fan), level + 1, np.float64
    rows = sorted(parts.select("chunk", "data").collect())  # one array of parameters, whatever the input
    return np.concatenate([np.frombuffer(r.data, kind) for r in rows]).astype(np.float64) if rows else np.zeros(0)


def train(tokens: DataFrame, total: int, vocabulary: Vocabulary, scratch: Scratch, rounds: int = ROUNDS, seed: int = 1, chunk: int = 1 << 16) -> list[np.ndarray]:
    """The averaged network of rows (deal, ids) with `total` tokens. Every document is trained on in one of the rounds.

    A row's hash gives its round, its shard and its place, so rows that are equal share a shard.
    """
    spark = tokens.sparkSession
    net = start(vocabulary, seed)
    shards = max(1, -(-total // (rounds * SHARD)))
    dealt = tokens.select("deal", "ids", F.pmod(F.xxhash64(F.lit(1), "deal"), F.lit(rounds)).alias("turn"), F.pmod(F.xxhash64(F.lit(2), "deal"), F.lit(shards)).cast("int").alias("shard"))
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast((net, vocabulary.tree))  # a size fixed by the constants above

        def learn(batches: Iterator[pa.RecordBatch], sent=sent, turn=turn) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            own = None

            def give() -> Iterator[pa.RecordBatch]:
                flat = own.moved()
                for k, a in enumerate(range(0, len(flat), chunk)):
                    yield pa.RecordBatch.from_arrays([pa.array([own.number], pa.int32()), pa.array([k], pa.int32()), pa.array([flat[a : a + chunk].tobytes()], pa.binary())], ["shard", "chunk", "data"])

            for batch in batches:
                shard = batch.column(0).to_numpy()
                cuts = np.flatnonzero(np.diff(shard, prepend=-1))
                for a, b in zip(cuts, [*cuts[1:], len(shard)], strict=True):
                    if own is None or own.number != shard[a]:
                        if own is not None:
                            yield from give()
                        own = _Shard(int(shard[a]), *sent.value, seed + turn)
                    for begin in range(a, b, 256):
                        lists = batch.column(1).slice(begin, min(256, b - begin))
                        offsets = lists.offsets.to_numpy().astype(np.int64)
                        own.add(lists.flatten().to_numpy(), offsets - offsets[0])
            if own is not None:
                yield from give()

        rows = dealt.where(F.col("turn") == turn).repartition("shard").sortWithinPartitions("shard", "deal").select("shard", "ids")
        parts = scratch.save(rows.mapInArrow(learn, "shard int, chunk int, data binary"), f"parts-{turn}")
        sums = tree_sum(parts, shards, f"sums-{turn}", scratch)
        net = averaged(net, sums) if len(sums) else net
        scratch.drop(f"parts-{turn}")
        sent.unpersist()
    return net


# Scores -----------------------------------------------------------------------------------------


class Model(NamedTuple):
    """words: the counts (word, n) of the corpus the network was trained on."""

    vocabulary: Vocabulary
    net: list[np.ndarray]
    words: DataFrame


def fit(docs: DataFrame, rounds: int = ROUNDS, seed: int = 1, scratch: Scratch | None = None) -> tuple[Model, DataFrame]:
    """(a model of all documents, their tokens). Rows with the same id and text are learned from as often as they occur."""
    scratch = scratch or Scratch(docs.sparkSession)
    words = scratch.save(word_counts(docs), "words")
    vocabulary = build_vocabulary(words)
    tokens = scratch.save(tokenized(docs, vocabulary), "tokens")
    return Model(vocabulary, train(tokens, int(vocabulary.counts.sum()), vocabulary, scratch, rounds, seed), words), tokens


def score(tokens: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_probability) of rows as `tokenized` by the model's vocabulary, each with a written number `row`.

    A word that the model's corpus has not counts there as half a word. Scores are rounded to
    three digits: how rows are batched changes the last bits of single-precision sums. Rows without
    tokens have the sum 0 and a null mean; null and repeated ids are rows like all others, texts of
    any length are scored whole, other columns are ignored, an empty table gives no rows.
    """
    sent = tokens.sparkSession.sparkContext.broadcast((model.vocabulary, model.net))

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vocabulary, net = sent.value
        is_shared = np.zeros(_IDS, bool)
        is_shared[vocabulary.spare] = True
        log_count = np.log(np.maximum(vocabulary.counts, 0.5))
        for begin in range(0, len(batch), 256):
            part = batch.slice(begin, 256)
            lists = part.column(2)
            at = lists.offsets.to_numpy().astype(np.int64)
            at, ids = at - at[0], lists.flatten().to_numpy()
            logs = log_probabilities(net, vocabulary.tree, ids, at) - np.where(is_shared[ids], log_count[ids], 0.0)
            sums = np.concatenate([[0.0], np.cumsum(logs)])
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.diff(at)), pa.array(sums[at[1:]] - sums[at[:-1]])], ["row", "doc_id", "n_tokens", "net"])

    scored = arrow_map(tokens.select("row", "doc_id", "ids"), each, "row long, doc_id long, n_tokens long, net double")
    # A rare word's count comes by a join, in whole millionths so that sums are exact in any order.
    rare = tokens.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", "w.rare", "w.times")
    counted = rare.join(model.words, rare["rare"] == model.words["word"], "left")
    log_n = F.round(F.log(F.coalesce(F.col("n").cast("double"), F.lit(0.5))) * 1e6).cast("long")
    of_rare = counted.groupBy("row").agg(F.sum(F.col("times") * log_n).alias("micro"))
    total = F.round(F.col("net") + F.coalesce(F.col("micro"), F.lit(0)) / 1e6, 3)
    joined = scored.join(of_rare, "row", "left").select("doc_id", "n_tokens", F.when(F.col("n_tokens") > 0, total).otherwise(0.0).alias("log_likelihood"))
    return joined.withColumn("mean_log_probability", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))


def pseudo_likelihood(docs: DataFrame, rounds: int = ROUNDS, seed: int = 1, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_probability) by a network trained on docs, one row for each row of docs.

    Words are `[^\\x20\\x09-\\x0D]+`, A-Z folded. Texts without words (null, empty) have the sum 0
    and a null mean. Whole texts are scored, whatever their length. Repeated rows get the same
    score, each a row of its own; a null id is kept. Words of equal count are numbered in the
    order of their hashes. Other columns are ignored. An empty table gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    model, tokens = fit(docs, rounds, seed, scratch)
    return score(tokens, model)


def op4_masked_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(documents(spark, sf_dir))


QUERIES, ORACLE = {"op4_masked_likelihood": op4_masked_likelihood}, {}
