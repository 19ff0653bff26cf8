"""The byte network against hand-walked responses, numeric gradients and held-out rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rostrum.llm import language
from rostrum.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string"


def toy(seed=3):
    net = language.start(["aa", "bb", "cc"], seed=seed)
    rng = np.random.default_rng(seed)
    for p in net.params():
        p[...] = rng.normal(0, 0.5, p.shape)
    for t in net.tables:
        t[:, language.FILL] = 0
    return net


def by_hand(net, text):
    """Mean chances over the windows of one text, filter by filter."""
    data, total = text.encode(), np.zeros(len(net.languages))
    for at in range(0, len(data), language.WINDOW):
        own = list(data[at : at + language.WINDOW])
        filled = own + [language.FILL] * (language.WINDOW - len(own))
        top = []
        for t in net.tables:
            for f in range(t.shape[2]):
                top.append(max(sum(t[k][filled[p + k]][f] for k in range(len(t))) for p in range(len(filled) - len(t) + 1)))
        z = np.maximum(np.array(top) + net.bias, 0) @ net.weights + net.offsets
        e = np.exp(z - z.max())
        total += e / e.sum() * len(own)
    return total / len(data)


def test_chances_by_hand():
    net = toy()
    texts = ["a", "héllo wörld", "x" * 256, "y" * 257, "some longer text " * 40]
    got = language.text_chances(net, pa.array([*texts, None, ""]))
    for text, p in zip(texts, got, strict=False):
        assert p == pytest.approx(by_hand(net, text), abs=1e-4)
    assert got[-2:] == pytest.approx(1 / 3)


def test_long_texts_are_read_whole():
    """A text longer than a run of windows has the mean over all of them, and its end counts."""
    net = toy()
    text = "".join(chr(97 + k % 23) + chr(65 + k % 11) for k in range(300_000))
    got = language.text_chances(net, pa.array(["short", text, text[:-1000] + "z" * 1000, "other"]))
    windows, _, size = language.cut_windows(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    p = np.concatenate([language.chances(net, language.responses(net, windows[k : k + 64])[0]) for k in range(0, len(windows), 64)])
    assert got[1] == pytest.approx((p * size[:, None]).sum(0) / size.sum(), abs=1e-6) and abs(got[1] - got[2]).max() > 1e-6


def test_gradients():
    net = toy(5)
    rng = np.random.default_rng(1)
    windows, label = rng.integers(97, 105, (6, language.WINDOW)).astype(np.int16), np.array([0, 1, 2, 0, 1, 2])
    windows[0, 40:] = language.FILL
    for p in net.params():
        p *= 0.3
    net.tables, net.bias, net.weights, net.offsets = [t.astype(float) for t in net.tables], net.bias.astype(float), net.weights.astype(float), net.offsets.astype(float)
    _, grads = language.gradients(net, windows, label)
    for p, g in zip(net.params(), grads, strict=True):
        for at in [np.unravel_index(k, p.shape) for k in np.argsort(-np.abs(g).ravel())[:4]]:
            old, eps = p[at], 1e-5
            p[at] = old + eps
            up = language.gradients(net, windows, label)[0]
            p[at] = old - eps
            down = language.gradients(net, windows, label)[0]
            p[at] = old
            assert g[at] == pytest.approx((up - down) / (2 * eps), rel=1e-3, abs=1e-8)


def test_windows_cover_every_byte():
    texts = [b"", b"a", b"b" * 256, b"c" * 700, b""]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    windows, text, size = language.cut_windows(data, offsets)
    for k, t in enumerate(texts):
        assert bytes(windows[text == k][windows[text == k] != language.FILL].astype(np.uint8)) == t
    assert size.tolist() == [1, 256, 256, 256, 188]


def test_held_out_languages(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op13_byte_convolution"](spark, folder).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    right = [r for r in held if r.lang_pred == docs[r.doc_id].lang]
    assert len(held) > 200 and len(right) >= 0.98 * len(held)
    for lang in {d.lang for d in docs.values()}:
        own = [r for r in held if docs[r.doc_id].lang == lang]
        assert sum(r.lang_pred == lang for r in own) >= 0.95 * len(own)


@pytest.fixture(scope="module")
def odd(spark):
    """Two made-up languages; nulls in any column, texts without letters, long ones, repeated rows, clashing columns."""
    rows = [(n, f"oka {n % 17} mala tona rika", "oka", "s") for n in range(40)] + [(100 + n, f"schrum {n % 13} blintz quorp", "rum", "s") for n in range(40)]
    rows += [(200, None, "oka", "s"), (201, "", "oka", None), (202, " \n 123 --- ", "rum", "s"), (203, "oka mala tona rika " * 20_000, None, "s"), (None, "schrum blintz quorp", None, None), (204, "blintz", "rum", "s"), (204, "blintz", "rum", "s"), (205, "жук", None, "s"), (206, "\x00é", "", "s")]
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("key", "window", "letter", "score", "lang_pred", "held_out")})


def test_odd_texts(spark, odd):
    net = language.train(odd, F.lit(True))
    assert set(net.languages) == {"", "oka", "rum"}
    got = {}
    for r in language.identify(odd, net).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert got[200] == got[201] == got[202] == [("und", 0.0)] and got[203][0][0] == "oka" and got[None][0][0] == "rum"
    assert len(got[204]) == 2 and got[204][0] == got[204][1] and got[204][0][0] == "rum" and got[205][0][0] in net.languages
    again = language.train(odd.repartition(5), F.lit(True))
    assert all((p == q).all() for p, q in zip(net.params(), again.params(), strict=True))


def test_nothing_to_learn_or_to_read(spark, odd):
    none = odd.limit(0)
    blank = language.train(none, F.lit(True))
    assert blank.languages == [] and {(r.lang_pred, r.score) for r in language.identify(odd, blank).collect()} == {("und", 0.0)}
    assert language.identify(none, language.train(odd, F.lit(True))).count() == 0
    one = language.train(odd, F.col("lang") == "oka")
    assert {r.lang_pred for r in language.identify(odd, one).collect()} == {"oka", "und"}


def test_copies_are_learned_once(spark):
    """However often one text occurs, the fitted texts keep their bound."""
    rows = [(n, "the same text", "aa", None) for n in range(500)] + [(1000 + n, f"text {n} of its own", "aa", None) for n in range(500)]
    got = language.fitted_texts(spark.createDataFrame(rows, SCHEMA).repartition(4), F.lit(True), 100).collect()
    assert 60 < len(got) < 140 and len({r.text for r in got}) == len(got)
