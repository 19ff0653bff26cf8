"""Corpus operators against brute force, round trips and held-out rows."""

import collections
import hashlib
import os
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rostrum.llm import jaccard_join, lines, masked_lm, matroska, mixing, pieces, quality, sharding, token_counts, toxicity
from rostrum.llm.common import Scratch, most_frequent, numbered
from rostrum.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that every operator makes itself; input columns of these names must not disturb it.
CLASHES = ["size", "shard", "n", "component", "score", "kept_text", "n_lines", "stratum", "p", "place", "prefix", "batch", "n_tokens", "media", "fail_bits"]
LONG = "word " * 30_000 + "\n" + "x" * 50_000


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing columns."""
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "   \n\t\n", "en", "a", 6), (4, LONG, "en", "a", len(LONG)), (5, "same text here for all of us", "en", "b", 5), (6, "same text here for all of us", "en", "b", 5), (6, "same text here for all of us", "en", "b", 5), (7, "é Ünïcödé 😀 \x00 text", None, "b", None), (8, "one", "en", None, 3), (9, "one two", "en", None, 7), (None, "no id at all", "en", "a", 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_odd_and_empty_tables(spark, odd, none):
    n = odd.count()
    for make in (sharding.shard_by_bytes, mixing.mix_sources, quality.ledger, lines.dedup_lines, jaccard_join.similar_components, pieces.piece_digest, token_counts.encoded_lengths, lambda d: matroska.media_digest(matroska.encode_media(d)), masked_lm.pseudo_likelihood):
        assert make(odd).count() == n
        assert make(none).count() == 0
    labels = spark.createDataFrame([(5, 1, 0), (8, 1, 1), (2, None, None)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0)):
        machine = toxicity.train(odd, given, ~toxicity.held_out(F.col("doc_id")))
        assert toxicity.score_toxicity(odd, machine).where("score between 0 and 1").count() == n
        assert toxicity.score_toxicity(none, machine).count() == 0
    assert jaccard_join.one_of_each(odd).columns == odd.columns
    assert mixing.mix_documents(odd).columns == odd.columns
    assert toxicity.drop_toxic(odd, machine).columns == odd.columns
    assert token_counts.length_histogram(token_counts.encoded_lengths(none)).count() == 0


def test_values_on_the_odd_table(spark, odd):
    """Every row's own values: nulls, empty and long texts, repeats and columns of the operators' own names."""
    rows = texts_of(odd)
    texts = dict(rows)
    own = pieces.piece_model()
    encode = token_counts._encoding(token_counts.TOKENIZER).encode_ordinary
    by = lambda df, *columns: sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    each = lambda make: sorted(((i, *make(t or "")) for i, t in rows), key=repr)
    assert by(lines.dedup_lines(odd), "doc_id", "n_lines", "n_dropped", "kept_text") == each(lambda t: (t.count("\n") + 1, 0, t))
    assert by(pieces.piece_digest(odd), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == each(own.digest)
    assert by(token_counts.encoded_lengths(odd), "doc_id", "n_tokens") == each(lambda t: (len(encode(t)),))
    assert by(mixing.mix_sources(odd), "doc_id", "size") == each(lambda t: (len(words_of(t)),))
    check_shards(rows, sharding.shard_by_bytes(odd).collect(), 8)
    payload = lambda t: t.encode() + bytes(-len(t.encode()) % 64 or (64 if not t else 0))
    assert by(matroska.media_digest(matroska.encode_media(odd)), "doc_id", "n_bytes", "payload_sha256", "error") == each(lambda t: (len(t.encode()), hashlib.sha256(payload(t)).hexdigest(), None))
    found = by(jaccard_join.similar_components(odd, 3, 90), "doc_id", "n_shingles", "component_id")
    want = brute_components([(i, t) for i, t in texts.items() if i is not None], 3, 90)
    assert [r for r in found if r[0] is None] == [(None, 2, None)] and {r[0]: r[1:] for r in found if r[0] is not None} == want and len(found) == len(rows)
    scores = masked_lm.pseudo_likelihood(odd).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in scores), key=repr) == each(lambda t: (len(words_of(t)),))
    assert all((r.log_likelihood == 0 and r.mean_log_probability is None) if r.n_tokens == 0 else r.log_likelihood < 0 for r in scores)
    assert len({r.log_likelihood for r in scores if r.doc_id in (5, 6)}) == 1


def test_pipeline_on_odd_and_empty_tables(spark, odd, none, tmp_path):
    import corpus_pipeline as pipeline

    labels = spark.createDataFrame([(k, 1, 0) for k in (3, 5, 7, 8)] + [(2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    odd.write.parquet(f"{tmp_path}/odd/documents.parquet")
    labels.write.parquet(f"{tmp_path}/odd/labels.parquet")
    got = pipeline.run(spark, f"file://{tmp_path}/odd").collect()
    own, texts = pieces.piece_model(), dict(texts_of(odd))
    assert {r.doc_id for r in got} <= set(texts) and got
    copies = collections.Counter(r.doc_id for r in got)
    assert 6 not in copies  # a copy of 5
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == own.digest(texts[r.doc_id] or "")
    none.write.parquet(f"{tmp_path}/none/documents.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/none/labels.parquet")
    assert pipeline.run(spark, f"file://{tmp_path}/none").count() == 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, FOLDER).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


# 1 ------------------------------------------------------------------------------------------------


def test_mix_targets_by_hand(spark):
    rows = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 100), (None, 50), (None, 0)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    sizes, weights = {"a": 1000, "b": 10, "c": 100, None: 50}, {"a": 1, "b": 2, "c": 3, None: 1}
    target, free = {}, set(sizes)
    while True:  # share, cap, share the excess
        left = 1160 - sum(target.values())
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            break
        target |= {s: 3 * sizes[s] for s in over}
        free -= over
    assert got == pytest.approx(target | share)


def test_mix_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix_sources(docs).toPandas()
    again = mixing.mix_sources(docs.repartition(7)).toPandas()
    assert got.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))
    assert (got.taken <= 3 * got["size"]).all() and len(got) == 1000
    by = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), copies=("copies", "sum"), n=("size", "count"), size=("size", "sum"), most=("size", "max"))
    off = abs(by.taken - by.target)
    assert (off <= 0.25 * by.most).all() and (off / by.target).mean() < 0.01  # short documents are the last ones left
    assert (abs(by.copies - by.target / by["size"] * by.n) <= 3).all()
    assert abs(by.taken.sum() / got["size"].sum() - 1) < 0.05


def test_mix_of_repeated_and_null_ids(spark):
    """Equal rows are decided one by one in mix_sources, by summed sizes in mix_documents."""
    rows = [(None, "one two three", "a")] * 90 + [(5, "one two", "a")] * 90 + [(k, "w " * (k % 7), "b") for k in range(10, 100)] + [(None, "other", "b"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got, again = (sorted(map(str, mixing.mix_sources(d, block=16).collect())) for d in (docs, docs.repartition(5)))
    assert got == again and len(got) == len(rows)
    by = mixing.mix_sources(docs, block=16).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most")).where("source is not null")
    assert all(abs(r.taken - r.target) <= r.most for r in by.collect())
    copies = collections.Counter((r.doc_id, r.text, r.source) for r in mixing.mix_documents(docs).collect())
    assert all(n % 90 == 0 for (i, t, _), n in copies.items() if i == 5 or t == "one two three")


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(3)
    size, p = rng.integers(1, 500, 400).astype(float), rng.random(400)
    a = np.stack([size, np.ones(400)])
    moved, left = mixing.flight(p, a, rng)
    assert len(left) <= 2 and np.allclose(a @ moved, a @ p) and set(np.flatnonzero((moved > 0) & (moved < 1))) <= set(left)
    means = np.mean([mixing.flight(p[:12], a[:, :12], np.random.default_rng(k))[0] for k in range(3000)], 0)
    assert np.allclose(means, p[:12], atol=0.05)


# 2 ------------------------------------------------------------------------------------------------


def brute_components(rows, k, percent):
    sets, least = {}, {}
    for i, text in rows:
        w = words_of(text)
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        least[i] = i
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in range(len(rows)):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    return {i: (len(sets[i]), least[i]) for i in sets}


@pytest.mark.parametrize(("k", "percent", "tile"), [(3, 90, 16), (5, 80, 4096)])
def test_joined_components(spark, k, percent, tile, monkeypatch):
    rng = random.Random(5)
    vocabulary = [f"w{n}" for n in range(300)]
    base = [rng.choices(vocabulary, k=n) for n in (4, 12, 60, 130, 300)]
    rows = [(900 + n, t) for n, t in enumerate(["", None, "one", "ONE", "one two", "one  two"])]
    for n in range(240):  # chains of copies with a few words changed
        own = list(base[n % 5])
        for _ in range(rng.randint(0, 1 + len(own) // 40)):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        rows.append((n, " ".join(own)))
    monkeypatch.setattr(jaccard_join, "LEAF", 8)
    monkeypatch.setattr(jaccard_join, "TILE_DOCS", tile)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_components(docs, k, percent).collect()}
    assert got == brute_components(rows, k, percent)


def test_hot_group_is_linked_by_its_centre(spark, monkeypatch):
    """Near copies of one text in a large tree: linked to a centre, so no texts are left to compare but the leftovers'."""
    monkeypatch.setattr(jaccard_join, "LEAF", 8)
    monkeypatch.setattr(jaccard_join, "TILE_DOCS", 16)
    rng = random.Random(8)
    base = [f"w{n}" for n in range(200)]
    rows = [(n, " ".join([*base[:k], f"x{n}", *base[k + 1 :]])) for n in range(100) for k in [rng.randrange(200)]]
    rows += [(100 + n, " ".join([*base[:150], *(f"y{n}_{k}" for k in range(50))])) for n in range(20)]  # too far from all
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    shipped = []
    plain = jaccard_join.linked
    monkeypatch.setattr(jaccard_join, "linked", lambda docs, reps, found, labels, *rest: shipped.append((found.count(), labels.count())) or plain(docs, reps, found, labels, *rest))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_components(docs, 3, 90).collect()}
    assert got == brute_components(rows, 3, 90)
    assert shipped[0][1] >= 95 and shipped[0][0] <= 40


def test_many_leftovers(spark, monkeypatch):
    """Several families share all their frequent shingles; parts of cores and of others meet as they must."""
    monkeypatch.setattr(jaccard_join, "LEAF", 4)
    monkeypatch.setattr(jaccard_join, "TILE_DOCS", 6)
    rng = random.Random(12)
    common = [f"c{n}" for n in range(60)]
    rows = []
    for n in range(150):
        own = [f"f{n % 5}_{k}" for k in range(12)] + common
        for _ in range(rng.randint(0, 2)):
            own[rng.randrange(len(own))] = f"e{rng.randrange(40)}"
        rows.append((n, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_components(docs, 3, 85).collect()}
    assert got == brute_components(rows, 3, 85)


def test_ids_with_several_texts(spark):
    """Rows that share an id are one document: nothing that one of its texts links with is lost."""
    text = lambda name, *changed: " ".join(f"{name}{n}" if n not in changed else f"other{n}" for n in range(60))
    rows = [(5, text("a")), (5, text("b")), (6, text("a", 59)), (7, text("b", 59)), (8, text("c")), (8, text("d")), (9, text("d")), (3, text("d", 0)), (-4, text("e")), (-4, text("e")), (-9, text("f")), (-9, None), (None, text("a"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.class_id) for r in jaccard_join.similar_components(docs, 3, 90).collect()), key=repr)
    assert got == sorted([(5, 58, 5, 5), (5, 58, 5, 5), (6, 58, 5, 6), (7, 58, 5, 7), (8, 58, 3, 8), (8, 58, 3, 8), (9, 58, 3, 8), (3, 58, 3, 3), (-4, 58, -4, -4), (-4, 58, -4, -4), (-9, 58, -9, -9), (-9, 0, -9, -9), (None, 58, None, 5)], key=repr)
    kept = jaccard_join.one_of_each(docs, 3, 90)
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(["5", "5", "3", "-4", "-4", "-9", "-9", "None"])


def test_join_on_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op2_count_tree_join"](spark, FOLDER).collect()}
    assert got == brute_components(texts_of(docs), 3, 90)


def test_tree_search_is_complete():
    rng = np.random.default_rng(2)
    points = rng.poisson(6, (500, 32))
    points[250:] = points[:250] + (rng.random((250, 32)) < 0.05)
    order = np.argsort(points.sum(1), kind="stable")
    points = points[order]
    totals = points.sum(1)
    tree = jaccard_join.CountTree(points, totals)
    for i in range(0, 500, 7):
        bound = np.minimum(points, points[i]).sum(1)
        assert set(tree.search(points[i], int(totals[i]), 90)) == set(np.flatnonzero(190 * bound >= 90 * (totals + totals[i])))


def test_vectors_of_other_lengths_meet():
    rng = np.random.default_rng(4)
    sets = sorted((np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (480, 505, 511, 512, 514, 530, 4080, 4100)), key=len)
    sets += [np.unique(np.append(s[3:], s[0] + np.uint64(1))) for s in sets]
    sets = sorted(sets, key=len)
    n = np.array([len(s) for s in sets])
    found = {(i, int(j)) for i, js in jaccard_join.near_places([jaccard_join.count_vector(s) for s in sets], n, 90) for j in js}
    true = {(i, j) for j in range(len(sets)) for i in range(j) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 90 * len(np.union1d(sets[i], sets[j]))}
    assert len(true) == 8 and true <= found and len(found) < 12


# 3 ------------------------------------------------------------------------------------------------


def test_matroska_round_trip():
    rng = random.Random(1)
    for n in [64, 400, 448, 3200, 3264, 51_200, 51_264, 200_000, *(64 * rng.randint(1, 3000) for _ in range(40))]:
        payload = rng.randbytes(n)
        media = matroska.write_matroska(payload)
        tracks, packets = matroska.read_matroska(media)
        assert b"".join(media[p.offset : p.offset + p.size] for p in packets) == payload
        assert tracks[1]["bits"] == 8 and all(p.cued for p in packets)
        assert [p.timestamp_ms for p in packets] == sorted(p.timestamp_ms for p in packets)
        assert all(p.timestamp_ms == (k // matroska.LACED * matroska.LACED * matroska.FRAME) * 1000 // matroska.RATE for k, p in enumerate(packets))


@pytest.mark.parametrize("kind", [matroska.XIPH, matroska.EBML_LACING])
def test_laces(kind):
    for sizes in ([0, 255, 256, 510, 7], [1000, 1, 900, 16_000, 20, 20], [5, 5]):
        data = matroska._laces(sizes, kind) + bytes(sum(sizes))
        assert [n for _, n in matroska.read_laces(data, 0, len(data), kind)] == sizes


def _frames(data, at, end):
    """Packets by a plain recursive walk over written files of known sizes."""
    out = []
    while at < end:
        width = 9 - data[at].bit_length()
        ident = data[at : at + width]
        more = 9 - data[at + width].bit_length()
        size = int.from_bytes(data[at + width : at + width + more], "big") - (1 << 7 * more)
        at += width + more
        if ident in (b"\x18\x53\x80\x67", b"\x1f\x43\xb6\x75"):
            out += _frames(data, at, at + size)
        elif ident == b"\xa3":
            out.append(data[at : at + size])
        at += size
    return out


@pytest.mark.parametrize("open_segment", [False, True])
def test_clusters_of_unknown_size(open_segment):
    """Live files leave the sizes of clusters, and of the segment, open; all bytes are read."""
    payload = random.Random(3).randbytes(102_400)
    media = bytearray(matroska.write_matroska(payload))
    for name in (b"\x1f\x43\xb6\x75", *([b"\x18\x53\x80\x67"] if open_segment else [])):
        at = media.find(name)
        while at >= 0:
            width = 9 - media[at + 4].bit_length()
            media[at + 4 : at + 4 + width] = ((1 << 7 * width) - 1 | 1 << 7 * width).to_bytes(width, "big")
            at = media.find(name, at + 4)
    tracks, packets = matroska.read_matroska(bytes(media))
    assert b"".join(media[p.offset : p.offset + p.size] for p in packets) == payload
    assert len({p.cluster_offset for p in packets}) == 2 and all(p.cued for p in packets) and tracks[1]["bits"] == 8


def test_no_bytes_are_lost_in_silence():
    with pytest.raises(ValueError, match="equal laces"):
        matroska.read_laces(b"\1" + bytes(11), 0, 12, matroska.FIXED)
    block = matroska._element(matroska.BLOCK_GROUP, b"").replace(b"\x80", b"\xff")
    with pytest.raises(ValueError, match="no size"):
        list(matroska.elements(block, 0, len(block)))


def with_encodings(media, *encodings):
    """A written file whose track declares encodings (order, scope, type, algorithm, settings), sizes put right."""
    el, uint = matroska._element, matroska._uint
    own = b"".join(el(matroska.ENCODING, uint(matroska.ENCODING_ORDER, o) + uint(matroska.ENCODING_SCOPE, s) + uint(matroska.ENCODING_TYPE, t) + el(matroska.COMPRESSION, uint(matroska.COMPRESSION_ALGORITHM, a) + el(matroska.COMPRESSION_SETTINGS, h))) for o, s, t, a, h in encodings)
    out = b""
    for ident, at, first, stop in matroska.elements(media, 0, len(media)):
        if ident != matroska.SEGMENT:
            out += media[at:stop]
            continue
        body = b""
        for child, a, b, c in matroska.elements(media, first, stop):
            if child == matroska.TRACKS:
                _, _, d, e = next(iter(matroska.elements(media, b, c)))
                body += el(matroska.TRACKS, el(matroska.TRACK_ENTRY, media[d:e] + el(matroska.ENCODINGS, own)))
            elif child != matroska.CUES:  # their positions would be others now
                body += media[a:c]
        out += el(matroska.SEGMENT, body)
    return out


def test_encoded_tracks():
    """Stripped headers come back to every frame, laced or not; other encodings of frames are errors."""
    payload = random.Random(6).randbytes(12_800)
    media = matroska.write_matroska(payload)
    plain = [media[p.offset : p.offset + p.size] for p in matroska.read_matroska(media)[1]]
    strips = (0, 1, 0, matroska.HEADER_STRIPPING, b"\xab\xcd")
    coded = with_encodings(media, strips)
    assert [p.bytes_of(coded) for p in matroska.read_matroska(coded)[1]] == [b"\xab\xcd" + f for f in plain]
    twice = with_encodings(media, (1, 1, 0, matroska.HEADER_STRIPPING, b"z"), strips, (2, 2, 0, 0, b"of the codec's own data"))
    assert [p.bytes_of(twice) for p in matroska.read_matroska(twice)[1]] == [b"\xab\xcdz" + f for f in plain]
    for other in ((0, 1, 0, 0, b""), (0, 1, 1, matroska.HEADER_STRIPPING, b"x"), (0, 3, 0, 2, b"")):
        with pytest.raises(ValueError, match="encrypted or compressed"):
            matroska.read_matroska(with_encodings(media, other))


def test_digest_of_an_encoded_track(spark):
    media = matroska.write_matroska(bytes(640))
    files = {1: with_encodings(media, (0, 1, 0, matroska.HEADER_STRIPPING, b"ab")), 2: with_encodings(media, (0, 1, 0, 0, b""))}
    df = spark.createDataFrame([(k, 640, bytearray(m)) for k, m in files.items()], "doc_id long, n_bytes long, media binary")
    got = {r.doc_id: r for r in matroska.media_digest(df).collect()}
    frames = [bytes(400), bytes(240)]
    assert got[1].payload_sha256 == hashlib.sha256(b"".join(b"ab" + f for f in frames)).hexdigest() and got[1].error is None
    assert got[2].payload_sha256 is None and "compressed" in got[2].error
    assert {(r.doc_id, r.header, r.crc32) for r in matroska.packet_table(df).collect()} == {(1, b"ab", zlib.crc32(b"ab" + f)) for f in frames}


def test_packet_table_row_by_row(spark):
    files = {k: matroska.write_matroska(random.Random(k).randbytes(n)) for k, n in enumerate((64, 3264, 51_264, 60_032))}
    got = matroska.packet_table(spark.createDataFrame([(k, bytearray(m)) for k, m in files.items()] + [(9, None)], "doc_id long, media binary")).collect()
    for k, media in files.items():
        own = sorted((r for r in got if r.doc_id == k), key=lambda r: r.packet)
        blocks = _frames(media, 0, len(media))
        assert [r.packet for r in own] == list(range(len(own))) and sum(r.lace == 0 for r in own) == len(blocks)
        for r in own:
            assert r.crc32 == zlib.crc32(media[r.offset : r.offset + r.size]) and r.track == 1 and r.cued
            assert media[r.cluster_offset : r.cluster_offset + 4] == b"\x1f\x43\xb6\x75" and r.timestamp_ms == r.packet // matroska.LACED * matroska.LACED * matroska.FRAME * 1000 // matroska.RATE
        assert b"".join(media[r.offset : r.offset + r.size] for r in own) == random.Random(k).randbytes((64, 3264, 51_264, 60_032)[k])
    assert {r.doc_id for r in got} == set(files)


def test_damaged_media(spark):
    media = matroska.write_matroska(bytes(range(64)) * 20)
    files = spark.createDataFrame([(1, 5, bytearray(media)), (2, 5, bytearray(media[:-3])), (3, 5, bytearray(b"\x00\x01")), (4, 5, None), (5, 5, bytearray(b""))], "doc_id long, n_bytes long, media binary")
    got = {r.doc_id: r for r in matroska.media_digest(files).collect()}
    assert got[1].error is None and got[2].error and got[3].error and 4 not in got
    assert matroska.packet_table(files).where("doc_id = 1").count() == got[1].n_packets


def test_media_of_documents(spark):
    docs = dict(texts_of(spark.read.parquet(f"{FOLDER}/documents.parquet")))
    for r in QUERIES["op3_matroska"](spark, FOLDER).collect():
        payload = docs[r.doc_id].encode()
        padded = payload + bytes(-len(payload) % 64 or (64 if not payload else 0))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(payload), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))


def test_most_frequent_cuts_a_step(spark):
    """Of a step with too many rows a hash takes its share: no jump to nothing."""
    rows = [(k, 7) for k in range(1000)] + [(5000 + k, 900 - k) for k in range(20)]
    counts = spark.createDataFrame(rows, "word long, n long")
    got = {r.word for r in most_frequent(counts, "n", 120).collect()}
    assert set(range(5000, 5020)) <= got and 80 < len(got) - 20 < 120
    assert got == {r.word for r in most_frequent(counts.repartition(5), "n", 120).collect()}
    assert most_frequent(counts, "n", 5000).count() == 1020 and most_frequent(counts.limit(0), "n", 10).count() == 0
    assert 20 < most_frequent(counts.where("n = 7"), "n", 50).count() < 80


# 4 ------------------------------------------------------------------------------------------------


def small_model(words=60, seed=1):
    rng = np.random.default_rng(seed)
    counts = np.zeros(masked_lm._IDS)
    counts[:words] = np.sort(rng.integers(1, 1000, words))[::-1]
    vocabulary = masked_lm.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(masked_lm.SPARE, np.int64), counts, masked_lm.huffman(counts))
    net = masked_lm.start(vocabulary)
    net[3] = rng.normal(0, 0.5, net[3].shape).astype(np.float32)
    return vocabulary, net


def test_untrained_network_is_the_unigram_model():
    vocabulary, _ = small_model(3000)
    net = masked_lm.start(vocabulary)
    tokens = np.arange(3000)
    got = masked_lm.log_probabilities(net, vocabulary.tree, tokens, np.array([0, 3000]))
    assert got == pytest.approx(np.log(vocabulary.counts[:3000] / vocabulary.counts.sum()), abs=1e-3)


def test_chances_of_all_words_add_up():
    """In one context the ids' chances sum to 1, whatever the weights."""
    vocabulary, net = small_model(700)
    tokens = np.stack([np.full(700, 5), np.full(700, 9), np.arange(700), np.full(700, 2), np.full(700, 3)], 1).ravel()
    logs = masked_lm.log_probabilities(net, vocabulary.tree, tokens, np.arange(0, 3501, 5))
    assert np.exp(logs[2::5]).sum() == pytest.approx(1, abs=1e-3)


@pytest.mark.parametrize("words", [60, 900])
def test_pseudo_likelihood_by_hand(words):
    """Windows, hidden layer and the way through the tree, walked one by one."""
    vocabulary, net = small_model(words)
    tree = vocabulary.tree
    tokens, offsets = np.random.default_rng(2).integers(0, words, 12), np.array([0, 5, 5, 6, 12])
    got = masked_lm.log_probabilities(net, tree, tokens, offsets)
    for a, b in zip(offsets, offsets[1:], strict=False):
        for i in range(a, b):
            around = [tokens[j] if a <= j < b else masked_lm._IDS for j in (i - 2, i - 1, i + 1, i + 2)]
            h = np.tanh(np.concatenate([net[0][t] for t in around]) @ net[1] + net[2])
            k = tokens[i]
            way = [(n, side) for n, side in enumerate(tree.top[k]) if side] + [(n, side) for n, side in zip(tree.nodes[tree.begin[k] :][: tree.length[k]], tree.sides[tree.begin[k] :][: tree.length[k]], strict=True)]
            want = sum(-np.log1p(np.exp(-side * (h @ net[3][n] + net[4][n]))) for n, side in way)
            assert got[i] == pytest.approx(want, abs=1e-4)


def test_gradient_of_a_step():
    rng = np.random.default_rng(2)
    vocabulary, net = small_model(400)
    net = [p.astype(np.float64) for p in net]
    tokens = rng.integers(0, 400, 60)
    offsets = np.array([0, 60])
    context = masked_lm.windows(tokens, offsets)
    loss = lambda n: -masked_lm.log_probabilities(n, vocabulary.tree, tokens, offsets).mean()
    before = [p.copy() for p in net]
    masked_lm.train_step(net, [np.full_like(p, 1e12) for p in net], vocabulary.tree, context, tokens, 1e6)  # a plain step of size 1
    for k in range(5):
        at = np.unravel_index(np.abs(net[k] - before[k]).argmax(), net[k].shape)
        moved = [p.copy() for p in before]
        moved[k][at] += 1e-4
        assert (net[k] - before[k])[at] == pytest.approx(-(loss(moved) - loss(before)) / 1e-4, rel=0.05)


def test_a_step_holds_a_level_of_the_ways_at_once():
    """Weights and hidden values are gathered for a level of the tree, not for all nodes of all ways."""
    rng = np.random.default_rng(3)
    vocabulary, net = small_model(20_000)
    tokens = rng.integers(0, 20_000, 8192)
    context = masked_lm.windows(tokens, np.array([0, 8192]))
    squares = [np.full_like(p, 1e-5) for p in net]
    nodes = int(vocabulary.tree.length[tokens].sum())
    tracemalloc.start()
    masked_lm.train_step(net, squares, vocabulary.tree, context, tokens)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * 4 * masked_lm.HIDDEN * nodes, (peak, nodes)


def test_every_position_is_a_target():
    """Each token of a shard is learned from once, in steps that leave none out."""
    vocabulary, net = small_model(50)
    seen = []
    shard = masked_lm._Shard(0, net, vocabulary.tree, 1)
    plain = masked_lm.train_step
    masked_lm.train_step = lambda n, q, t, context, ids: seen.append(ids)
    try:
        texts = [np.arange(7), np.arange(50), np.array([3]), np.repeat(4, 3000)]
        for t in texts:
            shard.add(t, np.array([0, len(t)]))
        moved = shard.moved()
    finally:
        masked_lm.train_step = plain
    assert sorted(np.concatenate(seen).tolist()) == sorted(np.concatenate(texts).tolist()) and moved[-1] == sum(map(len, texts))


def test_averages_are_of_the_shards_that_saw():
    vocabulary, net = small_model(50)
    sums = np.zeros(sum(p.size for p in net) + 2 * masked_lm._IDS + 2)
    sums[: masked_lm.WIDTH] = 30.0  # the first id's embedding, moved in one shard of 10 tokens
    sums[net[0].size] = 30.0  # a hidden weight, moved in all
    sums[-2 * masked_lm._IDS - 2] = 10
    sums[-1] = 40
    got = masked_lm.averaged(net, sums)
    assert got[0][0] == pytest.approx(net[0][0] + 3) and got[1].ravel()[0] == pytest.approx(net[1].ravel()[0] + 0.75)
    assert all(np.array_equal(a.ravel()[masked_lm.WIDTH :], b.ravel()[masked_lm.WIDTH :]) for a, b in [(got[0], net[0])])


def test_sums_in_a_tree(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(7, 10)).astype(np.float32)
    rows = [(s, k, bytearray(data[s, 4 * k : 4 * k + 4].tobytes())) for s in range(7) for k in range(3)]
    parts = spark.createDataFrame(rows, "shard int, chunk int, data binary").repartition(5)
    assert masked_lm.tree_sum(parts, 7, "t", Scratch(spark), fan=2) == pytest.approx(data.astype(float).sum(0))
    assert masked_lm.tree_sum(parts.where("shard = 3"), 1, "one", Scratch(spark)) == pytest.approx(data[3])


def test_rare_words_have_their_own_chance(spark):
    """Beyond the vocabulary each word counts by itself: by the untrained network, scores are those of the corpus' counts."""
    rng = random.Random(7)
    n = masked_lm.VOCABULARY + 3000
    words = [f"w{k}" for k in range(n)]
    rows = [(0, " ".join(words)), (1, " ".join(words[:n - 1500])), (2, " ".join(rng.choices(words[-3000:], k=500))), (3, ""), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    scratch = Scratch(spark)
    counted = scratch.save(masked_lm.word_counts(docs), "w")
    vocabulary = masked_lm.build_vocabulary(counted)
    tokens = scratch.save(masked_lm.tokenized(docs, vocabulary), "t")
    got = {r.doc_id: r for r in masked_lm.score(tokens, masked_lm.Model(vocabulary, masked_lm.start(vocabulary), counted)).collect()}
    counts = collections.Counter(w for _, t in rows for w in (t or "").split())
    total = vocabulary.counts.sum()
    assert abs(total - sum(counts.values())) <= 0.5 * masked_lm.SPARE
    for i, text in rows:
        own = (text or "").split()
        assert got[i].n_tokens == len(own) and got[i].log_likelihood == pytest.approx(sum(np.log(counts[w] / total) for w in own), rel=1e-4)
    assert got[3].mean_log_probability is None and got[4].log_likelihood == 0


def test_order_of_words_is_worse_shuffled(spark):
    rng = random.Random(3)
    text = lambda: " ".join(" ".join(rng.choice(["the cat sat on a mat", "we read the red book", "rain falls in spring now"]) for _ in range(30)).split())
    scratch = Scratch(spark)
    model, _ = masked_lm.fit(spark.createDataFrame([(k, text()) for k in range(1500)], "doc_id long, text string"), scratch=scratch)
    own = [(k, text()) for k in range(50)]
    own += [(100 + k, " ".join(rng.sample(t.split(), len(t.split())))) for k, t in own]
    tokens = scratch.save(masked_lm.tokenized(spark.createDataFrame(own, "doc_id long, text string"), model.vocabulary), "other")
    mean = {r.shuffled: r.m for r in masked_lm.score(tokens, model).groupBy((F.col("doc_id") >= 100).alias("shuffled")).agg(F.avg("mean_log_probability").alias("m")).collect()}
    assert mean[False] > mean[True] + 0.5


def test_held_out_documents_and_other_partitions(spark):
    """Better than the unigram model by 0.15 nats a token on documents it has not seen; the same scores however the rows are dealt."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    held = F.pmod(F.xxhash64("text"), F.lit(5)) == 0
    scratch = Scratch(spark)
    model, _ = masked_lm.fit(docs.where(~held), scratch=scratch)
    tokens = scratch.save(masked_lm.tokenized(docs.where(held), model.vocabulary), "held")
    mean = lambda m: masked_lm.score(tokens, m).agg(F.sum("log_likelihood") / F.sum("n_tokens")).first()[0]
    assert mean(model) > mean(model._replace(net=masked_lm.start(model.vocabulary))) + 0.15
    first = {r.doc_id: r.log_likelihood for r in masked_lm.pseudo_likelihood(docs.repartition(2)).collect()}
    again = {r.doc_id: r.log_likelihood for r in masked_lm.pseudo_likelihood(docs.repartition(7)).collect()}
    assert first == pytest.approx(again, rel=1e-5, abs=0.01)


# 5 ------------------------------------------------------------------------------------------------


def brute_lines(rows, least_chars=40, least_docs=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    found = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                found[key(line)].add(i)
    out = {}
    for i, text in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if not (len(found.get(key(x), ())) >= least_docs and max(found[key(x)]) != i)]
        out[i] = (len(own), len(own) - len(kept), "\n".join(kept))
    return out


def test_lines_by_hand(spark):
    rng = random.Random(4)
    pool = [f"  A common Line number {n} with É and enough characters in it\t" for n in range(12)] + ["short", "", "x" * 39, "Y" * 40]
    rows = [(k, "\n".join(rng.choices(pool, k=rng.randint(0, 9)))) for k in range(60)] + [(60, None), (61, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for batches in (1, 5):
        got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in lines.dedup_lines(docs, batches=batches).collect()}
        assert got == brute_lines(rows)


def test_lines_count_documents_not_rows(spark):
    """Ids on several rows and rows without an id don't make a line common."""
    repeated, unnamed, common = (f"a line that {x} holds, of more than forty characters" for x in ("a repeated id", "a row without an id", "each document"))
    rows = [(1, repeated)] * 4 + [(2, repeated)] + [(3, unnamed)] + [(None, unnamed)] * 5 + [(k, common) for k in (4, 4, 5, 6, 7, 8)]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.kept_text) for r in got) == sorted((i or 0, "" if i in (4, 5, 6, 7) else t) for i, t in rows)


def test_runs_are_levelled(spark):
    """Batches from the largest ids down; hash 0 is in all of them and settled after the second."""
    index = lines.LineRuns(Scratch(spark), enough=2)
    batches = [spark.createDataFrame([(100 - 10 * b - k, k, k) for k in (0, b + 1, b + 2)], "doc_id long, h1 long, h2 long") for b in range(5)]
    for n, batch in enumerate(batches):
        assert {r.h1 for r in index.unsettled(batch.select("h1", "h2")).collect()} == ({0, n + 1, n + 2} if n < 2 else {n + 1, n + 2})
        index.add(batch)
    assert {level: len(runs) for level, runs in index.levels.items() if runs} == {0: 1, 2: 1}
    assert {(r.h1, r.newest) for r in index.common().collect()} == {(0, 100)} | {(k, 100 - 10 * (k - 2) - k) for k in range(2, 6)}


def test_runs_are_merged_in_place(spark):
    """Neither merges nor anti-joins shuffle or sort the runs."""
    index = lines.LineRuns(Scratch(spark))
    for b in range(3):
        index.add(spark.range(50).selectExpr(f"{100 * (9 - b)} + id AS doc_id", "xxhash64(id) AS h1", "xxhash64(1, id) AS h2"))
    with lines._sorted_scans(spark):
        merged = lines.merged(*index._runs())._jdf.queryExecution().executedPlan().toString()
        fresh = index.unsettled(index._runs()[0])._jdf.queryExecution().executedPlan().toString()
    for plan, kind in ((merged, "FullOuter"), (fresh, "LeftAnti")):
        assert "Exchange" not in plan and "Sort " not in plan and "SortMergeJoin" in plan and kind in plan


def _shuffled(spark):
    """Bytes written to shuffles so far."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))


def test_join_shuffles_texts_of_candidates_alone(spark):
    """Texts without candidates are neither shuffled to be verified nor to be kept, at any size of table; names that the bitmap uses may be columns."""
    rng = random.Random(3)
    text = lambda: [rng.randbytes(20).hex() for _ in range(80)]
    rows = [(k, " ".join(text())) for k in range(1200)]
    rows += [(2000 + k, rows[k][1] + " more") for k in range(20)] + [(3000 + k, rows[k][1]) for k in range(20)] + [(None, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("p", "word", "marks", "doc_id_")})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        begun = _shuffled(spark)
        kept = jaccard_join.one_of_each(docs).collect()
        written = _shuffled(spark) - begun
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted((r.doc_id, r.text, r.marks) for r in kept if r.doc_id is not None) == [(k, t, "marks") for k, t in rows[:1200]]
    assert [r.text for r in kept if r.doc_id is None] == [rows[0][1]]
    assert written < 0.6 * sum(len(t) for _, t in rows)


def test_only_marked_documents_are_shuffled(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(500)] + [(None, "x")] * 3, "doc_id long, text string")
    some, untouched = lines.split_by_marks(docs, lines.marks_of(spark.createDataFrame([(7,), (499,)], "doc_id long")))
    assert sorted(r.doc_id for r in some.collect()) == [7, 499] and untouched.count() == 501


def test_lines_with_repeated_and_null_ids(spark):
    """Brute force over ids that repeat and are missing; a null or repeated id is no further document."""
    rng = random.Random(9)
    pool = [f"line number {n} of a pool, long enough to be counted" for n in range(8)]
    rows = [(rng.choice([None, *range(9)]), "\n".join(rng.choices(pool, k=rng.randint(0, 4)))) for _ in range(60)]
    rows += [(6, pool[0])] * 4 + [(5, pool[0])]
    holders = collections.defaultdict(set)
    for i, text in rows:
        for x in text.split("\n"):
            if len(x) >= 40 and i is not None:
                holders[x].add(i)
    gone = lambda i, x: i is not None and len(holders[x]) >= 5 and max(holders[x]) != i
    want = [(i, sum(gone(i, x) for x in t.split("\n")), "\n".join(x for x in t.split("\n") if not gone(i, x))) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for batches in (3,):
        got = [(r.doc_id, r.n_dropped, r.kept_text) for r in lines.dedup_lines(docs, batches=batches).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


# 6 ------------------------------------------------------------------------------------------------


def test_pairs_are_learned():
    """Toxic only if both terms are there: additive weights can't tell, the machine can."""
    rng = np.random.default_rng(1)
    x = rng.random((2000, 2)) < 0.5
    label = (x[:, 0] == x[:, 1]).astype(float)
    owner, term = np.nonzero(x)
    m = toxicity.fit_machine(np.arange(2, dtype=np.uint64), term, owner, label, epochs=600)
    score = toxicity._sigmoid(toxicity._raw(m, term, owner, 2000))
    assert ((score > 0.5) == (label == 1)).mean() > 0.95


def test_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(5)
    m = toxicity.Machine(np.arange(12, dtype=np.uint64), 0.3, rng.normal(size=12), rng.normal(size=(12, 4)))
    x = rng.random((20, 12)) < 0.4
    owner, term = np.nonzero(x)
    want = [m.w0 + m.w[t].sum() + sum(m.v[a] @ m.v[b] for n, a in enumerate(t) for b in t[:n]) for t in map(np.flatnonzero, x)]
    assert toxicity._raw(m, term, owner, 20) == pytest.approx(want)


def test_scores_from_texts(spark, odd):
    """Each row's score is that of its distinct terms; a null id is not held out."""
    texts = ["ab abc abcd", "zz Zz zz", "", None, "abcd abcd zz 😀 zz" + " x" * 50_000, "éa"]
    at, owner = toxicity.distinct_terms(*(np.frombuffer("abcd zz".encode(), np.uint8), np.array([0, 7])))
    terms = np.unique(at)
    rng = np.random.default_rng(6)
    m = toxicity.Machine(terms, -0.2, rng.normal(size=len(terms)), rng.normal(size=(len(terms), 2)))
    place = {int(t): k for k, t in enumerate(terms)}
    own = lambda word: toxicity.distinct_terms(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word)]))[0]
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), m).collect()}
    for k, text in enumerate(texts):
        hit = sorted({place[int(h)] for w in re.findall("[a-z]+", (text or "").lower()) for h in own(w) if int(h) in place})
        raw = m.w0 + sum(m.w[t] for t in hit) + sum(m.v[a] @ m.v[b] for n, a in enumerate(hit) for b in hit[:n])
        assert got[k] == pytest.approx(1 / (1 + np.exp(-raw)))
    assert not odd.select(toxicity.held_out(F.col("doc_id")).alias("h")).where("h is null").count()


def test_a_hot_id_keeps_the_bound(spark):
    """An id with many texts does not bring them all to the fit; equal rows count once."""
    rows = [(7, f"text {n} of one id") for n in range(600)] + [(7, "always the same")] * 300 + [(n, f"text of {n}") for n in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in (7, *range(100, 160))], "doc_id long, quality int, toxic int")
    got = [r.text for r in toxicity.labelled(docs, labels, F.lit(True), 100).collect()]
    assert 60 < len(got) < 150 and len(set(got)) == len(got)
    assert len(toxicity.labelled(docs, labels, F.lit(True), 5000).collect()) == 661
    one, two = (toxicity.train(d, labels, F.lit(True), 100) for d in (docs, docs.repartition(5)))
    assert (one.terms == two.terms).all() and (one.w == two.w).all()


def test_every_term_beyond_chance_is_an_input(spark):
    """However many there are: none is dropped from the scores."""
    word = lambda n: "".join(chr(97 + int(d)) for d in str(10_000 + n)) + "q"
    rows = [(n, " ".join(word(k) for k in range(200))) for n in range(40)] + [(100 + n, "quiet talk") for n in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i < 100)) for i, _ in rows], "doc_id long, quality int, toxic int")
    machine = toxicity.train(docs, labels, F.lit(True))
    single = spark.createDataFrame([(k, word(k)) for k in range(200)] + [(999, "quiet")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(single, machine).collect()}
    assert len(machine.terms) >= 200 and all(scores[k] > scores[999] for k in range(200))


def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op6_toxicity_fm"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id)
    caught = got[got.toxic == 1].predicted.mean()
    wrong = got[got.toxic == 0].predicted.mean()
    assert caught > 0.85 and wrong < 0.02


# 7 ------------------------------------------------------------------------------------------------


def test_pieces_as_the_library():
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    own = pieces.piece_model()
    rng = random.Random(1)
    texts = ["", " ", "  ", "a  b", " a", "a ", "\n\n \n", "<s>hi</s>", "<0x41>", "▁x▁▁", "Ａ한😀\x00", " " * 100, "a" * 300, "😀" * 20] + ["".join(rng.choices(" ▁abcdethn0123.,\n\t😀Ａéß한", k=rng.randint(0, 40))) for _ in range(3000)]
    texts += [t for _, t in _documents()]
    for text in texts:
        ids = library.encode(text)
        assert own.encode(text) == ids and own.decode(ids) == library.decode(ids)
        assert own.digest(text) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())


def _documents():
    import pyarrow.parquet as pq

    t = pq.read_table(f"{FOLDER}/documents.parquet").select(["doc_id", "text"]).to_pydict()
    return list(zip(t["doc_id"], t["text"], strict=True))


def test_backtracking_in_a_small_model():
    p = pieces.Piece
    model = pieces.PieceModel([p("<unk>", 0, 2), *(p(c, -10 - n, 1) for n, c in enumerate("abc▁")), p("ab", -1, 1), p("bc", -2, 1), p("abc", -3, 1), p("cb", -4, 1)])
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choices("abc", k=rng.randint(1, 14)))
        assert [model.pieces[k].text for k in model.encode_unit(text)] == model.merge(text)


def test_remembered_units_are_ids_alone_and_forgotten():
    p = pieces.Piece
    chars = [p(c, -10 - n, 1) for n, c in enumerate("abc▁")]
    own = pieces.PieceModel([p("<unk>", 0, 2), *chars, *(p(f"<0x{b:02X}>", 0, 6) for b in range(256))])
    lossy = pieces.PieceModel([p("<unk>", 0, 2), *chars])
    for model in (own, lossy):
        for text in ("a bé b", "", "é", " é c", "a bé b"):
            ids = model.encode(text)
            assert model.digest(text) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest())
    assert all(type(v) is str for v in own.units.values()) and type(lossy.units[" bé"]) is tuple
    own.forget()
    assert not own.units and not own.older


def test_stages_run_in_small_batches(spark):
    import corpus_pipeline as pipeline

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.createDataFrame([(k, f"a b {k}", "s", 5) for k in range(3000)], "doc_id long, text string, source string, n_chars long").coalesce(1)
    try:
        for _, stage in pipeline.STAGES[1:]:
            spark.conf.set(name, "10000")
            stage(spark, docs, "")
            rows = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([len(b)])], ["n"]) for b in batches), "n long").collect()
            assert max(r.n for r in rows) <= 1000
    finally:
        spark.conf.set(name, before)


def test_encode_and_decode_columns(spark, odd):
    decoded = {r.doc_id: r.text for r in pieces.decode_pieces(pieces.encode_pieces(odd)).collect()}
    for i, text in texts_of(odd):
        assert decoded[i] == (text or "")


# 8 ------------------------------------------------------------------------------------------------


def check_shards(rows, got, shards):
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / shards) <= largest


def test_shards(spark):
    rows = [(k, t) for k, t in _documents()] + [(10_000 + k, "a very common text") for k in range(400)] + [(20_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard_by_bytes(docs, ranges=32, per_range=4).collect()
    check_shards(rows, got, 8)
    assert sorted(map(tuple, got)) == sorted(map(tuple, sharding.shard_by_bytes(docs.repartition(9), ranges=32, per_range=4).collect()))
    check_shards(rows, sharding.shard_by_bytes(docs, 5, ranges=64, cell_rows=50).collect(), 5)


def test_many_equal_records(spark):
    """Repeated and null ids, a third of all rows: dealt to several cells, whole, the same on a rerun."""
    rows = [(None, "hot")] * 150 + [(7, "other")] * 150 + [(k, f"text {k} " * (k % 9)) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard_by_bytes(docs, 4, ranges=8, cell_rows=20).collect()
    again = sharding.shard_by_bytes(docs.repartition(7), 4, ranges=8, cell_rows=20).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(rows)
    for shard in range(4):
        own = [r for r in got if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - sum(r.size for r in got) / 4) <= max(r.size for r in got)


@pytest.mark.parametrize("run", [3, 1000])
def test_equal_rows_are_numbered(spark, run):
    rows = [(1, "a")] * 7 + [(None, "a")] * 4 + [(2, None)]
    got = numbered(spark.createDataFrame(rows, "doc_id long, source string"), Scratch(spark), "n", run).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, s, k)) for (i, s), n in collections.Counter(rows).items() for k in range(n))


def test_range_search(spark):
    bounds = [-5, 0, 3, 9]
    rows = spark.createDataFrame([(x,) for x in range(-8, 13)], "place long")
    got = {r.place: r.k for r in rows.select("place", sharding.range_of(F.col("place"), bounds).alias("k")).collect()}
    assert got == {x: sum(b <= x for b in bounds) for x in range(-8, 13)}


# 9 ------------------------------------------------------------------------------------------------


def test_histogram(spark):
    rng = random.Random(1)
    lengths = [rng.choice([0, 1, 5, 64, 65, 700, 5000]) for _ in range(300)]
    hist = token_counts.length_histogram(spark.createDataFrame([(k, n) for k, n in enumerate(lengths)], "doc_id long, n_tokens long"), block=64)
    for r in hist.collect():
        n = r.n_tokens
        assert (r.docs, r.tokens, r.docs_from, r.tokens_from, r.truncated_total) == (lengths.count(n), n * lengths.count(n), sum(x >= n for x in lengths), sum(x for x in lengths if x >= n), sum(min(x, n) for x in lengths))
        assert r.quantile == pytest.approx(sum(x <= n for x in lengths) / 300)
    got = {r.context: (r.docs_cut, r.truncated_total) for r in token_counts.answers(hist, [0, 60, 9999]).collect()}
    assert got == {c: (sum(x > c for x in lengths), sum(min(x, c) for x in lengths)) for c in (0, 60, 9999)}
    middle = {r.share: r.n_tokens for r in token_counts.quantiles(hist, [0.5, 1.0]).collect()}
    assert middle == {0.5: sorted(lengths)[149], 1.0: max(lengths)}


def test_lengths_as_the_library(spark):
    encode = token_counts._encoding(token_counts.TOKENIZER).encode_ordinary
    got = {r.doc_id: r.n_tokens for r in token_counts.encoded_lengths(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect()}
    assert got == {i: len(encode(t)) for i, t in _documents()}


# 10 -----------------------------------------------------------------------------------------------


def brute_measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    full = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in quality.SYMBOLS), len(full) - len(set(full)), len(covered)


def test_measures(spark, odd):
    rng = random.Random(2)
    rows = texts_of(odd) + [(100 + k, "".join(rng.choices(["a ", "b ", "c ", "\n", "#", "😀 ", "é"], k=rng.randint(0, 80)))) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").distinct()
    for r in quality.ledger(docs).join(docs, "doc_id").collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_measures(r.text)


def test_ablations(spark):
    rows = quality.ledger(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    bits = [r.fail_bits for r in rows.select("fail_bits").collect()]
    for r in quality.ablations(rows).collect():
        mask, bit = quality.mask_of(quality.POLICIES[r.policy]), 1 << quality.BIT[r.rule]
        assert (r.kept, r.kept_without, r.dropped_only_by) == (sum(not b & mask for b in bits), sum(not b & mask & ~bit for b in bits), sum(b & mask == bit for b in bits))


def test_clean_documents_stay(spark):
    folder = "/root/testdata/sf0.01"
    good = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").join(QUERIES["op10_quality_ledger"](spark, folder), "doc_id")
    assert good.where("not base_failed and not kept").count() == 0


def test_repeats_in_long_texts(spark):
    """Repeated windows far apart, beyond 2**16 words, and few repeats among very many windows."""
    middle = [f"w{n}" for n in range(120_000)]
    texts = [" ".join(["a", "b", "c", *middle, "a", "b", "c"]), " ".join(middle), " ".join(["x"] * 70_000)]
    got = {r.doc_id: r.n_repeat_words for r in quality.ledger(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: 6, 1: 0, 2: 70_000}


# Pipeline -----------------------------------------------------------------------------------------


def test_pipeline(spark):
    import corpus_pipeline as pipeline

    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing sources", "SentencePiece"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    scratch, seen = Scratch(spark), [docs]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        seen.append(scratch.save(stage(spark, seen[-1], FOLDER), f"s{k}"))
    assert all(df.columns == docs.columns for df in seen[:-1])
    before, after = dict(texts_of(seen[1])), dict(texts_of(seen[2]))
    assert {i: v[2] for i, v in brute_lines(list(before.items())).items()} == after
    assert {r.doc_id for r in seen[3].collect()} == {c for _, c in brute_components(list(after.items()), 5, 80).values()}
    copies = collections.Counter(r.doc_id for r in seen[4].collect())
    assert copies and max(copies.values()) <= 3 and set(copies) <= set(dict(texts_of(seen[3])))
    own = pieces.piece_model()
    for r in seen[5].collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == own.digest(after[r.doc_id])
    assert sorted(map(tuple, pipeline.run(spark, FOLDER).collect())) == sorted(map(tuple, seen[5].collect()))
    assert os.path.exists(pipeline.__file__)
