"""Media columns in Matroska: a writer for 8-bit PCM payloads and a reader into packet tables.

The reader walks variable-length EBML elements, clusters, simple blocks and block groups with
Xiph, EBML or fixed-size lacing, and cues. Layout: RFC 8794 (EBML) and RFC 9559 (Matroska).
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from struct import error as StructError
from struct import pack, unpack
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, documents

# Element ids of the format.
EBML, DOC_TYPE, SEGMENT, INFO, TIMESTAMP_SCALE, DURATION = 0x1A45DFA3, 0x4282, 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_TYPE, CODEC_ID = 0x1654AE6B, 0xAE, 0xD7, 0x83, 0x86
AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, CLUSTER_TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
CUES, CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
ENCODINGS, ENCODING, ENCODING_ORDER, ENCODING_SCOPE, ENCODING_TYPE = 0x6D80, 0x6240, 0x5031, 0x5032, 0x5033
COMPRESSION, COMPRESSION_ALGORITHM, COMPRESSION_SETTINGS, ENCRYPTED_BLOCK = 0x5034, 0x4254, 0x4255, 0xAF
HEADER_STRIPPING = 3
SEEK_HEAD, ATTACHMENTS, CHAPTERS, TAGS = 0x114D9B74, 0x1941A469, 0x1043A770, 0x1254C367
TOP = {EBML, SEGMENT}
IN_SEGMENT = {INFO, TRACKS, CLUSTER, CUES, SEEK_HEAD, ATTACHMENTS, CHAPTERS, TAGS}
NO_LACING, XIPH, FIXED, EBML_LACING = range(4)

#: The writer's choices: samples a second, samples a frame, frames a block, blocks a cluster.
RATE, FRAME, LACED, BLOCKS = 8000, 400, 8, 16


class Packet(NamedTuple):
    """One frame; offset and size are its byte range in the file, header the bytes that its track strips from the front."""

    track: int
    timestamp_ms: int
    offset: int
    size: int
    lacing: int
    lace: int
    cluster_offset: int
    cued: bool
    header: bytes = b""

    def bytes_of(self, data: bytes) -> bytes:
        return self.header + data[self.offset : self.offset + self.size]


# Writing ----------------------------------------------------------------------------------------


def _size(n: int, width: int = 0) -> bytes:
    """A length of 1 to 8 bytes whose leading zero bits tell how many; all ones is reserved."""
    width = width or next(w for w in range(1, 9) if n < (1 << 7 * w) - 1)
    return (n | 1 << 7 * width).to_bytes(width, "big")


def _element(ident: int, body: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + _size(len(body)) + body


def _uint(ident: int, value: int) -> bytes:
    return _element(ident, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def _laces(sizes: list[int], kind: int) -> bytes:
    """The lace head: frames less one, then the sizes of all but the last."""
    head = bytes([len(sizes) - 1])
    if kind == XIPH:
        return head + b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    if kind == EBML_LACING:
        head += _size(sizes[0])
        for before, n in zip(sizes, sizes[1:-1], strict=False):
            width = next(w for w in range(1, 9) if abs(n - before) < 1 << 7 * w - 1)
            head += _size(n - before + (1 << 7 * width - 1) - 1, width)
    return head


def _block(frames: list[bytes], ticks: int) -> bytes:
    """A key-frame simple block: equal frames are laced as such, others by EBML or Xiph sizes."""
    sizes = [len(f) for f in frames]
    kind = NO_LACING if len(frames) == 1 else FIXED if len(set(sizes)) == 1 else EBML_LACING if len(frames) % 2 else XIPH
    return b"\x81" + pack(">hB", ticks, 0x80 | kind << 1) + (_laces(sizes, kind) if kind else b"") + b"".join(frames)


def write_matroska(payload: bytes) -> bytes:
    """A file with one track of unsigned 8-bit samples, blocks in clusters, and cues to each cluster."""
    info = _element(INFO, _uint(TIMESTAMP_SCALE, 1_000_000) + _element(DURATION, pack(">d", len(payload) * 1000 / RATE)))
    audio = _element(AUDIO, _element(SAMPLING_FREQUENCY, pack(">d", RATE)) + _uint(CHANNELS, 1) + _uint(BIT_DEPTH, 8))
    tracks = _element(TRACKS, _element(TRACK_ENTRY, _uint(TRACK_NUMBER, 1) + _uint(TRACK_TYPE, 2) + _element(CODEC_ID, b"A_PCM/INT/LIT") + audio))
    body, cues = [info, tracks], []
    at = len(info) + len(tracks)
    per_block, per_cluster = FRAME * LACED, FRAME * LACED * BLOCKS
    for begin in range(0, len(payload), per_cluster):
        start = begin * 1000 // RATE
        parts = [_uint(CLUSTER_TIMESTAMP, start)]
        for first in range(begin, min(begin + per_cluster, len(payload)), per_block):
            frames = [payload[k : k + FRAME] for k in range(first, min(first + per_block, len(payload)), FRAME)]
            parts.append(_element(SIMPLE_BLOCK, _block(frames, first * 1000 // RATE - start)))
        cluster = _element(CLUSTER, b"".join(parts))
        cues.append(_element(CUE_POINT, _uint(CUE_TIME, start) + _element(CUE_TRACK_POSITIONS, _uint(CUE_TRACK, 1) + _uint(CUE_CLUSTER_POSITION, at))))
        body.append(cluster)
        at += len(cluster)
    head = _element(EBML, _element(DOC_TYPE, b"matroska"))
    return head + _element(SEGMENT, b"".join(body) + _element(CUES, b"".join(cues)))


# Reading ----------------------------------------------------------------------------------------


def read_size(data: bytes, at: int) -> tuple[int, int]:
    """(value, bytes read) of a variable-length number; -1 is the reserved unknown size."""
    first = data[at]
    if not first:
        raise ValueError(f"no length marker at byte {at}")
    width = 9 - first.bit_length()
    value = int.from_bytes(data[at : at + width], "big") & (1 << 7 * width) - 1
    return (-1 if value == (1 << 7 * width) - 1 else value), width


def elements(data: bytes, begin: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """(id, where it begins, first byte of its body, end) of the elements at one level."""
    at = begin
    while at < end:
        if not data[at]:
            raise ValueError(f"no element id at byte {at}")
        width = 9 - data[at].bit_length()
        ident = int.from_bytes(data[at : at + width], "big")
        size, more = read_size(data, at + width)
        body = at + width + more
        stop = body + size if size >= 0 else open_end(data, ident, body, end)
        if stop > end:
            raise ValueError(f"element {ident:x} at byte {at} runs past its parent")
        yield ident, at, body, stop
        at = stop


def open_end(data: bytes, ident: int, body: int, end: int) -> int:
    """Where an element of unknown size ends: before the next element that can't be its child. Only segments and clusters may be so."""
    if ident not in (SEGMENT, CLUSTER):
        raise ValueError(f"element {ident:x} before byte {body} has no size")
    beyond = TOP if ident == SEGMENT else TOP | IN_SEGMENT
    at = body
    while at < end:
        if not data[at]:
            raise ValueError(f"no element id at byte {at}")
        width = 9 - data[at].bit_length()
        child = int.from_bytes(data[at : at + width], "big")
        if child in beyond:
            return at
        size, more = read_size(data, at + width)
        at += width + more
        at = at + size if size >= 0 else open_end(data, child, at, end)
    return at


def read_laces(data: bytes, at: int, end: int, kind: int) -> list[tuple[int, int]]:
    """(offset, size) of the frames of a block's body."""
    if kind == NO_LACING:
        return [(at, end - at)]
    count, at = data[at] + 1, at + 1
    sizes: list[int] = []
    if kind == FIXED:
        if (end - at) % count:
            raise ValueError(f"{end - at} bytes at byte {at} are no {count} equal laces")
        sizes = [(end - at) // count] * count
    elif kind == XIPH:
        for _ in range(count - 1):
            n = 0
            while data[at] == 255:
                n, at = n + 255, at + 1
            sizes.append(n + data[at])
            at += 1
    else:
        n, width = read_size(data, at)
        sizes, at = [n], at + width
        for _ in range(count - 2):
            step, width = read_size(data, at)
            n += step - ((1 << 7 * width - 1) - 1)
            sizes.append(n)
            at += width
    if kind != FIXED:
        sizes.append(end - at - sum(sizes))
    frames = []
    for n in sizes:
        if n < 0 or at + n > end:
            raise ValueError(f"a lace of {n} bytes at byte {at} runs past its block")
        frames.append((at, n))
        at += n
    return frames


def stripped_header(data: bytes, begin: int, end: int) -> bytes:
    """What a track's encodings strip from the front of every frame; any other encoding of frames is an error."""
    found = []
    for ident, _, first, stop in elements(data, begin, end):
        if ident != ENCODING:
            continue
        entry = {i: data[a:b] for i, _, a, b in elements(data, first, stop)}
        number = lambda i, default: int.from_bytes(entry[i], "big") if i in entry else default
        if not number(ENCODING_SCOPE, 1) & 1:  # of the codec's own data, not of frames
            continue
        inside = {i: body for i, body in ((i, data[a:b]) for i, _, c, d in elements(data, first, stop) if i == COMPRESSION for i, _, a, b in elements(data, c, d))}
        if number(ENCODING_TYPE, 0) != 0 or int.from_bytes(inside.get(COMPRESSION_ALGORITHM, b""), "big") != HEADER_STRIPPING:
            raise ValueError(f"frames are encrypted or compressed otherwise than by header stripping (encoding at byte {first})")
        found.append((number(ENCODING_ORDER, 0), inside.get(COMPRESSION_SETTINGS, b"")))
    return b"".join(header for _, header in sorted(found))


def read_matroska(data: bytes) -> tuple[dict[int, dict], list[Packet]]:
    """(tracks, packets in file order). A laced block's frames share its timestamp.

    Packets of a track that strips headers carry them. Frames in any other encoding, encrypted
    blocks, and packets of a track that the file doesn't describe are errors.
    """
    tracks: dict[int, dict] = {}
    clusters: list[tuple[int, int, int]] = []
    cued: set[tuple[int, int]] = set()
    scale, segment = 1_000_000, 0

    def uint(begin: int, end: int) -> int:
        return int.from_bytes(data[begin:end], "big")

    def children(begin: int, end: int) -> dict[int, tuple[int, int]]:
        return {ident: (body, stop) for ident, _, body, stop in elements(data, begin, end)}

    for ident, _, body, end in elements(data, 0, len(data)):
        if ident != SEGMENT:
            continue
        segment = body
        for child, at, first, stop in elements(data, body, end):
            if child == INFO:
                scale = uint(*children(first, stop).get(TIMESTAMP_SCALE, (0, 0))) or scale
            elif child == TRACKS:
                for _, _, a, b in (e for e in elements(data, first, stop) if e[0] == TRACK_ENTRY):
                    entry = children(a, b)
                    audio = children(*entry[AUDIO]) if AUDIO in entry else {}
                    span = audio.get(SAMPLING_FREQUENCY)
                    rate = unpack(">d" if span[1] - span[0] == 8 else ">f", data[span[0] : span[1]])[0] if span else 8000.0
                    tracks[uint(*entry[TRACK_NUMBER])] = {"codec": data[slice(*entry[CODEC_ID])].decode(), "type": uint(*entry[TRACK_TYPE]), "rate": rate, "bits": uint(*audio.get(BIT_DEPTH, (0, 0))), "header": stripped_header(data, *entry[ENCODINGS]) if ENCODINGS in entry else b""}
            elif child == CLUSTER:
                clusters.append((at, first, stop))
            elif child == CUES:
                for _, _, a, b in elements(data, first, stop):
                    for _, _, c, d in (e for e in elements(data, a, b) if e[0] == CUE_TRACK_POSITIONS):
                        spot = children(c, d)
                        cued.add((uint(*spot[CUE_TRACK]), segment + uint(*spot[CUE_CLUSTER_POSITION])))
    if not segment:
        raise ValueError("no segment")
    packets = []
    for at, first, stop in clusters:
        base = 0
        for child, _, a, b in elements(data, first, stop):
            if child == CLUSTER_TIMESTAMP:
                base = uint(a, b)
            inside = list(elements(data, a, b)) if child == BLOCK_GROUP else []
            if any(e == ENCRYPTED_BLOCK for e, *_ in inside) or child == ENCRYPTED_BLOCK:
                raise ValueError(f"an encrypted block at byte {a}")
            blocks = [(a, b)] if child == SIMPLE_BLOCK else [(c, d) for e, _, c, d in inside if e == BLOCK]
            for c, d in blocks:
                track, width = read_size(data, c)
                ticks, flags = unpack(">hB", data[c + width : c + width + 3])
                kind = flags >> 1 & 3
                if track not in tracks:
                    raise ValueError(f"a block of track {track}, which the file doesn't describe, at byte {c}")
                for lace, (offset, size) in enumerate(read_laces(data, c + width + 3, d, kind)):
                    packets.append(Packet(track, (base + ticks) * scale // 1_000_000, offset, size, kind, lace, at, (track, at) in cued, tracks[track]["header"]))
    return tracks, packets


# Columns ----------------------------------------------------------------------------------------


def payload_of(text: str | None) -> bytes:
    data = (text or "").encode()
    return data + bytes(-len(data) % 64 or 64 * (not data))


def encode_media(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each whole text (null: empty), zero-padded to a positive multiple of 64 bytes, as a file.

    One row for each row of docs: repeated rows give equal files, null ids stay null, an empty
    table gives none. A text of any length is one file. Other columns of docs are ignored.
    """

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0)
        for begin in range(0, len(batch), 256):  # files of few texts at a time
            texts = batch.column(1).slice(begin, 256).to_pylist()
            yield pa.RecordBatch.from_arrays([ids.slice(begin, 256), pa.array([len((t or "").encode()) for t in texts], pa.int64()), pa.array([write_matroska(payload_of(t)) for t in texts], pa.binary())], ["doc_id", "n_bytes", "media"])

    return arrow_map(_columns(docs), each, "doc_id long, n_bytes long, media binary")


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def packet_table(files: DataFrame) -> DataFrame:
    """A row for each packet of files (doc_id, media): doc_id, packet, the fields of Packet, crc32 (of the whole packet, its header included).

    A null or unreadable file has no packets; see `media_digest` for its error. Files of any
    number of packets leave in batches of some thousand rows; repeated files give their packets
    again. Other columns of files are ignored, an empty table gives no rows.
    """

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for doc_id, media in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            try:
                packets = read_matroska(media)[1] if media else []
            except (ValueError, IndexError, KeyError, StructError):
                packets = []
            for begin in range(0, len(packets), 4096):
                rows = [{"doc_id": doc_id, "packet": begin + k, **p._asdict(), "crc32": zlib.crc32(p.bytes_of(media))} for k, p in enumerate(packets[begin : begin + 4096])]
                yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("doc_id", pa.int64()), ("packet", pa.int64()), *((n, {"cued": pa.bool_(), "header": pa.binary()}.get(n, pa.int64())) for n in Packet._fields), ("crc32", pa.int64())])
    return arrow_map(files.select("doc_id", "media"), each, "doc_id long, packet long, track long, timestamp_ms long, offset long, size long, lacing long, lace long, cluster_offset long, cued boolean, header binary, crc32 long")


def media_digest(files: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, n_packets, last_ms, error).

    One row for each file that is not null. The payload is put together from the packets' byte
    ranges of the stored file. A file that cannot be read whole has an error and nulls in place
    of what it would hold: a reader that loses bytes fails rather than give a shorter payload.
    Repeated files give equal rows, other columns of files are ignored, an empty table gives no rows.
    """

    def one(doc_id: int, n_bytes: int, media: bytes) -> dict:
        row = {"doc_id": doc_id, "n_bytes": n_bytes, "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest()}
        try:
            tracks, packets = read_matroska(media)
        except (ValueError, IndexError, KeyError, StructError) as error:
            return row | {"error": str(error)}
        payload = b"".join(p.bytes_of(media) for p in packets)
        laces = [sum(p.lacing == kind and p.lace == 0 for p in packets) for kind in range(4)]
        clusters = {p.cluster_offset for p in packets}
        track = tracks.get(1, {})
        feature = f"{track.get('codec')} {track.get('bits')} bit {track.get('rate'):g} Hz; packets {len(packets)}; blocks {'/'.join(map(str, laces))}; clusters {len(clusters)}, cued {len({p.cluster_offset for p in packets if p.cued})}; mean {sum(payload) / max(1, len(payload)):.3f}"
        return row | {"payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-64:]), "feature": feature, "n_packets": len(packets), "last_ms": packets[-1].timestamp_ms if packets else None}

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
        yield pa.RecordBatch.from_pylist([one(*row) for row in rows if row[2] is not None], schema)

    fields = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_packets long, last_ms long, error string"
    schema = pa.schema([(n, pa.int64() if kind == "long" else pa.string()) for n, kind in (f.split() for f in fields.split(", "))])
    return arrow_map(files.select("doc_id", "n_bytes", "media"), each, fields)


def op3_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digest(encode_media(documents(spark, sf_dir)))


QUERIES, ORACLE = {"op3_matroska": op3_matroska}, {}
