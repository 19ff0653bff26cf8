"""Merge-type piece encoding by backtracking, and its decoding.

The model's result is what repeated merging of the best adjacent pair gives. A sequence of
pieces is that result exactly if every adjacent pair of pieces stays as it is when its own
text is merged anew. So the encoder walks the text with the longest matches of an Aho-Corasick
automaton, checks each new pair by re-merging it, and steps back to shorter matches where a
pair fails; a bitfield of positions known to fail keeps this linear.

Pieces never hold a space mark after another character, and no piece holds a newline, so no
merge crosses from a character to a space mark or over a newline. Texts are cut there into
units that are encoded one by one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, documents

MODEL = "piece_bpe_32k.model"
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Units remembered by a worker in a task: up to twice so many, those used of late; pairs of pieces at most.
REMEMBERED, PAIRS = 50_000, 400_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, data[at : at + size]
        at += size


class Piece(NamedTuple):
    text: str
    score: float
    kind: int


def read_pieces(path: str) -> list[Piece]:
    """The pieces of a model file (field 1 of the model: piece, score, type)."""
    from struct import unpack

    pieces = []
    with open(path, "rb") as file:
        for number, value in _fields(file.read()):
            if number == 1:
                own = dict(_fields(value))
                pieces.append(Piece(own[1].decode(), unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
    return pieces


class PieceModel:
    """Encodes and decodes with one model's pieces."""

    def __init__(self, pieces: list[Piece]) -> None:
        import ahocorasick

        self.pieces = pieces
        self.ids = {p.text: k for k, p in enumerate(pieces) if p.kind in (NORMAL, USER)}
        self.score = {p.text: p.score for p in pieces if p.kind in (NORMAL, USER)}
        self.byte_ids = {int(p.text[3:5], 16): k for k, p in enumerate(pieces) if p.kind == BYTE}
        self.unknown = next((k for k, p in enumerate(pieces) if p.kind == UNKNOWN), 0)
        self.raw = [bytes([int(p.text[3:5], 16)]) if p.kind == BYTE else b"" if p.kind == CONTROL else p.text.replace(MARK, " ").encode() for p in pieces]
        self.chars = {c for text in self.ids for c in text}
        if any(MARK in text.lstrip(MARK) for text in self.ids):
            raise ValueError("a piece holds a space mark after another character")
        self.automaton = ahocorasick.Automaton()
        for text, k in self.ids.items():
            if self.merge(text) == [text]:  # a piece that merging does not give can't be in a result
                self.automaton.add_word(text, (len(text), k))
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.units: dict[str, str | tuple[str, str]] = {}
        self.older: dict[str, str | tuple[str, str]] = {}
        self.cutter = re.compile(" +[^ ]*" if "\n" in self.chars else " +[^ \n]*|[^ \n]+|\n+")

    def merge(self, text: str) -> list[str]:
        """Merges the best adjacent pair, the first of equals, until none is a piece. For short texts."""
        parts = list(text)
        while len(parts) > 1:
            pairs = [(-self.score[both], k) for k in range(len(parts) - 1) if (both := parts[k] + parts[k + 1]) in self.score]
            if not pairs:
                break
            k = min(pairs)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces stay when their joint text is merged anew."""
        key = (left, right)
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            a, b = self.pieces[left].text, self.pieces[right].text
            known = self.fits[key] = self.merge(a + b) == [a, b]
        return known

    def _known(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are in pieces."""
        size = len(text)
        matches: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for end, match in self.automaton.iter(text):
            matches[end - match[0] + 1].append(match)  # shorter ones first
        fits, compatible = self.fits.get, self.compatible
        failed = bytearray(size + 1)  # positions from which no valid way on is left
        path: list[int] = []
        begins: list[tuple[int, int]] = []  # of each piece: where it begins, how many shorter matches are left there
        at, left, before = 0, len(matches[0]), -1
        while at < size:
            own = matches[at]
            while left:
                left -= 1
                length, k = own[left]
                if failed[at + length]:
                    continue
                if before >= 0:
                    fit = fits((before, k))
                    if not (compatible(before, k) if fit is None else fit):
                        continue
                path.append(k)
                begins.append((at, left))
                before = k
                at += length
                left = len(matches[at]) if at < size else 0
                break
            else:
                if not path:
                    raise ValueError("no valid sequence of pieces")
                # A position is entered after its longest valid prefix first, so once it fails it fails for good.
                failed[at] = 1
                path.pop()
                at, left = begins.pop()
                before = path[-1] if path else -1
        return path

    def encode_unit(self, unit: str) -> list[int]:
        """Ids of a unit, spaces as marks; characters that no piece has become bytes."""
        unit = unit.replace(" ", MARK)
        if self.chars.issuperset(unit):
            return self._known(unit)
        ids: list[int] = []
        for known, run in groupby(unit, self.chars.__contains__):
            if known:
                ids += self._known("".join(run))
            else:
                ids += [self.byte_ids[b] for b in "".join(run).encode()] if self.byte_ids else [self.unknown]
        return ids

    def _unit(self, unit: str) -> str | tuple[str, str]:
        """Ids joined by commas, and what they decode to unless it is the unit again."""
        found = self.older.get(unit)
        if found is None:
            ids = self.encode_unit(unit)
            found, decoded = ",".join(map(str, ids)), b"".join([self.raw[k] for k in ids]).decode("utf-8", "surrogateescape")
            if decoded != unit:
                found = found, decoded
        if len(unit) <= 64:
            if len(self.units) >= REMEMBERED:
                self.older, self.units = self.units, {}
            self.units[unit] = found
        return found

    def _cut(self, text: str) -> list[str]:
        """Units of a text with the space before it; a space mark counts as a space."""
        return self.cutter.findall(" " + text.replace(MARK, " ")) if text else []

    def encode(self, text: str) -> list[int]:
        """Ids, with the space mark that the model puts before every text."""
        return [k for unit in self._cut(text) for k in self.encode_unit(unit)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the first space, which encoding put there, goes. Bad bytes become U+FFFD."""
        return _text(b"".join([self.raw[k] for k in ids]))

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, sha256 of the ids joined by commas, sha256 of the decoded text), by units."""
        remembered, unit = self.units.get, self._unit
        parts, raw = [], []
        for u in self._cut(text):
            found = remembered(u)
            if found is None:
                found = unit(u)
                remembered = self.units.get
            if type(found) is tuple:
                found, u = found  # noqa: PLW2901
            parts.append(found)
            raw.append(u)
        ids, decoded = ",".join(parts), _text("".join(raw).encode("utf-8", "surrogateescape"))
        return ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    def forget(self) -> None:
        """Drops the remembered units: a worker lives on from stage to stage and would keep them."""
        self.units, self.older = {}, {}


def _text(raw: bytes) -> str:
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


@lru_cache(2)
def piece_model(name: str = MODEL) -> PieceModel:
    """A model by its path, or by a name that the installed package of public tokenizers resolves."""
    import public_tokenizers

    return PieceModel(read_pieces(name if "/" in name else public_tokenizers.path(name)))


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode_pieces(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, ids) of every whole text; a null or empty text has no ids.

    One row for each row of docs: repeated rows get equal ids, null doc_ids stay null. There is
    one encoding of a text, so ties don't arise. Texts of any length are encoded whole. Other
    columns are ignored, an empty table gives no rows.
    """

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = piece_model(model)
        for begin in range(0, len(batch), 512):
            part = batch.slice(begin, 512)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([own.encode(t or "") for t in part.column(1).to_pylist()], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return arrow_map(_columns(docs), each, "doc_id long, ids array<int>")


def decode_pieces(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids and empty lists give an empty text.

    One row for each row of encoded, repeated and unnamed ones too; lists of any length are
    decoded whole. Other columns are ignored, an empty table gives no rows.
    """

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = piece_model(model)
        for begin in range(0, len(batch), 512):
            part = batch.slice(begin, 512)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([own.decode(ids or []) for ids in part.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return arrow_map(encoded.select("doc_id", "ids"), each, "doc_id long, text string")


def piece_digest(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, ids and text made and decoded in one pass.

    Null and empty texts have no ids and decode to an empty text. One row for each row of docs:
    repeated rows give equal digests, null doc_ids stay null, texts of any length are encoded
    whole; ties don't arise. Other columns are ignored, an empty table gives no rows.
    """

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = piece_model(model)
        for begin in range(0, len(batch), 512):
            part = batch.slice(begin, 512)
            n, ids, decoded = zip(*(own.digest(t or "") for t in part.column(1).to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return arrow_map(_columns(docs), each, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", lambda: piece_model(model).forget())


def op7_pieces_backtrack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digest(documents(spark, sf_dir))


QUERIES, ORACLE = {"op7_pieces_backtrack": op7_pieces_backtrack}, {}
