"""SentencePiece encoding and decoding by a weighted finite-state transducer.

The model's normaliser, pieces and byte fallback are compiled once. Composing
them with an input gives a lattice: states are places in the text, arcs are
pieces, and the model's order of merges weighs a piece after another as free
(0) if the two would stay apart, else as impossible (infinity, the zero of the
tropical semiring). The shortest path is then the encoding. A sequence of
pieces is what merging yields exactly if this holds for each neighbouring two.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodgetrail.llm.recent import Recent

SPACE = "▁"
# Kinds of pieces and the fields of a model file that are read.
_NORMAL, _UNKNOWN, _BYTE = 1, 2, 6
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_BPE = 2
#: Stretches of a generation that a worker keeps (two at most), about 200 bytes each.
KEPT = 300_000
_CUT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes | float]]:
    """Field numbers and values of a protocol buffer message."""
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
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, data[at : at + size]
            at += size
        else:
            size = 4 if kind == 5 else 8
            yield key >> 3, struct.unpack("<f" if kind == 5 else "<d", data[at : at + size])[0]
            at += size


@dataclass
class Model:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    dummy_prefix: bool
    squeeze: bool  # runs of spaces become one, outer ones go


def load(data: bytes) -> Model:
    """A model whose encoding is by merges and whose normaliser keeps characters; others are refused."""
    pieces, scores, kinds = [], [], []
    prefix, squeeze, escape, charsmap, merges = True, True, True, b"", 1
    for number, value in _fields(data):
        if number == _PIECES:
            own = dict(_fields(value))
            pieces.append(own.get(1, b"").decode())
            scores.append(own.get(2, 0.0))
            kinds.append(own.get(3, _NORMAL))
        elif number == _TRAINER:
            merges = dict(_fields(value)).get(3, 1)
        elif number == _NORMALIZER:
            own = dict(_fields(value))
            charsmap, prefix = own.get(2, b""), bool(own.get(3, 1))
            squeeze, escape = bool(own.get(4, 1)), bool(own.get(5, 1))
    if merges != _BPE or charsmap or not escape:
        raise ValueError("only merging models with an identity normaliser are supported")
    return Model(pieces, scores, kinds, prefix, squeeze)


class Transducer:
    def __init__(self, model: Model, kept: int = KEPT):
        self.model, self.kept = model, kept
        self.ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == _NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == _BYTE}
        self.unknown = model.kinds.index(_UNKNOWN) if _UNKNOWN in model.kinds else 0
        # Arcs leave a state by a piece that merging can make, or by any one character.
        made = [p for p in self.ids if len(p) > 1 and self.merged(p) == [p]]
        # Whether a text is such a piece, or just the start of one.
        self.arcs = dict.fromkeys((p[:n] for p in made for n in range(2, len(p) + 1)), False) | dict.fromkeys(made, True)
        self.weights: dict[str, dict[str, float]] = {}
        self.weighed = 0
        self.known = Recent(kept, lambda parts: map(self.compose, parts))
        kinds = {_BYTE: lambda p: bytes([int(p[3:5], 16)]), _NORMAL: str.encode, _UNKNOWN: lambda p: " ⁇ ".encode()}
        self.outputs = [kinds.get(k, lambda p: b"")(p) for p, k in zip(model.pieces, model.kinds)]

    def normalise(self, text: str | None) -> str:
        """Spaces become their mark, one is put before the text. An empty text stays empty."""
        if not text:
            return ""
        if self.model.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.model.dummy_prefix:
            text = " " + text
        return text.replace(" ", SPACE)

    def merged(self, text: str) -> list[str]:
        """The merges by themselves: best score first, then leftmost. For the short texts that weights ask about."""
        parts = list(text)
        while len(parts) > 1:
            pairs = [(-self.model.scores[i], n) for n in range(len(parts) - 1) if (i := self.ids.get(parts[n] + parts[n + 1])) is not None]
            if not pairs:
                break
            n = min(pairs)[1]
            parts[n : n + 2] = [parts[n] + parts[n + 1]]
        return parts

    def weight(self, left: str, right: str) -> float:
        """0 where the two pieces, next to each other, stay as they are, else infinity."""
        self.weighed += 1
        if self.weighed > 4 * self.kept:
            self.weights.clear()
            self.weighed = 0
        found = 0.0 if self.merged(left + right) == [left, right] else math.inf
        self.weights.setdefault(left, {})[right] = found
        return found

    def shortest_path(self, text: str) -> list[str]:
        """Pieces of least total weight through the composed lattice.

        At each place one last piece has a path of weight 0, as merging a
        prefix has one result, so one state per place is kept.
        """
        size = len(text)
        last: list[str | None] = ["", *[None] * size]
        arcs, weights = self.arcs.get, self.weights
        for at in range(size):
            left = last[at]
            if left is None:
                continue
            known = weights.get(left, {})
            for end in range(at + 1, size + 1):
                piece = text[at:end]
                if end > at + 1:
                    made = arcs(piece)
                    if made is None:
                        break
                    if not made:
                        continue
                if last[end] is None:
                    weight = known.get(piece) if left else 0.0
                    if weight is None:
                        weight = self.weight(left, piece)
                    if weight == 0.0:
                        last[end] = piece
        path, at = [], len(text)
        while at:
            path.append(last[at])
            at -= len(path[-1])
        return path[::-1]

    def piece_ids(self, piece: str) -> list[int]:
        """A piece's id, or those of its bytes, or the unknown id."""
        found = self.ids.get(piece)
        if found is not None:
            return [found]
        own = piece.encode("utf-8", "replace")
        return [self.bytes[b] for b in own] if self.bytes else [self.unknown]

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit bytes.

        No piece holds a space mark after another character, so a text may be
        cut before a run of them; each stretch is composed once.
        """
        return b"".join(self.known.look(_CUT.findall(self.normalise(text))))

    def compose(self, part: str) -> bytes:
        ids = [i for piece in self.shortest_path(part) for i in self.piece_ids(piece)]
        return array("I", ids).tobytes()

    def decode(self, ids: Iterable[int]) -> str:
        """The inverted transducer: pieces to text, byte pieces to characters, the prefix removed."""
        text = b"".join(map(self.outputs.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


_made: dict[str, Transducer] = {}


def worker_transducer(data: bytes) -> Transducer:
    key = hashlib.md5(data).hexdigest()
    if key not in _made:
        _made[key] = Transducer(load(data))
    return _made[key]


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _mapped(rows: DataFrame, path: str, each, schema: str) -> DataFrame:
    data = rows.sparkSession.sparkContext.broadcast(model_bytes(path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = worker_transducer(data.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays(each(machine, some), [c.split()[0] for c in schema.split(", ")])

    return rows.mapInArrow(run, schema)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids``: every whole text encoded. NULL and empty texts have no ids; all rows stay."""

    def each(machine: Transducer, batch: pa.RecordBatch) -> list:
        ids = [array("I", machine.encode(t)).tolist() for t in batch.column(1).to_pylist()]
        return [batch.column(0), pa.array(ids, pa.list_(pa.int32()))]

    return _mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), path, each, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``text`` of rows with ``ids``; NULL ids count as none."""

    def each(machine: Transducer, batch: pa.RecordBatch) -> list:
        return [batch.column(0), pa.array([machine.decode(i or []) for i in batch.column(1).to_pylist()], pa.string())]

    return _mapped(rows.select("doc_id", "ids"), path, each, "doc_id long, text string")


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_ids``, ``ids_crc32``, ``round_trip``: whether decoding the ids gives the text back.

    It does for every text but those holding the space mark itself, which
    comes back as a space.
    """

    def each(machine: Transducer, batch: pa.RecordBatch) -> list:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        data = [machine.encode(t) for t in texts]
        back = [machine.decode(memoryview(d).cast("I")) == t for d, t in zip(data, texts)]
        sizes = pa.array([len(d) // 4 for d in data], pa.int64())
        return [batch.column(0), sizes, pa.array([zlib.crc32(d) for d in data], pa.int64()), pa.array(back, pa.bool_())]

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _mapped(narrow, path, each, "doc_id long, n_ids long, ids_crc32 long, round_trip boolean")
