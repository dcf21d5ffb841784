"""Fill-in-middle: documents cut at two token ends, their parts put in another order.

A token is a run of white space with the run of other signs behind it; white
space at the end of a text is one too. White space is ASCII, so tokens end at
bytes: those that are no white space but stand before it, and a text's last.

The texts of a batch are one buffer of UTF-8, seen as 64-bit words. Token ends
are marked in the top bit of their byte, eight bytes at a time, by additions
that never carry into the next byte. A text's k-th end is found by the running
count of marks per word, then within the one word that holds it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# The signs in front of the three parts, and the names of the orders.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

SEED = 42
#: Of a hundred texts, how many are cut, and how many of these have the suffix in front.
CUT, SUFFIX_FIRST = 50, 80
#: Texts are worked on in slices of about this many bytes; a longer text is a slice of its own.
SLICE = 4 << 20

_U = np.uint64


def _each(byte: int) -> np.uint64:
    """A word with this value in each of its bytes."""
    return _U(int.from_bytes(bytes([byte]) * 8, "little"))


_TOP, _LOW = _each(0x80), _each(0x7F)


def space_marks(words: np.ndarray) -> np.ndarray:
    """The top bit of each byte that is a space or one of 0x09 to 0x0D."""
    low = words & _LOW
    from_tab = low + _each(0x80 - 0x09)
    over_return = low + _each(0x80 - 0x0E)
    other_than_space = (low ^ _each(0x20)) + _LOW
    return (from_tab & ~over_return | ~other_than_space) & ~words & _TOP


def following_marks(words: np.ndarray) -> np.ndarray:
    """The top bit of each byte that goes on with a code point begun before."""
    return words & ~(words << _U(1)) & _TOP


class Marks:
    """Marked bytes of a buffer, with the number of marks up to each word."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.upto = np.cumsum(np.bitwise_count(marks), dtype="i8")

    def before(self, byte: np.ndarray) -> np.ndarray:
        """How many marks stand before each of these bytes."""
        word, within = byte >> 3, (byte & 7).astype("u8") * _U(8)
        held = self.marks[word]
        part = np.bitwise_count(held & ((_U(1) << within) - _U(1))).astype("i8")
        return self.upto[word] - np.bitwise_count(held) + part

    def end_of(self, number: np.ndarray) -> np.ndarray:
        """The byte behind each of these marks, counted from 1 over the whole buffer."""
        word = np.minimum(np.searchsorted(self.upto, number), len(self.marks) - 1)
        left = self.marks[word]
        skipped = number - 1 - (self.upto[word] - np.bitwise_count(left))
        for n in range(7):  # clears the lowest mark as often as marks go before the wanted one
            left = np.where(skipped > n, left & (left - _U(1)), left)
        lowest = left & (~left + _U(1))
        return word * 8 + np.bitwise_count(lowest - _U(1)).astype("i8") // 8 + 1


def marked(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[Marks, Marks]:
    """Token ends, and bytes that go on with a code point, of texts that follow each other in ``data``."""
    padded = np.full(len(data) // 8 * 8 + 16, 0x20, "u1")
    padded[: len(data)] = data
    words = padded.view("<u8")
    spaces = space_marks(words)
    next_is_space = spaces >> _U(8)
    next_is_space[:-1] |= spaces[1:] << _U(56)
    tokens = ~spaces & next_is_space & _TOP
    by_byte = tokens.view("u1")
    by_byte[len(data) :] = 0
    by_byte[ends[ends > starts] - 1] = 0x80
    return Marks(tokens), Marks(following_marks(words))


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four numbers that depend on nothing but the seed and the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[at : at + 8], 16) for at in (0, 8, 16, 24))


def _offsets(texts: pa.Array) -> np.ndarray:
    """Where each text starts in the array's bytes, and where the last one ends."""
    if not len(texts):
        return np.zeros(1, "i8")
    return np.frombuffer(texts.buffers()[1], "<i4")[texts.offset : texts.offset + len(texts) + 1].astype("i8")


def _cut_slice(ids: list, texts: pa.Array, seed: int, cut: int, suffix_first: int) -> pa.RecordBatch:
    offsets = _offsets(texts)
    held = texts.buffers()[2]
    data = np.frombuffer(held, "u1")[offsets[0] : offsets[-1]] if held else np.empty(0, "u1")
    starts, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    tokens, following = marked(data, starts, ends)
    before = tokens.before(starts)
    n = tokens.before(ends) - before
    drawn = np.array([draws(i, seed) for i in ids], "u8").astype("i8").reshape(-1, 4)
    places = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
    edges = []
    for units in places.T:
        # The first end that a text without units has is another's; such a text is cut at its start.
        edge = tokens.end_of(np.maximum(before + units, 1))
        edges.append(np.where(units > 0, edge, starts))
    a, b = edges
    letters = [(y - x) - (following.before(y) - following.before(x)) for x, y in ((starts, a), (a, b))]

    raw = data.tobytes()
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    forms, outputs = [], []
    for i, (start, x, y, end) in enumerate(zip(starts.tolist(), a.tolist(), b.tolist(), ends.tolist())):
        text = raw[start:end]
        if not text or drawn[i, 2] % 100 >= cut or p in text or s in text or m in text:
            forms.append(PLAIN)
            outputs.append(text)
            continue
        prefix, middle, suffix = raw[start:x], raw[x:y], raw[y:end]
        if drawn[i, 3] % 100 < suffix_first:
            forms.append(SPM)
            outputs.append(b"".join((s, suffix, p, prefix, m, middle)))
        else:
            forms.append(PSM)
            outputs.append(b"".join((p, prefix, s, suffix, m, middle)))
    plain = np.array([f == PLAIN for f in forms], bool)
    columns = [
        pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
        pa.array(letters[0], pa.int64(), mask=plain), pa.array(letters[1], pa.int64(), mask=plain),
        pa.array(outputs, pa.binary()).cast(pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def _slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows from and to, about ``SLICE`` bytes at a time, one row at least."""
    at = 0
    while at < len(offsets) - 1:
        upto = int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1
        upto = max(at + 1, upto)
        yield at, upto
        at = upto


def transformed(docs: DataFrame, seed: int = SEED, cut: int = CUT, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``doc_id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output``: every row's whole text in its new order.

    ``n`` counts tokens. Cut are ``cut`` of a hundred texts, drawn by seed and
    id alone, and of these ``suffix_first`` of a hundred have the suffix in
    front. A text that is empty or holds one of the signs stays plain, without
    lengths of its parts. A NULL text is empty; a NULL id draws as an empty
    one. Rows with equal ids draw alike, each for its own text; repeated rows
    all stay. Other columns than ``doc_id`` and ``text`` are not read. An empty
    table gives no rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for at, upto in _slices(_offsets(texts)):
                ids = batch.column(0).slice(at, upto - at).to_pylist()
                yield _cut_slice(ids, texts.slice(at, upto - at), seed, cut, suffix_first)

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return whole.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``transformed`` put in another order, from its output and form alone."""
    first, second = F.lit(PREFIX), F.lit(SUFFIX)

    def parts(front: Column, behind: Column) -> tuple[Column, Column, Column]:
        # No part holds a sign, so each sign stands where it is first found.
        rest = F.substr(output, F.length(front) + 1)
        at = F.instr(rest, behind)
        tail = F.substr(rest, at + F.length(behind))
        last = F.instr(tail, MIDDLE)
        return F.substr(rest, F.lit(1), at - 1), F.substr(tail, F.lit(1), last - 1), F.substr(tail, last + len(MIDDLE))

    prefix, suffix, middle = parts(first, second)
    suffix2, prefix2, middle2 = parts(second, first)
    return (
        F.when(form == PSM, F.concat(prefix, middle, suffix))
        .when(form == SPM, F.concat(prefix2, middle2, suffix2))
        .otherwise(output)
    )


def digests(docs: DataFrame) -> DataFrame:
    """What ``transformed`` makes of ``docs``, its output and the text restored from it as SHA-256."""
    rows = transformed(docs)
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
