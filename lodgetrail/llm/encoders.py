"""Token ids of whole texts by the tokenizers library, each distinct stretch of text encoded once per worker.

A text is cut only where the vocabulary's own splitting pattern always ends a
token, so the ids of the cuts, joined, are the ids of the whole text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer
from tokenizers.models import BPE

from lodgetrail.llm.recent import Known

#: Bytes of a generation of stretches that a worker keeps, of two generations at most.
KEPT = 96 << 20

# White space that only some libraries count as such; texts with it are cut by the careful patterns.
_RARE = re.compile(r"[\x1c-\x1f\x85\xa0  -     　]")
_WORDS = re.compile(r"[^ \t\n\r\f\v]+")
_ODD_SPACE = re.compile(r"[^\S \n]|\s\s")
_LED = re.compile(r"\s*\S+(?:[^\S \t\n\r]\s*\S*)*|\s+")

# Signs that, behind a word, every pattern below takes for one token. An apostrophe may be part of one.
_BEHIND = "".join(chr(n) for n in range(33, 127) if not chr(n).isalnum() and chr(n) != "'")
# Letters from here on are left to the whole tokenizer.
_FAR = "\u0250"

# How byte-level vocabularies split a text, and the signs they write bytes with.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SIGNS = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_SPACE = _BYTE_SIGNS[32]
#: The signs of the bytes of each letter that is not left to the whole tokenizer.
_SIGNS = {n: "".join(_BYTE_SIGNS.get(b, chr(b)) for b in chr(n).encode()) for n in range(ord(_FAR))}

#: How a vocabulary may be cut.
LED = "led"  # byte-level: before a run of white space, which then leads its stretch
WORDS = "words"  # white space is never part of a token


def model_text(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def uncached_model(spec: dict) -> BPE:
    """The merging model of a vocabulary, without the library's own table of the words it has merged."""
    if spec["type"] != "BPE":
        raise ValueError(f"only models that merge are supported, not {spec['type']}")
    options = {k: v for k, v in spec.items() if k not in ("type", "vocab", "merges") and v is not None}
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["merges"]]
    return BPE(spec["vocab"], pairs, cache_capacity=0, **options)


def added_ids(listed: list[dict]) -> dict[str, bytes]:
    """The id of each string that a vocabulary finds in a text before anything else."""
    for token in listed:
        if any(token[flag] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added tokens are only supported as they stand, unlike {token}")
    return {token["content"]: array("I", [token["id"]]).tobytes() for token in listed}


class Encoder:
    """Whole texts to ids as little-endian unsigned 32-bit bytes.

    For vocabularies that merge the bytes of a text. Added tokens, such as the
    one for a text's end, are found in a text as the library finds them.
    """

    def __init__(self, model: str, cut: str, kept: int = KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        spec = json.loads(model)
        self.tokenizer = Tokenizer.from_str(model)
        # Stretches are kept here, so the model need not keep them too.
        self.tokenizer.model = uncached_model(spec["model"])
        self.merge = self.tokenizer.model.tokenize
        self.added = added_ids(spec["added_tokens"])
        marks = sorted(self.added, key=len, reverse=True)
        self.split = re.compile(f"({'|'.join(map(re.escape, marks))})").split
        splits = spec["pre_tokenizer"].get("pretokenizers", [{}])
        self.tokens = regex.compile(splits[0].get("pattern", {}).get("Regex") or BYTE_LEVEL).findall
        self.cut, self.lower = cut, cut == WORDS
        #: Stretches as they stand, and by what follows the one space they begin with.
        self.plain = Known(kept if self.lower else kept // 4, self._alone)
        self.spaced = Known(kept, self._after_space)

    def _merged(self, signs: str) -> bytes:
        return array("I", [t.id for t in self.merge(signs)]).tobytes()

    def _after_space(self, rest: str) -> bytes:
        if rest[:1] == "\n":
            return self._ids(rest)
        return self._word(rest, _SPACE, self.spaced) or self._ids(f" {rest}")

    def _alone(self, stretch: str) -> bytes:
        if self.lower and not stretch.islower() and (stretch.isascii() or max(stretch) < _FAR):
            lowered = stretch.lower()
            if lowered != stretch:
                return self.plain[lowered]
        return self._word(stretch, "", self.plain) or self._ids(stretch)

    def _word(self, stretch: str, space: str, known: Known) -> bytes:
        """Ids of a word, with signs behind it or without; none for other stretches."""
        letters = stretch.rstrip(_BEHIND)
        if not letters.isalpha():
            return b""
        ascii = letters.isascii()
        if not ascii and max(letters) >= _FAR:
            return b""
        if len(letters) < len(stretch):
            return known[letters] + self.plain[stretch[len(letters) :]]
        return self._merged(space + (letters if ascii else letters.translate(_SIGNS)))

    def _ids(self, stretch: str) -> bytes:
        """Ids of one stretch, put together from those of its tokens, or found by the whole tokenizer for rarer letters."""
        if not stretch.isascii() and (max(stretch) >= _FAR or _RARE.search(stretch)):
            return array("I", self.tokenizer.encode_batch_fast([stretch], add_special_tokens=False)[0].ids).tobytes()
        tokens = self.tokens(stretch)
        if len(tokens) > 1:
            # A token that begins with a space goes on with other signs: it is a stretch too.
            return b"".join([self.spaced[t[1:]] if t[0] == " " and not t.isspace() else self.plain[t] for t in tokens])
        return b"".join([self._merged(t.translate(_SIGNS)) for t in tokens])

    def encode(self, text: str) -> bytes:
        for mark in self.added:
            if mark in text:
                parts = self.split(text)
                return b"".join([self.added[p] if p in self.added else self._encode(p) for p in parts if p])
        return self._encode(text)

    def _encode(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        if self.cut == WORDS:
            parts = _WORDS.findall(text) if _RARE.search(text) else text.split()
            return b"".join(map(self.plain.__getitem__, parts))
        if _ODD_SPACE.search(text):
            return b"".join(map(self.plain.__getitem__, _LED.findall(text)))
        # One space or line break between words: words stand for themselves with the space before them.
        first, *parts = text.replace("\n", " \n").split(" ")
        start = self.plain[first] if first else b""
        return start + b"".join(map(self.spaced.__getitem__, parts))


_made: dict[tuple[str, str, int], Encoder] = {}


def worker_encoder(model: str, cut: str, kept: int = KEPT) -> Encoder:
    """This worker's encoder; what it has learnt stays for the worker's next task."""
    key = (hashlib.md5(model.encode()).hexdigest(), cut, kept)
    if key not in _made:
        _made[key] = Encoder(model, cut, kept)
    return _made[key]


def map_encoded(
    docs: DataFrame,
    path: str,
    cut: str,
    each: Callable[[pa.RecordBatch, list[bytes]], pa.RecordBatch],
    schema: str,
    text: str = "text",
    kept: int = KEPT,
) -> DataFrame:
    """``each(batch, ids of its texts)`` over all rows. A NULL text counts as empty.

    Workers keep up to ``kept`` bytes of stretches in a generation.
    """
    spark: SparkSession = docs.sparkSession
    model = spark.sparkContext.broadcast(model_text(path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(model.value, cut, kept)
        for batch in batches:
            # A few texts at a time keep long texts from adding up.
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                texts = some.column(some.schema.names.index(text)).to_pylist()
                yield each(some, [encoder.encode(t) if t else b"" for t in texts])

    return docs.mapInArrow(run, schema)


def ids_of(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4")
