"""Masked pseudo-likelihood of documents by a bidirectional window network in numpy.

Every token is predicted from the two before and the two after it; a
document's score is the sum of those conditional log-probabilities. The network
adds up place-dependent embeddings of the four neighbours, squashes the sum,
and predicts the token's class and then the token within its class.

Counts cover every token of the corpus, and so does training. The network starts
from the counted frequencies. Documents are dealt by a hash into lanes, whose
number follows from the corpus alone; each lane learns every position of its own
documents, starting from the same weights, and the weights are averaged by the
tokens learnt from. How the input is split therefore changes nothing.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodgetrail.llm import tables

CLASSES, WITHIN = 32, 32
TYPES = CLASSES * WITHIN
#: Types that stand for one word each; the other words share the rest by a hash.
FREQUENT = 896
DIM = 16
SIDES = (-2, -1, 1, 2)
GAP = 2
#: Tokens of a lane, about: the corpus has as many lanes as it takes.
LANE_TOKENS = 2_000_000
#: Tasks that the lanes are dealt over at most; each reads its lanes one after the other.
LANE_TASKS = 20_000
#: Lanes averaged by one task; their averages are averaged in turn.
FAN = 64
BATCH = 4096
#: Tokens read before their positions are mixed and learnt from.
MIXED = BATCH * 32
RATE = 2.5
#: Positions scored at a time.
SCORED = 1 << 13
#: Distinct words that a counting task holds before it hands them on.
HELD = 300_000
#: Weights per row when networks are averaged.
_PART = 8192

_TOKEN = re.compile(r"\w+|[^\w\s]+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def word_counts(docs: DataFrame) -> DataFrame:
    """``word``, ``n`` over all whole texts, summed up in each task before the shuffle."""

    def count(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def taken() -> pd.DataFrame:
            out = pd.DataFrame({"word": list(held.keys()), "n": np.fromiter(held.values(), "i8", len(held))})
            held.clear()
            return out

        for frame in frames:
            for text in frame["text"].tolist():
                held.update(tokens(text))
                if len(held) > HELD:
                    yield taken()
        if held:
            yield taken()

    return docs.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Words with a type of their own, and how many words share each of the other types."""

    frequent: dict[str, int]
    shared: np.ndarray
    #: How often each type occurs in the corpus.
    seen: np.ndarray

    def type_of(self, word: str) -> int:
        found = self.frequent.get(word)
        return found if found is not None else FREQUENT + zlib.crc32(word.encode("utf-8", "replace")) % (TYPES - FREQUENT)

    def log_share(self) -> np.ndarray:
        """Log-probability of a word given its type: words that share one are taken as equally likely."""
        return -np.log(np.concatenate([np.ones(FREQUENT), np.maximum(self.shared, 1)]))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the counts of all words; ties among frequent ones go by the word. Two bounded results reach the driver."""
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT)
    words = [(row["word"], row["n"]) for row in top.collect()]
    # Neighbouring types form a class, so classes hold words of like frequency.
    frequent = {w: i for i, (w, _) in enumerate(words)}
    rest = TYPES - FREQUENT
    kind = F.crc32(F.col("word").cast("binary")) % rest
    shared, seen = np.zeros(rest), np.zeros(TYPES, "i8")
    for row in counts.groupBy(kind.alias("kind")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect():
        shared[row["kind"]] = row["words"]
        seen[FREQUENT + row["kind"]] = row["n"]
    for i, (w, n) in enumerate(words):
        own = zlib.crc32(w.encode("utf-8", "replace")) % rest
        shared[own] -= 1
        seen[FREQUENT + own] -= n
        seen[i] = n
    return Vocabulary(frequent, shared, seen)


class Network:
    """Weights in one flat vector, so that networks can be averaged; type TYPES is the gap around a text."""

    SHAPES = {
        "context": (len(SIDES), TYPES + 1, DIM),
        "bias": (DIM,),
        "classes": (CLASSES, DIM),
        "class_bias": (CLASSES,),
        "words": (CLASSES, WITHIN, DIM),
        "word_bias": (CLASSES, WITHIN),
    }
    SIZE = sum(math.prod(s) for s in SHAPES.values())

    def __init__(self, flat: np.ndarray):
        self.flat, at = flat, 0
        for name, shape in self.SHAPES.items():
            size = math.prod(shape)
            setattr(self, name, flat[at : at + size].reshape(shape))
            at += size

    @classmethod
    def fresh(cls, seed: int = 5) -> Network:
        return cls(np.random.default_rng(seed).normal(0, 0.1, cls.SIZE).astype("f4"))

    @classmethod
    def started(cls, words: Vocabulary, seed: int = 5) -> Network:
        """Predicts the counted frequencies whatever the neighbours: from there, learning adds what they tell."""
        network = cls.fresh(seed)
        cells = (words.seen + 0.5).reshape(CLASSES, WITHIN)
        network.classes[:], network.words[:], network.bias[:] = 0, 0, 0
        network.class_bias[:] = np.log(cells.sum(1) / cells.sum())
        network.word_bias[:] = np.log(cells / cells.sum(1, keepdims=True))
        return network

    def hidden(self, types: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.broadcast_to(self.bias, (len(at), DIM)).copy()
        for side, table in zip(SIDES, self.context):
            total += table[types[at + side]]
        return np.tanh(total)

    def _within(self, hidden: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Scores of the types of each row's class, rows being in order of classes; and each class's stretch of rows."""
        edges = np.searchsorted(classes, np.arange(CLASSES + 1)).tolist()
        stretches = [(c, a, b) for c, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]
        scores = np.empty((len(hidden), WITHIN), "f4")
        for c, a, b in stretches:
            np.matmul(hidden[a:b], self.words[c].T, out=scores[a:b])
        scores += self.word_bias[classes]
        return scores, stretches

    def log_probabilities(self, types: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probability of the type at each place given its neighbours."""
        order = _by_class(types[at])
        own = types[at[order]]
        hidden = self.hidden(types, at[order])
        classes, places = own // WITHIN, own % WITHIN
        logs = _log_chance(hidden @ self.classes.T + self.class_bias, classes)
        logs += _log_chance(self._within(hidden, classes)[0], places)
        out = np.empty_like(logs)
        out[order] = logs
        return out

    def learn(self, types: np.ndarray, at: np.ndarray, rate: float) -> None:
        """One step of gradient descent on these places."""
        at = at[_by_class(types[at])]
        hidden, own = self.hidden(types, at), types[at]
        classes, places = own // WITHIN, own % WITHIN
        rows, step = np.arange(len(at)), np.float32(rate / len(at))
        error = _softmax(hidden @ self.classes.T + self.class_bias)
        error[rows, classes] -= 1
        back = error @ self.classes
        self.classes -= step * (error.T @ hidden)
        self.class_bias -= step * error.sum(0)
        scores, stretches = self._within(hidden, classes)
        error = _softmax(scores)
        error[rows, places] -= 1
        for c, a, b in stretches:
            back[a:b] += error[a:b] @ self.words[c]
            self.words[c] -= 8 * step * (error[a:b].T @ hidden[a:b])
            self.word_bias[c] -= 8 * step * error[a:b].sum(0)
        back *= 1 - hidden * hidden
        self.bias -= step * back.sum(0)
        # Rare neighbours get longer steps, or they would hardly move.
        back *= 30 * step
        cells = np.arange(DIM)
        for side, table in zip(SIDES, self.context):
            np.subtract.at(table.reshape(-1), (types[at + side][:, None] * DIM + cells).ravel(), back.ravel())

    def bounded(self) -> None:
        np.clip(self.flat, -30, 30, out=self.flat)


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(1, keepdims=True)
    np.exp(x, out=x)
    x *= 1 / x.sum(1, keepdims=True)
    return x


def _log_chance(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log of the softmax at one place of each row."""
    x -= x.max(1, keepdims=True)
    own = x[np.arange(len(x)), chosen]
    np.exp(x, out=x)
    return own - np.log(x.sum(1))


def _by_class(types: np.ndarray) -> np.ndarray:
    return np.argsort((types // WITHIN).astype("u1"), kind="stable")


class Reader:
    """Texts to types, each word looked up once."""

    def __init__(self, words: Vocabulary):
        self.words, self.known = words, dict(words.frequent)

    def types(self, text: str | None) -> np.ndarray:
        words = tokens(text)
        found = list(map(self.known.get, words))
        if None in found:
            if len(self.known) > HELD:
                self.known = dict(self.words.frequent)
            self.known.update((w, self.words.type_of(w)) for w, f in zip(words, found) if f is None)
            found = [f if f is not None else self.known[w] for w, f in zip(words, found)]
        return np.array(found, "i4")


def typed(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """``doc_id``, ``types``: each whole text's types as little-endian 16-bit numbers; no bytes for NULL and empty texts."""
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(sent.value)
        for batch in batches:
            # A few texts at a time keep long texts from adding up.
            for a in range(0, batch.num_rows, 512):
                some = batch.slice(a, 512)
                types = [reader.types(t).astype("<u2").tobytes() for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(types, pa.binary())], ["doc_id", "types"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(read, "doc_id long, types binary")


def _types(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2").astype("i4")


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one row of types with gaps around each; the places of tokens and the text each belongs to."""
    gap = np.full(GAP, TYPES, "i4")
    row = np.concatenate([x for t in texts for x in (gap, t)] + [gap])
    at = np.flatnonzero(row != TYPES)
    return row, at, np.repeat(np.arange(len(texts)), [len(t) for t in texts])


def train(docs: DataFrame, words: Vocabulary, lane_tokens: int = LANE_TOKENS) -> Network:
    return train_typed(typed(docs, words), words, lane_tokens)


def dealt(rows: DataFrame, lanes: int) -> DataFrame:
    """``lane``, ``types``: documents by a hash of id and text, each lane in one task and in an order of its own.

    Rows alike in both are told apart by nothing, so their order does not matter.
    """
    hashed = rows.select("doc_id", "types", F.xxhash64("doc_id", "types").alias("_hash"))
    laned = hashed.where(F.length("types") > 0).withColumn("lane", F.pmod("_hash", F.lit(lanes)).cast("int"))
    tasks = min(lanes, LANE_TASKS)
    laned = laned.repartitionById(tasks, F.col("lane") % tasks)
    return laned.sortWithinPartitions("lane", "_hash", "doc_id", "types").select("lane", "types")


def train_typed(rows: DataFrame, words: Vocabulary, lane_tokens: int = LANE_TOKENS) -> Network:
    """Average of networks that each learnt every position of one lane's documents.

    The work grows with the corpus: a lane holds about ``lane_tokens`` tokens,
    and is read as a stream, so a crowded one takes longer, not more memory.
    """
    spark = rows.sparkSession
    start = Network.started(words)
    lanes = max(1, math.ceil(int(words.seen.sum()) / lane_tokens))
    sent = spark.sparkContext.broadcast(start.flat)

    def learn(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lane, own, weight, held, size = None, None, 0, [], 0

        def step() -> int:
            row, at, _ = _joined(held)
            # Neighbouring positions are alike; a fixed shuffle spreads them over the batches.
            mixed = np.random.default_rng(len(at)).permutation(at)
            for a in range(0, len(mixed), BATCH):
                own.learn(row, mixed[a : a + BATCH], RATE)
            own.bounded()
            return len(mixed)

        for frame in frames:
            for number, data in zip(frame["lane"].tolist(), frame["types"].tolist()):
                if number != lane:
                    if own is not None:
                        weight += step() if held else 0
                        yield in_parts(own.flat, lane, weight)
                    lane, own, weight, held, size = number, Network(sent.value.copy()), 0, [], 0
                whole = _types(data)
                for a in range(0, len(whole), MIXED):  # a very long text is learnt in pieces
                    held.append(whole[a : a + MIXED])
                    size += len(held[-1])
                    if size >= MIXED:
                        weight += step()
                        held, size = [], 0
        if own is not None:
            weight += step() if held else 0
            yield in_parts(own.flat, lane, weight)

    flat = averaged(dealt(rows, lanes).mapInPandas(learn, LEARNT), lanes)
    sent.unpersist()
    return start if flat is None else Network(flat)


#: The weights that lanes learnt, in parts of so many.
LEARNT = "part int, lane int, weight double, values binary"


def in_parts(flat: np.ndarray, lane: int, weight: float) -> pd.DataFrame:
    values = [flat[a : a + _PART].astype("f4").tobytes() for a in range(0, len(flat), _PART)]
    return pd.DataFrame({"part": range(len(values)), "lane": lane, "weight": float(weight), "values": values})


def averaged(learnt: DataFrame, lanes: int) -> np.ndarray | None:
    """The lanes' weights averaged, a bounded number of lanes at a time; None where no lane learnt anything."""
    while lanes > FAN:
        learnt = _average(learnt.withColumn("group", (F.col("lane") / FAN).cast("int")))
        lanes = math.ceil(lanes / FAN)
    rows = _average(learnt.withColumn("group", F.lit(0))).orderBy("part").collect()  # one network
    return np.concatenate([np.frombuffer(r["values"], "f4") for r in rows]).copy() if rows else None


def _average(rows: DataFrame) -> DataFrame:
    """The lanes of a ``group`` averaged by weight, part by part and in the lanes' order; the group is the new lane."""

    def mean(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lane")
        total, weight = 0.0, float(pdf["weight"].sum())
        for values, w in zip(pdf["values"], pdf["weight"]):
            total = total + np.frombuffer(values, "f4").astype("f8") * (w / weight)
        group, part = int(pdf["group"].iloc[0]), int(pdf["part"].iloc[0])
        return pd.DataFrame({"part": [part], "lane": [group], "weight": [weight], "values": [total.astype("f4").tobytes()]})

    return rows.groupBy("part", "group").applyInPandas(mean, LEARNT)


def scored(docs: DataFrame, words: Vocabulary, network: Network) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``log_likelihood`` (0 without tokens), ``per_token`` (NULL without tokens).

    NULL texts are empty; every row given has one row.
    """
    return scored_typed(typed(docs, words), words, network)


def scored_typed(rows: DataFrame, words: Vocabulary, network: Network) -> DataFrame:
    """As ``scored``, of rows read before."""
    sent = rows.sparkSession.sparkContext.broadcast((network.flat, words.log_share()))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, share = sent.value
        own = Network(flat)
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                some = batch.slice(a, 64)
                texts = [_types(data) for data in some.column(1).to_pylist()]
                row, at, owner = _joined(texts)
                logs = np.empty(len(at))
                for b in range(0, len(at), SCORED):
                    places = at[b : b + SCORED]
                    logs[b : b + SCORED] = own.log_probabilities(row, places) + share[row[places]]
                sums = np.bincount(owner, logs, len(texts)) if len(at) else np.zeros(len(texts))
                sizes = pa.array([len(t) for t in texts], pa.int64())
                columns = [some.column(0), sizes, pa.array(sums, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "log_likelihood"])

    found = rows.select("doc_id", "types").mapInArrow(score, "doc_id long, n_tokens long, log_likelihood double")
    return found.withColumn("per_token", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")))


def score_documents(docs: DataFrame) -> DataFrame:
    """Counts, trains and scores over the same documents, whose words are looked up once.

    One row per row given, NULL and repeated ids included; NULL, empty and
    wordless texts score 0 with a NULL ``per_token``. Other columns are not read.
    """
    words = vocabulary(tables.stored(word_counts(docs), "word-counts"))
    rows = tables.stored(typed(docs, words), "types")
    return scored_typed(rows, words, train_typed(rows, words))
