"""Toxic texts by a convolutional classifier over hashed word embeddings, trained in numpy.

A word's embedding is the sum of those of its hashed spelling and beginnings.
Filters one, two and three words wide run over the whole text; the largest
response of each feeds a logistic output.

All labelled rows are learnt from. They are dealt into lanes, which learn from
a common start, the counts of the whole corpus, and are averaged.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lodgetrail.llm import labelled, lm, tables

BUCKETS = 1 << 15
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
GAP = max(WIDTHS) - 1
#: Words a worker keeps before it starts anew: about 350 bytes each.
KEPT = 130_000
#: A text counts as toxic from here, unless its language was given a threshold of its own.
THRESHOLD = 0.7
#: Validation documents of either class that a language needs for a threshold of its own.
ENOUGH = 20
#: Batches of 64 that a model learns from at least, going over its rows again where they are fewer; of each lane where there are several.
STEPS, LANE_STEPS = 250, 125
#: Rows and characters of a lane, about: the corpus has as many lanes as it takes.
LANE_ROWS, LANE_CHARS = 20_000, 1 << 26

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def word_features(word: str) -> tuple[int, ...]:
    """Buckets of the spelling and of its first four and five letters."""
    return tuple(crc32(part.encode("utf-8", "replace"), n) % BUCKETS for n, part in enumerate((word, word[:4], word[:5])))


@dataclass
class Model:
    embeddings: np.ndarray  # BUCKETS x DIM
    filters: list[np.ndarray]  # per width: width x DIM x FILTERS
    biases: np.ndarray  # over all filters
    weights: np.ndarray
    offset: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = THRESHOLD

    def threshold_of(self, lang: str | None) -> float:
        return self.thresholds.get(lang, self.threshold)

    def output(self, pooled: np.ndarray) -> np.ndarray:
        logits = np.clip(np.maximum(pooled + self.biases, 0) @ self.weights + self.offset, -30, 30)
        return 1 / (1 + np.exp(-logits.astype("f8")))


class Scorer:
    """Scores texts; keeps each word's filter responses once computed."""

    def __init__(self, model: Model, kept: int = KEPT):
        self.model, self.kept = model, kept
        # One column block per width and place: what a word adds to a window there.
        self.places = np.concatenate([w[k] for w in model.filters for k in range(len(w))], axis=1)
        self._start()

    def _start(self) -> None:
        self.rows: dict[str, int] = {"": 0}  # row 0 is the gap between texts
        self.responses = np.zeros((4096, self.places.shape[1]), "f4")

    def _lookup(self, words: list[str]) -> np.ndarray:
        found = list(map(self.rows.get, words))
        if None in found:
            new = {w for w, row in zip(words, found) if row is None}
            if len(self.rows) + len(new) > self.kept:
                self._start()
                new = set(words)
            at = len(self.rows)
            while at + len(new) > len(self.responses):
                self.responses = np.concatenate([self.responses, np.zeros_like(self.responses)])
            features = np.array([word_features(w) for w in new])
            self.responses[at : at + len(new)] = self.model.embeddings[features].sum(1) @ self.places
            self.rows.update((w, at + n) for n, w in enumerate(new))
            found = list(map(self.rows.__getitem__, words))
        return np.array(found, "i8")

    def pooled(self, texts: list[str | None]) -> np.ndarray:
        """Largest response of every filter in each text; windows may run into the gap after it."""
        out = np.empty((len(texts), FILTERS * len(WIDTHS)), "f4")
        for n, text in enumerate(texts):
            words = words_of(text)
            # An empty text is one window of gap.
            ids = np.concatenate([self._lookup(words), np.zeros(GAP + (not words), "i8")])
            windows, best = len(ids) - GAP, None
            for at in range(0, windows, 1 << 14):
                size = min(1 << 14, windows - at)
                found = self.responses[ids[at : at + size + GAP]]
                tops, column = [], 0
                for width in WIDTHS:
                    sums = found[:size, column : column + FILTERS]
                    for k in range(1, width):
                        column += FILTERS
                        sums = sums + found[k : k + size, column : column + FILTERS]
                    column += FILTERS
                    tops.append(sums.max(0))
                top = np.concatenate(tops)
                best = top if best is None else np.maximum(best, top)
            out[n] = best
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return self.model.output(self.pooled(texts))


def _features(texts: Iterable[str]) -> Iterator[np.ndarray]:
    """Per text, the buckets of its words."""
    known: dict[str, tuple[int, ...]] = {}
    for text in texts:
        if len(known) > KEPT:
            known.clear()
        rows = [known.get(w) or known.setdefault(w, word_features(w)) for w in words_of(text)]
        yield np.array(rows, "i4").reshape(-1, 3)


@dataclass
class Counts:
    """What training starts from: rows of either class, and in how many of them each bucket occurs."""

    rows: np.ndarray
    buckets: np.ndarray

    @classmethod
    def none(cls) -> Counts:
        return cls(np.zeros(2, "i8"), np.zeros((2, BUCKETS), "i8"))

    def add(self, features: np.ndarray, label: int) -> None:
        self.rows[label] += 1
        self.buckets[label, np.unique(features)] += 1

    def evidence(self) -> np.ndarray:
        """Smoothed log-odds of each bucket: where the first dimension starts."""
        counts, totals = self.buckets + 0.5, self.rows + 1.0
        return np.log(counts[1] / totals[1]) - np.log(counts[0] / totals[0])


def _model(params: list[np.ndarray]) -> Model:
    embeddings, *filters, biases, weights, offset = params
    return Model(embeddings, filters, biases, weights, float(offset[0]))


def _fresh(rng: np.random.Generator) -> list[np.ndarray]:
    embeddings = rng.normal(0, 0.05, (BUCKETS, DIM)).astype("f4")
    filters = [rng.normal(0, 0.2, (w, DIM, FILTERS)).astype("f4") for w in WIDTHS]
    total = FILTERS * len(WIDTHS)
    return [embeddings, *filters, np.zeros(total, "f4"), np.full(total, 0.1, "f4"), np.zeros(1, "f4")]


def _one_class(counts: Counts, seed: int = 7) -> Model:
    """The share of the only class as every score."""
    *params, weights, offset = _fresh(np.random.default_rng(seed))
    share = float(counts.rows[1] / counts.rows.sum()) if counts.rows.any() else 0.0
    offset[0] = np.log((share + 0.01) / (1.01 - share))
    return _model([*params, np.zeros_like(weights), offset])


def train(texts: list[str], y: np.ndarray, steps: int = STEPS) -> Model:
    """Fit by Adam on logistic loss, both classes weighing the same. One class alone gives its share as every score."""
    y = np.asarray(y, "i8")
    features = list(_features(texts))
    counts = Counts.none()
    for f, label in zip(features, y):
        counts.add(f, label)
    return _model(_learn(features, y, counts, steps)) if counts.rows.all() else _one_class(counts)


def _learn(
    features: list[np.ndarray], y: np.ndarray, counts: Counts, steps: int, batch: int = 64, rate: float = 0.01, seed: int = 7
) -> list[np.ndarray]:
    """Weights after whole passes over the rows, as many as come to ``steps`` batches, from where ``counts`` has them start."""
    rng = np.random.default_rng(seed)
    params = _fresh(rng)
    embeddings, *filters, biases, weights, offset = params
    embeddings[:, 0] = np.clip(counts.evidence(), -3, 3)
    for f in filters:
        f[:, 0, :] = rng.uniform(0.1, 0.5, (len(f), FILTERS)) * np.sign(rng.normal(0.5, 1, (1, FILTERS)))
    offset[0] = -1
    class_weight = counts.rows.sum() / (2 * counts.rows)
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    while step < steps:
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            grads = [np.zeros_like(p) for p in params[1:]]
            touched, pushed = [], []
            for i in chosen:
                ids = features[i]
                emb = np.zeros((max(1, len(ids)) + GAP, DIM), "f4")
                if len(ids):
                    emb[: len(ids)] = embeddings[ids].sum(1)
                size = max(1, len(ids))
                tops, places = [], []
                for f in filters:
                    response = sum(emb[k : k + size] @ f[k] for k in range(len(f)))
                    best = response.argmax(0)
                    places.append(best)
                    tops.append(response[best, np.arange(FILTERS)])
                pooled = np.concatenate(tops) + biases
                hidden = np.maximum(pooled, 0)
                p = 1 / (1 + np.exp(-np.clip(hidden @ weights + offset[0], -30, 30)))
                error = np.float32((p - y[i]) * class_weight[y[i]] / len(chosen))
                grads[-1][0] += error
                grads[-2] += error * hidden
                back = error * weights * (pooled > 0)
                grads[-3] += back
                for n, (f, best) in enumerate(zip(filters, places)):
                    own = back[n * FILTERS : (n + 1) * FILTERS]
                    for k in range(len(f)):
                        grads[n][k] += emb[best + k].T * own
                        real = best + k < len(ids)
                        if real.any():
                            gradient = (f[k] * own).T[real]
                            touched.append(ids[best[real] + k].ravel())
                            pushed.append(np.repeat(gradient, 3, axis=0))
            step += 1
            for n, grad in enumerate(grads, 1):
                _adam(params[n], first[n], second[n], grad, step, rate, slice(None))
            if touched:
                rows, where = np.unique(np.concatenate(touched), return_inverse=True)
                grad = np.zeros((len(rows), DIM), "f4")
                np.add.at(grad, where, np.concatenate(pushed))
                _adam(embeddings, first[0], second[0], grad, step, rate, rows)
    return params


def _adam(param, first, second, grad, step, rate, rows) -> None:
    first[rows] = 0.9 * first[rows] + 0.1 * grad
    second[rows] = 0.99 * second[rows] + 0.01 * grad * grad
    up = first[rows] / (1 - 0.9**step)
    param[rows] -= rate * up / (np.sqrt(second[rows] / (1 - 0.99**step)) + 1e-6)


#: Thresholds that calibration tries.
TRIED = np.linspace(0.5, 0.9, 41)


def _best_threshold(reached: Iterable[tuple[int, int, int]]) -> float:
    """The middle of the stretch of thresholds with the highest F1, kept within 0.5 and 0.9.

    ``reached`` tells, by label and how many of the thresholds a score reaches, the number of documents.
    """
    passed, positives = np.zeros((2, len(TRIED)), "i8"), 0
    for label, thresholds, n in reached:
        passed[label, :thresholds] += n
        positives += n * label
    f1 = [2 * hits / max(1, every + positives) for hits, every in zip(passed[1], passed.sum(0))]
    best = TRIED[np.isclose(f1, max(f1))]
    return float(best[len(best) // 2])


def _counted(rows: DataFrame) -> Counts:
    """Counted in every task and summed up; what reaches the driver is as large as the table of buckets."""

    def count(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Counts.none()
        for frame in frames:
            for features, label in zip(_features(frame["text"]), frame["y"].tolist()):
                own.add(features, label)
        for label in (0, 1):
            at = np.flatnonzero(own.buckets[label])
            yield pd.DataFrame({"y": label, "bucket": [-1, *at], "n": [own.rows[label], *own.buckets[label, at]]})

    counted, parts = Counts.none(), rows.select("text", "y").mapInPandas(count, "y int, bucket int, n long")
    for row in parts.groupBy("y", "bucket").agg(F.sum("n").alias("n")).collect():
        if row["bucket"] < 0:
            counted.rows[row["y"]] = row["n"]
        else:
            counted.buckets[row["y"], row["bucket"]] = row["n"]
    return counted


def _learnt(rows: DataFrame, lanes: int, counts: Counts) -> Model:
    """The average of models that each learnt all rows of one lane, from the same start."""
    sent = rows.sparkSession.sparkContext.broadcast(counts)
    shapes = [p.shape for p in _fresh(np.random.default_rng(0))]
    steps = STEPS if lanes == 1 else LANE_STEPS

    def learn(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lane, features, y = None, [], []

        def finished() -> pd.DataFrame:
            params = _learn(features, np.array(y, "i8"), sent.value, steps)
            return lm.in_parts(np.concatenate([p.ravel() for p in params]), lane, len(y))

        for frame in frames:
            for number, found, label in zip(frame["lane"].tolist(), _features(frame["text"]), frame["y"].tolist()):
                if number != lane:
                    if y:
                        yield finished()
                    lane, features, y = number, [], []
                features.append(found)
                y.append(label)
        if y:
            yield finished()

    dealt = rows.repartitionById(min(lanes, lm.LANE_TASKS), F.col("lane") % min(lanes, lm.LANE_TASKS))
    dealt = dealt.sortWithinPartitions("lane", "_id", "y", "_print").select("lane", "text", "y")
    flat = lm.averaged(dealt.mapInPandas(learn, lm.LEARNT), lanes)
    sent.unpersist()
    edges = np.cumsum([int(np.prod(shape)) for shape in shapes])[:-1]
    return _model([part.reshape(shape).copy() for part, shape in zip(np.split(flat, edges), shapes)])


def _calibrate(model: Model, aside: DataFrame) -> None:
    """Thresholds by the scores of rows that were not learnt from, counted by Spark."""
    scored = aside.select("lang", "y", score(model, aside.sparkSession, F.col("text")).alias("score"))
    reached = sum((F.col("score") >= float(t)).cast("int") for t in TRIED)
    counts = tables.stored(
        scored.groupBy("lang", "y", reached.alias("reached")).agg(F.count("*").alias("n")), "toxicity-calibration"
    )
    every = counts.groupBy("y", "reached").agg(F.sum("n").alias("n")).collect()
    if len({row["y"] for row in every}) == 2:
        model.threshold = _best_threshold((r["y"], r["reached"], r["n"]) for r in every)
    of_class = [F.coalesce(F.sum(F.when(F.col("y") == label, F.col("n"))), F.lit(0)) for label in (0, 1)]
    enough = counts.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.least(*of_class).alias("_least"))
    by_lang: dict[str, list] = {}
    for row in counts.join(enough.where(F.col("_least") >= ENOUGH), "lang").collect():
        by_lang.setdefault(row["lang"], []).append((row["y"], row["reached"], row["n"]))
    model.thresholds.update((lang, _best_threshold(own)) for lang, own in by_lang.items())


_scorers: dict[int, tuple[object, Scorer]] = {}


def score(model: Model, spark, text: Column) -> Column:
    """Toxicity of whole texts from 0 to 1; NULL and empty texts have the score of no words."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(sent.value)
        for texts in batches:
            yield pd.Series(scorer.scores(texts.tolist()))

    return scored(text)


def threshold_by_language(model: Model, lang: Column) -> Column:
    chosen = F.lit(model.threshold)
    for name, value in sorted(model.thresholds.items()):
        chosen = F.when(lang == name, F.lit(value)).otherwise(chosen)
    return chosen


def fit(docs: DataFrame, labels: DataFrame, lane_rows: int = LANE_ROWS, lane_chars: int = LANE_CHARS) -> Model:
    """Train on four fifths of all labelled rows that are not held out, and calibrate thresholds by language on the rest.

    Whole texts of any length are learnt from, in lanes of about ``lane_rows``
    rows and ``lane_chars`` characters at most, whose number follows from the
    corpus alone. Languages with few validation documents of a class take the
    common threshold.
    """
    rows, lanes = labelled.fit_rows(docs, labels, "toxic", lane_rows, lane_chars)
    counts = _counted(rows.where(~F.col("aside")))
    model = _learnt(rows.where(~F.col("aside")), lanes, counts) if counts.rows.all() else _one_class(counts)
    _calibrate(model, rows.where("aside"))
    return model


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` and the language's own ``threshold`` and ``rejected``.

    One row per row given, NULL and repeated ids included. ``lang`` chooses the
    threshold of ``rejected`` and nothing else; without the column all rows
    have the common one.
    """
    model = fit(docs, labels)
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    read = docs.select("doc_id", "text", lang.alias("lang"))
    rows = read.select("doc_id", "lang", score(model, docs.sparkSession, F.col("text")).alias("score"))
    threshold = threshold_by_language(model, F.col("lang"))
    return rows.select(
        "doc_id",
        labelled.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        threshold.alias("threshold"),
        (F.col("score") >= threshold).alias("rejected"),
    )


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose score stays under their language's threshold, with all columns given."""
    model = fit(docs, labels)
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    kept = score(model, docs.sparkSession, F.col("text")) < threshold_by_language(model, lang)
    return docs.where(kept)
