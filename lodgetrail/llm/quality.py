"""Document quality by hierarchical empirical Bayes.

A logistic classifier turns a text's surface into evidence. Sums of that
evidence by host and by path below it, shrunk towards the host and towards the
whole corpus, give each document the prior it is judged with.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lodgetrail.llm import labelled, tables

_MARKS = "!|#*%&$?<>{}[]=_/\\@~^"
_LIMIT = 1e-4
KEEP_FROM = 0.5


def features(text: str | None) -> np.ndarray:
    """What the surface of a whole text looks like; all zero but the constant for texts without words."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return np.array([1.0] + [0.0] * 11)
    chars = len(text)
    marks = [text.count(m) for m in _MARKS]
    repeated = sum(map(operator.eq, words, words[1:])) / n
    lines = text.split("\n")
    shares = [
        sum(map(str.isupper, words)) / n,
        sum(marks) / n,
        marks[0] / n,
        marks[1] / n,
        repeated,
        1 - len(set(lines)) / len(lines),
        sum(map(str.isdigit, words)) / n,
        1 - len(set(words)) / n,
    ]
    return np.array([1.0, *np.log(np.array(shares) + 0.01) - np.log(0.01), chars / n / 10, np.log(n) / 10, float(n < 5)])


@dataclass
class Evidence:
    """Logistic weights; ``prior`` is the share of good documents fitted on."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def chances(self, texts: list[str | None]) -> np.ndarray:
        x = (np.array([features(t) for t in texts]).reshape(-1, 12) - self.mean) / self.scale
        p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
        return np.clip(p, _LIMIT, 1 - _LIMIT)


def fit(sample: pd.DataFrame, ridge: float = 1.0, steps: int = 30) -> Evidence:
    """Newton's method on a bounded sample. Without both classes, no text is evidence of anything."""
    y = sample["y"].to_numpy("f8") if len(sample) else np.zeros(0)
    prior = float(np.clip((y.sum() + 1) / (len(y) + 2), 0.01, 0.99))
    x = np.array([features(t) for t in sample["text"]]).reshape(-1, 12)
    mean, scale = np.zeros(12), np.ones(12)
    weights = np.zeros(12)
    weights[0] = np.log(prior / (1 - prior))
    if len(np.unique(y)) == 2:
        mean, scale = x.mean(0), x.std(0) + 1e-3
        mean[0], scale[0] = 0, 1
        x = (x - mean) / scale
        penalty = np.full(12, ridge)
        penalty[0] = 0
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            curve = x.T @ (x * (p * (1 - p))[:, None]) + np.diag(penalty + 1e-6)
            weights = weights - np.linalg.solve(curve, x.T @ (p - y) + penalty * weights)
    return Evidence(mean, scale, weights, prior)


def chance(evidence: Evidence, spark, text: Column) -> Column:
    """Chance that a text is good by itself."""
    sent = spark.sparkContext.broadcast(evidence)

    @F.pandas_udf("double")
    def chances(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(sent.value.chances(texts.tolist()))

    return chances(text)


def _concentration(groups: DataFrame, mean: Column, of: Column, n: str, s: str) -> float:
    """How many documents a parent's mean weighs, by the method of moments over groups of two or more."""
    p = F.col(s) / F.col(n)
    rows = groups.where(F.col(n) > 1)
    moments = rows.agg(
        F.count("*").alias("groups"),
        F.avg((p - mean) ** 2).alias("spread"),
        F.avg(of * (1 - of) / F.col(n)).alias("noise"),
        F.avg(of * (1 - of)).alias("within"),
    ).first()
    if not moments["groups"] or moments["groups"] < 2:
        return 100.0
    between = max(moments["spread"] - moments["noise"], moments["within"] * 1e-4)
    return float(np.clip(moments["within"] / between - 1, 1.0, 1e4))


def site_priors(scored: DataFrame) -> DataFrame:
    """``host``, ``path``, ``documents``, ``good``, ``host_mean``, ``path_weight`` from ``host``, ``path``, ``chance``.

    Sums are made in each task first, so a host with a third of all rows sends
    one row per task and path. NULL hosts and paths are sites like any other.
    """
    paths = scored.groupBy("host", "path").agg(F.count("*").alias("documents"), F.sum("chance").alias("good"))
    paths = tables.stored(paths, "site-paths")
    hosts = paths.groupBy("host").agg(F.sum("documents").alias("host_documents"), F.sum("good").alias("host_good"))
    total = hosts.agg(F.sum("host_documents").alias("n"), F.sum("host_good").alias("s")).first()
    mean = F.lit((total["s"] or 0.0) / (total["n"] or 1))
    weight = _concentration(hosts, mean, mean, "host_documents", "host_good")
    host_mean = (F.col("host_good") + weight * mean) / (F.col("host_documents") + weight)
    hosts = hosts.select(F.col("host").alias("_host"), host_mean.alias("host_mean"))
    both = paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    path_weight = _concentration(both, F.col("host_mean"), F.col("host_mean"), "documents", "good")
    return both.withColumn("path_weight", F.lit(path_weight))


def posterior(own: Column, site: Column, prior: float) -> Column:
    """Chance of a good document given its text and its site, the document itself left out of the site's sums."""
    good, documents, weight = (site.getField(f) for f in ("good", "documents", "path_weight"))
    mean = (good - own + weight * site.getField("host_mean")) / (documents - 1 + weight)
    mean = F.greatest(F.lit(0.01), F.least(F.lit(0.99), mean))
    odds = F.log(own / (1 - own)) - float(np.log(prior / (1 - prior))) + F.log(mean / (1 - mean))
    return 1 / (1 + F.exp(-odds))


def _with_site(rows: DataFrame, sites: DataFrame, host: str, path: str, name: str) -> DataFrame:
    sites = sites.select(F.struct("*").alias(name))
    same = F.col(host).eqNullSafe(F.col(f"{name}.host")) & F.col(path).eqNullSafe(F.col(f"{name}.path"))
    return rows.join(sites, same)


def _site(docs: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in docs.columns else F.lit(None).cast("string")


def scored_documents(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """``doc_id``, ``chance`` by the text alone, ``posterior`` and ``keep``.

    One row per row given, NULL and repeated ids included; NULL and empty texts
    are judged as texts without words. A column that is missing makes one site.
    """
    evidence = fit(labelled.fit_sample(docs, labels, "quality"))
    own = chance(evidence, docs.sparkSession, F.col("text"))
    narrow = docs.select("doc_id", _site(docs, host).alias("host"), _site(docs, path).alias("path"), own.alias("chance"))
    narrow = tables.stored(narrow, "quality-scores")
    final = posterior(F.col("chance"), F.col("site"), evidence.prior)
    return _with_site(narrow, site_priors(narrow), "host", "path", "site").select(
        "doc_id", "chance", final.alias("posterior"), (final >= KEEP_FROM).alias("keep"),
        labelled.held_out(F.col("doc_id")).alias("held_out"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """The rows with a posterior of a half or more, with all columns given.

    NULL and empty texts are judged as texts without words, NULL hosts and paths
    as sites like any other; a column that is missing makes one site. Repeated
    rows are judged alike, columns of any name pass. The texts are judged once
    and written with their chances; an empty table gives an empty one.
    """
    evidence = fit(labelled.fit_sample(docs, labels, "quality"))
    h, p, c, site = (tables.unused(docs, f"own_{x}") for x in ("host", "path", "chance", "site"))
    own = chance(evidence, docs.sparkSession, F.col("text"))
    rows = tables.stored(docs.withColumns({h: _site(docs, host), p: _site(docs, path), c: own}), "quality-texts")
    sites = site_priors(rows.select(F.col(h).alias("host"), F.col(p).alias("path"), F.col(c).alias("chance")))
    good = posterior(F.col(c), F.col(site), evidence.prior) >= KEEP_FROM
    return _with_site(rows, sites, h, p, site).where(good).select(*docs.columns)
