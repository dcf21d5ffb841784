"""Vectors to search: which take part, repeated ones once, and rows packed into blocks for numpy."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` long and ``vec`` array of double of the rows that take part.

    Left out: NULL ids, NULL vectors, vectors holding NULL or non-finite
    components, and vectors of another length than the most common one (of
    equally common ones the shorter). Of rows that share an id, the least
    vector counts, so each id is one vector.
    """
    vec = F.col(vector).cast("array<double>")
    rows = df.select(F.col(key).cast("long").alias("id"), vec.alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & F.coalesce(finite, F.lit(False)))
    # One row per length that occurs, of which one is taken.
    common = rows.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    size = common["n"] if common else 1
    return rows.where(F.size("vec") == size).groupBy("id").agg(F.min("vec").alias("vec"))


def fewest(rows: DataFrame, keep: int) -> DataFrame:
    """Of each set of equal vectors, the ``keep`` smallest ids: no others can be among the nearest ``keep - 1``.

    The limit is applied before the shuffle too, so a vector that a third of
    the rows share sends ``keep`` rows per task.
    """
    rank = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    return rows.withColumn("_n", rank).where(F.col("_n") <= keep).drop("_n")


def best(found: DataFrame, k: int, *more: str) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` and ``more``: the ``k`` highest scores, ties to smaller ids."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", *more)


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype("f8")


def blocks(n: int, size: int) -> int:
    return max(1, math.ceil(n / size))


def dealt(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(parts)).cast("int")


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]
