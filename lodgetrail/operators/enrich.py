"""Attaching dimension attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def attach(facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """Left outer equi-join keeping both keys; several dimension rows per key fan out.

    The dimension's key is text, so the fact key is compared as text. Neither
    side is hinted: Spark broadcasts the dimension where its size is within
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides,
    where adaptive execution splits a hot (or NULL) key's partition.
    """
    same = facts[fact_key].cast("string") == dimension[dimension_key]
    return facts.join(dimension, same, "left")


def broadcast_if_small(dimension: DataFrame, most_bytes: int) -> DataFrame:
    """The dimension marked for broadcast if its text and its rows come to few enough bytes, else as it is.

    Spark's own threshold is set for tables in general; facts are so much wider
    than a dimension of a few short columns that sparing their shuffle pays for
    far larger broadcasts.
    """
    texts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in dimension.columns]
    # What a row takes beside its texts, once it is part of a hashed relation.
    held = dimension.select((sum(texts, F.lit(0)) + 64).alias("bytes")).agg(F.sum("bytes")).first()[0] or 0
    return F.broadcast(dimension) if held <= most_bytes else dimension


def ambiguous_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Dimension keys with several rows, which would multiply facts, and their row count."""
    return dimension.groupBy(key).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)
