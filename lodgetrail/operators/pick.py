"""Top-1 per key, and the coupon pick by status priority.

Keys here are event row ids: nearly unique in clean data, yet one id may hold a
large share of a day's rows. So nothing funnels a whole id through one task:

* ``top_one`` ranks with a limit of 1, which Spark applies before the shuffle
  too, so each map task sends at most one row per id.
* ``priority_pick`` and ``chosen_positions`` reduce ids by minimum, with
  map-side combine, and join the small result back; see ``join_by_key``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodgetrail.operators import filters


def top_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key; end ``order`` with a unique column to break ties."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .where(filters.at_most(F.col("_rank")))
        .drop("_rank")
    )


def status_positions(
    df: DataFrame, key: str, position: str, status: str, statuses: Sequence[str]
) -> DataFrame:
    """One row per key: the smallest position of each listed status, one column each.

    The list is fixed by the caller, so no job runs to discover statuses and a
    status absent from the data is a NULL column.
    """
    return df.groupBy(key).agg(
        *[F.min(F.when(F.col(status) == F.lit(s), F.col(position))).alias(s) for s in statuses]
    )


def join_by_key(df: DataFrame, per_key: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join a one-row-per-key table onto rows whose keys may be heavily skewed.

    Adaptive execution splits a hot shuffle partition only where both inputs of
    the join come straight out of an exchange the join asked for. An aggregate's
    own partitioning on the key would stand in for that exchange; joining on a
    hash of the key as well keeps it from doing so. Small sides still become
    broadcasts at run time, by measured size.
    """
    hashed = "_key_hash"
    return (
        df.withColumn(hashed, F.xxhash64(key))
        .join(per_key.withColumn(hashed, F.xxhash64(key)), [key, hashed], how)
        .drop(hashed)
    )


def priority_pick(
    df: DataFrame,
    key: str,
    position: str,
    status: str,
    priorities: Sequence[str],
    keep_unmatched: bool = False,
) -> DataFrame:
    """Of opened rows keep, per key, those at the best status's first position.

    The best status is the first of ``priorities`` the key has anywhere. Rows
    without a status always stay, NULL keys never do. Keys of which no row has
    a listed status lose their other rows, unless ``keep_unmatched``.
    """
    chosen = status_positions(df, key, position, status, priorities).select(
        key, F.coalesce(*[F.col(s) for s in priorities]).alias("_chosen")
    )
    keep = filters.at_position_or_null(F.col(position), F.col("_chosen"), F.col(status))
    if keep_unmatched:
        keep = keep | F.col("_chosen").isNull()
    known = df.where(F.col(key).isNotNull())
    # Keys without a status row at all need no partner from the other side.
    return join_by_key(known, chosen, key).where(keep).drop("_chosen")


def chosen_positions(df: DataFrame, key: str, firsts: Sequence[str], shared_only: bool = False) -> DataFrame:
    """Per key, the first non-NULL of the minima of the ``firsts`` columns.

    ``firsts`` hold each row's own first position per status, best status
    first. With ``shared_only``, only keys that occur on several rows.
    """
    minima = df.groupBy(key).agg(*[F.min(c).alias(c) for c in firsts], F.count("*").alias("_rows"))
    if shared_only:
        minima = minima.where(F.col("_rows") > 1)
    return minima.select(key, F.coalesce(*[F.col(c) for c in firsts]).alias("_chosen"))


def shared_keys(df: DataFrame, key: str) -> DataFrame:
    """The non-NULL keys that occur on more than one row."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > 1)
        .select(key)
    )
