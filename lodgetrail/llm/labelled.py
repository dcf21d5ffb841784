"""Labelled documents: which may be learnt from, all of them in lanes, and a bounded sample of them for fitting."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from lodgetrail.llm import tables
from lodgetrail.operators import enrich

#: Rows a classifier is fitted on at most, chosen by a hash of their id.
FIT_ROWS = 4_000
#: Longer texts are not fitted on (they are scored like any other), so the sample's size is bounded.
FIT_CHARS = 60_000


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text leaves 1 modulo 3. A NULL id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


#: Labels of up to this many bytes go to every executor, which spares texts without a label their shuffle.
BROADCAST_LABELS = 100 << 20


def _known(labels: DataFrame, label: str) -> DataFrame:
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y"))
    return known.where(F.col("y").isin(0, 1) & ~held_out(F.col("_id")))


def fit_rows(docs: DataFrame, labels: DataFrame, label: str, lane_rows: int, lane_chars: int) -> tuple[DataFrame, int]:
    """``_id``, ``y``, ``lane``, ``aside``, ``text``, ``lang`` of all labelled rows that are not held out; how many lanes there are.

    Nothing reaches the driver. A document is in one lane with all its labels
    and texts, each taken once; every fifth label of a lane is set aside. NULL
    labels and texts are left out; ``lang`` is NULL where ``docs`` lacks the column.
    """
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    texts = docs.select(F.col("doc_id").alias("_id"), "text", lang.cast("string").alias("lang")).where(F.col("text").isNotNull())
    sizes = texts.groupBy("_id").agg(F.sum(F.length("text")).alias("_chars"))
    # Ids are settled first, so the texts of the other rows are never moved where labels are few.
    known = tables.stored(_known(labels, label).distinct().join(sizes, "_id"), "labelled-ids")
    n, chars = known.agg(F.count("*"), F.coalesce(F.sum("_chars"), F.lit(0))).first()
    lanes = max(1, -(-n // lane_rows), -(-chars // lane_chars))
    number = F.row_number().over(Window.partitionBy("lane").orderBy("_id", "y"))
    laned = known.select("_id", "y", F.pmod(F.xxhash64("_id"), F.lit(lanes)).cast("int").alias("lane"))
    chosen = enrich.broadcast_if_small(laned.withColumn("aside", number % 5 == 0), BROADCAST_LABELS)
    # A text is told from others of its id by its hash, and taken with the first of its languages.
    found = texts.join(chosen, "_id").withColumn("_print", F.xxhash64("text"))
    rows = found.groupBy("_id", "y", "lane", "aside", "_print").agg(F.min("text").alias("text"), F.min("lang").alias("lang"))
    return tables.stored(rows, "labelled-rows"), lanes


def fit_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = FIT_ROWS, chars: int = FIT_CHARS) -> pd.DataFrame:
    """``text``, ``lang``, ``y`` of at most ``rows`` labelled rows that are not held out.

    ``rows`` times ``chars`` bounds what reaches the driver. ``lang`` is NULL
    where ``docs`` lacks the column. A document with several labels is taken
    once for each; NULL labels and texts are left out.
    """
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    known = _known(labels, label)
    texts = docs.select(F.col("doc_id").alias("_id"), "text", lang.cast("string").alias("lang"))
    # Ids are chosen first, so the texts of the other rows are never sorted or moved.
    chosen = (
        known.join(texts.where(F.length("text") <= chars).select("_id").distinct(), "_id", "left_semi")
        .orderBy(F.xxhash64("_id", F.lit(label)), "_id").limit(rows)
    )
    found = texts.where(F.length("text") <= chars).join(F.broadcast(chosen), "_id")
    return found.dropDuplicates(["_id", "y"]).orderBy("_id", "y").select("text", "lang", "y").toPandas()
