"""Token counts of documents for every context limit, from an exact histogram of lengths."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lodgetrail.llm import encoders, tables

#: Lengths are summed in blocks this wide first, so no window holds more than a block or the list of blocks.
BLOCK = 1024


def encoded_lengths(docs: DataFrame, tokenizer: str, cut: str = encoders.LED, text: str = "text") -> DataFrame:
    """``length``: the ids of each whole text. NULL and empty texts have 0; one row per row given."""

    def lengths(_, ids: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([len(i) // 4 for i in ids], pa.int64())], ["length"])

    return encoders.map_encoded(docs.select(text), tokenizer, cut, lengths, "length long", text)


def histogram(lengths: DataFrame) -> DataFrame:
    """``length``, ``documents``: exact, with map-side sums, so a common length costs a row per task."""
    return lengths.groupBy("length").agg(F.count("*").alias("documents"))


def limit_table(hist: DataFrame) -> DataFrame:
    """What each limit keeps, one row per length that occurs.

    ``documents``: of just this length; ``documents_over``: longer than it;
    ``documents_up_to`` and ``tokens_up_to``: of this length or less;
    ``truncated_total``: ids left when every document is cut at this length;
    ``quantile``: the part of all documents that is no longer.

    Between two lengths that occur, truncated totals grow by ``documents_over``
    of the lower one for each id of the limit (``truncated_at``). An empty
    table gives no rows.
    """
    # Read twice below: written, so that no text is encoded twice.
    hist = tables.stored(hist.select("length", "documents"), "length-histogram")
    block = F.floor(F.col("length") / BLOCK).alias("block")
    sized = hist.select("length", "documents", (F.col("length") * F.col("documents")).alias("tokens"), block)
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = sized.groupBy("block").agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t"))
    # One row per block of lengths: as many as the longest document has blocks.
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("later_documents"),
        F.sum("d").over(Window.partitionBy()).alias("all_documents"),
        F.sum("t").over(Window.partitionBy()).alias("all_tokens"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("later_tokens"),
    )
    within = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    over = F.col("later_documents") + F.coalesce(F.sum("documents").over(within), F.lit(0))
    tokens_over = F.col("later_tokens") + F.coalesce(F.sum("tokens").over(within), F.lit(0))
    joined = sized.join(blocks, "block").withColumn("documents_over", over).withColumn("tokens_over", tokens_over)
    up_to = F.col("all_documents") - F.col("documents_over")
    tokens_up_to = F.col("all_tokens") - F.col("tokens_over")
    return joined.select(
        "length",
        "documents",
        "documents_over",
        up_to.alias("documents_up_to"),
        tokens_up_to.alias("tokens_up_to"),
        (tokens_up_to + F.col("length") * F.col("documents_over")).alias("truncated_total"),
        (up_to / F.col("all_documents")).alias("quantile"),
    )


def truncated_at(limits: DataFrame, limit: int) -> int:
    """Ids left when every document is cut at any ``limit`` of 0 or more."""
    below = limits.where(F.col("length") <= limit).orderBy(F.desc("length")).limit(1).collect()
    if below:
        row = below[0]
        return row["truncated_total"] + (limit - row["length"]) * row["documents_over"]
    # No document is that short: each keeps the limit.
    first = limits.orderBy("length").limit(1).collect()
    return limit * (first[0]["documents"] + first[0]["documents_over"]) if first else 0


def length_quantile(limits: DataFrame, part: float) -> int | None:
    """The smallest length that at least this part of the documents does not exceed; None without documents."""
    return limits.where(F.col("quantile") >= part).agg(F.min("length")).first()[0]
