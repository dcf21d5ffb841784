"""Token ids as ORC files in document order, with an index, and reading them back.

The ids of a document are one ``array<int>`` row, which ORC run-length encodes;
row indexes and a Bloom filter on the document ids let a reader skip stripes
and row groups. Spark reads the stripes of a large file in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lodgetrail.llm import encoders

END_ID = 2
_ROWS = "doc_id long, row long, part_start long, n_tokens long, ids array<int>"
_WRITER = {
    "compression": "none",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.row.index.stride": "2000",
    "orc.stripe.size": str(64 << 20),
}


def write_tokens(docs: DataFrame, path: str, tokenizer: str, cut: str = encoders.WORDS, end_id: int = END_ID) -> None:
    """Encode every whole text, append ``end_id`` and write the ids in ascending ``doc_id`` order.

    Files follow each other by their part number. Rows hold the document's
    place in its file: ``row`` and ``part_start``, the ids before it there.
    A NULL text is empty and holds the end id alone. NULL ids come first; equal
    ids stand in any order, each row once. Only ``doc_id`` and ``text`` are
    read, whatever other columns there are. An empty table writes no rows.

    The range shuffle carries texts, which are smaller than their ids, and its
    sampling therefore never encodes. Repeated ids are dealt out by their texts.
    """
    end = np.array([end_id], "<u4").tobytes()
    model = docs.sparkSession.sparkContext.broadcast(encoders.model_text(tokenizer))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(F.col("doc_id"), F.xxhash64("text"))
        .sortWithinPartitions("doc_id")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoders.worker_encoder(model.value, cut)
        row = start = 0
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                data = [(encoder.encode(t) if t else b"") + end for t in batch.column(1).to_pylist()]
                counts = np.array([len(d) // 4 for d in data], "i8")
                ends = np.cumsum(counts)
                offsets = np.concatenate([[0], ends]).astype("i4")
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(data), "<i4")))
                rows = np.arange(row, row + len(data))
                columns = [batch.column(0), pa.array(rows), pa.array(start + ends - counts), pa.array(counts), ids]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "part_start", "n_tokens", "ids"])
                row, start = row + len(data), start + int(ends[-1])

    ordered.mapInArrow(run, _ROWS).write.options(**_WRITER).orc(path)


def read_tokens(spark: SparkSession, path: str, only: Column | None = None) -> DataFrame:
    """Documents with their ids; a predicate on ``doc_id`` reaches the row indexes and Bloom filters."""
    rows = spark.read.schema(_ROWS).orc(path)
    return rows if only is None else rows.where(only)


def _part() -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """``part``, ``before``: the ids in all earlier files. One row per file, found without reading ids."""
    files = (
        spark.read.schema(_ROWS).orc(path)
        .groupBy(_part().alias("part"))
        .agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("held"))
    )
    before = F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return files.select("part", F.coalesce(before, F.lit(0)).alias("before"))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``."""
    rows = spark.read.schema(_ROWS).orc(path).select("doc_id", "part_start", _part().alias("part"), "ids")

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            offsets = ids.offsets.to_numpy()
            values = memoryview(ids.values.to_numpy().astype("<i4", copy=False)).cast("B")
            sums = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:])]
            counts = np.diff(offsets).astype("i8")
            columns = [*batch.columns[:3], pa.array(counts), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part_start", "part", "n_tokens", "ids_crc32"])

    read = rows.mapInArrow(digests, "doc_id long, part_start long, part long, n_tokens long, ids_crc32 long")
    return read.join(part_starts(spark, path), "part").select(
        "doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"
    )
