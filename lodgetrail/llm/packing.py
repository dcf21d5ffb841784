"""Packing documents into sequences of a fixed size, bin counts certified by lower bounds.

Each partition packs its pieces by best-fit decreasing and compares its bins
with a lower bound from dual feasible functions. Where the two differ, the
documents of bins that are not full are exchanged between those partitions and
packed again, as long as that saves sequences.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodgetrail.llm import encoders, tables

CAPACITY = 1024
END_ID = 2
#: Pieces that one task packs: some 40 bytes each.
PIECES = 50_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = f"{_PIECES}, part int, bin int, offset long, fill long, bins long, bound long"


def cut_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, kept: int = encoders.KEPT
) -> DataFrame:
    """Every whole text as pieces of at most ``capacity`` ids, the end id included.

    Only longer documents are cut, into pieces of ``capacity`` after a first
    piece with what is left over. NULL texts are empty: one piece with the end
    id. NULL and repeated document ids keep all their rows. Other columns than
    ``doc_id`` and ``text`` are not read.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        rows = []
        for doc, ids in zip(batch.column(0).to_pylist(), texts):
            data = memoryview(ids + end)
            n = len(data) // 4
            edges = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
            for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                rows.append((doc, piece, a, b - a, zlib.crc32(data[4 * a : 4 * b])))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return encoders.map_encoded(whole, tokenizer, encoders.LED, cut, _PIECES, kept=kept)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Sequences that these lengths need at least, by two families of dual feasible functions.

    For each threshold k up to half the capacity, lengths over capacity - k
    count as full and those under k as nothing. The second family rounds
    lengths to multiples of a 1/(m+1) of the capacity.
    """
    if not len(lengths):
        return 0
    n = np.bincount(lengths, minlength=capacity + 1).astype("i8")
    sizes = np.arange(capacity + 1)
    count, total = np.cumsum(n), np.cumsum(n * sizes)
    best = math.ceil(total[-1] / capacity)
    for k in range(1, capacity // 2 + 1):
        large = count[-1] - count[capacity - k]
        middle = total[capacity - k] - total[k - 1]
        best = max(best, int(large) + math.ceil(middle / capacity))
    for m in range(1, 101):
        # u(x) = x where x (m + 1) / capacity is whole, else floor(x (m + 1) / capacity) / m
        scaled = sizes * (m + 1)
        exact = scaled % capacity == 0
        # In units of 1 / (m (m + 1)), to stay with whole numbers.
        units = np.where(exact, (scaled // capacity) * m, (scaled // capacity) * (m + 1))
        best = max(best, -(-int((n * units).sum()) // (m * (m + 1))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length: longest first, each into the fullest bin that still takes it."""
    bins, offsets = np.empty(len(lengths), "i4"), np.empty(len(lengths), "i8")
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by the room left
    open_rooms, made = 0, 0  # bit r is set where room[r] has bins
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = open_rooms >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            chosen = room[left].pop()
            if not room[left]:
                open_rooms &= ~(1 << left)
        else:
            left, chosen, made = capacity, made, made + 1
        bins[i], offsets[i] = chosen, capacity - left
        if left > size:
            room[left - size].append(chosen)
            open_rooms |= 1 << (left - size)
    return bins, offsets


def _pack_parts(pieces: DataFrame, parts: int, capacity: int) -> DataFrame:
    """Each of ``parts`` even partitions packed by itself, with its certificate."""
    from pyspark import TaskContext

    def pack(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [f for f in frames if len(f)]
        if not rows:
            return
        all_rows = pd.concat(rows, ignore_index=True)
        lengths = all_rows["length"].to_numpy()
        bins, offsets = best_fit_decreasing(lengths, capacity)
        fills = np.bincount(bins, lengths).astype("i8")
        all_rows["part"] = np.int32(TaskContext.get().partitionId())
        all_rows["bin"], all_rows["offset"], all_rows["fill"] = bins, offsets, fills[bins]
        all_rows["bins"], all_rows["bound"] = len(fills), lower_bound(lengths, capacity)
        yield all_rows

    return pieces.repartition(parts).mapInPandas(pack, _PACKED)


def pack_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, per_part: int = PIECES
) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Pieces with ``sequence_id``, ``offset`` and a certificate, and (sequences, bound) of each round.

    ``pieces`` must be a written table, as it is read several times. Full
    pieces are sequences of their own. Rounds after the first pack only what
    was exchanged: the pieces of bins with room, of partitions whose bins
    exceed their bound; where that is one partition alone, its bins with room
    meet those of all partitions of its round. Rounds go on until every
    partition meets its bound or a round saves nothing, which is dropped; each
    but the last saves a sequence, so they end.

    The certificate is ``packed_sequences``, how many sequences the pieces
    took that were packed with this one, and ``lower_bound``, how many they
    need at least. Sequences without room are their own certificate: 1 and 1.
    """
    columns = [c.split()[0] for c in _PIECES.split(", ")]
    full = pieces.where(F.col("length") == capacity)
    open_pieces = pieces.where(F.col("length") < capacity).select(*columns)

    first = 0  # partitions are numbered on from round to round, so sequence ids do not repeat

    def packed(rows: DataFrame, number: int) -> tuple[DataFrame, int, int, int, int]:
        parts = max(1, math.ceil(rows.count() / per_part))
        done = tables.stored(_pack_parts(rows, parts, capacity), f"packing-{number}")
        # One row per partition, summed: three numbers.
        sums = (
            done.groupBy("part").agg(F.first("bins").alias("bins"), F.first("bound").alias("bound"))
            .agg(F.sum("bins"), F.sum("bound"), F.count_if(F.col("bins") > F.col("bound"))).first()
        )
        return done, sums[0] or 0, sums[1] or 0, sums[2], parts

    open_gap = F.col("bins") > F.col("bound")
    done, bins, bound, gaps, parts = packed(open_pieces, 0)
    history, settled = [(bins, bound)], []
    while gaps:
        gap = (F.lit(True) if gaps == 1 else open_gap) & (F.col("fill") < capacity)
        loose = done.where(gap)
        before = loose.select("part", "bin").distinct().count()
        again, bins, bound, gaps, more = packed(loose.select(*columns), len(history))
        if bins >= before:
            break
        settled.append((first, done.where(~gap)))
        done, first, parts = again, first + parts, more
        history.append((bins, bound))
    one = F.lit(1).cast("long")
    result = full.select(
        *columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        one.alias("packed_sequences"), one.alias("lower_bound"),
    )
    for of, rows in [*settled, (first, done)]:
        sequence = F.shiftleft(F.col("part").cast("long") + of, 32) + F.col("bin")
        by_itself = F.col("fill") == capacity
        result = result.unionByName(
            rows.select(
                *columns, sequence.alias("sequence_id"), "offset",
                F.when(by_itself, one).otherwise(F.col("bins")).alias("packed_sequences"),
                F.when(by_itself, one).otherwise(F.col("bound")).alias("lower_bound"),
            )
        )
    return result, history


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, kept: int = encoders.KEPT
) -> DataFrame:
    """All documents as pieces placed in sequences, gapless from offset 0; ``kept`` as in ``encoders``.

    With the certificate of ``pack_pieces``. No documents give no rows.
    """
    pieces = tables.stored(cut_pieces(docs, tokenizer, capacity, kept=kept), "pieces")
    return pack_pieces(pieces, capacity)[0]
