"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Two fingerprints of eight bytes that differ in at most two bits share at least
six of their eight positional bytes. A list of one byte at one position holds
every 256th fingerprint, so its pairs grow with the square of the corpus; the
index therefore posts four positional bytes at a time. With the bytes taken as
four neighbours of two, the six bytes that must match fill at least two of
them, so every link shares one of the six lists of its two fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lodgetrail.llm import components, tables

SHINGLE = 3
MAX_BITS = 2
#: Lists up to this long are paired off; members of longer ones are linked through their neighbours.
LIST = 32
_SEED = 42
# Bits set in each byte value, least significant first.
_BITS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype("i8")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a whole text; 0 without words."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), "i8", len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(shingle, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros((8, 256), "i8")
    for at in range(0, len(starts), 1 << 16):
        part = slice(at, at + (1 << 16))
        values = np.array([hashed(joined[a:b], _SEED) for a, b in zip(starts[part], ends[part])], "<u8")
        by_place = values.view("u1").reshape(-1, 8) + np.arange(0, 2048, 256)
        counts += np.bincount(by_place.ravel(), minlength=2048).reshape(8, 256)
    bits = (counts @ _BITS).ravel()
    return int(np.packbits(2 * bits > len(starts), bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts.tolist()], dtype="int64")

    return prints(text)


def shared_bytes(a: str, b: str) -> str:
    """SQL for the tally of equal positional bytes of two fingerprints."""
    return " + ".join(f"int((shiftrightunsigned({a} ^ {b}, {8 * i}) & 255) = 0)" for i in range(8))


def _postings(prints: DataFrame) -> DataFrame:
    """``list``, ``four``, ``fp``: each fingerprint in the six lists of its positional bytes."""
    twos = [f"(shiftrightunsigned(fp, {16 * i}) & 65535)" for i in range(4)]
    keys = [
        f"struct({n} AS list, shiftleft({twos[i]}, 16) | {twos[j]} AS four)"
        for n, (i, j) in enumerate(combinations(range(4), 2))
    ]
    return prints.select("fp", F.expr(f"explode(array({', '.join(keys)}))").alias("key")).select("key.*", "fp")


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``u``, ``v``: edges that connect distinct ``fp`` wherever at most ``max_bits`` (2 or fewer) bits differ.

    Lists of up to ``LIST`` are paired off: the tally of shared positional
    bytes must reach eight less ``max_bits``, then the bits are counted. A
    longer list is never paired off. Its members are posted under all values
    one bit away; two of them are linked where they meet, which is just where
    at most two bits differ, and no such place has over 65 members.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the index is made for up to two differing bits")
    postings = _postings(prints)
    sizes = postings.groupBy("list", "four").agg(F.count("*").alias("n")).where("n > 1")
    members = tables.stored(postings.join(sizes, ["list", "four"]), "posting-lists")
    pair = (
        "flatten(transform(fps, (a, i) -> transform(filter(slice(fps, i + 2, size(fps)), b -> "
        f"{shared_bytes('a', 'b')} >= {8 - max_bits} AND bit_count(a ^ b) <= {max_bits}), b -> struct(a AS u, b AS v))))"
    )
    short = (
        members.where(F.col("n") <= LIST).groupBy("list", "four").agg(F.collect_list("fp").alias("fps"))
        .select(F.explode(F.expr(pair)).alias("pair")).select("pair.u", "pair.v")
    )
    around = ", ".join(["fp", *[f"fp ^ shiftleft(1L, {b})" for b in range(64)]])
    long = (
        members.where(F.col("n") > LIST).select("fp").distinct()
        .select("fp", F.expr(f"explode(array({around}))").alias("middle"))
        .groupBy("middle").agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1")
    )
    if max_bits == 2:
        edge = "transform(fps, x -> struct(x AS u, array_min(fps) AS v))"
    else:
        # Closer than two bits: only those met at the other side itself.
        near = f"array_contains(fps, middle) AND bit_count(x ^ middle) <= {max_bits}"
        edge = f"transform(filter(fps, x -> {near}), x -> struct(x AS u, middle AS v))"
    edge = F.explode(F.expr(edge))
    far = long.select(edge.alias("pair")).select("pair.u", "pair.v").where("u <> v")
    return short.unionByName(far)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id`` (the smallest id reachable over links) and ``keep`` columns, a row per row given.

    NULL and empty texts have fingerprint zero, linked like any other. Copies
    share a fingerprint and are one node. A component of NULL ids alone has a
    NULL component.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep, fingerprint_column(F.col("text"), shingle).alias("fp"))
    narrow = tables.stored(narrow, "fingerprints")
    nodes = tables.stored(narrow.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    linked = components.components(links(nodes.select("fp"), max_bits))
    own = linked.join(nodes, linked["node"] == nodes["fp"]).select("node", "root", "first")
    least = own.groupBy("root").agg(F.min("first").alias("least"))
    mapped = tables.stored(own.join(least, "root").select("node", "root", "least"), "mapped")
    groups = nodes.join(mapped, nodes["fp"] == mapped["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("group"), F.coalesce("least", "first").alias("component_id")
    )
    return narrow.join(groups, "fp")


def component_table(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group, that of the smallest id (NULLs last), with all columns given.

    Rows are found again by id and a hash of the text; of equal rows, one stays.
    """
    text_hash = tables.unused(docs, "text_hash")
    hashed = docs.withColumn(text_hash, F.xxhash64("text"))
    found = near_duplicates(hashed.select("doc_id", "text", F.col(text_hash).alias("th")), shingle, max_bits, ("th",))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    kept = found.groupBy("group").agg(F.min(order).alias("kept")).select(
        F.col("kept.doc_id").alias("kept_id"), F.col("kept.th").alias("kept_hash")
    )
    same = hashed["doc_id"].cast("long").eqNullSafe(F.col("kept_id")) & (hashed[text_hash] == F.col("kept_hash"))
    rows = hashed.join(kept, same, "left_semi")
    return rows.dropDuplicates(["doc_id", text_hash]).select(*docs.columns)
