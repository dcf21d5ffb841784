"""Encoding, token files, packing and length counts against the tokenizer libraries used plainly."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from brute import HARD
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodgetrail.llm import counts, encoders, fst, orc_tokens, packing

BYTE, WORD, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string"


def plain(path: str, text: str | None) -> list[int]:
    tokenizer = Tokenizer.from_file(path)
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def odd_texts(n: int) -> list[str]:
    rng = random.Random(4)
    signs = " \n\tabeinst's  …éñ漢🎉\x00́x1▁.,!\x1c\x85\xa0 İΣσς"
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def marked_texts(n: int) -> list[str]:
    """Texts that hold the vocabularies' added tokens, whole and in part, also next to each other."""
    rng = random.Random(5)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "<", "|>", " ", "  ", "\n", "a", "'s", "é", "漢", "."]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(n)]


@pytest.fixture(scope="module")
def hard(spark):
    # Columns whose names clash with those of the results.
    rows = [(i, t, "x", 1, "y") for i, t in HARD]
    return spark.createDataFrame(rows, f"{SCHEMA}, ids string, length int, start string")


@pytest.mark.parametrize("path,cut", [(BYTE, encoders.LED), (WORD, encoders.WORDS)])
@pytest.mark.parametrize("kept", [5, 2_000, 10 << 20])
def test_cut_texts_have_the_ids_of_the_whole(path, cut, kept):
    encoder = encoders.Encoder(encoders.model_text(path), cut, kept)
    tokenizer = Tokenizer.from_file(path)
    texts = odd_texts(1500) + [t for _, t in HARD if t] + marked_texts(1500)
    texts += ["x'll  'll 's\n's Don'T \n 't we've  \t!'s ''s ' s", "one two,two two, (two) TWO Two2two", "漢字" * 3000, "Ab," * 9000]
    for text, whole in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert encoders.ids_of(encoder.encode(text)).tolist() == whole.ids, repr(text)


def test_token_files_hold_every_row_in_order(spark, hard, tmp_path):
    path = str(tmp_path / "ids")
    orc_tokens.write_tokens(hard, path, WORD)
    got = [tuple(r) for r in orc_tokens.token_index(spark, path).collect()]
    expected = Counter()
    for i, text in HARD:
        ids = np.array([*plain(WORD, text), 2], "<u4")
        expected[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((i, n, c) for i, _, n, c in got) == expected
    ordered = sorted(got, key=lambda r: r[1])
    assert [r[1] for r in ordered] == [0, *np.cumsum([r[2] for r in ordered])[:-1]]
    assert [r[0] for r in ordered] == sorted((r[0] for r in got), key=lambda i: (i is not None, i))
    found = orc_tokens.read_tokens(spark, path, F.col("doc_id") == 3)
    assert [r["ids"] for r in found.collect()] == [[2]]
    assert "PushedFilters" in found._jdf.queryExecution().toString()


def test_token_files_of_no_documents(spark, tmp_path):
    path = str(tmp_path / "none")
    orc_tokens.write_tokens(spark.createDataFrame([], SCHEMA), path, WORD)
    assert orc_tokens.token_index(spark, path).count() == 0


def test_packing_is_whole_and_gapless(hard):
    rows = packing.pack_documents(hard, BYTE).collect()
    by_doc, expected = Counter(), Counter()
    for r in rows:
        by_doc[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
    for i, text in HARD:
        ids = np.array([*plain(BYTE, text), 2], "<u4")
        first = (len(ids) - 1) % 1024 + 1
        edges = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(edges, edges[1:])):
            expected[i, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert by_doc == expected
    sequences: dict[int, list] = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 1024


def test_packing_nothing(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), BYTE).count() == 0


def fewest_bins(lengths: list[int], capacity: int) -> int:
    """By trying all ways; for a handful of lengths."""
    best = len(lengths)

    def put(n: int, bins: list[int]) -> None:
        nonlocal best
        if len(bins) >= best:
            return
        if n == len(lengths):
            best = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + lengths[n] <= capacity:
                put(n + 1, [*bins[:b], bins[b] + lengths[n], *bins[b + 1 :]])
        put(n + 1, [*bins, lengths[n]])

    put(0, [])
    return best


def test_lower_bounds_never_exceed_the_fewest_bins():
    rng = random.Random(2)
    for _ in range(60):
        lengths = [rng.randint(1, 64) for _ in range(rng.randint(1, 8))]
        bound = packing.lower_bound(np.array(lengths), 64)
        bins, _ = packing.best_fit_decreasing(np.array(lengths), 64)
        assert bound <= fewest_bins(lengths, 64) <= bins.max() + 1
    # 33 of 64 never go together: the sum alone would allow six.
    assert packing.lower_bound(np.array([33] * 10), 64) == 10


def test_exchanges_save_sequences(spark, tmp_path):
    # Some three pieces go together: few at a time miss the bound, which more would meet.
    rng = random.Random(4)
    lengths = [rng.randint(250, 430) for _ in range(180)] + [1024, 1024]
    rows = [(n, 0, 0, size, 0) for n, size in enumerate(lengths)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    packed, history = packing.pack_pieces(pieces, 1024, per_part=9)
    packed = packed.collect()
    assert sorted(r["doc_id"] for r in packed) == list(range(len(lengths)))
    used = len({r["sequence_id"] for r in packed})
    assert len(history) > 1 and used < history[0][0] + 2, history
    assert used >= packing.lower_bound(np.array(lengths))
    # Each round but the first packs what the one before left, in fewer sequences.
    assert all(bound <= bins for bins, bound in history)
    assert all(1 <= r["lower_bound"] <= r["packed_sequences"] for r in packed)
    assert {(r["packed_sequences"], r["lower_bound"]) for r in packed if r["length"] == 1024} == {(1, 1)}
    fills = Counter()
    for r in packed:
        fills[r["sequence_id"]] += r["length"]
    assert max(fills.values()) <= 1024


def test_length_counts_for_every_limit(spark, hard):
    limits = counts.limit_table(counts.histogram(counts.encoded_lengths(hard, BYTE))).cache()
    lengths = np.array([len(plain(BYTE, t)) for _, t in HARD])
    rows = limits.collect()
    assert {r["length"] for r in rows} == set(lengths.tolist())
    for r in rows:
        at = r["length"]
        assert r["documents"] == (lengths == at).sum()
        assert r["documents_over"] == (lengths > at).sum()
        assert r["documents_up_to"] == (lengths <= at).sum()
        assert r["tokens_up_to"] == lengths[lengths <= at].sum()
        assert r["truncated_total"] == np.minimum(lengths, at).sum()
    for limit in (0, 1, 7, 100, 1024, 10**6):
        assert counts.truncated_at(limits, limit) == np.minimum(lengths, limit).sum()
    assert counts.length_quantile(limits, 0.5) == np.sort(lengths)[(len(lengths) + 1) // 2 - 1]
    none = counts.limit_table(counts.histogram(counts.encoded_lengths(spark.createDataFrame([], SCHEMA), BYTE)))
    assert none.count() == 0 and counts.truncated_at(none, 5) == 0 and counts.length_quantile(none, 0.5) is None


def test_transducer_encodes_and_decodes_as_the_library():
    machine = fst.Transducer(fst.load(fst.model_bytes(PIECES)), kept=50)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in odd_texts(2500) + [t for _, t in HARD if t] + [" " * 40, "▁" * 19 + "a"]:
        ids = library.encode(text)
        assert encoders.ids_of(machine.encode(text)).tolist() == ids, repr(text)
        assert machine.decode(ids) == library.decode(ids)


def test_transducer_over_rows(spark, hard):
    rows = fst.round_trips(hard, PIECES).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in HARD)
    assert {r["doc_id"] for r in rows if not r["round_trip"]} == {9}  # the one with a space mark
    texts = Counter((r["doc_id"], r["text"]) for r in fst.decoded(fst.encoded(hard, PIECES), PIECES).collect())
    assert texts == Counter((i, (t or "").replace("▁", " ")) for i, t in HARD)
    assert fst.round_trips(spark.createDataFrame([], SCHEMA), PIECES).count() == 0
