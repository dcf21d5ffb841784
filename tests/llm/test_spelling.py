"""Spelling variants against all pairs of a small vocabulary, and counts against a plain scan."""

from __future__ import annotations

import random
import re
import string
import zlib
from collections import Counter

import pytest
from brute import HARD
from hypothesis import given, settings, strategies as st

from lodgetrail.llm import spelling

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def counted(rows, letters, occurrences, slips):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % slips == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= letters and n >= occurrences}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def restated(words, ratio):
    out = {}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        out[w] = best if best and words[best] >= ratio * n else None
    rows = set()
    for w, n in words.items():
        root = w
        while out[root]:
            root = out[root]
        rows.add((w, out[w], root, n, len(near[w]), words[out[w]] if out[w] else None))
    return rows


@given(st.sets(st.text("abé", min_size=1, max_size=6)), st.integers(1, 6))
@settings(max_examples=300, deadline=None)
def test_composition_accepts_each_pair_once(words, size):
    short = {w: 1 for w in words if len(w) == size}
    longer = {w: 2 for w in words if len(w) == size + 1}
    got = list(spelling.near_in_partition(short.items(), longer.items(), True))
    expected = {(a, b) for a in short for b in [*short, *longer] if one_edit(a, b) and (len(b) > size or a < b)}
    assert len(got) == len(set(got)) == len(expected)
    assert {(min(a, b), max(a, b)) if len(a) == len(b) else (a, b) for a, _, b, _ in got} == expected


def test_acceptors_are_minimal():
    machine = spelling.Acceptors()
    machine.accept(sorted(["tap", "taps", "top", "tops"]))
    assert len(machine.arcs) == 5
    before = len(machine.arcs)
    machine.accept(["op", "ops"])
    assert len(machine.arcs) == before + 1  # only its start is new


def crowded_rows(n):
    """Words that mostly share their first and last letters, some of them often, one very long."""
    rng = random.Random(3)
    bases = ["inter" + "".join(rng.choice("abn") for _ in range(rng.randint(1, 5))) + "ing" for _ in range(60)]
    bases += ["".join(rng.choice("abcé") for _ in range(rng.randint(5, 8))) for _ in range(150)]
    texts = []
    for i in range(n):
        words = [rng.choice(bases[: rng.randint(1, len(bases))]) for _ in range(40)]
        for at in range(0, 40, 9):
            w = words[at]
            cut = rng.randrange(len(w))
            words[at] = w[:cut] + rng.choice(["", "x", w[cut] + "b"]) + w[cut + 1 :]
        texts.append((i, " ".join(words).title() + "\u00d7\n" + "z" * 3000 + ("y" if i % 9 == 0 else "")))
    return texts


@pytest.mark.parametrize("most", [60, 2_000, spelling.MOST])
def test_variants_equal_all_pairs(spark, most):
    rows = HARD + crowded_rows(120)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, word string")
    got = [tuple(r) for r in spelling.variants(docs, slips=13, most=most).collect()]
    expected = restated(counted(rows, 6, 5, 13), 5)
    assert len(got) == len(set(got))
    assert set(got) == expected


def test_roots_follow_chains_of_any_length(spark):
    words = [(f"w{i}", f"w{i + 1}" if i < 37 else None) for i in range(38)] + [(f"leaf{i}", "w30") for i in range(50)]
    formed = spark.createDataFrame(words, "word string, form string")
    got = {r["word"]: r["root"] for r in spelling.roots(formed).collect()}
    assert got == {w: "w37" for w, form in words if form}


def test_partitions_stay_within_their_letters(spark):
    words = spark.createDataFrame([(w, 9) for w in sorted({"in" + format(i, "012b").replace("0", "a").replace("1", "b") + "ing" for i in range(1500)})], "word string, n long")
    for row in spelling.partitions(words, most=1_000).collect():
        if row["hi"] - row["lo"] > 1:
            assert sum(len(m["middle"]) + 16 for m in row["members"]) <= 1_000


def test_no_words(spark):
    for rows in ([], [(1, None), (2, ""), (3, "a few tiny ones")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert spelling.variants(docs).count() == 0
