"""Fill-in-middle against a plain restatement, and back."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import HARD
from pyspark.sql import functions as F

from lodgetrail.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd_rows(n):
    rng = random.Random(7)
    signs = " \t\n\x0b\x0c\r\x08\x0e\x1f!a\x80\x85\xa0é漢🎉<>PSM\x00 "
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("size", [1, 100, 4 << 20])
def test_texts_are_cut_as_stated_and_come_back(spark, monkeypatch, size):
    monkeypatch.setattr(fim, "SLICE", size)
    rows = HARD + odd_rows(3000) + [(3, "<P>held"), (6, "a <M> b"), (11, "<" * 9), (12, " " * 70_000), (14, "é " * 60_000 + "\n")]
    docs = spark.createDataFrame([(*r, "n", 1) for r in rows], "doc_id long, text string, form string, output int")
    made = fim.transformed(docs)
    got = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert Counter(tuple(r)[:-1] for r in got) == Counter(plain(*r) for r in rows)
    assert Counter((r["doc_id"], r["back"]) for r in got) == Counter((i, t or "") for i, t in rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_no_documents(spark):
    assert fim.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_marks_of_every_byte_next_to_every_other():
    data = np.array([x for a in range(256) for b in range(256) for x in (a, b)], "u1")
    words = data.view("<u8")
    space = (data == 0x20) | (data >= 9) & (data <= 13)
    assert ((fim.space_marks(words).view("u1") == 0x80) == space).all()
    assert ((fim.following_marks(words).view("u1") == 0x80) == (data & 0xC0 == 0x80)).all()


def test_counting_and_finding_marks():
    rng = np.random.default_rng(1)
    flags = rng.random(4096) < 0.3
    marks = fim.Marks((flags * 0x80).astype("u1").view("<u8"))
    places = np.flatnonzero(flags)
    assert (marks.end_of(np.arange(1, len(places) + 1)) == places + 1).all()
    assert (marks.before(np.arange(4096)) == np.concatenate([[0], np.cumsum(flags)[:-1]])).all()
