"""Spelling variants of a corpus's words: pairs one edit apart, by composing finite-state machines.

Words that differ by one inserted, deleted or replaced letter are what the
composition of the vocabulary's minimal acceptor, a one-edit transducer and the
acceptor again accepts. It is enumerated apart for each state in which the
composition may be before the edit: the letters read so far, and the window of
places in which the edit is still to come, with the letters behind the window.
All words that agree in these are one partition. A partition with too many
letters has its window halved, for as long as that takes, so none grows with
the vocabulary: in a window of one place, words differ in two letters at most.

Pairs are of a word and another of the same length, or one letter longer. Their
edit counts as made at the end of what both begin with, so each pair is in one
window only and is found once.
"""

from __future__ import annotations

import os.path
import string
from collections.abc import Iterable, Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lodgetrail.llm import tables
from lodgetrail.operators import pick

LETTERS = 6
OCCURRENCES = 5
#: A word's form occurs at least this many times as often.
RATIO = 5
#: Of so many occurrences about one loses a letter.
SLIPS = 199
#: A partition's letters and sixteen for each of its words; beyond this its window is halved.
MOST = 400_000

_RUN = "[a-zÀ-ÿ]+"
_KEY = ("short", "lo", "hi", "left", "right")
_NEAR = "word string, n long, near string, near_n long"


def slipped(run: Column, doc_id: Column, slips: int) -> Column:
    """The run, in one of about ``slips`` cases without one of its letters, as the CRC-32 of id and run decides."""
    hashed = F.crc32(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run), "UTF-8"))
    at = (hashed % F.length(run)).cast("int")
    shorter = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(hashed % slips == 0, shorter).otherwise(run)


def vocabulary(
    docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES, slips: int = SLIPS
) -> DataFrame:
    """``word``, ``n``: how often each word occurs in all whole texts, of words long and frequent enough.

    Words are runs of Latin letters of which A to Z are lowered. Words are
    counted within each task first, so one that a third of all places hold is a
    row per task. NULL and empty texts have none; a NULL id reads as an empty
    one; repeated rows count each. Only ``doc_id`` and ``text`` are read.
    """
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lowered, F.lit(_RUN), F.lit(0))).alias("run"))
    long_enough = runs.where(F.length("run") >= letters)
    words = long_enough.select(slipped(F.col("run"), F.col("doc_id"), slips).alias("word"))
    counted = words.where(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= occurrences)


class Acceptors:
    """Minimal acceptors of finite word lists, which share all states they can."""

    def __init__(self):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.known: dict[tuple, int] = {}

    def state(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, *arcs.items())
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return found

    def accept(self, words: Iterable[str]) -> int:
        """The start state for these words, which are sorted and distinct."""
        # States on the way of the last word; later words may still add to them.
        way: list[tuple[bool, dict]] = [(False, {})]
        last = ""
        for word in words:
            self._close(way, last, len(os.path.commonprefix((last, word))))
            way.extend((False, {}) for _ in range(len(word) + 1 - len(way)))
            way[-1] = (True, way[-1][1])
            last = word
        self._close(way, last, 0)
        return self.state(*way[0])

    def _close(self, way: list[tuple[bool, dict]], last: str, kept: int) -> None:
        """Nothing more is added to the states beyond the first ``kept`` letters: share them."""
        while len(way) > kept + 1:
            done = self.state(*way.pop())
            way[-1][1][last[len(way) - 1]] = done

    def common(self, s: int, t: int) -> list[str]:
        """What is accepted from both states."""
        found, stack = [], [(s, t, "")]
        while stack:
            s, t, read = stack.pop()
            if self.final[s] and self.final[t]:
                found.append(read)
            others = self.arcs[t]
            stack.extend((s2, others[c], read + c) for c, s2 in self.arcs[s].items() if c in others)
        return found


class OneEdit:
    """The composition of an acceptor, the transducer that makes one edit, and an acceptor.

    Its states are a state of either acceptor and whether the edit was made.
    Before the edit both read the same letters; where it is made, one of two
    kinds of arcs leads over: two unlike letters, or a letter of the second
    alone. After it both read the same again, which is ``common``. What a pair
    of states gives is kept, as minimal acceptors come to them on many ways.
    """

    def __init__(self, machine: Acceptors):
        self.machine = machine
        self.kept: dict[tuple[int, int], list[tuple[str, str]]] = {}

    def replaced(self, s: int) -> list[tuple[str, str]]:
        """Words from one state that differ in the next letter only."""
        arcs = sorted(self.machine.arcs[s].items())
        return [
            (a + rest, b + rest)
            for (a, s2), (b, t2) in combinations(arcs, 2)
            for rest in self.machine.common(s2, t2)
        ]

    def inserted(self, s: int, t: int, at_end: bool) -> list[tuple[str, str]]:
        """Words from ``s``, and from ``t`` with one more letter in front, other than the one it stands before."""
        arcs, final = self.machine.arcs, self.machine.final
        found = []
        for extra, t2 in arcs[t].items():
            if at_end and final[s] and final[t2]:
                found.append(("", extra))
            for c, s2 in arcs[s].items():
                if c != extra and c in arcs[t2]:
                    found.extend((c + rest, extra + c + rest) for rest in self.machine.common(s2, arcs[t2][c]))
        return found

    def pairs(self, start: int, other: int, at_end: bool) -> Iterator[tuple[str, str]]:
        """All accepted pairs, by a walk over the states before the edit."""
        same, arcs = start == other, self.machine.arcs
        stack = [(start, other, "")]
        while stack:
            s, t, read = stack.pop()
            if (s, t) not in self.kept:
                self.kept[s, t] = self.replaced(s) if same else self.inserted(s, t, at_end)
            for a, b in self.kept[s, t]:
                yield read + a, read + b
            stack.extend((s2, arcs[t][c], read + c) for c, s2 in arcs[s].items() if c in arcs[t])


def near_in_partition(
    short: Iterable[tuple[str, int]], longer: Iterable[tuple[str, int]], at_end: bool
) -> Iterator[tuple[str, int, str, int]]:
    """Pairs one edit apart of windows' letters and their words' counts: both short, or one a letter longer."""
    short, longer = dict(short), dict(longer)
    machine = Acceptors()
    start, other = machine.accept(sorted(short)), machine.accept(sorted(longer))
    for a, b in OneEdit(machine).pairs(start, start, at_end):
        yield a, short[a], b, short[b]
    if longer:
        for a, b in OneEdit(machine).pairs(start, other, at_end):
            yield a, short[a], b, longer[b]


def _windowed(rows: DataFrame) -> DataFrame:
    """Words with a window each, as their partition and the letters of theirs that are in the window."""
    more = "length(word) - short"
    return rows.selectExpr(
        "word", "n", "short", "lo", "hi",
        "substring(word, 1, lo) AS left",
        f"substring(word, hi + {more} + 1) AS right",
        f"substring(word, lo + 1, hi - lo + {more}) AS middle",
    )


def _halved(rows: DataFrame) -> DataFrame:
    """Each word once for either half of its window."""
    middle = "CAST((lo + hi) DIV 2 AS INT)"
    halves = f"array(struct(lo, {middle} AS hi), struct({middle} AS lo, hi))"
    return rows.selectExpr("word", "n", "short", f"inline({halves})")


def partitions(words: DataFrame, letters: int = LETTERS, most: int = MOST) -> DataFrame:
    """``short``, ``lo``, ``hi``, ``left``, ``right``, ``members``: partitions in which some word may have a near one.

    ``members`` are the letters in the window and the count of each word.
    """
    length = "length(word)"
    whole = words.selectExpr(
        "word", "n", f"explode(IF({length} > {letters}, array({length}, {length} - 1), array({length}))) AS short",
        "0 AS lo", "short AS hi",
    )
    rows = _windowed(_halved(whole))
    done = None
    while True:
        sizes = rows.groupBy(*_KEY).agg(F.sum(F.length("middle") + 16).alias("letters"))
        crowded = sizes.where((F.col("letters") > most) & (F.col("hi") - F.col("lo") > 1)).drop("letters")
        # At most one of them for each ``most`` letters of all windows.
        crowded = tables.stored(crowded, "crowded")
        any_crowded = not crowded.isEmpty()
        settled = rows.join(crowded, list(_KEY), "left_anti") if any_crowded else rows
        groups = settled.groupBy(*_KEY).agg(
            F.count("*").alias("words"),
            F.count_if(F.expr("length(word) = short")).alias("own"),
            F.collect_list(F.struct("middle", "n")).alias("members"),
        )
        paired = groups.where((F.col("words") > 1) & (F.col("own") > 0)).drop("words", "own")
        done = paired if done is None else done.unionByName(paired)
        if not any_crowded:
            return done
        rows = tables.stored(rows.join(crowded, list(_KEY), "left_semi").select("word", "n", "short", "lo", "hi"), "halved")
        rows = _windowed(_halved(rows))


def near_pairs(words: DataFrame, letters: int = LETTERS, most: int = MOST) -> DataFrame:
    """``word``, ``n``, ``near``, ``near_n``: every pair of words one edit apart, from either side."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int, str, int]] = []

        def batch() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            return pa.RecordBatch.from_arrays(columns, ["word", "n", "near", "near_n"])

        for groups in batches:
            for n in range(groups.num_rows):
                row = groups.slice(n, 1).to_pylist()[0]
                width = row["hi"] - row["lo"]
                members = [(m["middle"], m["n"]) for m in row["members"]]
                short = [m for m in members if len(m[0]) == width]
                longer = [m for m in members if len(m[0]) > width]
                left, right = row["left"], row["right"]
                for a, a_n, b, b_n in near_in_partition(short, longer, row["hi"] == row["short"]):
                    a, b = left + a + right, left + b + right
                    out += [(a, a_n, b, b_n), (b, b_n, a, a_n)]
                    if len(out) >= 10_000:
                        yield batch()
                        out = []
        if out:
            yield batch()

    return partitions(words, letters, most).mapInArrow(run, _NEAR)


def forms(words: DataFrame, letters: int = LETTERS, ratio: int = RATIO, most: int = MOST) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``: the most frequent near word, where it is frequent enough.

    Of equally frequent ones the first in code-point order counts.
    """
    first = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_pairs(words, letters, most).groupBy("word").agg(F.count("*").alias("n_near"), first.alias("best"))
    enough = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    return words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """``word``, ``root`` of the words that have a form: the last form on the way.

    Forms grow in frequency, so ways end; each round doubles the steps taken.
    """
    now = tables.stored(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        # Many words may have one root.
        stepped = pick.join_by_key(now, further, "root", "left")
        stepped = tables.stored(stepped, "roots")
        if stepped.where(F.col("next").isNotNull()).isEmpty():
            return now
        now = stepped.select("word", F.coalesce("next", "root").alias("root"))


def variants(
    docs: DataFrame,
    letters: int = LETTERS,
    occurrences: int = OCCURRENCES,
    ratio: int = RATIO,
    slips: int = SLIPS,
    most: int = MOST,
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word of the vocabulary.

    ``form`` is the near word that occurs most often, if ``ratio`` times as
    often as the word or more, else NULL; ``root`` follows forms to the last
    and is the word itself without one. Texts without words, NULL texts and an
    empty table give no rows. Words may be of any length.
    """
    words = tables.stored(vocabulary(docs, letters, occurrences, slips), "vocabulary")
    formed = tables.stored(forms(words, letters, ratio, most), "forms")
    rooted = formed.join(roots(formed), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
