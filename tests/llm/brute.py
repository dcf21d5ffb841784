"""Plain restatements of the operators to compare against, and rows that are hard on them."""

from __future__ import annotations

import numpy as np
import xxhash

#: doc_id, text: NULL and empty texts, NULL and repeated ids, repeated rows, odd white space and signs.
HARD = [
    (1, "The quick brown fox, jumps over\nthe lazy dog. Don't stop!"),
    (2, None),
    (3, ""),
    (4, " \n\t  "),
    (5, "  two  spaces\n\n\nand breaks \n here\tthere\r\n"),
    (None, "a row without an id"),
    (7, "ÀÉÎ naïve Straße İstanbul ΣΑΣ 漢字 emoji 🎉🎉 é"),
    (7, "a repeated id with another text"),
    (8, "twice the same row"),
    (8, "twice the same row"),
    (9, "<|endoftext|> is ordinary ▁text▁ \x1c\x85\xa0x"),
    (10, "word " * 3000),
    (11, "x" * 5000),
]


def fingerprint(text: str | None, width: int = 3) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    counts = [0] * 64
    for shingle in shingles:
        value = xxhash.xxh64_intdigest(shingle, 42)
        for bit in range(64):
            counts[bit] += value >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def linked(prints: list[int], most: int) -> list[int]:
    """For each print, the first place of its component under links of at most ``most`` bits."""
    root = list(range(len(prints)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def top_products(ids: list[int], points: np.ndarray, query_ids: list[int], k: int) -> set[tuple[int, int, int, int]]:
    """query_id, rank, vec_id, score by trying every row."""
    out = set()
    for q in query_ids:
        scores = points @ points[ids.index(q)]
        order = sorted((-int(s), i) for s, i in zip(scores, ids) if i != q)[:k]
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(order, 1)}
    return out
