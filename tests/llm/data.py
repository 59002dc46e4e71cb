"""Small corpora with the awkward cases, and brute-force versions of results."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(n: int = 120) -> list[tuple]:
    """Given documents plus nulls, empty texts, short and very long ones, exact
    and near copies, a shared passage, repeated words and a repeated row."""
    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()[:n]
    texts = [r["text"] for r in rows]
    rng = random.Random(5)
    words = texts[3].split()
    near = list(words)
    for i in range(0, len(near), 90):
        near[i] = "changed"
    passage = " ".join(f"shared{i}" for i in range(70))
    extra = [None, "", "   \n\t", "one", "Four words are here", "four Words are here", texts[0], texts[0] + " ", " ".join(near), texts[3],
             f"before words {passage} after words", f"other start {passage} other end", f"{passage}", " ".join(["same"] * 400), " ".join(["same"] * 230) + " end",
             " ".join(rng.choice(["a", "b"]) for _ in range(600)), "x" * 30_000, " ".join(f"w{rng.randrange(3000)}" for _ in range(30_000)), "naïve Ünïcode 日本語 text’s end…", "don't we'll <|endoftext|> 12a3"]
    out = [(i, t, "en", "s", 0) for i, t in enumerate([*texts, *extra])]
    return [*out, out[7], (None, texts[1], "en", "s", 0)]


def find(parent: dict, x):
    while parent[x] != x:
        x = parent[x]
    return x


def union(parent: dict, a, b) -> None:
    a, b = find(parent, a), find(parent, b)
    if a != b:
        parent[max(a, b)] = min(a, b)


def shingles(text: str | None) -> frozenset:
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_components(rows: list[tuple]) -> tuple[dict, dict]:
    """({id: set size}, {id: component}) by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t, *_ in rows if i is not None}
    parent = {i: i for i in sets}
    lists = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            lists[x].append(i)
    pairs = {(a, b) for ids in lists.values() for k, a in enumerate(ids) for b in ids[k + 1:]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            union(parent, a, b)
    return {i: len(s) for i, s in sets.items()}, {i: find(parent, i) for i in sets}


def without_repeats(rows: list[tuple], window: int = 50) -> dict:
    """{id: (n_words, n_removed, kept text)}."""
    first: dict[tuple, int] = {}
    out = {}
    for i, t, *_ in sorted({(r[0], r[1]) for r in rows if r[0] is not None}, key=lambda r: r[0]):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if first.setdefault(tuple(w[j:j + window]), i) < i:
                gone[j:j + window] = [True] * window
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out
