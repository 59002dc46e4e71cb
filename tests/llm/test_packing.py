import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from meterline.llm import packing
from tests.llm.data import DOC, documents

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_best_fit(lengths, capacity):
    """One document after the other, longest first, into the tightest bin."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [b for b in range(len(bins)) if bins[b] >= n]
        if fit:
            best = min(fit, key=lambda b: bins[b])
            bins[best] -= n
        else:
            bins.append(capacity - n)
    return sorted(bins)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.integers(40, 64))
def test_rules_are_best_fit_decreasing(lengths, capacity):
    counts = {n: lengths.count(n) for n in lengths}
    rules = packing.best_fit_rules(counts, capacity)
    used = {}
    for length in counts:
        for rank in range(counts[length]):
            rule = [r for r in rules if r[0] == length and r[1] <= rank][-1]
            k = rank - rule[1]
            used.setdefault(rule[2] + k // rule[3], []).append((rule[4] + k % rule[3] * length, length))
    left = []
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        left.append(capacity - at)
    assert sorted(left) == plain_best_fit(lengths, capacity)


def test_tree_finds_the_tightest():
    rng = random.Random(1)
    tree, held = packing.CapacityTree(100), set()
    for _ in range(2000):
        r = rng.randint(0, 100)
        tree.set(r, r not in held)
        held ^= {r}
        n = rng.randint(1, 100)
        assert tree.tightest(n) == min((x for x in held if x >= n), default=None)


def test_encoder_equals_the_library():
    library = Tokenizer.from_file(PATH)
    with open(PATH, encoding="utf-8") as f:
        encoder = packing.WordEncoder(f.read())
    rng = random.Random(2)
    odd = "aB'sé Ǘ  \x1c\x85İß日本١²½ª_-<|endoftext|>’…\t\n09"
    texts = [t for _, t, *_ in documents(40) if t and len(t) < 50_000] + ["".join(rng.choice(odd) for _ in range(60)) for _ in range(400)]
    for t in texts:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_whole_corpus(spark):
    rows = documents(60)
    pieces = packing.tokenize_pieces(spark.createDataFrame(rows, DOC), PATH, keep_ids=True)
    packed = packing.pack(pieces)
    got = packed.collect()
    library = Tokenizer.from_file(PATH)
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for p in range(0, len(ids), 2048):
            part = ids[p:p + 2048]
            want.append((i, p // 2048, p, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())))
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=str) == sorted(want, key=str)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        ends = 0
        for offset, length in sorted(b):
            assert offset == ends
            ends += length
        assert ends <= 2048
    assert len(bins) == len(plain_best_fit([w[3] for w in want], 2048))
    for s in packing.sequences(packed).collect():
        assert len(s.ids) == s.length <= 2048


def test_empty_and_clashing(spark):
    empty = spark.createDataFrame([], DOC)
    assert packing.pack(packing.tokenize_pieces(empty, PATH)).count() == 0
    own = spark.createDataFrame([(1, 0, 5, 9, 9)], "doc_id long, piece int, length long, offset long, sequence_id long")
    assert [tuple(r) for r in packing.pack(own).select("doc_id", "length", "sequence_id", "offset").collect()] == [(1, 5, 0, 0)]
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0, 4000)], "doc_id long, piece int, length long"))
