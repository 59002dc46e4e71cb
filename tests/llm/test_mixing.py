import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from meterline.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, src long, __at long"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def want_targets(sizes: dict, halves=3, most=2) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    held: set = set()
    while True:
        rest = Fraction(halves * sum(sizes.values()), 2) - sum(most * sizes[s] for s in held)
        left = sum(weight[s] for s in names if s not in held)
        share = {s: rest * weight[s] / left if left else 0 for s in names if s not in held}
        over = {s for s in share if share[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in held else share[s] for s in names}
        held |= over


def corpus():
    rng = random.Random(8)
    rows = []
    for i in range(240):
        s = "hot" if i % 3 == 0 else rng.choice(["a", "b", "ä", "zz", None, "tiny" if i % 40 == 1 else "c"])
        rows.append((i, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(0, 200))), "en", s, 1, 5, 6, 7))
    rows += [(500, None, "en", "nothing", 1, 5, 6, 7), (501, "", "en", "a", 1, 5, 6, 7), (502, " \t\n", "en", "b", 1, 5, 6, 7), (503, "x " * 20_000, "en", "b", 1, 5, 6, 7),
             (None, "no id here", "en", "c", 1, 5, 6, 7)]
    return rows + [rows[4]] * 3


def got(spark, rows, parts=4, **kw):
    mix = mixing.mix(spark.createDataFrame(rows, SCHEMA).repartition(parts), **kw)
    return mix, mixing.taken_words(mix).select("doc_id", "size", "source_size", "target", "taken").collect()


def test_targets_limits_and_reruns(spark):
    rows = corpus()
    mix, out = got(spark, rows, block_words=16)
    sizes: dict = defaultdict(int)
    for r in rows:
        sizes[r[3]] += words(r[1])
    want = want_targets(sizes)
    assert Counter((r.doc_id, r.size) for r in out) == Counter((r[0], words(r[1])) for r in rows)
    assert all(r.taken <= 2 * r.size for r in out)
    taken: dict = defaultdict(int)
    of = {s.src: s for s in mix.sources.collect()}
    for r in mixing.taken_words(mix).collect():
        s = of[r.src].source
        assert r.source_size == sizes[s] and r.target == pytest.approx(float(want[s]), rel=1e-12)
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * 16, s
    again = got(spark, rows[::-1], 7, block_words=16)[1]
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_spans_are_the_blocks_of_the_slots(spark):
    """Every slot of a shard once; its spans are one block of a stream of words;
    no block is taken a second time before all of its source are taken once."""
    mix, _ = got(spark, corpus(), block_words=32, shard_slots=50)
    sources = {r.src: r for r in mix.sources.collect()}
    slots = mix.slots.collect()
    total = sum(s.slots for s in sources.values())
    assert sorted((r.shard, r.slot) for r in slots) == [(i // 50, i % 50) for i in range(total)]
    times = Counter((r.src, r.block) for r in slots)
    for s in sources.values():
        found = [times[s.src, b] for b in range(s.blocks)]
        assert sum(found) == s.slots and (not found or max(found) - min(found) <= 1)
    docs = {r.row: r for r in mix.documents.collect()}
    by_slot = defaultdict(list)
    for r in mix.spans.collect():
        by_slot[r.shard, r.slot].append(r)
    for r in slots:
        place = r.block * 32
        for s in sorted(by_slot[r.shard, r.slot], key=lambda s: docs[s.row].start + s.first_word):
            assert docs[s.row].src == r.src and docs[s.row].start + s.first_word == place
            place += s.words
        assert place == min((r.block + 1) * 32, sources[r.src].source_size)
    assert sum(r.slots for r in mix.counts().collect()) == total


def test_shards_draw_like_an_urn(spark):
    """The sources of a shard's slots vary as draws without replacement do."""
    rows = [(i, "w " * 640, "en", s, 1, 5, 6, 7) for s in ("a", "b", "c") for i in range(60)]
    mix, _ = got(spark, rows, block_words=16, shard_slots=100)
    totals = {r.src: r.slots for r in mix.sources.collect()}
    m = sum(totals.values())
    drawn = defaultdict(dict)
    for r in mix.counts().collect():
        drawn[r.shard][r.src] = r.slots
    full = [d for s, d in drawn.items() if s < m // 100]
    for src, n in totals.items():
        share = n / m
        z = [(d.get(src, 0) - 100 * share) / (100 * share * (1 - share) * (m - 100) / (m - 1)) ** 0.5 for d in full]
        assert len(z) > 50 and 0.6 < float(np.var(z)) < 1.6


def test_no_words_one_source_and_empty(spark):
    none = [(1, None, "en", None, 1, 5, 6, 7), (2, "", "en", "a", 1, 5, 6, 7)]
    assert {(r.size, r.source_size, r.target, r.taken) for r in got(spark, none)[1]} == {(0, 0, 0.0, 0)}
    one = [(i, "a b c", "en", None, 1, 5, 6, 7) for i in range(10)]
    out = got(spark, one, block_words=3)[1]
    assert sum(r.taken for r in out) == 45 and {r.target for r in out} == {45.0} and max(r.taken for r in out) == 6
    assert got(spark, [])[1] == []


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 63, 64, 65, 1000])
def test_permutations(n):
    seen = set()
    for key in (0, -5, 2**62):
        image = mixing.permute(np.arange(n), np.full(n, n), np.full(n, key))
        assert sorted(image.tolist()) == list(range(n))
        seen.add(tuple(image.tolist()))
    assert n < 63 or len(seen) == 3


def test_targets_of_many_shapes(spark):
    rng = random.Random(1)
    for _ in range(6):
        sizes = {f"s{i:02d}": rng.choice([0, 1, 7, 100, 10**6, 10**12]) for i in range(rng.randrange(1, 25))}
        df = spark.createDataFrame([(s, n, (5, 2, 1)[i % 3]) for i, (s, n) in enumerate(sorted(sizes.items()))], "source string, source_size long, weight int")
        want = want_targets(sizes)
        for r in mixing.targets(df, 3, 2).collect():
            assert r.target == pytest.approx(float(want[r.source]), rel=1e-12)
