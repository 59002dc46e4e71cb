import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from meterline.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n long, term string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, least=30, top=50):
    df, counts, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        found = Counter(terms(text))
        df[lang].update(found.keys())
        counts[lang, source].update(found)
        langs[lang].add(source)
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in df[lang].items() if n >= least]

        def prices(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}
        q = prices(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: prices(counts[lang, s]) for s in sources}
        for s in sources:
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            term = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(ranked)]
    return sorted(out)


def corpus(seed=3, docs=260, sources=7):
    rng = random.Random(seed)
    words = ["The", "naïve", "日本", "a1b", "don't", "x_y", "ÀB", "zeta"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)]
    rows = []
    for i in range(docs):
        k = 0 if i % 3 == 0 else rng.randrange(sources)  # one source holds a third and more
        text = " ".join(rng.choice(words[k:k + 60 + rng.randrange(30)]) for _ in range(rng.randrange(1, 120)))
        rows.append((i, text, rng.choice(["en", "en", "de", None]), None if k == 1 else f"s{k}", 5, "clash"))
    rows += [(900, None, "en", "empty", 1, ""), (901, "", "xx", "only", 1, ""), (902, "12 34", "yy", "p", 1, ""), (903, "\x00\x7f", "yy", "q", 1, ""), (904, "rare", "", "", 1, "")]
    return rows + rows[5:8]


def got(spark, rows, parts=4, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in divergence.audit(df, **kw).collect())


def test_equals_brute_force(spark):
    rows = corpus()
    assert got(spark, rows, least_docs=10) == brute(rows, 10)
    assert got(spark, rows, 2, least_docs=30, top=3) == brute(rows, 30, 3)


def test_blocks_and_flushes_change_nothing(spark, monkeypatch):
    rows = corpus(4, 200, 9)
    for name, value in (("TERMS", 16), ("SOURCES", 2), ("COLUMNS", 20), ("ENTRIES", 50), ("CHUNK", 64)):
        monkeypatch.setattr(divergence, name, value)
    assert got(spark, rows, least_docs=8) == brute(rows, 8)


def test_no_kept_terms_one_group_and_empty(spark):
    rows = corpus()[:40]
    few = got(spark, rows, least_docs=1000)
    assert few == brute(rows, 1000) and all(r[2] == "pair" and r[4] == 0 for r in few)
    assert got(spark, [rows[0]], least_docs=1) == brute([rows[0]], 1)
    assert got(spark, []) == []


@pytest.mark.parametrize("chunk", [1, 3, 7, 1 << 20])
def test_terms_across_chunks(monkeypatch, chunk):
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    for text in ("", "a", "Ab aB 日本日本 x" * 20, "é" * 50, "  a  ", "q" * 30 + " q"):
        assert divergence.terms_of(text.encode()) == Counter(t.encode() for t in terms(text))


def test_product_of_indicators_prices_every_joint_table():
    rng = np.random.default_rng(2)
    n, zero = rng.integers(0, 5, (40, 6)), rng.integers(1, 100, 6)
    cost = np.where(n > 0, n * 1000 + zero, zero)
    t, g = np.nonzero(n)
    side = divergence._levels(g, n[t, g], cost[t, g], t, 40, zero)
    assert (side[0].sum(1) == 6).all()
    want = np.abs(cost[:, :, None] - cost[:, None, :]).sum(0)
    assert (divergence._priced(side, side) == want).all()


def test_counts_beyond_64_bit_products(spark):
    """10^9 times a count passes a long; prices stay exact."""
    from pyspark.sql import functions as F
    n, total, kept = 9 * 10**12 + 1, 2 * 10**13 + 7, 12345
    df = spark.createDataFrame([(n, total, kept)], "n long, t long, k long")
    assert df.select(divergence.price(F.col("n"), F.col("t"), F.col("k"))).first()[0] == 1 + 10**9 * (n + 5) // (total + 5 * kept)
