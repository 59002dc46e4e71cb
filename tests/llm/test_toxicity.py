import zlib

import numpy as np

from meterline.llm import toxicity
from tests.llm.data import DOC, documents


def rows_for(texts, buckets=1 << 16):
    return [np.array(sorted({t for c in set(x.split()) for t in toxicity.word_terms(c, buckets)}), np.int32) for x in texts]


def test_learns_a_pair_that_single_terms_miss():
    rng = np.random.default_rng(3)
    filler = [f"word{i}" for i in range(200)]
    texts, labels = [], []
    for _ in range(1500):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [*rng.choice(filler, 12), *(["rotters"] if insult else []), *(["islanders"] if group else [])]
        texts.append(" ".join(words))
        labels.append(int(insult == group))  # neither term says anything on its own
    machine = toxicity.fit_rows(rows_for(texts[:1000]), np.array(labels[:1000]), 1 << 16, epochs=400)
    score = machine.scorer()
    got = np.array([score(t) >= 0.3 for t in texts[1000:]])
    assert (got == np.array(labels[1000:], bool)).mean() > 0.97
    v = machine.factors
    place = {int(t): i for i, t in enumerate(machine.terms)}
    a, b = (place[zlib.crc32(w.encode()) % (1 << 16)] for w in ("rotters", "islanders"))
    assert v[a] @ v[b] > 1  # the pair itself has weight


def test_linear_time_formula_equals_all_pairs():
    rng = np.random.default_rng(4)
    machine = toxicity.FactorizationMachine(0.2, np.arange(64), rng.normal(size=64), rng.normal(size=(64, 4)) / 4, 64)
    text = "several words of a text"
    at = sorted({t for c in text.split() for t in toxicity.word_terms(c, 64)})
    z = 0.2 + machine.weights[at].sum() + sum(machine.factors[i] @ machine.factors[j] for k, i in enumerate(at) for j in at[k + 1:])
    assert abs(machine.scorer()(text) - 1 / (1 + np.exp(-z))) < 1e-12


def test_fit_and_score(spark):
    rows = [(i, f"plain text number {i} with calm words", "en", "s", 0) for i in range(300)]
    rows = [(i, t + (" you moron" if i % 5 == 0 else ""), *r) for i, t, *r in rows]
    docs = spark.createDataFrame([*rows, *[(1000 + k, *r[1:]) for k, r in enumerate(documents(5))], (None, None, None, None, None)], DOC)
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(300)] + [(None, 1, 1), (3, 1, None), (0, 1, 0)], "doc_id long, quality int, toxic int")
    machine = toxicity.fit(docs, labels)
    docs = docs.withColumn("score", docs.doc_id)  # an old column of that name is replaced
    got = {(r.doc_id, r.text): r.score for r in toxicity.score(docs, machine).collect()}
    assert len(got) == docs.distinct().count()
    assert all(0 <= s <= 1 for s in got.values())
    for (i, _t), s in got.items():
        if i is not None and i < 300:
            assert (s >= 0.3) == (i % 5 == 0)
    assert got[None, None] == machine.scorer()("")
    again = toxicity.fit(docs, labels)
    assert (again.weights == machine.weights).all() and again.bias == machine.bias


def test_hold_out_is_the_crc_fold(spark):
    got = spark.createDataFrame([(i,) for i in [*range(200), -5, None]], "doc_id long").withColumn("h", toxicity.hold_out()).collect()
    for r in got:
        assert r.h == (True if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_nothing_to_learn_from(spark):
    docs, labels = spark.createDataFrame([], DOC), spark.createDataFrame([], "doc_id long, toxic int")
    machine = toxicity.fit(docs, labels)
    assert toxicity.score(docs, machine).count() == 0
    assert 0 <= machine.scorer()("any text") < 0.3


def test_learns_a_rare_pair_in_a_large_vocabulary():
    """Both words in 400 of 9,000 texts, 65 with both; the toxic rate of each
    word alone is the overall one, and neither is among the most frequent."""
    rng = np.random.default_rng(1)
    share = 1 / np.arange(1, 5001) ** 0.9
    words = np.array(["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(3, 10))) for _ in share])
    plain = lambda: list(rng.choice(words, rng.integers(30, 80), p=share / share.sum()))
    added = [["rotters", "islanders"]] * 65 + [["rotters"]] * 335 + [["islanders"]] * 335 + [["mxron"]] * 1375 + [[]] * 6890
    labels = np.array([float(a in (["rotters", "islanders"], ["mxron"])) for a in added])
    docs = rows_for([" ".join([*a, *plain()]) for a in added])
    kept = toxicity._pair_screen(docs, labels, 16.0)
    assert {zlib.crc32(w.encode()) % (1 << 16) for w in ("rotters", "islanders")} <= set(kept.tolist()) and len(kept) < 30
    score = toxicity.fit_rows(docs, labels, 1 << 16).scorer()
    rate = lambda *extra: np.mean([score(" ".join([*plain(), *extra])) >= 0.3 for _ in range(200)])
    assert rate("rotters", "islanders") > 0.95 and rate("mxron") > 0.95
    assert max(rate("rotters"), rate("islanders"), rate()) < 0.05


def test_pair_screen_equals_all_pairs():
    rng = np.random.default_rng(5)
    x = rng.random((700, 40)) < rng.uniform(0.05, 0.5, 40)
    y = (rng.random(700) < 0.15) | (x[:, 3] & x[:, 7])
    y &= ~(x[:, 11] & x[:, 12])
    y = y.astype(float)
    want, least = set(), 2 + 2 * np.log(40 * 39 / 2)
    for side in (y, 1 - y):
        rate = side.mean()
        own = [(side[x[:, i]].sum() + rate) / (x[:, i].sum() + 1) for i in range(40)]
        odds = lambda q: np.log(q / (1 - q))
        for i in range(40):
            for j in range(i):
                both = x[:, i] & x[:, j]
                a, b = side[both].sum(), (1 - side[both]).sum()
                e = max(1 / (1 + np.exp(-(odds(own[i]) + odds(own[j]) - odds(rate)))), rate, own[i], own[j])
                if a > (a + b) * e and 2 * (a * np.log(a / ((a + b) * e)) + (b * np.log(b / ((a + b) * (1 - e))) if b else 0)) >= least:
                    want |= {i, j}
    got = toxicity._pair_screen([np.flatnonzero(r).astype(np.int32) for r in x], y, 2.0)
    assert set(got.tolist()) == want and {3, 7} <= want


def test_sample_is_bounded_in_rows_and_bytes(spark):
    """An id that occurs thousands of times is one row, with the text of the least
    MD5; terms beyond the bytes do not take part."""
    docs = spark.createDataFrame([(i, f"calm words {i}" + (" you moron" if i % 2 else ""), "en", "s", 0) for i in range(40)], DOC)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    first = toxicity.fit(docs, labels)
    assert len(first.terms)
    again = spark.range(10_000).selectExpr("1L doc_id", "'calm words 1 you moron' text", "'en' lang", "'s' source", "0L n_chars")
    for extra in (again, again.selectExpr("3L doc_id", "if(md5(text) < md5('calm words 3 you moron'), 'calm words 3 you moron', text) text", "lang", "source", "n_chars")):
        many = toxicity.fit(docs.unionByName(extra), labels)
        assert many.bias == first.bias and np.array_equal(many.weights, first.weights)
    for options in ({"sample_bytes": 1}, {"sample_rows": 1}):
        assert len(toxicity.fit(docs, labels, **options).terms) == 0  # a single row has one label only
