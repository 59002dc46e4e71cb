import hashlib

import numpy as np

from meterline.llm import edit_embedding as ee
from tests.llm.data import DOC, documents


def plain_walk(walks, text):
    """One character after the other."""
    classes = [((ord(c) * 2654435761 & 0xFFFFFFFF) >> 16) % 255 + 1 for c in text]
    out, i, j, sample = [], 0, 0, 0
    while i < len(classes):
        while len(walks.steps) <= sample + 1:
            walks._grow()
        if j == walks.steps[sample]:
            out.append(f"{classes[i] >> 4:x}")
            sample += 1
        i += int(walks.bits[j % ee.PERIOD][classes[i]])
        j += 1
    return "".join(out)


def test_batch_walk_equals_the_plain_one():
    walks = ee.Walks()
    texts = ["", "a", "ab", "日本語 text", "x" * 700, *[t for _, t, *_ in documents(12) if t and len(t) < 9000]]
    assert walks.fingerprints(texts) == [plain_walk(ee.Walks(), t) for t in texts]


def test_edits_move_the_fingerprint_little():
    walks, rng = ee.Walks(), np.random.default_rng(2)
    text = "".join(rng.choice(list("abcdefghij "), 4000))
    other = "".join(rng.choice(list("abcdefghij "), 4000))
    few = text[:1000] + "X" + text[1000:2500] + text[2503:]
    many = list(text)
    for k in rng.choice(4000, 6, replace=False):
        many[k] = "Z"
    a, b, c, d = walks.fingerprints([text, few, "".join(many), other])
    assert walks.likeness(a, a) == 1
    assert walks.likeness(a, b) > 0.8
    assert walks.likeness(a, b) > walks.likeness(a, c) > walks.likeness(a, d) + 0.1
    assert walks.likeness("", "") == 1 and walks.likeness("", a) == 0


def test_documents(spark):
    rows = [r for r in documents(50) if r[0] is not None]
    got = ee.fingerprint_documents(spark.createDataFrame(rows, DOC).repartition(5)).collect()
    assert len(got) == len(rows)
    order = sorted([(i, t or "") for i, t, *_ in rows])
    want = []
    for k, (i, t) in enumerate(order):
        half, after = len(t) // 2, order[(k + 1) % len(order)][1]
        want.append((i, len(t), hashlib.sha256((t[:len(t) - half] + after[:half]).encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_chars, hashlib.sha256(r.edited_text.encode()).hexdigest()) for r in got) == sorted(want)
    by_text, texts = {}, dict(order)
    for r in got:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_nulls_single_and_empty(spark):
    assert ee.fingerprint_documents(spark.createDataFrame([], DOC)).count() == 0
    one = ee.fingerprint_documents(spark.createDataFrame([(4, "abcd", "", "", 0)], DOC)).collect()
    assert [(r.doc_id, r.edited_text, r.near_next) for r in one] == [(4, "abab", 1.0)]
    rows = [(None, "first", "", "", 0), (1, None, "", "", 0), (2, "last one", "", "", 0)]
    got = {r.doc_id: r.edited_text for r in ee.fingerprint_documents(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {None: "fir", 1: "", 2: "lastfirs"}


def test_banding_finds_near_copies(spark):
    rng = np.random.default_rng(6)
    rows = []
    for k in range(30):
        text = "".join(rng.choice(list("abcdefghij "), 1500 + 37 * k))
        rows += [(10 * k, text), (10 * k + 1, text[:700] + "!" + text[700:]), (10 * k + 2, text[:50] + text[52:])]
    walks = ee.Walks()
    prints = walks.fingerprints([t for _, t in rows])
    like = {(a[0], b[0]): walks.likeness(x, y) for a, x in zip(rows, prints, strict=True) for b, y in zip(rows, prints, strict=True) if a[0] < b[0]}
    got = {(r.a, r.b): r.likeness for r in ee.near_documents(spark.createDataFrame([(r[0], p) for r, p in zip(rows, prints, strict=True)], "doc_id long, fingerprint string")).collect()}
    assert all(like[ab] == s >= 0.8 for ab, s in got.items())
    assert sum((10 * k, 10 * k + 1) in got for k in range(30)) >= 28


def brute_links(walks, prints):
    """All pairs of the smallest ids of each fingerprint, and copies with theirs."""
    reps, out = {}, {}
    for i, fp in sorted(prints):
        if reps.setdefault(fp, i) != i:
            out[reps[fp], i] = 1.0
    items = list(reps.items())
    for k, (x, a) in enumerate(items):
        for y, b in items[k + 1:]:
            like = walks.likeness(x, y)
            if like >= 0.8:
                out[min(a, b), max(a, b)] = like
    return out


def near(spark, prints, **options):
    rows = ee.near_documents(spark.createDataFrame(prints, "doc_id long, fingerprint string"), **options).collect()
    got = {(r.a, r.b): r.likeness for r in rows}
    assert len(got) == len(rows)
    return got


def changed_digits(rng, fp, n):
    out = list(fp)
    for k in rng.choice(len(fp), n, replace=False):
        out[k] = "0123456789abcdef"[(int(out[k], 16) + 1 + int(rng.integers(15))) % 16]
    return "".join(out)


def test_buckets_whose_smallest_id_is_unlike_the_rest(spark):
    rng, walks = np.random.default_rng(8), ee.Walks()
    opening = "".join(rng.choice(list("0123456789abcdef"), 64))  # shared by all, so that some buckets hold them all
    tail = lambda: "".join(rng.choice(list("0123456789abcdef"), 60))
    rows = [(0, opening + tail())]
    for k in range(1, 90):  # one long bucket: groups of three that are like each other only
        base = opening + tail()
        near_base = [opening + changed_digits(rng, base[64:], 3) for _ in range(2)]
        rows += [(10 * k + i, fp) for i, fp in enumerate([base, *near_base, base])]
    want = brute_links(walks, rows)
    got = near(spark, rows)
    assert got == want
    assert all((10 * k + 1, 10 * k + 2) in got and (10 * k, 10 * k + 3) in got for k in range(1, 90))
    few = [(i, fp) for i, fp in rows if i < 60]  # and short ones
    assert near(spark, few) == brute_links(walks, few)


def test_blocks_of_a_long_bucket(spark, monkeypatch):
    monkeypatch.setattr(ee, "BUCKET_BLOCK", 16)
    rng, walks = np.random.default_rng(9), ee.Walks()
    base = "".join(rng.choice(list("0123456789abcdef"), 124))
    rows = [(i, changed_digits(rng, base, 4)) for i in range(150)]  # so alike that every pair shares a band
    assert near(spark, rows) == brute_links(walks, rows)


def test_recall_wherever_the_texts_differ(spark):
    rng, walks, letters = np.random.default_rng(11), ee.Walks(), np.array(list("abcdefghij klmnopqrstuvwxyz"))
    text = lambda n: "".join(rng.choice(letters, n))
    texts, place = [], {}
    for n in (3_000, 16_000, 60_000):
        for where in (0, 0.5, 1):
            for share in (0.02, 0.05, 0.08, 0.12, 0.15):
                for _ in range(3):
                    x, k = text(n), int(n * share)
                    at = int((n - k) * where)
                    place[len(texts), len(texts) + 1] = where
                    texts += [x, x[:at] + text(k) + x[at + k:]]
    prints = list(enumerate(walks.fingerprints(texts)))
    want, got = brute_links(walks, prints), near(spark, prints)
    assert all(want[ab] == s for ab, s in got.items())
    for where in (0, 0.5, 1):
        pairs = [ab for ab in want if place.get(ab) == where]
        assert len(pairs) >= 20 and sum(ab in got for ab in pairs) >= 0.98 * len(pairs)


def test_bands_follow_the_threshold():
    rng = np.random.default_rng(12)
    for least in (0.6, 0.8, 0.95):
        met = 0
        for seed in range(60):
            walks = ee.Walks()
            bands = ee.Bands(walks, least, None, 4, 0.95, seed)
            fp = changed_digits(rng, "0" * 700, 700)[:int(rng.integers(20, 600))]
            other = fp
            for k in range(len(fp)):  # as unlike as ``least`` allows, from the start on
                changed = "g" * (k + 1) + fp[k + 1:]
                if walks.likeness(fp, changed) < least:
                    break
                other = changed
            met += len(np.intersect1d(bands.keys(fp), bands.keys(other))) > 0
        assert met >= 0.9 * 60
