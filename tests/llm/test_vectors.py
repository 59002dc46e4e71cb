import contextlib
import os
import threading
from pathlib import Path

import numpy as np
import pyarrow as pa

from meterline.llm import spherical
from meterline.session import checkpoint_dir
from tests.llm.data import find, union

SCHEMA = "vec_id long, embedding array<float>, label int, rep long"


def brute(rows, cosine=0.93):
    good = {}
    for i, v, label, *_ in rows:
        if i is not None and v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = (label, np.asarray(np.asarray(v, np.float32), float))
    links, parent = dict.fromkeys(good, 0), {i: i for i in good}
    ids = list(good)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            (la, x), (lb, y) = good[a], good[b]
            if la == lb and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                links[a] += 1
                links[b] += 1
                union(parent, a, b)
    return links, {i: find(parent, i) for i in good}


def vectors():
    rng = np.random.default_rng(12)
    rows = []
    centres = rng.normal(size=(8, 24))
    for i in range(240):
        c = centres[i % 8]
        v = c + rng.normal(size=24) * rng.choice([0.02, 0.1, 0.25])
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 2, 0))
    rows += [(300 + k, rows[0][1], 0, 0) for k in range(30)]  # copies
    rows += [(400, [2 * x for x in rows[0][1]], 0, 0), (401, [x * 1e-30 for x in rows[0][1]], 0, 0), (402, rows[0][1], 1, 0), (403, rows[0][1], None, 0),
             (404, None, 0, 0), (405, [0.0] * 24, 0, 0), (406, [float("nan")] * 24, 0, 0), (407, [None] * 24, 0, 0), (408, [], 0, 0), (409, [1.0, 2.0], 0, 0),
             (410, [2.0, 4.0], 0, 0), (411, [float("inf")] * 24, 0, 0), (None, rows[0][1], 0, 0), rows[9]]
    return rows


def test_against_all_pairs(spark):
    rows = vectors()
    got = spherical.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    links, parts = brute(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, False)
        else:
            assert (r.n_links, r.component_id, r.kept) == (links.get(r.vec_id, 0), parts.get(r.vec_id, r.vec_id), parts.get(r.vec_id, r.vec_id) == r.vec_id), r


def test_recall_at_the_threshold():
    rng = np.random.default_rng(0)
    x = spherical._unit(rng.normal(size=(400, 64)))
    w = rng.normal(size=(400, 64))
    w = spherical._unit(w - (w * x).sum(1, keepdims=True) * x)
    y = 0.93 * x + np.sqrt(1 - 0.93 ** 2) * w
    met = np.zeros(400, bool)
    for number in range(spherical.CODES):
        code = spherical.ProductCode(64, spherical.CODEWORDS, 3, number, spherical.DEPTH)
        met |= [bool(np.intersect1d(a, b).size) for a, b in zip(code.decode(x), code.decode(y), strict=True)]
    assert met.mean() > 0.98


def test_decode_lists_exactly_the_exceeding_directions():
    code = spherical.ProductCode(10, 6, 1, 0, 2)
    x = spherical._unit(np.random.default_rng(1).normal(size=(20, 10)))
    for v, got in zip(x, code.decode(x), strict=True):
        p = (np.r_[v, 0, 0] @ code.rotation).reshape(4, 3)
        s = [p[k] @ code.books[k].T for k in range(4)]
        total = (s[0][:, None, None, None] + s[1][:, None, None] + s[2][:, None] + s[3]).ravel()
        want = np.flatnonzero(total >= min(code.least, total.max()) - 1e-12)
        assert set(want) == set(got.tolist())


def test_blocks_of_a_large_direction(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=16)
    rows = [(i, [float(x) for x in (base + rng.normal(size=16) * 0.02).astype(np.float32)], 1, 0) for i in range(150)]
    classes = spark.createDataFrame([(i, 1, 16, bytearray(np.asarray(v, np.float64).tobytes()), 1) for i, v, *_ in rows], "rep long, space int, dim int, x binary, copies long")
    got = spherical.linked_vectors(classes, "bigint", 0.93, 16, 2, 2, 3, block=20).groupBy("rep").sum("links").collect()
    assert {r[0]: r[1] for r in got} == brute(rows)[0]


def test_empty(spark):
    assert spherical.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_vector_has_a_direction():
    """The best direction counts whatever rounding does to its halves."""
    for dim in (2, 3, 10, 64, 256):
        x = spherical._unit(np.random.default_rng(dim).normal(size=(10_000 if dim < 200 else 2_000, dim)))
        code = spherical.ProductCode(dim, spherical.CODEWORDS, 3, 0, spherical.DEPTH)
        assert min(map(len, code.decode(x))) >= 1


def test_shared_directions_in_parts(spark, monkeypatch):
    """Links are counted once whatever number of directions is looked at together."""
    x = np.random.default_rng(6).normal(size=(60, 8))
    rows = [(i, (x[i // 6] + 0.02 * x[(i * 7) % 60]).tolist(), 1) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = sorted(map(str, spherical.near_vectors(df).collect()))
    monkeypatch.setattr(spherical, "NAMES", 3)
    assert sorted(map(str, spherical.near_vectors(df).collect())) == want


def clustered(n, dim, centres, seed, noise=0.05):
    rng = np.random.default_rng(seed)
    c = spherical._unit(rng.normal(size=(centres, dim)))
    return (c[np.arange(n) % centres] + noise / np.sqrt(dim) * rng.normal(size=(n, dim))).astype(np.float32)


def test_disk_in_proportion_to_the_vectors(spark, monkeypatch):
    """Intermediate tables and shuffle files together stay a small multiple of the
    vectors, also while they link (before: lists and vectors for each direction)."""
    monkeypatch.setattr(spherical, "PASS_BYTES", 0, raising=False)
    x = clustered(3000, 64, 30, 4, 0.2)
    folders = [Path(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    folders.append(Path(checkpoint_dir(spark).removeprefix("file:")) / "meterline" / "llm")

    def used():
        total = 0
        for top in folders:
            for d, _, names in os.walk(top):
                for name in names:
                    if top is folders[-1] or name.startswith("shuffle_"):
                        with contextlib.suppress(OSError):
                            total += os.stat(f"{d}/{name}").st_size
        return total

    before, most, over = used(), [0], threading.Event()

    def watch():
        while not over.wait(0.05):
            most[0] = max(most[0], used() - before)

    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        got = spherical.near_vectors(rows, codes=2).agg({"n_links": "sum"}).first()[0]
    finally:
        over.set()
        watcher.join()
    assert got > 200_000  # of 297,000 link ends, with two codes
    assert max(most[0], used() - before) < 6 * x.nbytes


def test_cells_blocks_and_turns_give_the_same(spark, monkeypatch):
    """Whatever is a group or a turn, the links are those of pairs that share a direction, once each."""
    rows = [(1000 * k + i, v.astype(kept).tobytes(), k, len(v), 1 + i % 2) for k, (dim, n, kept) in enumerate([(16, 90, np.float32), (16, 70, np.float32), (7, 60, np.float64), (64, 12, np.float64)])
            for i, v in enumerate(clustered(n, dim, 6, k, 0.25))]
    classes = spark.createDataFrame([(i, k, dim, bytearray(v), n) for i, v, k, dim, n in rows], "rep long, space int, dim int, x binary, copies long")
    want, root = dict.fromkeys((r[0] for r in rows), 0), {r[0]: r[0] for r in rows}
    for k in range(4):
        own = [r for r in rows if r[2] == k]
        x = np.concatenate([spherical._units(pa.array([r[1]]), r[3]) for r in own])
        lists = [[set(f) for f in spherical.ProductCode(own[0][3], 8, 3, number, 1).decode(x)] for number in range(3)]
        for a in range(len(own)):
            for b in range(a):
                if x[a] @ x[b] >= 0.93 and any(f[a] & f[b] for f in lists):
                    want[own[a][0]] += own[b][4]
                    want[own[b][0]] += own[a][4]
                    union(root, own[a][0], own[b][0])
    want = {i: n for i, n in want.items() if n}
    assert len(want) > 150
    for block, cell_bytes, pass_bytes, share in ((512, 32 << 20, 256 << 20, spherical.SHARE), (16, 32 << 20, 0, spherical.SHARE), (4, 16 * 8 * 20, 256 << 20, spherical.SHARE), (16, 32 << 20, 1 << 40, (1, 1e5, 1e5, 1e5))):
        monkeypatch.setattr(spherical, "CELL_BYTES", cell_bytes)
        monkeypatch.setattr(spherical, "PASS_BYTES", pass_bytes)
        monkeypatch.setattr(spherical, "SHARE", share)
        got = spherical.linked_vectors(classes, "bigint", 0.93, 8, 1, 3, 3, block=block).collect()
        links, found = {}, {r[0]: r[0] for r in rows}
        for rep, n, other in got:
            links[rep] = links.get(rep, 0) + n
            union(found, rep, other)
        assert links == want, (block, cell_bytes, pass_bytes)
        assert all(find(found, i) == find(root, i) for i in root)


def test_turns_cover_every_cell_once():
    for codes in (1, 3, 10):
        for wanted in (1, 2, 3, 7, 10, 11, 40):
            turns = spherical._turns(codes, wanted)
            assert len(turns) >= wanted
            cells = [(c, cell) for numbers, part, parts in turns for c in numbers for cell in range(50) if cell % parts == part]
            assert sorted(cells) == [(c, cell) for c in range(codes) for cell in range(50)]


def test_lists_do_not_depend_on_company():
    """A vector has the same products and lists in every task that decodes it, and
    the first shared direction is that of the lists."""
    code = spherical.ProductCode(64, 32, 3, 0, 1)
    x = spherical._unit(np.concatenate([clustered(400, 64, 40, 1, 0.5), clustered(300, 64, 300, 2)]).astype(float))
    some = np.random.default_rng(1).permutation(700)[:333]
    assert all((a[some] == b).all() for a, b in zip(code.sections(x), code.sections(x[some]), strict=True))
    lists = code.decode(x)
    for words in (1, 2, 3):
        cell = int(lists[0][0] // code.below[words])
        row, f = code.listed(code.sections(x), cell, words)
        assert [(r, g) for r, g in zip(row, f, strict=True)] == [(r, g) for r, own in enumerate(lists) for g in own if g // code.below[words] == cell]
    u, v = np.triu_indices(400, 1)
    want = np.array([min(set(lists[a]) & set(lists[b]), default=-1) for a, b in zip(u, v, strict=True)])
    assert (code.first_shared(x, u, v) == want).all()
    assert (code.shared(x, u, v) == (want >= 0)).all()
    end = int(np.median(want[want >= 0]))
    assert (code.first_shared(x, u, v, end) == np.where(want < end, want, -1)).all()
