import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from meterline.llm import minhash, substring
from meterline.llm.components import components
from meterline.llm.shingles import shingle_set
from tests.llm.data import DOC, documents, find, near_components, shingles, union, without_repeats


def test_near_duplicates(spark):
    rows = documents()
    got = minhash.near_duplicates(spark.createDataFrame(rows, DOC)).collect()
    assert len(got) == len(rows)
    sizes, parts = near_components(rows)
    for r in got:
        if r.doc_id is None:
            assert not r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (sizes[r.doc_id], parts[r.doc_id], parts[r.doc_id] == r.doc_id)


def test_chain_of_near_copies_in_one_list(spark):
    """A group whose members link only along a chain, and a crowd around one base."""
    base = [f"b{i}" for i in range(120)]
    rows = [(0, " ".join(base), "", "", 0)]
    for k in range(1, 60):  # each copy has one edit of its own: linked with the base, hardly with each other
        w = list(base)
        for j in range(3):
            w[(7 * k + 31 * j) % 120] = f"e{k}x{j}"
        rows.append((k, " ".join(w), "", "", 0))
    chain = [f"c{i}" for i in range(200)]
    for k in range(12):
        rows.append((100 + k, " ".join(chain[12 * k:12 * k + 60 + 60]), "", "", 0))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, DOC)).collect()}
    assert got == near_components(rows)[1]


def test_long_lists_in_blocks(spark, monkeypatch):
    """The same components when every list is compared in blocks."""
    monkeypatch.setattr(minhash, "LONG_LIST", 1)
    monkeypatch.setattr(minhash, "BLOCK", 4)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for k in range(40):  # deletions: copies that are alike in many shades
        w = [x for i, x in enumerate(base) if i not in {(3 * k) % 100, (7 * k + 1) % 100, *((11 * k + j * 17) % 100 for j in range(k % 6))}]
        rows.append((k, " ".join(w), "", "", 0))
    rows += [(100 + i, t, "", "", 0) for i, t in enumerate([r[1] for r in documents() if r[0] is not None][-20:])]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, DOC)).collect()}
    want = near_components(rows)[1]
    assert got == want and len({want[k] for k in range(40)}) > 2


def test_shingle_set_size():
    for _, t, *_ in documents(30):
        assert len(shingle_set((t or "").encode())) == len(shingles(t))


def test_near_duplicates_empty_and_clashing(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], DOC)).count() == 0
    one = spark.createDataFrame([(5, "a text", 1, 2)], "doc_id long, text string, rep long, sig long")
    assert [tuple(r) for r in minhash.near_duplicates(one).collect()] == [(5, 1, 5, True)]


def test_remove_repeats(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, DOC).withColumn("n_words", substring.F.lit("old"))
    got = substring.remove_repeats(docs).collect()
    assert len(got) == len(rows)
    want = without_repeats(rows)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_words, r.n_removed, r.kept_text) == want[r.doc_id]
    assert sum(r.n_removed > 0 for r in got) > 5


def several_texts_of_one_id() -> list[tuple]:
    text = {k: [f"{k}{i}" for i in range(200)] for k in "abcdu"}
    near = {k: " ".join([*text[k][:100], "changed", *text[k][101:]]) for k in "abcd"}
    t = {k: " ".join(w) for k, w in text.items()}
    ids = [(5, t["a"]), (5, t["b"]), (7, near["a"]), (8, near["b"]), (3, near["c"]), (5, t["c"]), (9, t["c"]), (2, t["d"]), (2, near["d"]), (2, t["d"]),
           (1, " ".join(text["u"][:60])), (5, " ".join([*text["u"][:60], "and", "more"])), (5, " ".join(f"own{i}" for i in range(90))), (5, None), (5, ""), (None, near["b"]), (None, None)]
    return [(i, t, "", "", 0) for i, t in ids]


def test_near_duplicates_with_several_texts_of_one_id(spark):
    """Every row is a document; the result does not depend on the rows' order."""
    rows = several_texts_of_one_id()
    sets = [shingles(r[1]) for r in rows]
    parent = {i: i for i in range(len(rows))}
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if rows[i][0] is not None and rows[j][0] is not None and a and 100 * len(a & b) >= 75 * len(a | b):
                union(parent, i, j)
    part = {}
    for i, r in enumerate(rows):
        part.setdefault(find(parent, i), []).append(r[0])
    want = [(r[0], len(sets[i]), min(part[find(parent, i)]), r[0] == min(part[find(parent, i)])) for i, r in enumerate(rows) if r[0] is not None]
    for order in (rows, rows[::-1]):
        got = [tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(order, DOC).repartition(3)).collect()]
        assert sorted(g for g in got if g[0] is not None) == sorted(want)
        alone = sorted((g for g in got if g[0] is None), key=str)
        assert [(g[1] == 0, g[3]) for g in alone] == [(True, False), (False, False)]  # a null text, then a text near b
    assert (7, 196, 5, False) in want and (8, 196, 5, False) in want


def test_remove_repeats_with_several_texts_of_one_id(spark):
    rows = several_texts_of_one_id()
    first, want = {}, []
    for i, t, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words = (t or "").split()
        gone = [False] * len(words)
        for j in range(len(words) - 49):
            if first.setdefault(tuple(words[j:j + 50]), i) < i:
                gone[j:j + 50] = [True] * 50
        want.append((i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    for order in (rows, rows[::-1]):
        got = substring.remove_repeats(spark.createDataFrame(order, DOC).repartition(3)).collect()
        assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got if r.doc_id is not None) == sorted(want)
        assert all(r.n_removed == 0 for r in got if r.doc_id is None)
    assert any(w[2] == 60 for w in want) and any(w[1] == 90 and not w[2] for w in want)


def test_a_row_repeated_many_times(spark):
    words = [f"w{i}" for i in range(80)]
    rows = [(1, " ".join(words), "", "", 0)] + [(2, " ".join(["x", *words]), "", "", 0)] * 3000
    docs = spark.createDataFrame(rows, DOC)
    assert {(r.doc_id, r.n_removed) for r in substring.remove_repeats(docs).collect()} == {(1, 0), (2, 80)}
    assert {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()} == {(1, 1), (2, 1)}


def test_remove_repeats_empty(spark):
    assert substring.remove_repeats(spark.createDataFrame([], DOC)).count() == 0


@settings(max_examples=120, deadline=None)
@given(st.data())
def test_inner_symbols_do_not_depend_on_the_surroundings(data):
    """The symbols well inside a passage are equal wherever it stands, also in
    text of few different words."""
    letters = data.draw(st.sampled_from(["ab", "abcdefgh"]))
    draw = lambda n: data.draw(st.text(letters, min_size=0, max_size=n))
    passage = data.draw(st.text(letters, min_size=50, max_size=60))
    edge, found = substring.margin(substring.CAPS), []
    for before, after in ((draw(30), draw(30)), (draw(30), draw(30))):
        text = before + passage + after
        h = np.array([ord(c) * 2654435761 for c in text], np.uint64)
        first = np.zeros(len(h), bool)
        first[0] = True
        name, start, size = substring.recompress(h, first, substring.CAPS)
        at = len(before)
        inside = (start >= at + edge) & (start + size <= at + len(passage) - edge)
        found.append([(int(n), int(s) - at, int(k)) for n, s, k in zip(name[inside], start[inside], size[inside], strict=True)])
    assert found[0] == found[1] and found[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.text("ab", min_size=0, max_size=90)), min_size=1, max_size=6))
def test_every_window_has_an_anchor_of_its_own_words(texts):
    docs = [" ".join(t).encode() for _, t in texts]
    got = substring.parse(docs, 50, substring.CAPS)
    assert len(got.window) == sum(max(0, len(t) - 49) for _, t in texts)
    if len(got.window):
        start = got.anchor_start[got.anchor]
        assert (start >= got.window + 8).all() and (start < got.window + 42).all()
        seen = {}
        words = [w for d in got.words for w in d]
        for p, a in zip(got.window, got.anchor, strict=True):  # equal windows choose equal anchors
            key = tuple(words[p:p + 50])
            mine = (int(got.anchor_start[a] - p), int(got.anchor_key[a]))
            assert seen.setdefault(key, mine) == mine


def test_components_against_union_find(spark):
    rng = np.random.default_rng(8)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1040)] + [(5, 5)]
    parent = {x: x for ab in links for x in ab}
    for a, b in links:
        union(parent, a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()}
    assert got == {x: find(parent, x) for x in parent if any(x in ab and ab[0] != ab[1] for ab in links)}
