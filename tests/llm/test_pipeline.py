import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tests.llm.data import DOC, documents, near_components, without_repeats


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rows = documents(80)
    last = max(r[0] for r in rows if r[0] is not None)
    rows += [(last + 1 + i, f"calm words number {i} in a text of its own" + (" you moron" if i % 4 == 0 else ""), "en", "s", 0) for i in range(200)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, DOC).write.parquet(f"{folder}/documents.parquet")
    labels = [(last + 1 + i, 1, int(i % 4 == 0)) for i in range(200)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, {last + 1 + i for i in range(200) if i % 4 == 0}


def test_stages(spark, corpus):
    folder, rows, toxic = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(cp.STAGES)
    assert list(stages) == ["toxicity", "minhash near-dedup", "substring dedup", "best-fit packing"]

    one = cp.written(stages["toxicity"](spark, docs, folder), "t")
    assert one.columns == docs.columns
    left = [tuple(r) for r in one.collect()]
    calm = [r for r in rows if "moron" not in (r[1] or "").lower()]  # some of the given documents are toxic too
    assert sorted(left, key=str) == sorted(calm, key=str) and toxic <= {r[0] for r in rows} - {r[0] for r in calm}

    two = cp.written(stages["minhash near-dedup"](spark, one, folder), "t")
    assert two.columns == docs.columns
    parts = near_components(left)[1]
    kept = {r for r in left if r[0] is None or parts[r[0]] == r[0]}
    got = [tuple(r) for r in two.collect()]
    assert sorted(got, key=str) == sorted(kept, key=str)

    three = cp.written(stages["substring dedup"](spark, two, folder), "t")
    want = without_repeats(got)
    expect = [r if r[0] is None or not want[r[0]][1] else (r[0], want[r[0]][2], r[2], r[3], len(want[r[0]][2])) for r in got]
    clean = [tuple(r) for r in three.collect()]
    assert sorted(clean, key=str) == sorted(expect, key=str) and any(want[i][1] for i in want)

    four = stages["best-fit packing"](spark, three, folder).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert sum(r.length for r in four) == sum(len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in clean)
    assert {r.doc_id for r in four} == {r[0] for r in clean}


def test_run_is_the_stages(spark, corpus):
    folder, rows, toxic = corpus
    got = cp.run(spark, folder)
    assert got.count() > 0 and not {r.doc_id for r in got.collect()} & toxic


def test_different_texts_of_one_id_stay(spark, tmp_path):
    text = {k: " ".join(f"{k}{i}" for i in range(200)) for k in "abcdx"}
    rows = [(1, text["a"], "en", "s", 0), (5, text["a"], "en", "s", 0), (5, text["b"], "en", "s", 0), (5, text["b"] + " end", "en", "s", 0), (5, text["c"], "en", "t", 1), (5, text["c"], "en", "s", 2),
            (6, text["b"], "en", "s", 0), (7, text["d"], "en", "s", 0), (7, None, "en", "s", 0), (7, "", "en", "s", 0), (None, text["x"], "en", "s", 0), (None, text["x"], "en", "s", 0)]
    for order in (rows, rows[::-1]):
        got = [tuple(r) for r in cp.drop_near_duplicates(spark, spark.createDataFrame(order, DOC).repartition(3), "").collect()]
        b = [r for r in got if r[1] in (text["b"], text["b"] + " end")]
        assert len(b) == 1 and b[0][0] == 5  # near texts of one id are one group
        assert sorted((r for r in got if r not in b), key=str) == sorted([rows[0], rows[5], *rows[7:]], key=str)
