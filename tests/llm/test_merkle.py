import hashlib
import zlib

from pyspark.sql import functions as F

from meterline.llm import common, merkle, ordering, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, __at long"


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes: list[str]) -> tuple[str, list[list[str]], list[list[tuple[list[str], list[str]]]]]:
    """The top digest and, for every bottom node, its (left, right) siblings by level."""
    paths = [[] for _ in nodes]
    owners = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, over = [], []
        for at in range(0, len(nodes), 3):
            run = nodes[at:at + 3]
            for j in range(len(run)):
                for i in owners[at + j]:
                    paths[i].append((run[:j], run[j + 1:]))
            above.append(sha(*run))
            over.append([i for o in owners[at:at + 3] for i in o])
        nodes, owners = above, over
    return nodes[0], paths


def brute(rows: list[tuple], tamper) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row."""
    groups: dict = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        def h(t, doc_id=doc_id, source=source, lang=lang, n_chars=n_chars):
            return sha(*map(field, (doc_id, source, lang, n_chars, t)))
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, h(text), h(tamper(doc_id, text)), doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops, lower = [], {}
    for name in names:
        groups[name].sort(key=lambda r: r[:3])
        top, paths = climb([r[2] for r in groups[name]])
        tops.append(top)
        lower[name] = paths
    root, upper = climb(tops)
    out = []
    for g, name in enumerate(names):
        for r, path in zip(groups[name], lower[name], strict=True):
            node, whole = r[3], [*path, *upper[g]]
            for left, right in whole:
                node = sha(*left, node, *right)
            out.append((r[4], r[2], tops[g], root, sha(*[x for s in whole for side in s for x in side]), node, node == root))
    return sorted(out, key=str)


def tamper(doc_id, text):
    return text if doc_id is None or text is None or zlib.crc32(str(doc_id).encode()) % 2 else text.replace("\n", "")


def got(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    audit = merkle.verify(merkle.manifest(df, queries.tampered_text()))
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted([tuple(r) for r in audit.select(*cols).collect()], key=str)


def row(i, text, source, n=1, lang="en"):
    return (i, text, lang, source, n, "clash", 7)


def test_awkward_rows(spark):
    rows = [row(i, t, s) for s in (None, "", "a", "ä", "Z") for i, t in enumerate(["x\ny", "", None, "日本\n", "x" * 50_000])]
    rows += [row(None, "no id\n", "a"), row(None, None, None, None, None), row(4, "again\n", "a"), row(4, "other\n", "a"), row(4, "again\n", "a"), row(-7, "\n", "alone")]
    want = brute(rows, tamper)
    assert got(spark, rows) == want and got(spark, rows[::-1], 5) == want
    assert {r[6] for r in want} == {True, False}


def test_every_size_up_to_thirty_and_blocks_of_a_hot_source(spark):
    rows = [row(i, f"t{i}\n", f"s{n:02d}") for n in range(1, 30) for i in range(n)]
    rows += [row(i, f"hot {i}\n", "hot") for i in range(merkle.ARITY ** merkle.LEVELS * 3 + 5)]
    assert got(spark, rows) == brute(rows, tamper)


def test_many_sources_one_row_and_none(spark):
    rows = [row(i, "same\n", f"src{i}") for i in range(300)]
    assert got(spark, rows) == brute(rows, tamper)
    assert got(spark, rows[:1]) == brute(rows[:1], tamper)
    assert got(spark, rows[:1])[0][4] == sha()
    assert got(spark, []) == []


def test_repeats_of_one_row(spark):
    rows = [row(1, "same", "s")] * 400 + [row(2, "b", "s")]
    assert got(spark, rows, 6) == brute(rows, tamper)


def test_without_tampering_all_are_verified(spark):
    audit = merkle.verify(merkle.manifest(spark.createDataFrame([row(i, f"{i}\n", f"s{i % 3}") for i in range(50)], SCHEMA)))
    assert audit.where("verified and leaf = tampered_leaf").count() == 50


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([row(1, "a", "s")], SCHEMA)
    plan = merkle.verify(merkle.manifest(df.select("*"), F.lit(None).cast("string")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_few_intermediate_files(spark, monkeypatch):
    files = {}

    def spy(df, label):
        out = common.written(df, label)
        files[label] = files.get(label, 0) + len(out.inputFiles())
        return out

    monkeypatch.setattr(merkle, "written", spy)
    monkeypatch.setattr(ordering, "written", spy)
    rows = [row(i, f"t{i}\n", f"s{i % 5}") for i in range(1500)]
    assert got(spark, rows, 3) == brute(rows, tamper)
    # an executor starts processes for every file: 3 tasks of leaves, one small file for each other table
    assert set(files) == {"merkle_leaves", "merkle_rows", "merkle_runs", "merkle_pass"}
    assert files["merkle_rows"] == 1 and sum(files.values()) <= 8


def test_sources_that_begin_and_end_anywhere_in_a_partition(spark, monkeypatch):
    monkeypatch.setattr(ordering, "PART_ROWS", 40)
    rows = [row(i, f"t{i}\n", s) for s, n in ((None, 3), ("", 1), ("a", 130), ("b", 2), ("c", 1), ("d", 90), ("é", 60)) for i in range(n)]
    assert got(spark, rows, 4) == brute(rows, tamper)
