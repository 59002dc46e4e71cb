"""The registered queries over whole small tables: SQL twins, and the columns
that the others promise."""

import zlib

import pytest

from meterline.llm import queries
from tests.conftest import SF001
from tools.check_oracles import compare, duck

COLUMNS = {
    "op1_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op2_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op6_edit_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op9_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op11_source_mix": ["doc_id", "size", "source_size", "target", "taken"],
    "op10_sentencepiece": ["doc_id", "n_ids", "ids_hash", "decoded_sha256", "round_trip"],
}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_its_oracle(spark, name):
    df = queries.QUERIES[name](spark, SF001)
    cur = duck(SF001).execute(queries.ORACLES[name])
    assert compare([tuple(r) for r in df.collect()], df.columns, cur.fetchall(), [d[0] for d in cur.description]) is None


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    df = queries.QUERIES[name](spark, SF001)
    rows = df.collect()
    assert df.columns == COLUMNS[name]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(docs)
    if name == "op9_sharding":
        sizes = [sum(r.shard == s for r in rows) for s in range(40)]
        assert max(sizes) - min(sizes) <= 1 and len(rows) == len(docs)
        for r in rows:
            data = (docs[r.doc_id] or "").encode()
            assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "rows", None)
    if name == "op10_sentencepiece":
        assert all(r.round_trip for r in rows)
    if name == "op2_toxicity":
        assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
