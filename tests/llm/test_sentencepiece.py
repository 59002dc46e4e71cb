import random

import numpy as np
import public_tokenizers
import sentencepiece

from meterline.llm import sentencepiece_codec as sc
from tests.llm.data import DOC, documents

PATH = public_tokenizers.path("piece_bpe_32k.model")


def model():
    with open(PATH, "rb") as f:
        return sc.Model.parse(f.read())


def test_equals_the_library():
    codec, library = sc.Codec(model()), sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(3)
    texts = [t for _, t, *_ in documents(40) if t is not None and len(t) < 60_000]
    texts += ["".join(rng.choice("ab etin  sor.,ABé日\n\t0😀▁<s>") for _ in range(rng.randint(0, 120))) for _ in range(800)]
    for t in texts:
        ids = codec.encode(t)
        assert ids.tolist() == library.encode(t), t[:80]
        assert codec.decode(ids) == library.decode(ids.tolist())
        assert MARKED(t) or codec.decode(ids) == t


def MARKED(t):  # the mark itself reads back as a space
    return sc.MARK in t


def test_streams_text_without_any_space():
    codec, library = sc.Codec(model()), sentencepiece.SentencePieceProcessor(model_file=PATH)
    rng = random.Random(5)
    text = "".join(rng.choice("abetinsor") for _ in range(8000))
    assert codec.encode(text).tolist() == library.encode(text)
    codec.split = False  # one lattice for the whole text
    many = " ".join(text[i:i + 7] for i in range(0, 3000, 7))
    assert codec.encode(many).tolist() == library.encode(many)


def test_window_is_bounded():
    codec, widest = sc.Codec(model()), 0
    meet = codec._meet

    def watched(back, base, end):
        nonlocal widest
        widest = max(widest, end - base)
        return meet(back, base, end)

    codec._meet = watched
    list(codec.paths("".join(random.Random(1).choice("abetinsor") for _ in range(5000))))
    assert 0 < widest < 40 * codec.longest


def unigram(scores):
    m = sc.Model(pieces=["<unk>", *scores], scores=[0.0, *scores.values()], kinds=[sc.UNKNOWN] + [sc.NORMAL] * len(scores), type=sc.UNIGRAM, squeeze=False)
    return sc.Codec(m)


def test_unigram_is_the_best_path():
    rng = random.Random(9)
    for _ in range(40):
        pieces = {c: -rng.uniform(2, 6) for c in "abc▁"}
        pieces |= {"".join(rng.choice("abc▁") for _ in range(rng.randint(2, 5))): -rng.uniform(1, 9) for _ in range(25)}
        codec = unigram(pieces)
        text = "".join(rng.choice("abc d") for _ in range(90))
        normal = codec.normalized(text)
        best = [0.0] + [-1e18] * len(normal)
        for e in range(1, len(normal) + 1):
            for s in range(max(0, e - 5), e):
                p = normal[s:e]
                v = pieces.get(p, codec.least if e - s == 1 else None)
                if v is not None:
                    best[e] = max(best[e], best[s] + v)
        path = list(codec.paths(normal))
        assert "".join(path) == normal
        assert abs(sum(pieces.get(p, codec.least) for p in path) - best[-1]) < 1e-9


def test_unknown_runs_are_one_id():
    codec = unigram({"a": -1.0, sc.MARK: -1.0})
    assert codec.encode("a xyz a").tolist() == [2, 1, 2, 0, 2, 1]


def test_encode_and_decode(spark):
    rows = documents(40)
    docs = spark.createDataFrame(rows, DOC).withColumn("ids", sc.F.lit("old"))
    coded = sc.encode(docs, PATH)
    got = sc.decode(coded.withColumn("decoded", sc.F.lit(1)), PATH).collect()
    assert len(got) == len(rows) and all(r.decoded == (r.text or "") for r in got)
    assert all(r.ids == [] for r in got if not r.text)
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert sc.decode(nulls, PATH).first().decoded == ""
    assert sc.encode(docs.limit(0), PATH).count() == 0


def test_other_models_are_refused():
    m = b"\x0a\x05\x0a\x01a\x18\x04"  # one user-defined piece
    try:
        sc.Model.parse(m)
    except ValueError:
        return
    raise AssertionError


def test_decode_table():
    codec = sc.Codec(model())
    assert codec.decode(np.asarray([codec.bytes[0xC3]], np.int32)) == "�"


def test_a_worker_keeps_the_codec_for_its_tasks(spark):
    with open(PATH, "rb") as f:
        data = f.read()
    assert sc._codec(data) is sc._codec(bytes(bytearray(data)))
    texts = [(i, t) for i, t, *_ in documents(12)] + [(100, None), (101, ""), (102, "a b"), (102, "a b")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    fresh = sc.Codec(model())
    for _ in range(2):  # the second run meets warm workers
        got = sorted(((r.doc_id, r.text or "", list(r.ids)) for r in sc.encode(df, PATH).collect()), key=str)
        assert got == sorted(((i, t or "", fresh.encode(t or "").tolist()) for i, t in texts), key=str)
