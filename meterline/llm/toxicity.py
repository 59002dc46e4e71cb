"""Toxicity scores by a factorization machine over hashed terms.

A text's terms are its lower-cased words and the first characters of its
words (stems that only ever occur with endings). Each term is hashed into
one of ``buckets`` places. The machine scores

    sigmoid(w0 + sum_i w_i + sum_{i<j} <v_i, v_j>)

over the distinct terms of the text: the last sum learns pairs, such as an
insult next to a group mention, that are harmless on their own and that
additive weights miss. It is computed as half of |sum v|^2 - sum |v|^2, so the
cost is linear in the terms.

The fit takes at most ``sample_rows`` labelled documents (those with the smallest
hashed ids) with at most ``sample_bytes`` bytes of terms, the only sample, and runs
in one task; only the machine reaches the driver. Scoring reads every
whole text."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import arrow_batches

BUCKETS = 1 << 18
SAMPLE_ROWS = 12_000
SAMPLE_BYTES = 96 << 20  # four bytes for each distinct term of a sampled text
WORD = re.compile(r"[^\W_]+")
PREFIXES = (4, 5, 6)
CACHE_WORDS = 300_000
PAIR_BLOCK = 1024  # terms counted against each other at once
FIT_ROWS = 1024  # rows of the fit held unpacked at once
TERM_CHUNK = 1 << 12  # terms whose documents are summed up at once
PAIR_CHUNK = 1 << 15  # pairs whose documents are intersected at once


def word_terms(chunk: str, buckets: int) -> list[int]:
    """Hashed terms of one stretch of non-space characters."""
    out = []
    for word in WORD.findall(chunk.lower()):
        out.append(zlib.crc32(word.encode()) % buckets)
        for n in PREFIXES:
            if len(word) >= n:
                out.append(zlib.crc32(b"\x01" + word[:n].encode()) % buckets)
    return out


@dataclass(frozen=True)
class FactorizationMachine:
    """Weights of the terms that matter; all others weigh nothing. Its size is
    bounded by the number of terms kept, never by the corpus."""

    bias: float
    terms: np.ndarray  # sorted bucket numbers
    weights: np.ndarray
    factors: np.ndarray  # terms x factors
    buckets: int

    def scorer(self):
        """A function from a text to its score, remembering words."""
        place = {int(t): i for i, t in enumerate(self.terms)}
        memo: dict[str, tuple[int, ...]] = {}

        def found(chunk: str) -> tuple[int, ...]:
            if len(memo) >= CACHE_WORDS:
                memo.clear()
            got = memo[chunk] = tuple(place[t] for t in word_terms(chunk, self.buckets) if t in place)
            return got

        def score(text: str) -> float:
            seen: set[int] = set()
            for chunk in set(text.split()):
                got = memo.get(chunk)
                if got is None:
                    got = found(chunk)
                if got:
                    seen.update(got)
            z = self.bias
            if seen:
                i = np.fromiter(sorted(seen), np.int64, len(seen))
                v = self.factors[i]
                z += self.weights[i].sum() + 0.5 * float((v.sum(0) ** 2).sum() - (v ** 2).sum())
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        return score


def _screen(docs: list[np.ndarray], y: np.ndarray, buckets: int, keep: int, common: int, least: float) -> np.ndarray:
    """The ``keep`` buckets most associated with the label (G statistic above
    ``least``), so that rare words do not drown the fit in noise, and the
    ``common`` most frequent ones (terms that matter in pairs alone come from
    ``_pair_screen``)."""
    n, n1 = len(y), max(1.0, float(y.sum()))
    df = np.zeros(buckets)
    pos = np.zeros(buckets)
    for d, label in zip(docs, y, strict=True):
        df[d] += 1
        if label:
            pos[d] += 1
    at = np.flatnonzero(df >= 3)
    df, pos, rate = df[at], pos[at], n1 / n
    neg = df - pos

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0)

    g = 2 * (part(pos, df * rate) + part(neg, df * (1 - rate))
             + part(n1 - pos, (n - df) * rate) + part(n - n1 - neg, (n - df) * (1 - rate)))
    best = np.argsort(-g, kind="stable")[:keep]
    return np.union1d(at[best[g[best] >= least]], at[np.argsort(-df, kind="stable")[:common]])


def _pair_screen(docs: list[np.ndarray], y: np.ndarray, least: float) -> np.ndarray:
    """The buckets of all pairs of terms that say together what neither says
    alone: the label's rate in the documents with both exceeds (for either
    label) what the two terms' own rates add up to, with a G statistic above
    ``least`` plus twice the log of the number of pairs.

    All pairs are counted, whatever the single terms' association. A pair whose
    documents with the label are too few to get there even if no others had both
    terms is left out before its other documents are counted; that bound is
    exact. Terms of the very same documents are counted as one."""
    n = len(y)
    entries = np.concatenate(docs).astype(np.int64) << 32  # (term, document) in one number, sorted in place
    entries |= np.repeat(np.arange(n, dtype=np.int32), [len(d) for d in docs])
    entries.sort()
    row = entries.astype(np.int32)  # the low half
    entries >>= 32
    col = entries.astype(np.int32)
    del entries
    at = np.flatnonzero(col[1:] != col[:-1]) + 1
    at = np.concatenate([[0], at]) if len(col) else at
    df = np.diff(np.append(at, len(col)))
    marks = np.random.default_rng(0).integers(0, 2 ** 63, n, np.uint64)
    sums = [np.add.reduceat(marks[row[at[lo]:at[lo:lo + TERM_CHUNK][-1] + df[lo:lo + TERM_CHUNK][-1]]], at[lo:lo + TERM_CHUNK] - at[lo])
            for lo in range(0, len(at), TERM_CHUNK)]
    if not sums:
        return np.zeros(0, np.int64)
    one, alike = np.unique(np.concatenate(sums), return_index=True, return_inverse=True)[1:]
    one = one[df[one] >= 3]
    if len(one) < 2:
        return np.zeros(0, np.int64)
    least = least + 2 * float(np.log(len(one) * (len(one) - 1) / 2))
    found = np.zeros(len(at), bool)
    for label in (1, 0):
        mine = y == label
        rate = mine.mean()
        side = np.add.reduceat(mine[row].astype(np.int32), at).astype(np.int64)
        own = (side + rate) / (df + 1)
        own_logit = np.log(own / (1 - own)) - np.log(rate / (1 - rate))
        most = 2 * side * -np.log(np.maximum(own, rate))
        cand = one[most[one] >= least]
        rank, other_rank = np.cumsum(mine) - 1, np.cumsum(~mine) - 1
        n_mine, n_other = int(mine.sum()), int((~mine).sum())

        def expected(i, j, own=own, own_logit=own_logit, rate=rate):
            both = 1 / (1 + np.exp(-(np.log(rate / (1 - rate)) + own_logit[i] + own_logit[j])))
            return np.minimum(np.maximum(np.maximum(both, rate), np.maximum(own[i], own[j])), 1 - 1e-9)

        bits = np.zeros((len(cand), (n_other + 63) // 64 * 8), np.uint8)
        dense = lambda part: np.zeros((len(part), n_mine), np.float32)
        for k, c in enumerate(cand):
            r = row[at[c]:at[c] + df[c]]
            flags = np.zeros(bits.shape[1] * 8, np.uint8)
            flags[other_rank[r[~mine[r]]]] = 1
            bits[k] = np.packbits(flags)
        words = bits.view(np.uint64)

        def block(part, dense=dense, mine=mine, rank=rank):
            out = dense(part)
            for k, c in enumerate(part):
                r = row[at[c]:at[c] + df[c]]
                out[k, rank[r[mine[r]]]] = 1
            return out

        for lo in range(0, len(cand), PAIR_BLOCK):
            left = block(cand[lo:lo + PAIR_BLOCK])
            for lo2 in range(lo, len(cand), PAIR_BLOCK):
                right = left if lo2 == lo else block(cand[lo2:lo2 + PAIR_BLOCK])
                count = left @ right.T
                if lo2 == lo:
                    count = np.triu(count, 1)
                i, j = np.nonzero(count >= least / (-2 * np.log(rate)))
                a, i, j = count[i, j].astype(float), i + lo, j + lo2
                e = expected(cand[i], cand[j])
                open_ = np.flatnonzero(-2 * a * np.log(e) >= least)
                for cut in range(0, len(open_), PAIR_CHUNK):
                    o = open_[cut:cut + PAIR_CHUNK]
                    b = np.bitwise_count(words[i[o]] & words[j[o]]).sum(1).astype(float)
                    k, x, ek = a[o] + b, a[o], e[o]
                    g = 2 * (x * np.log(x / (k * ek)) + np.where(b > 0, b * np.log(np.maximum(b, 1e-12) / (k * (1 - ek))), 0))
                    hit = o[(x > k * ek) & (g >= least)]
                    found[cand[i[hit]]] = found[cand[j[hit]]] = True
    return col[at[np.isin(alike, alike[found])]].astype(np.int64)


def fit_rows(docs: list[np.ndarray], y: np.ndarray, buckets: int = BUCKETS, factors: int = 8, keep: int = 8192,
             common: int = 48, least: float = 16.0, epochs: int = 150, rate: float = 0.05, l2: float = 3e-4, seed: int = 7) -> FactorizationMachine:
    """Fit on distinct term buckets per document (logistic loss, Adam, whole
    batch; the same rows give the same weights). Without any row, or with one
    label only, the machine is its bias alone."""
    y = np.asarray(y, float)
    n = len(y)
    prior = (y.sum() + 0.5) / (n + 1.0) if n else 0.0
    bias = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    terms = np.zeros(0, np.int64)
    if n and 0 < y.sum() < n:
        terms = np.union1d(_screen(docs, y, buckets, keep, common, least), _pair_screen(docs, y, least))
    m = len(terms)
    rng = np.random.default_rng(seed)
    w, v = np.zeros(m), rng.normal(0, 0.05, (m, factors))
    if not m:
        return FactorizationMachine(bias, terms, w, v, buckets)
    index = np.full(buckets, -1)
    index[terms] = np.arange(m)
    cols = [x[x >= 0] for x in (index[d] for d in docs)]
    cuts = range(0, n, FIT_ROWS)
    packed = []  # the 0/1 table of rows and terms, eight to a byte
    for lo in cuts:
        part = np.zeros((min(FIT_ROWS, n - lo), m), np.uint8)
        for r, c in zip(part, cols[lo:lo + FIT_ROWS], strict=True):
            r[c] = 1
        packed.append(np.packbits(part, axis=1))

    b = bias
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (np.zeros(1), w, v)]
    for step in range(1, epochs + 1):
        right = np.column_stack([v, w, (v ** 2).sum(1)]).astype(np.float32)
        back = np.zeros((m, factors + 1))
        g = np.zeros(n)
        for lo, bits in zip(cuts, packed, strict=True):
            x = np.unpackbits(bits, axis=1, count=m).astype(np.float32)
            got = x @ right
            s = got[:, :factors]
            z = b + got[:, factors] + 0.5 * ((s ** 2).sum(1) - got[:, factors + 1])
            part = (1 / (1 + np.exp(-np.clip(z.astype(float), -30, 30))) - y[lo:lo + FIT_ROWS]) / n
            g[lo:lo + FIT_ROWS] = part
            back += x.T @ np.column_stack([s * part[:, None], part]).astype(np.float32)
        gw = back[:, factors] + l2 * w / 10
        gv = back[:, :factors] - back[:, factors, None] * v + l2 * v / 10
        gb = np.array([g.sum()])
        moved = []
        for (m1, m2), grad in zip(state, (gb, gw, gv), strict=True):
            m1 += 0.1 * (grad - m1)
            m2 += 0.001 * (grad ** 2 - m2)
            moved.append(rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8))
        b, w, v = b - float(moved[0][0]), w - moved[1], v - moved[2]
    return FactorizationMachine(b, terms, w, v, buckets)


def hold_out(id_col: str = "doc_id", fold: int = 2, folds: int = 4) -> Column:
    """Whether the row's id falls into the held-out fold: crc32 of its text
    form modulo ``folds``. A null id counts as held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS, sample_bytes: int = SAMPLE_BYTES, **options) -> FactorizationMachine:
    """Fit from labelled documents outside the held-out fold.

    At most ``sample_rows`` labelled ids (the smallest hashes) take part, and of
    these, in that order, as many as have ``sample_bytes`` bytes of terms (one at least);
    their list is small enough to broadcast, so no text is shuffled. Of the
    texts of a repeated id the one with the smallest MD5 counts. Rows with a null id or label are not
    used; contradicting labels of one id count as 1. The rows of the sample go
    to one task, which fits; the driver receives the machine."""
    spark = docs.sparkSession
    arrow_batches(spark)
    chosen = (labels.where(~hold_out(id_col) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("__y"))
              .orderBy(F.xxhash64("__id"), "__id").limit(sample_rows))
    texts = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("__text"):
                got: set[int] = set()
                for chunk in set(text.as_py().split()):
                    got.update(word_terms(chunk, buckets))
                out.append(np.fromiter(sorted(got), np.int32, len(got)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("__y"), batch.column("__key"), pa.array(out, pa.binary())], ["id", "y", "key", "terms"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, y, size = [], [], 0
        for batch in batches:
            for label, data in zip(batch.column("y").to_pylist(), batch.column("terms").to_pylist(), strict=True):
                size += len(data)
                if size <= sample_bytes or not lists:
                    lists.append(np.frombuffer(data, np.int32))
                    y.append(label)
        machine = fit_rows(lists, np.array(y, float), buckets, **options)
        arrays = [pa.array([a.tobytes()], pa.binary()) for a in (machine.terms, machine.weights, machine.factors)]
        yield pa.RecordBatch.from_arrays([pa.array([machine.bias]), pa.array([machine.factors.shape[1]], pa.int32()), *arrays],
                                         ["bias", "width", "terms", "weights", "factors"])

    found = (texts.join(F.broadcast(chosen), "__id").select("__id", "__y", F.md5("__text").alias("__key"), "__text")
             .mapInArrow(terms, f"id {docs.schema[id_col].dataType.simpleString()}, y int, key string, terms binary"))
    one = found.groupBy("id").agg(F.min(F.struct("key", "y", "terms")).alias("row")).select("id", "row.y", "row.terms")
    rows = one.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id").select("y", "terms")
    got = rows.mapInArrow(fitted, "bias double, width int, terms binary, weights binary, factors binary").first()
    if got is None:
        return fit_rows([], np.zeros(0), buckets, **options)
    weights = np.frombuffer(got.weights)
    return FactorizationMachine(got.bias, np.frombuffer(got.terms, np.int64), weights, np.frombuffer(got.factors).reshape(len(weights), got.width), buckets)


def score(docs: DataFrame, machine: FactorizationMachine, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` in [0, 1] for every row; a null text scores
    as an empty one. All other columns pass through (an old ``score_col`` is
    replaced)."""
    arrow_batches(docs.sparkSession)
    parts = (machine.bias, machine.terms, machine.weights, machine.factors, machine.buckets)
    model = docs.sparkSession.sparkContext.broadcast(parts)  # bounded by the terms kept

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = FactorizationMachine(*model.value).scorer()
        for texts in batches:
            yield pd.Series([one(t or "") for t in texts], dtype="float64")

    return docs.withColumn(score_col, scored(F.col(text_col).cast("string")))
