"""Exact removal of long repeated word passages, found by recompression.

Every document is a sequence of symbols, at first its words. A recompression
round names maximal runs of one symbol, then adjacent pairs whose left symbol
hashes to the left side and whose right one to the right side. A name is a
64-bit hash of what it stands for, so all tasks name equal runs and pairs
alike, without exchanging a dictionary, and equal passages get equal symbols
everywhere but near their ends. A round lets symbols grow to ``caps[r]`` words at
most; runs and pairs beyond that are left alone. So a passage's symbols can
depend on what surrounds it in at most 2 * (cap - 1) words per round and side:
with the default caps every window of 50 words has the same symbols in its
inner words, wherever it occurs.

Spark rounds:
1. Of the symbols inside each window the one with the smallest hash is the
   window's anchor. Anchors (with the words next to them, which the window
   contains too) are counted over the corpus: those of a single document go.
2. Only windows whose anchor is shared are hashed as a whole (96 bits) and
   grouped; a window that occurs in a smaller document is a repeat.
3. Repeats are brought back to their documents, whose covered words go.

Documents with equal word sequences are settled first: all but the smallest
lose every word (if they hold a window at all).

A row is known by its id and a 64-bit hash of its text, so that different texts
of one id keep their own windows; rows equal in both are one document."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.common import arrow_batches, maybe_broadcast, written
from meterline.llm.shingles import BASE, mix, word_hashes

WINDOW = 50
CAPS = (2, 4)


def margin(caps: tuple[int, ...]) -> int:
    """Words at either end of a passage whose symbols may depend on its surroundings."""
    return sum(2 * (c - 1) for c in caps)


def recompress(h: np.ndarray, first: np.ndarray, caps: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, start, words) of the symbols after the rounds; ``first`` marks the
    first word of each document, across which nothing is joined."""
    name, start, size, head = mix(h), np.arange(len(h)), np.ones(len(h), np.int64), first.copy()
    for r, cap in enumerate(caps):
        n = len(name)
        begins = np.flatnonzero(np.r_[True, name[1:] != name[:-1]] | head)
        k = np.diff(np.r_[begins, n])
        total = k * size[begins]
        run = (k > 1) & (total <= cap)
        keep = np.ones(n, bool)
        if run.any():
            inside = np.zeros(n + 1, np.int64)
            np.add.at(inside, begins[run] + 1, 1)
            np.add.at(inside, begins[run] + k[run], -1)
            keep = np.cumsum(inside[:n]) == 0
            name[begins[run]] = mix(name[begins[run]] * BASE + k[run].astype(np.uint64) + np.uint64(2 * r + 1))
            size[begins[run]] = total[run]
        name, start, size, head = name[keep], start[keep], size[keep], head[keep]
        right = mix(name + np.uint64(r + 11)) >> np.uint64(63) == 1
        at = np.flatnonzero(~right[:-1] & right[1:] & ~head[1:] & (size[:-1] + size[1:] <= cap))
        name[at] = mix((name[at] * BASE + name[at + 1]) * BASE + np.uint64(2 * r + 2))
        size[at] += size[at + 1]
        keep = np.ones(len(name), bool)
        keep[at + 1] = False
        name, start, size, head = name[keep], start[keep], size[keep], head[keep]
    return name, start, size


class Rolling:
    """Hashes of stretches of a word sequence, from prefix sums."""

    def __init__(self, h: np.ndarray, base: int):
        self.up = np.full(len(h) + 1, base, np.uint64)
        self.up[0] = 1
        self.up = np.cumprod(self.up)
        self.down = np.full(len(h) + 1, pow(base, -1, 1 << 64), np.uint64)
        self.down[0] = 1
        self.down = np.cumprod(self.down)
        self.sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * self.up[:-1], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.down[begin])


@dataclass
class Parsed:
    """A batch of documents, their windows and the windows' anchors."""

    words: list[list[bytes]]
    cut: np.ndarray  # word index at which each document starts, and the end
    window: np.ndarray  # first word of each window
    window_doc: np.ndarray
    anchor: np.ndarray  # place in the lists below, per window
    anchor_start: np.ndarray
    anchor_doc: np.ndarray
    anchor_key: np.ndarray
    hashes: np.ndarray


def parse(texts: list[bytes], window: int, caps: tuple[int, ...]) -> Parsed:
    words = [t.split() for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    cut = np.r_[0, np.cumsum(n)]
    h = np.concatenate([word_hashes(w) for w in words]) if len(words) else np.zeros(0, np.uint64)
    wins = np.maximum(n - window + 1, 0)
    none = np.zeros(0, np.int64)
    if not wins.sum():
        return Parsed(words, cut, none, none, none, none, none, none.astype(np.uint64), h)
    first = np.zeros(len(h), bool)
    first[cut[:-1][n > 0]] = True
    name, start, size = recompress(h, first, caps)
    doc = np.repeat(np.arange(len(n)), wins)
    p = np.arange(wins.sum()) - np.repeat(np.cumsum(wins) - wins, wins) + cut[doc]
    edge = margin(caps)
    lo = np.searchsorted(start, p + edge, side="left")
    hi = np.searchsorted(start + size, p + window - edge, side="right")
    # smallest hash in [lo, hi): minima over powers of two, two of which cover any range
    low = np.uint64((1 << len(name).bit_length()) - 1)
    key = (mix(name ^ BASE) & ~low) | np.arange(len(name), dtype=np.uint64)
    level = np.frexp((hi - lo).astype(float))[1] - 1
    best = np.zeros(len(p), np.uint64)
    table, wide = key, 1
    for j in range(int(level.max()) + 1):
        at = np.flatnonzero(level == j)
        best[at] = np.minimum(table[lo[at]], table[hi[at] - wide])
        if len(table) > wide:
            table = np.minimum(table[:-wide], table[wide:])
        wide *= 2
    symbol, anchor = np.unique((best & low).astype(np.int64), return_inverse=True)
    a, b = start[symbol], start[symbol] + size[symbol]
    context = Rolling(h, int(BASE)).of(a - edge, b + edge)
    return Parsed(words, cut, p, doc, anchor, a, np.searchsorted(cut, a, side="right") - 1, mix(name[symbol] + context), h)


def _batches(batches: Iterator[pa.RecordBatch], words: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``words`` words, so that the arrays above stay small."""
    for batch in batches:
        at, held = 0, 0
        size = pa.compute.fill_null(pa.compute.binary_length(batch.column("__text")), 0).to_pylist()
        for i, s in enumerate(size):
            if held and held + s > 6 * words:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += s
        if at < batch.num_rows:
            yield batch.slice(at)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("__text").to_pylist()]


def find_anchors(docs: DataFrame, kind: str, window: int, caps: tuple[int, ...]) -> DataFrame:
    """(id, text_key, words_key, keys, starts) per document with a window: its distinct
    anchor keys and the places of each."""

    def run(batches):
        for batch in _batches(batches):
            got = parse(_texts(batch), window, caps)
            n = np.diff(got.cut)
            rows = np.flatnonzero(n >= window)
            whole = [xxhash.xxh3_128_digest(got.hashes[got.cut[i]:got.cut[i + 1]].tobytes()) for i in rows]
            # a key once per document, with all its places: repeated lines do not multiply rows
            order = np.lexsort((got.anchor_start, got.anchor_key, got.anchor_doc))
            doc, key, start = got.anchor_doc[order], got.anchor_key[order], got.anchor_start[order]
            new = np.ones(len(order), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
            head = np.flatnonzero(new)
            places = pa.ListArray.from_arrays(pa.array(np.r_[head, len(order)].astype(np.int32)), pa.array((start - got.cut[doc]).astype(np.int32)))
            outer = pa.array(np.r_[np.searchsorted(doc[head], rows, side="left"), len(head)].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id").take(pa.array(rows)), batch.column("__key").take(pa.array(rows)), pa.array(whole, pa.binary()),
                 pa.ListArray.from_arrays(outer, pa.array(key[head].view(np.int64))), pa.ListArray.from_arrays(outer, places)],
                ["id", "text_key", "words_key", "keys", "starts"])

    return docs.where("__id is not null").mapInArrow(run, f"id {kind}, text_key long, words_key binary, keys array<long>, starts array<array<int>>")


def shared_windows(texts: DataFrame, kind: str, window: int, caps: tuple[int, ...]) -> DataFrame:
    """(h, g, id, text_key, needy, starts): the distinct windows with a shared anchor, from
    rows that carry the starts of their shared anchors; needy if a smaller
    document has the anchor."""

    def run(batches):
        for batch in _batches(batches):
            got = parse(_texts(batch), window, caps)
            docs = np.repeat(np.arange(batch.num_rows), [len(s) for s in batch.column("starts").to_pylist()])
            at = np.concatenate([np.asarray(s, np.int64) for s in batch.column("starts").to_pylist()] or [np.zeros(0, np.int64)]) + got.cut[docs]
            late = np.concatenate([np.asarray(s, bool) for s in batch.column("late").to_pylist()] or [np.zeros(0, bool)])
            state = np.zeros(len(got.hashes) + 1, np.int8)  # by the anchor's first word
            state[at] = 1 + late
            mine = state[got.anchor_start[got.anchor]] if len(got.anchor) else np.zeros(0, np.int8)
            p, doc, mine = got.window[mine > 0], got.window_doc[mine > 0], mine[mine > 0]
            h = Rolling(got.hashes, int(BASE)).of(p, p + window)
            g = (Rolling(mix(got.hashes + np.uint64(1)), 0xD6E8FEB86659FD93).of(p, p + window) >> np.uint64(32)).astype(np.uint32)
            order = np.lexsort((p, g, h, doc))
            new = np.ones(len(order), bool)
            if len(order):
                o = order
                new[1:] = (doc[o][1:] != doc[o][:-1]) | (h[o][1:] != h[o][:-1]) | (g[o][1:] != g[o][:-1])
            head = np.flatnonzero(new)
            one = order[head]
            starts = pa.ListArray.from_arrays(pa.array(np.r_[head, len(order)].astype(np.int32)), pa.array((p - got.cut[doc])[order].astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[one].view(np.int64)), pa.array(g[one].view(np.int32)), batch.column("__id").take(pa.array(doc[one])),
                 batch.column("__key").take(pa.array(doc[one])), pa.array(mine[one] == 2), starts],
                ["h", "g", "id", "text_key", "needy", "starts"])

    return texts.select("__id", "__key", "__text", "starts", "late").mapInArrow(run, f"h long, g int, id {kind}, text_key long, needy boolean, starts array<int>")


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, caps: tuple[int, ...] = CAPS) -> DataFrame:
    """(id, text_key, starts, whole): for every document that repeats something of a
    smaller one, the first words of its repeated windows; whole marks documents
    equal to a smaller one, all of whose words are covered."""
    if 2 * margin(caps) + 2 * max(caps) > window:
        raise ValueError("the caps leave no symbol that every window is sure to contain")
    arrow_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    texts, mine = docs.select(F.col(id_col).alias("__id"), *_text_columns(text_col)), ["id", "text_key"]
    found = written(find_anchors(texts, kind, window, caps), "anchors")
    classes = found.groupBy("words_key").agg(F.min("id").alias("rep"), F.max("id").alias("last")).where("rep < last").select("words_key", "rep")
    copies = written(found.select(*mine, "words_key").join(classes, "words_key").where("id > rep").select(*mine).distinct(), "copies")
    n_copies = copies.count()
    own = found.select(*mine, "keys", "starts").join(maybe_broadcast(copies, n_copies, 24), mine, "left_anti")
    anchors = own.select(*mine, F.explode(F.arrays_zip("keys", "starts")).alias("a")).select(*mine, F.col("a.keys").alias("key"), F.col("a.starts").alias("places"))
    shared = written(anchors.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("last")).where("least < last").select("key", "least"), "shared_keys")
    late = F.transform("places", lambda s: F.struct(s.alias("start"), (F.col("id") > F.col("least")).alias("late")))
    # sets, not lists: a row that occurs a million times brings its anchors once
    marked = anchors.join(shared, "key").groupBy(*mine).agg(F.flatten(F.collect_set(late)).alias("m")).select(
        F.col("id").alias("__id"), F.col("text_key").alias("__key"), F.col("m.start").alias("starts"), F.col("m.late").alias("late"))  # a document's own anchors
    marked = written(marked, "shared_anchors")
    held = marked.agg(F.count(F.lit(1)), F.sum(F.size("starts"))).first()
    with_text = texts.join(maybe_broadcast(marked, 1, 56 * held[0] + 5 * (held[1] or 0)), ["__id", "__key"])
    windows = written(shared_windows(with_text, kind, window, caps), "windows")
    first = written(windows.groupBy("h", "g").agg(F.min("id").alias("least"), F.max("id").alias("last")).where("least < last").select("h", "g", "least"), "first_seen")
    hits = windows.where("needy").join(first, ["h", "g"]).where("id > least")
    part = hits.groupBy(*mine).agg(F.flatten(F.collect_set("starts")).alias("starts")).withColumn("whole", F.lit(False))
    return part.unionByName(copies.select(*mine, F.array().cast("array<int>").alias("starts"), F.lit(True).alias("whole")))


def _text_columns(text_col: str) -> list[Column]:
    """The text's bytes and their 64-bit hash."""
    text = F.col(text_col).cast("string").cast("binary")
    return [text.alias("__text"), F.xxhash64(text).alias("__key")]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, caps: tuple[int, ...] = CAPS) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text (the kept words, joined by
    one space), one row per input row.

    Words are stretches without ASCII white space. A word goes if a window of
    ``window`` consecutive words that covers it also starts in a document with
    a smaller id. Null texts have no words; rows with a null id neither lose
    words nor count as a place of first occurrence; rows of one id never take
    words from each other, and each text of an id loses what it itself repeats
    from a smaller id. All columns pass through (old columns of the new
    names are replaced); an empty table gives an empty result."""
    repeats = written(repeated_windows(docs, id_col, text_col, window, caps), "repeats")
    held = repeats.agg(F.count(F.lit(1)), F.sum(F.size("starts"))).first()
    repeats = maybe_broadcast(repeats.select(F.col("id").alias("__id"), F.col("text_key").alias("__key"), "starts", "whole"), 1, 56 * held[0] + 4 * (held[1] or 0))
    columns = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    rows = docs.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(columns)], F.col(id_col).alias("__id"), *_text_columns(text_col))
    schema = T.StructType([*[docs.schema[c] for c in columns], T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])

    def run(batches):
        for batch in batches:
            total, gone, kept = [], [], []
            for text, starts, whole in zip(*(batch.column(c) for c in ("__text", "starts", "whole")), strict=True):
                words = (text.as_py() or b"").split()
                total.append(len(words))
                if whole.as_py():
                    gone.append(len(words))
                    words = []
                elif not starts.is_valid:
                    gone.append(0)
                else:
                    s = np.asarray(starts.as_py(), np.int64)
                    s = s[s + window <= len(words)]
                    step = np.zeros(len(words) + 1, np.int64)
                    np.add.at(step, s, 1)
                    np.add.at(step, s + window, -1)
                    covered = np.cumsum(step[:-1]) > 0
                    gone.append(int(covered.sum()))
                    words = [words[i] for i in np.flatnonzero(~covered)]
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f"__c{i}") for i in range(len(columns))), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                schema.names)

    joined = rows.join(repeats, ["__id", "__key"], "left")
    return joined.select(*[f"__c{i}" for i in range(len(columns))], "__text", "starts", "whole").mapInArrow(run, schema)
