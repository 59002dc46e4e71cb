"""Best-fit packing of documents into fixed-length token sequences.

``tokenize_pieces`` turns texts into pieces of at most ``capacity`` tokens and
``pack`` places the pieces by best-fit decreasing.

Piece lengths are whole numbers up to ``capacity``, so the best-fit-decreasing
run depends on the data only through the histogram of lengths (at most
``capacity`` counts, whatever the corpus size). The run itself is a short
driver computation: a segment tree over remaining capacities finds the
tightest open bin in logarithmic time, and equal pieces that meet equal bins
are placed in one step. It yields placement rules ("pieces of length L with
ranks a..b go to bins from c, q to a bin, from offset o"); Spark ranks the
pieces of each length and applies the rules in parallel."""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.common import arrow_batches, gapless_rank, written

CAPACITY = 2048
END_ID = 0
CACHE_WORDS = 400_000


# --- tokens ---------------------------------------------------------------

class _Missing(dict):
    """A bounded memo: computes absent entries, starts over when full."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.compute(key)
        return value


class WordEncoder:
    """Token ids of whole texts as little-endian uint32 bytes, equal to
    ``Tokenizer.encode(text, add_special_tokens=False).ids`` for a word-level
    BPE vocabulary that drops white space: the text splits at white space,
    and the ids of each distinct word are remembered."""

    PLAIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿ]*")  # here str.lower, NFC and the classes below agree with the library
    SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
    SEPARATORS = re.compile("[\x1c-\x1f]")  # white space to str.split, not to the library

    def __init__(self, spec: str, words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        # byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        self.alphabet = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.parts = _Missing(self._part, words)
        self.words = _Missing(self._word, words)

    def _library(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        mapped = part.encode().decode("latin-1").translate(self.alphabet)
        return np.asarray([t.id for t in self.model.tokenize(mapped)], "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if "<|" in word or not self.PLAIN.fullmatch(word):
            return self._library(word)
        return b"".join([self.parts[p] for p in self.SPLIT.findall(word.lower())])

    def encode(self, text: str) -> bytes:
        if self.SEPARATORS.search(text):
            return self._library(text)
        return b"".join(map(self.words.__getitem__, text.split()))


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                    capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Pieces of every document: ``id_col``, piece, start, length, ids_crc32
    and, with ``keep_ids``, the ids.

    A document is its ids followed by ``end_id``; a null or empty text is
    ``end_id`` alone. Documents longer than ``capacity`` are cut into pieces of
    ``capacity`` tokens, the last one may be shorter. Repeated ids are kept
    as separate documents; other columns are ignored."""
    spark = docs.sparkSession
    arrow_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())  # the vocabulary: fixed size
    end = np.asarray([end_id], "<u4").tobytes()
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType())]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(spec.value)
        step = 4 * capacity
        for batch in batches:
            row, piece, length, crc, ids = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                data = encoder.encode(text.as_py() or "") + end
                for p, at in enumerate(range(0, len(data), step)):
                    part = data[at:at + step]
                    row.append(i)
                    piece.append(p)
                    length.append(len(part) >> 2)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(np.frombuffer(part, "<i4"))
            piece = np.asarray(piece, np.int32)
            columns = [batch.column(0).take(pa.array(row, pa.int32())), pa.array(piece),
                       pa.array(piece.astype(np.int64) * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(pieces, T.StructType(fields))


# --- best fit -------------------------------------------------------------

class CapacityTree:
    """Segment tree over remaining capacities 0..top: which of them some open
    bin has, and the smallest one that is at least a given length."""

    def __init__(self, top: int):
        self.size = 1 << max(0, top).bit_length()
        self.any = bytearray(2 * self.size)

    def set(self, r: int, present: bool) -> None:
        i = self.size + r
        self.any[i] = present
        while i > 1:
            i >>= 1
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]

    def tightest(self, length: int) -> int | None:
        i = self.size + length
        if self.any[i]:
            return length
        while i > 1:  # up until a right sibling has a bin, then down its left-most path
            if not i & 1 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def best_fit_rules(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over ``{length: count}``; rules
    ``(length, first rank, first bin, pieces per bin, first offset)`` sorted by
    length and rank.

    After a piece lands in the tightest bin (remaining r), that bin is still
    the tightest one while it has room, so it takes r // length pieces before
    the next bin: bins of equal r are served as ranges."""
    tree = CapacityTree(capacity)
    bins: dict[int, deque] = {}
    rules, opened = [], 0

    def put(r: int, first: int, n: int) -> None:
        if r > 0:
            bins.setdefault(r, deque()).append((first, n))
            tree.set(r, True)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            r = tree.tightest(length)
            if r is None:
                need = -(-left // (capacity // length))
                put(capacity, opened, need)
                opened += need
                r = capacity
            per = r // length
            first, n = bins[r].popleft()
            full, some = min(n, left // per), 0
            if full:
                rules.append((length, rank, first, per, capacity - r))
                put(r - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if left and full < n:  # the last pieces of this length fill one more bin in part
                some = 1
                rules.append((length, rank, first + full, left, capacity - r))
                put(r - left * length, first + full, 1)
                left = 0
            if full + some < n:
                bins[r].appendleft((first + full + some, n - full - some))
            if not bins[r]:
                tree.set(r, False)
    return sorted(rules)


def pack(pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length",
         order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, packed by best-fit
    decreasing into sequences of at most ``capacity``.

    Lengths must lie in 1..capacity (others raise). ``order`` breaks ties
    among equal lengths; rows equal in it are interchangeable. Extra columns
    pass through (old ``sequence_id`` and ``offset`` are replaced); an empty table gives an empty result."""
    spark = pieces.sparkSession
    arrow_batches(spark)
    pieces = written(pieces.drop("sequence_id", "offset"), "pieces")
    counts = pieces.groupBy(F.col(length_col).cast("long")).count().limit(capacity + 2).collect()
    histogram = {r[0]: r[1] for r in counts}
    if any(not n or not 1 <= n <= capacity for n in histogram):
        raise ValueError(f"lengths must lie in 1..{capacity}")
    rules = best_fit_rules(histogram, capacity)
    table = spark.sparkContext.broadcast(np.asarray(rules, np.int64).reshape(-1, 5))  # bounded by capacity, not by rows
    ranked = gapless_rank(pieces, [length_col], list(order), "__rank", sum(histogram.values()))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    width = len(pieces.columns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = table.value
        key = (rule[:, 0] << 48) + rule[:, 1]
        for batch in batches:
            length = batch.column(length_col).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(width).to_numpy(zero_copy_only=False)
            at = rule[np.searchsorted(key, (length << 48) + rank, side="right") - 1]
            k = rank - at[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array(at[:, 2] + k // at[:, 3]), pa.array(at[:, 4] + k % at[:, 3] * length)], schema.names)

    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, length and ids, from
    pieces that carry ``ids``. A sequence holds at most ``capacity`` tokens, so
    each group is small."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
