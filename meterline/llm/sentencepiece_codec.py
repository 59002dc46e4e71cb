"""SentencePiece encoding and decoding by streaming Viterbi.

The model file gives the pieces, their scores and the normalizer's rules. A
text is a lattice whose edges are pieces. The encoder walks it character by
character and keeps back pointers for a window only: a new piece starts at most
``longest`` characters back, so when the paths of all those positions meet in
one earlier boundary, what lies before it is final, its ids are committed and
the window starts there. Memory is bounded by the window, not by the text.

Unigram models: the path with the largest sum of scores. BPE models: a path is
admissible if no two neighbouring pieces would have been merged differently,
that is if merging their joined text yields just these two; then exactly one
piece can end an admissible path at each position, and the path is the
library's own result. Whether two pieces fit is found by undoing their merges.

If no piece continues past a white-space mark inside it, every path has a
boundary there, and at a line feed that no piece has; the stretches between go
through the encoder one by one and are remembered in a bounded memo."""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import arrow_batches

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values of the model format
UNIGRAM, BPE = 1, 2
UNKNOWN_PENALTY = 10.0
MEMO = 300_000  # words, and pairs of pieces; about 250 bytes each


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a serialized message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value: object = varint()
        elif kind == 2:
            n = varint()
            value, at = data[at:at + n], at + n
        else:
            n = 8 if kind == 1 else 4
            value, at = data[at:at + n], at + n
        yield tag >> 3, value


@dataclass
class Model:
    """What a model file says, as far as coding needs it."""

    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True

    @staticmethod
    def parse(data: bytes) -> Model:
        m = Model()
        for number, value in _fields(data):
            if number == 1:
                got = dict(_fields(value))
                m.pieces.append(got[1].decode())
                m.scores.append(struct.unpack("<f", got.get(2, b"\0" * 4))[0])
                m.kinds.append(got.get(3, NORMAL))
            elif number == 2:
                got = dict(_fields(value))
                m.type, m.byte_fallback = got.get(3, UNIGRAM), bool(got.get(35, 0))
            elif number == 3:
                got = dict(_fields(value))
                m.charsmap, m.dummy_prefix = got.get(2, b""), bool(got.get(3, 1))
                m.squeeze, m.escape = bool(got.get(4, 1)), bool(got.get(5, 1))
        if m.type not in (UNIGRAM, BPE) or m.charsmap or not m.escape or USER in m.kinds or UNUSED in m.kinds:
            raise ValueError("only unigram and BPE models with white-space rules, without character maps, user-defined or unused pieces")
        return m


class Codec:
    def __init__(self, model: Model, memo: int = MEMO):
        self.model = model
        self.ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == NORMAL}
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = next((i for i, k in enumerate(model.kinds) if k == UNKNOWN), 0)
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == BYTE}
        self.least = min((model.scores[i] for i in self.ids.values()), default=0.0) - UNKNOWN_PENALTY
        plain = [bytes([int(p[3:5], 16)]) if k == BYTE else b" \xe2\x81\x87 " if k == UNKNOWN else b"" if k == CONTROL else p.replace(MARK, " ").encode()
                 for p, k in zip(model.pieces, model.kinds, strict=True)]
        self.plain = pa.array(plain, pa.large_binary())
        self.split = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        self.prefixes = {p[:n] for p in self.ids for n in range(1, len(p) + 1)}
        # place of each piece in the order of merging; single characters are there from the start
        order = {s: i for i, s in enumerate(sorted({model.scores[i] for i in self.ids.values()}, reverse=True), 1)}
        self.rank = {p: order[model.scores[i]] if len(p) > 1 else 0 for p, i in self.ids.items()}
        self.halves: dict[str, tuple[str, str] | None] = {}
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        # between marks, and between line feeds if no piece has one, the lattice is cut
        feed = "" if any("\n" in p for p in self.ids) else "\n"
        self.stretch = re.compile(f"{MARK}+[^{MARK}{feed}]*|[^{MARK}{feed}]+" + (f"|{feed}+" if feed else ""))
        self.memo: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.most = memo

    # --- the lattice

    def half(self, piece: str) -> tuple[str, str] | None:
        """The two parts whose merge makes ``piece``; None if merging its
        characters ends in something else. A single character has no parts."""
        got = self.halves.get(piece, self)
        if got is self:
            parts, last = list(piece), (piece, piece)
            while len(parts) > 1:  # the best adjacent pair merges, the leftmost of equals
                at = min(range(len(parts) - 1), key=lambda i: self.rank.get(parts[i] + parts[i + 1], 1 << 60))
                if parts[at] + parts[at + 1] not in self.rank:
                    break
                last = (parts[at], parts[at + 1])
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            got = self.halves[piece] = last if len(parts) == 1 else None
        return got

    def fits(self, a: str, b: str) -> bool:
        """Whether BPE leaves the pieces ``a`` and ``b`` side by side: undoing
        their merges from the last one on, no merge across the boundary would
        have come first."""
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) >= self.most:
                self.pairs.clear()
            got = self.pairs[a, b] = self.half(b) is not None and (a not in self.rank or self._apart(a, b))
        return got

    def _apart(self, a: str, b: str) -> bool:
        rank, limit = self.rank, 1 << 60
        while True:
            if rank.get(a + b, 1 << 60) < limit:
                return False
            if rank[a] > rank[b]:
                limit, a = rank[a], self.half(a)[1]  # a's own merge is further left: it wins ties
            elif rank[b]:
                limit, b = rank[b] + 1, self.half(b)[0]
            else:
                return True

    def paths(self, text: str) -> Iterator[str]:
        """The pieces of ``text``, committed as soon as they are certain.

        A character outside the vocabulary is a piece of its own."""
        if self.model.type == BPE:
            yield from self._bpe_paths(text)
            return
        ids, scores, longest, prefixes = self.ids, self.model.scores, self.longest, self.prefixes
        base = 0  # committed up to here; the lists below are relative to it
        back: list[int | None] = [-1]  # start of the piece that ends at each position
        score: list[float] = [0.0]
        n = len(text)
        for start in range(n):
            if start - base >= 4 * longest:
                boundary = self._meet(back, base, start)
                if boundary > base:
                    yield from self._pieces(text, back, base, boundary)
                    cut = boundary - base
                    back, score, base = back[cut:], score[cut:], boundary
            here = start - base
            if back[here] is None:
                continue
            so_far = score[here]
            for end in range(start + 1, min(n, start + longest) + 1):
                p = text[start:end]
                got = ids.get(p)
                if got is None and end - start > 1:
                    if p in prefixes:
                        continue
                    break
                at = end - base
                while len(back) <= at:
                    back.append(None)
                    score.append(-float("inf"))
                s = so_far + (scores[got] if got is not None else self.least)
                if s > score[at]:
                    back[at], score[at] = start, s
        if n > base:
            yield from self._pieces(text, back, base, n)

    def _bpe_paths(self, text: str) -> Iterator[str]:
        """``paths`` of a BPE model: the automaton names the pieces that end at each
        character, and the one that fits its predecessor becomes the back pointer.
        A piece that ends later starts at most ``longest`` characters back."""
        pairs, fits, longest = self.pairs, self.fits, self.longest
        base = done = 0  # committed and settled up to here; the lists below are relative to base
        back: list[int] = [-1]
        last: list[str] = [""]
        for e, p in self.automaton.iter(text):
            if e < done:
                continue  # settled by another piece
            while done < e:  # a character that ends no piece stands alone
                back.append(done)
                last.append(text[done])
                done += 1
            start = e + 1 - len(p)
            key = (last[start - base], p)
            ok = pairs.get(key)
            if ok is None:
                ok = fits(*key)
            if ok:
                back.append(start)
                last.append(p)
                done = e + 1
                if done - base >= 4 * longest:
                    boundary = self._meet(back, base, done + 1 - longest)
                    if boundary > base:
                        yield from self._pieces(text, back, base, boundary)
                        back, last, base = back[boundary - base:], last[boundary - base:], boundary
        while done < len(text):
            back.append(done)
            done += 1
        if done > base:
            yield from self._pieces(text, back, base, done)

    @staticmethod
    def _pieces(text: str, back: list, base: int, end: int) -> list[str]:
        out = []
        while end > base:
            out.append(text[back[end - base]:end])
            end = back[end - base]
        return out[::-1]

    def _meet(self, back: list, base: int, start: int) -> int:
        """The boundary in which the paths of all positions from ``start`` on meet;
        whatever is read later continues one of them."""
        alive = {i for i in range(start, base + len(back)) if back[i - base] is not None}
        while len(alive) > 1:
            top = max(alive)
            alive.remove(top)
            if top == base:
                return base
            alive.add(max(base, back[top - base]))
        return alive.pop()

    # --- texts

    def normalized(self, text: str) -> str:
        if self.model.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return ((" " if self.model.dummy_prefix else "") + text).replace(" ", MARK)

    def _numbers(self, pieces: Iterable[str]) -> bytes:
        out, gap = [], False
        for p in pieces:
            got = self.ids.get(p)
            if got is not None:
                out.append(got)
            elif self.model.byte_fallback:
                out += [self.bytes[b] for b in p.encode()]
            elif not gap:
                out.append(self.unknown)  # a run of unknown characters is one id
            gap = got is None
        return array("i", out).tobytes()

    def encode(self, text: str) -> np.ndarray:
        text = self.normalized(text)
        if not text:
            return np.zeros(0, np.int32)
        if not self.split:
            return np.frombuffer(self._numbers(self.paths(text)), "<i4")
        out, memo = [], self.memo
        for part in self.stretch.findall(text):
            got = memo.get(part)
            if got is None:
                got = self._numbers(self.paths(part))
                if len(part) <= 64:
                    if len(memo) >= self.most:
                        memo.clear()
                    memo[part] = got
            out.append(got)
        return self._joined(out)

    def _joined(self, parts: list[bytes]) -> np.ndarray:
        ids = np.frombuffer(b"".join(parts), "<i4")
        if not self.model.byte_fallback and (ids[1:] == self.unknown).any():
            ids = ids[np.r_[True, (ids[1:] != self.unknown) | (ids[:-1] != self.unknown)]]
        return ids

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_all(pa.array([ids], pa.list_(pa.int32())))[0].as_py()

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """The texts of a batch of id lists; null lists are empty texts."""
        pieces = self.plain.take(ids.flatten())
        sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
        ends = np.r_[0, np.cumsum(pc.binary_length(pieces).to_numpy())][np.r_[0, np.cumsum(sizes)]]
        data = pieces.buffers()[2].to_pybytes() if len(pieces) else b""
        skip = b" " if self.model.dummy_prefix else b"\0"
        texts = [data[a + (b > a and data[a:a + 1] == skip):b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        return pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())


# --- Spark ----------------------------------------------------------------

def _model_data(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: fixed size


@lru_cache(maxsize=2)
def _codec(data: bytes) -> Codec:
    """The codec of a model file, kept with its bounded memos by a Python worker for
    all tasks that it runs."""
    return Codec(Model.parse(data))


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """(id, text, ids) of every row, whole texts. Null and empty texts have no
    ids. Repeated rows are coded alike, other columns are ignored, an empty
    table gives an empty result."""
    arrow_batches(docs.sparkSession)
    data = _model_data(docs, model_path)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data.value)
        for batch in batches:
            ids = [codec.encode(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], ["id", "text", "ids"])

    coded = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, text string, ids array<int>")
    return coded.select(F.col("id").alias(id_col), F.col("text").alias(text_col), F.col("ids").alias(ids_col))


def decode(coded: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``coded`` with ``text_col`` (replaced if present): the text of its ids. Null
    ids are no ids; numbers outside the vocabulary raise."""
    arrow_batches(coded.sparkSession)
    data = _model_data(coded, model_path)
    coded = coded.drop(text_col)
    schema = coded.limit(0).withColumn(text_col, F.lit("")).schema
    place = coded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, codec.decode_all(batch.column(place))], schema.names)

    return coded.mapInArrow(run, schema)
