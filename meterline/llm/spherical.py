"""Near-duplicate vectors by spherical-cap filters.

Filter directions form a structured random product code: space is rotated at
random and cut into four sections, each with ``codewords`` random unit
vectors; a direction is one codeword per section, so ``codewords ** 4``
directions cost four small codebooks. A vector is list-decoded to all
directions that it exceeds: the words of a section, then sums over two sections,
are bounded by the best of the others, so few are visited. Its best direction
always counts, so no vector is left without.

Directions of one code share codewords, so what one code misses, it tends to
miss altogether; ``codes`` independent rotations and codebooks make up for it.

Vectors that share a direction are compared in double precision; equal vectors
are one class first. Neither lists nor vectors are written for each direction:
a vector goes once to each cell, the directions that begin with the same words,
and the task of a cell decodes it again. Codes, or parts of them, have their
turn one after another, so that what is shuffled at a time stays in proportion
to the vectors. A cell with many classes is split into blocks whose pairs of
blocks are separate groups; what leaves a group is one row per vector (its
links, its local component), never the pairs. A pair that meets under several
directions counts under the first one only."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import written
from meterline.llm.components import components
from meterline.session import scratch_path

CODEWORDS = 32
DEPTH = 1
CODES = 10  # at cosine 0.93 ten codes find 0.997 of the pairs or more (dimensions 2 to 768), at 0.98 practically all
COSINE = 0.93
#: Classes of a space that are one group without cells; rows of a product of vectors.
BLOCK = 512
#: Bytes of doubles of the classes of a group, at most about.
CELL_BYTES = 16 << 20
#: Cells of one code that a vector is in, by the words that name a cell (mean of random vectors).
SHARE = (1.0, 2.4, 5.0, 10.0)
#: Bytes shuffled at a time, if the vectors themselves are fewer; of one task.
PASS_BYTES, TASK_BYTES = 256 << 20, 32 << 20
SECTIONS = 4
SLACK = 1e-9
#: Vectors that are multiplied with a codebook, and that are decoded, at once.
ROWS, STEP = 256, 4096
#: Directions of pairs that are looked up at once when shared ones are looked for.
NAMES = 1 << 20
#: Pairs of a group whose directions are looked at together, or those of one tile.
PAIRS = 1 << 17
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class ProductCode:
    """The directions for one dimension, and the cosine from which one counts as
    exceeded: what a random vector's ``depth``-th best direction reaches in the
    median, so that lists are about equally long in every dimension."""

    def __init__(self, dim: int, codewords: int, seed: int, number: int, depth: int):
        rng = np.random.default_rng([seed, dim, number])
        self.width = -(-dim // SECTIONS) * SECTIONS
        self.rotation = np.linalg.qr(rng.normal(size=(self.width, self.width)))[0]
        section = self.width // SECTIONS
        books = rng.normal(size=(SECTIONS, _words(dim, codewords), section))
        books = books / np.linalg.norm(books, axis=2, keepdims=True) / np.sqrt(SECTIONS)
        self.books = [np.unique(b, axis=0) for b in books]  # a line has two unit vectors only
        sizes = [len(b) for b in self.books]
        #: Directions that begin with the same 0, 1, .. 4 words.
        self.below = np.array([int(np.prod(sizes[k:])) for k in range(SECTIONS + 1)])
        self.dim = dim
        s = self.sections(_unit(rng.normal(size=(256, dim))))
        one, two = (np.sort((a[:, :, None] + b[:, None, :]).reshape(256, -1), axis=1)[:, -depth:] for a, b in (s[:2], s[2:]))
        best = np.sort((one[:, :, None] + two[:, None, :]).reshape(256, -1), axis=1)
        self.least = float(np.median(best[:, -min(depth, best.shape[1])]))

    def sections(self, x: np.ndarray) -> list[np.ndarray]:
        """Products with all words of each section. The rows of a product are
        always as many: its last bits must not depend on a vector's company, for
        vectors are decoded in several tasks."""
        out = [np.empty((len(x), len(b))) for b in self.books]
        for lo in range(0, len(x), ROWS):
            part = x[lo:lo + ROWS]
            padded = np.zeros((ROWS, self.width))
            padded[:len(part), :self.dim] = part
            parts = (padded @ self.rotation).reshape(ROWS, SECTIONS, -1)
            for k, book in enumerate(self.books):
                out[k][lo:lo + ROWS] = (parts[:, k] @ book.T)[:len(part)]
        return out

    def wanted(self, s: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """The sum from which each vector exceeds a direction; its best products."""
        top = [p.max(1) for p in s]
        return np.minimum(self.least, (top[0] + top[1]) + (top[2] + top[3])), top

    def listed(self, s: list[np.ndarray], cell: int = 0, words: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(row, direction) of all directions that the vectors exceed, in order, or
        of those in a cell named by that many words."""
        want, top = self.wanted(s)
        named = [w[0] for w in self.words(np.array([cell * self.below[words]]))[:words]]
        s = [np.where(np.arange(p.shape[1]) == w, p, -np.inf) for p, w in zip(s, named, strict=False)] + s[words:]
        # the sum decides; rounding must not drop a half of it before
        row, i, one = _half(s[0], s[1], top[0], top[1], want - (top[2] + top[3]) - SLACK)
        other, j, two = _half(s[2], s[3], top[2], top[3], want - (top[0] + top[1]) - SLACK)
        u, v = _crossed(row, other, len(want))
        keep = one[u] + two[v] >= want[row[u]]
        u, v = u[keep], v[keep]
        return row[u], i[u] * self.below[2] + j[v]

    def words(self, f: np.ndarray) -> list[np.ndarray]:
        return [f // self.below[k + 1] % len(b) for k, b in enumerate(self.books)]

    def decode(self, x: np.ndarray) -> list[np.ndarray]:
        """For each unit vector, the numbers of all directions that it exceeds,
        and its best one."""
        row, f = self.listed(self.sections(x))
        return np.split(f, np.cumsum(np.bincount(row, minlength=len(x)))[:-1]) if len(x) else []

    def first_shared(self, x: np.ndarray, u: np.ndarray, v: np.ndarray, end: int | None = None) -> np.ndarray:
        """For pairs of rows of ``x``, the first direction (below ``end``) that both
        exceed, or -1. Of the shorter list, ever more directions are looked up."""
        s = self.sections(x)
        want, (row, f) = self.wanted(s)[0], self.listed(s)
        if end is not None:
            row, f = row[f < end], f[f < end]
        words, many = self.words(f), np.bincount(row, minlength=len(x))
        few = np.where(many[u] <= many[v], u, v)
        start, many, other = (np.cumsum(many) - many)[few], many[few], u + v - few
        out, left, tried, more = np.full(len(u), -1), np.arange(len(u)), 0, 2
        while len(left):
            for lo in range(0, len(left), max(1, NAMES // more)):
                now = left[lo:lo + max(1, NAMES // more)]
                pair, at = _ranges(start[now] + tried, np.clip(many[now] - tried, 0, more))
                pair = now[pair]
                hit = _sums(s, other[pair], [w[at] for w in words]) >= want[other[pair]]
                pair, at = pair[hit], at[hit]
                first = np.flatnonzero(np.diff(pair, prepend=-1))
                out[pair[first]] = f[at[first]]
            tried, more = tried + more, 2 * more
            left = left[(out[left] < 0) & (many[left] > tried)]
        return out

    def shared(self, x: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Whether pairs of rows of ``x`` share a direction. Mostly one's best does."""
        s = self.sections(x)
        want, best = self.wanted(s)[0], [p.argmax(1) for p in s]
        out = (_sums(s, v, [b[u] for b in best]) >= want[v]) | (_sums(s, u, [b[v] for b in best]) >= want[u])
        rest = np.flatnonzero(~out)
        if len(rest):
            out[rest] = _on_rows(self.first_shared, x, u[rest], v[rest]) >= 0
        return out


@lru_cache(maxsize=16)
def _code(dim: int, codewords: int, seed: int, number: int, depth: int) -> ProductCode:
    return ProductCode(dim, codewords, seed, number, depth)


def _words(dim: int, codewords: int) -> int:
    """Words of a section: fewer in low dimensions, or every direction is crowded."""
    return max(2, min(codewords, 4 * -(-dim // SECTIONS)))


def _ranges(start: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, value) of the ranges of ``many`` values from each ``start`` on."""
    place = np.repeat(np.arange(len(many)), many)
    return place, (start - np.cumsum(many) + many)[place] + np.arange(len(place))


def _crossed(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of an entry of ``a`` with an equal one of ``b``; both
    are sorted numbers below ``n``."""
    many = np.bincount(b, minlength=n)
    return _ranges((np.cumsum(many) - many)[a], many[a])


def _half(s: np.ndarray, t: np.ndarray, top_s: np.ndarray, top_t: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, number, sum) of the pairs of words of two sections that reach ``least``."""
    (row, w), (other, z) = np.nonzero(s >= (least - top_t - SLACK)[:, None]), np.nonzero(t >= (least - top_s - SLACK)[:, None])
    u, v = _crossed(row, other, len(least))
    row, w, z = row[u], w[u], z[v]
    sums = s[row, w] + t[row, z]
    keep = sums >= least[row]
    return row[keep], w[keep] * t.shape[1] + z[keep], sums[keep]


def _sums(s: list[np.ndarray], row: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    a, b, c, d = (p[row, w] for p, w in zip(s, words, strict=True))
    return (a + b) + (c + d)


def _on_rows(ask: Callable, x: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """``ask`` for pairs, with no other rows of ``x`` than theirs."""
    used = np.zeros(len(x), bool)
    used[u] = used[v] = True
    at = np.cumsum(used) - 1
    return ask(x[used], at[u], at[v])


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _units(x: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors of floats or doubles that come as bytes."""
    ends = np.frombuffer(x.buffers()[1], np.int64 if pa.types.is_large_binary(x.type) else np.int32)[x.offset:x.offset + len(x) + 1]
    data = x.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0]))
    v = np.frombuffer(data, np.float64 if len(data) == 8 * dim * len(x) else np.float32).reshape(len(x), dim).astype(np.float64)
    # far from 1 in size, squares of the components over- or underflow
    return _unit(v / np.abs(v).max(1, keepdims=True))


def _join(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """``root``, the smallest place that each place is known to be connected
    with, after links between ``u`` and ``v``."""
    while (differ := root[u] != root[v]).any():
        u, v = u[differ], v[differ]
        a, b = root[u], root[v]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


def _tiles(x: np.ndarray, single: np.ndarray, left: np.ndarray, right: np.ndarray, cosine: float, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a place in ``left`` and a place in ``right``, or where both are the
    same of two places in order, whose cosine reaches ``cosine``. ``single`` has
    the vectors in single precision."""
    same = left is right
    low = cosine - 1e-5 - 1.2e-7 * x.shape[1]  # what single precision may miss by
    for a in range(0, len(left), block):
        for b in range(a if same else 0, len(right), 2 * block):
            i, j = left[a:a + block], right[b:b + 2 * block]
            u, v = np.nonzero(single[i] @ single[j].T >= low)
            u, v = i[u], j[v]
            if same:
                u, v = u[u < v], v[u < v]
            near = [np.einsum("ij,ij->i", x[u[k:k + STEP]], x[v[k:k + STEP]]) >= cosine for k in range(0, len(u), STEP)]
            if near and (near := np.concatenate(near)).any():
                yield u[near], v[near]


def _parts(codes: list[ProductCode], x: np.ndarray, cell: int, depth: int, block: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """(places, first direction, end of the directions): the classes of a cell by
    as many words more as make their comparison cheapest."""
    code = codes[-1]
    lo = cell * code.below[depth]
    if len(x) <= block:
        yield np.arange(len(x)), lo, lo + code.below[depth]
        return
    rows, found = [], []
    for at in range(0, len(x), STEP):
        row, f = code.listed(code.sections(x[at:at + STEP]), cell, depth)
        rows.append(row + at)
        found.append(f)
    row, f = np.concatenate(rows), np.concatenate(found)
    best, cost = None, np.inf
    for k in range(depth, SECTIONS + 1):
        name = np.unique(f // code.below[k] * len(x) + row)
        cuts = np.flatnonzero(np.diff(name // len(x), prepend=-1))
        sizes = np.diff(cuts, append=len(name)).astype(float)
        now = (sizes ** 2).sum() * x.shape[1] * 6e-11 + len(sizes) * 2e-4  # seconds of products and of parts, about
        if now >= cost:
            break
        best, cost = (k, name, cuts), now
    k, name, cuts = best
    for members in np.split(name, cuts[1:]):
        first = int(members[0] // len(x) * code.below[k])
        yield members % len(x), first, first + int(code.below[k])


def _compare(codes: list[ProductCode], x: np.ndarray, copies: np.ndarray, side: np.ndarray | None, cell: int, depth: int, cosine: float, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, links, place of the local root) of the linked classes of one group:
    a cell of the last of ``codes``, or with no words all directions of all of
    them. ``side`` tells two blocks apart, of which only pairs across count."""
    links, root, single = np.zeros(len(x), np.int64), np.arange(len(x)), x.astype(np.float32)
    held: list[tuple[np.ndarray, ...]] = []

    def settle() -> None:
        u, v, lo, hi = (np.concatenate(c) for c in zip(*held, strict=True))
        held.clear()
        if depth:  # a pair counts under its first direction
            for code in codes[:-1]:
                if len(u):
                    new = ~_on_rows(code.shared, x, u, v)
                    u, v, lo, hi = u[new], v[new], lo[new], hi[new]
            f = _on_rows(partial(codes[-1].first_shared, end=(cell + 1) * codes[-1].below[depth]), x, u, v)
            met = (f >= lo) & (f < hi)
        else:
            met = np.zeros(len(u), bool)
            for code in codes:
                if len(rest := np.flatnonzero(~met)):
                    met[rest] = _on_rows(code.shared, x, u[rest], v[rest])
        u, v = u[met], v[met]
        np.add.at(links, u, copies[v])
        np.add.at(links, v, copies[u])
        _join(root, u, v)

    for places, lo, hi in _parts(codes, x, cell, depth, block) if depth else [(np.arange(len(x)), 0, 0)]:
        left, right = (places, places) if side is None else (places[~side[places]], places[side[places]])
        for u, v in _tiles(x, single, left, right, cosine, block):
            held.append((u, v, np.full(len(u), lo), np.full(len(u), hi)))
            if sum(len(h[0]) for h in held) >= PAIRS:
                settle()
    if held:
        settle()
    places = np.flatnonzero(links)
    return places, links[places], root[places]


def _turns(codes: int, wanted: int) -> list[tuple[range, int, int]]:
    """(codes, part, parts): ``wanted`` turns at least, each with some whole codes
    or with the cells of a code in one of several parts."""
    if wanted <= codes:
        ends = [codes * k // wanted for k in range(wanted + 1)]
        return [(range(a, b), 0, 1) for a, b in zip(ends, ends[1:], strict=False)]
    parts = -(-wanted // codes)
    return [(range(c, c + 1), k, parts) for c in range(codes) for k in range(parts)]


def linked_vectors(classes: DataFrame, kind: str, cosine: float, codewords: int, depth: int, codes: int, seed: int, block: int = BLOCK) -> DataFrame:
    """(rep, links, root): per class and group, its links and a class that it is
    connected with. ``classes`` has rep, space, dim, x (floats or doubles as bytes), copies."""
    spark = classes.sparkSession
    classes = classes.select(F.xxhash64("space", "dim").alias("key"), "dim", "rep", F.xxhash64("rep").alias("mark"), "copies", "x")
    rows, size = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("x")), F.lit(0))).first()
    # of the spaces with more than a block of classes: how many words name a cell
    large = classes.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first("dim").alias("dim")).where(F.col("n") > block).orderBy("key").collect()

    def most(dim: int) -> int:
        return max(2, CELL_BYTES // (8 * dim))

    def named(n: int, dim: int) -> int:
        return next((k for k in (1, 2) if n * SHARE[k] / _words(dim, codewords) ** k <= most(dim) / 2), 3)

    keys, deep = np.array([r.key for r in large], np.int64), np.array([named(r.n, r.dim) for r in large], np.int8)

    def cells(batch: pa.RecordBatch, numbers: range) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, cell): a cell's number begins with its code's, or is -1 for a small
        space as a whole, in the first code's turn."""
        key, dims = batch.column("key").to_numpy(), batch.column("dim").to_numpy()
        at = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
        words = np.where(keys[at] == key, deep[at], 0) if len(keys) else np.zeros(len(key), np.int8)
        for dim in np.unique(dims[words > 0]):
            mine = np.flatnonzero((dims == dim) & (words > 0))
            units = _units(batch.column("x").take(pa.array(mine)), int(dim))
            for number in numbers:
                code = _code(int(dim), codewords, seed, number, depth)
                row, f = code.listed(code.sections(units))
                cell = f // code.below[words[mine[row]]]
                new = (np.diff(row, prepend=-1) != 0) | (np.diff(cell, prepend=-1) != 0)
                yield mine[row[new]], (number << 32) + cell[new]
        if 0 in numbers:
            mine = np.flatnonzero(words == 0)
            yield mine, np.full(len(mine), -1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, STEP):
                part = batch.slice(lo, STEP)
                key = part.column("key").to_numpy()
                for row, cell in cells(part, range(codes)):
                    row, cell = row[cell >= 0], cell[cell >= 0]
                    if len(row):
                        (k, c), n = np.unique(np.stack([key[row], cell]), axis=1, return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c), pa.array(n)], ["key", "cell", "n"])

    # cells that are split into blocks: those of spaces that are no group by themselves
    crowded = {r.key: [] for r in large if r.n > most(r.dim)}
    if crowded:
        least = min(most(r.dim) for r in large)
        sizes = {r.key: most(r.dim) for r in large if r.key in crowded}
        counted = classes.where(F.col("key").isin(list(crowded)) if len(crowded) < 1000 else F.lit(True)).mapInArrow(count, "key long, cell long, n long")
        for r in counted.groupBy("key", "cell").agg(F.sum("n").alias("n")).where(F.col("n") > least).orderBy("key", "cell").collect():
            if r.key in crowded and r.n > sizes[r.key]:
                crowded[r.key].append((r.cell, -(-r.n // sizes[r.key]), r.n))
    extra = sum(n * (b - 1) for found in crowded.values() for _, b, n in found)
    crowded = {k: (np.array([c for c, _, _ in found]), np.array([b for _, b, _ in found])) for k, found in crowded.items() if found}
    kept = {"key": "long", "cell": "long", "pair": "long", "side": "boolean", "dim": "int", "rep": kind, "copies": "long", "x": "binary"}

    def deal(numbers: range, part: int, parts: int) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for lo in range(0, whole.num_rows, STEP):
                    batch = whole.slice(lo, STEP)
                    key, mark = batch.column("key").to_numpy(), batch.column("mark").to_numpy()
                    for row, cell in cells(batch, numbers):
                        mine = cell % parts == part
                        row, cell = row[mine], cell[mine]
                        blocks = np.ones(len(row), np.int64)
                        for k in np.unique(key[row]) if crowded else ():
                            if k in crowded:
                                mine = np.flatnonzero(key[row] == k)
                                at = np.minimum(np.searchsorted(crowded[k][0], cell[mine]), len(crowded[k][0]) - 1)
                                blocks[mine] = np.where(crowded[k][0][at] == cell[mine], crowded[k][1][at], 1)
                        place, other = _ranges(np.zeros(len(row), np.int64), blocks)
                        row, cell, mine = row[place], cell[place], mark[row[place]] % blocks[place]
                        columns = {"key": pa.array(key[row]), "cell": pa.array(cell), "pair": pa.array((np.minimum(mine, other) << 32) + np.maximum(mine, other)), "side": pa.array(mine > other)}
                        columns |= {c: batch.column(c).take(pa.array(row)) for c in kept if c not in columns}
                        yield pa.RecordBatch.from_arrays([columns[c] for c in kept], list(kept))
        return run

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        name = None

        def finish() -> Iterator[pa.RecordBatch]:
            if sum(b.num_rows for b in held) < 2:
                return
            group = pa.Table.from_batches(held).combine_chunks()
            dim, (key, cell, pair) = group["dim"][0].as_py(), name
            numbers, words = (cell >> 32, int(deep[np.searchsorted(keys, key)])) if cell >= 0 else (codes - 1, 0)
            made = [_code(dim, codewords, seed, number, depth) for number in range(numbers + 1)]
            side = group["side"].to_numpy() if pair >> 32 != pair & 0xFFFFFFFF else None
            places, links, roots = _compare(made, _units(group["x"].combine_chunks(), dim), group["copies"].to_numpy(), side, cell & 0xFFFFFFFF, words, cosine, block)
            if len(places):
                rep = group["rep"].combine_chunks()
                yield pa.RecordBatch.from_arrays([rep.take(pa.array(places)), pa.array(links), rep.take(pa.array(roots))], ["rep", "links", "root"])

        for batch in batches:
            names = np.stack([batch.column(c).to_numpy() for c in ("key", "cell", "pair")])
            cuts = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True) if batch.num_rows else ():
                if (now := tuple(names[:, a].tolist())) != name:
                    yield from finish()
                    held, name = [], now
                held.append(batch.slice(a, b - a))
        yield from finish()

    shuffled = (sum(r.n * SHARE[k] * codes for r, k in zip(large, deep, strict=True)) + rows + extra) * (size / max(1, rows) + 64)
    turns = _turns(codes, max(1, int(-(-shuffled // max(PASS_BYTES, size, 1)))))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(shuffled / len(turns) // TASK_BYTES))
    path = scratch_path(spark, "llm", "vector_links")
    for numbers, part, parts in turns:
        dealt = classes.mapInArrow(deal(numbers, part, parts), ", ".join(f"{c} {t}" for c, t in kept.items()))
        dealt = dealt.repartition(tasks, "key", "cell", "pair").sortWithinPartitions("key", "cell", "pair", "rep")
        dealt.mapInArrow(compare, f"rep {kind}, links long, root {kind}").write.mode("append").parquet(path)
    return spark.read.schema(f"rep {kind}, links long, root {kind}").parquet(path)


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the job that wrote them ends, not when the driver
    happens to collect its garbage: every job here ends in a written table."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def _packed(rows: DataFrame, kind: str, space: str, wide: bool) -> DataFrame:
    """(id, space, hi, lo) of all rows: a 128-bit hash of the vector, null for rows
    that link with nothing. Or with dim and x, the vector's bytes, of the others."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            flat = v.flatten()
            values = flat.fill_null(float("nan")).to_numpy() + flat.type.to_pandas_dtype()(0)  # -0.0 equals 0.0
            size = np.asarray(v.value_lengths().fill_null(0), np.int64)
            ends = np.cumsum(size)
            wrong, some = (np.concatenate([[0], np.cumsum(c)]) for c in (~np.isfinite(values), values != 0))
            good = (wrong[ends] == wrong[ends - size]) & (some[ends] > some[ends - size])
            good &= np.asarray(batch.column("id").is_valid()) & np.asarray(batch.column("space").is_valid())
            at, data, width = np.flatnonzero(good), values.tobytes(), values.itemsize
            x = [data[width * (ends[i] - size[i]):width * ends[i]] for i in at]
            named = np.zeros((batch.num_rows, 2), np.int64)
            named[at] = np.frombuffer(b"".join(hashlib.blake2b(b, digest_size=16).digest() for b in x), np.int64).reshape(-1, 2)
            out = [batch.column("id"), batch.column("space"), *(pa.array(named[:, k], mask=~good) for k in (0, 1))]
            if wide:
                out = [c.take(pa.array(at)) for c in out] + [pa.array(size[at].astype(np.int32)), pa.array(x, pa.binary())]
            yield pa.RecordBatch.from_arrays(out, ["id", "space", "hi", "lo", "dim", "x"][:len(out)])

    return rows.mapInArrow(pack, f"id {kind}, space {space}, hi long, lo long" + ", dim int, x binary" * wide)


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE,
                 codewords: int = CODEWORDS, depth: int = DEPTH, codes: int = CODES, seed: int = 3) -> DataFrame:
    """One row per input row: id, n_links (other ids linked directly),
    component_id (smallest id reachable), kept (id = component_id).

    Links join vectors of equal, non-null label and equal dimension with a
    cosine of at least ``cosine``. Vectors that are null, empty, zero or hold null
    or non-finite components, null labels and null ids link with nothing; a row
    with a null id has a null component and is not kept. Repeated rows of one
    id are one vector; an id with several vectors stands for all of them. Other columns are ignored; an empty table gives an empty
    result."""
    kind, space = (vectors.schema[c].dataType.simpleString() for c in (id_col, label_col))
    element = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("space"), F.col(vector_col).cast(f"array<{element}>").alias("v"))
    with _shuffles_freed(vectors.sparkSession):
        keys = written(_packed(rows, kind, space, False), "vector_keys")
        valid = keys.where(F.col("hi").isNotNull()).distinct()
        equal = written(valid.groupBy("space", "hi", "lo").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "equal_vectors")
        # a class has the vector of its representative; of repeated rows one
        named = equal.withColumnRenamed("rep", "id")
        of = ["id", "space", "hi", "lo"]
        classes = (_packed(rows, kind, space, True).join(named, of).groupBy(*of)
                   .agg(F.first("copies").alias("copies"), F.first("dim").alias("dim"), F.first("x").alias("x")))
        classes = written(classes.select(F.col("id").alias("rep"), "space", "copies", "dim", "x"), "vector_classes")
        found = linked_vectors(classes, kind, cosine, codewords, depth, codes, seed)
        sums = found.groupBy("rep").agg(F.sum("links").alias("links"))
        roots = components(found, "rep", "root").withColumnRenamed("node", "rep")
    facts = (equal.groupBy("rep").agg(F.sum("copies").alias("copies")).join(sums, "rep", "left").join(roots, "rep", "left")
             .select("rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root")))
    members = equal.where("copies > 1").select("space", "hi", "lo", "rep")
    keyed = keys.join(members, ["space", "hi", "lo"], "left").select("id", F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("rep"))
    return keyed.join(facts, "rep", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "id").alias("component_id"),
        F.coalesce(F.coalesce("root", "id") == F.col("id"), F.lit(False)).alias("kept"))
