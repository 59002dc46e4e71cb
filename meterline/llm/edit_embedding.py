"""Document fingerprints by randomised edit embedding.

A walk reads a text: at step j it stands on a character c, emits it, and moves
on if the shared random bit r(j, c) says so. Two texts walk with the same
bits, so after an insertion, deletion or replacement their walks soon meet
again and emit the same characters from there on: edit distance becomes
Hamming distance between the emitted strings. (The distortion is that of the
method: k edits can cost the order of k * k steps, so scattered edits weigh
more than one block.)

The fingerprint keeps a sample of what was emitted, over the whole walk: up to
``PER_OCTAVE`` steps of each octave [2^a, 2^(a+1)), four hashed bits each, as
hex digits. All texts sample the same steps, so fingerprints of any two
lengths compare: ``likeness`` weighs each digit by the steps that it stands for."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import arrow_batches, written

PER_OCTAVE = 64
PERIOD = 4096
SEED = 29
CHUNK_CHARS = 6_000_000
CHUNK_ROWS = 4096
LONG_BUCKET = 32  # longer buckets are compared in blocks inside tasks, without emitting pairs
BUCKET_BLOCK = 256


class Walks:
    """The shared random bits and sampled steps."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.bits = rng.integers(0, 2, (PERIOD, 256), np.uint8)
        self.bits[:, 0] = 0  # class 0 stands behind the end of a text
        self.seed = seed
        self.steps = np.zeros(0, np.int64)
        self.weights = np.zeros(0)
        self.octave = 0
        self._grow()

    def _grow(self) -> None:
        a = self.octave
        if a == 0:
            steps, weight = np.array([0, 1]), 1.0
        else:
            width = 1 << a
            take = min(width, PER_OCTAVE)
            steps = width + np.sort(np.random.default_rng([self.seed, a]).choice(width, take, replace=False))
            weight = width / take
        self.steps = np.r_[self.steps, steps]
        self.weights = np.r_[self.weights, np.full(len(steps), weight)]
        self.octave += 1

    def fingerprints(self, texts: list[str]) -> list[str]:
        """Of all texts at once: every step moves all walks that still run."""
        n = np.array([len(t) for t in texts], np.int64)
        joined = "\0".join(texts) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        classes = (((codes * np.uint32(2654435761)) >> np.uint32(16)) % np.uint32(255) + np.uint32(1)).astype(np.uint8)
        end = np.cumsum(n + 1) - 1
        classes[end] = 0
        who = np.flatnonzero(n > 0)
        at = (end - n)[who]
        # all walks end within a few times the longest text; samples are kept per step, then dealt to the texts
        kept_who, kept_step, kept_char = [], [], []
        sample, j = 0, 0
        buffer = np.empty(len(who), np.uint8)
        move = np.empty(len(who), np.uint8)
        while len(who):
            stop = j + 128
            while self.steps[-1] < stop:
                self._grow()
            next_sample = self.steps[sample]
            here, step = buffer[:len(who)], move[:len(who)]
            while j < stop:
                np.take(classes, at, out=here)
                if j == next_sample:
                    running = np.flatnonzero(here)
                    kept_who.append(who[running])
                    kept_step.append(np.full(len(running), sample, np.int32))
                    kept_char.append(here[running] >> 4)
                    sample += 1
                    next_sample = self.steps[sample]
                np.take(self.bits[j % PERIOD], here, out=step)
                np.add(at, step, out=at)
                j += 1
            running = classes[at] > 0
            if not running.all():
                who, at = who[running], at[running]
        out = [""] * len(texts)
        if kept_who:
            owner, step, char = np.concatenate(kept_who), np.concatenate(kept_step), np.concatenate(kept_char)
            order = np.lexsort((step, owner))
            digits = np.frombuffer(b"0123456789abcdef", np.uint8)[char[order]].tobytes().decode()
            begin = np.searchsorted(owner[order], np.arange(len(texts) + 1))
            out = [digits[begin[i]:begin[i + 1]] for i in range(len(texts))]
        return out

    def likeness(self, a: str, b: str) -> float:
        """Weighted share of equal digits; digits that only one text has differ."""
        if len(a) == len(b) == 0:
            return 1.0
        while len(self.steps) < max(len(a), len(b)):
            self._grow()
        m = min(len(a), len(b))
        same = np.frombuffer(a[:m].encode(), np.uint8) == np.frombuffer(b[:m].encode(), np.uint8)
        return float(self.weights[:m][same].sum() / self.weights[:max(len(a), len(b))].sum())


# --- neighbours in id order -----------------------------------------------

def _parts_of(order: Column, cuts: list) -> Column:
    """How many of the sorted ``cuts`` are at most ``order`` (binary search)."""
    if not cuts:
        return F.lit(0)
    values = F.array(*[F.lit(c) for c in cuts])
    steps = F.array(*[F.lit(i) for i in range(len(cuts).bit_length())])
    found = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")), lambda s, _: F.when(s["lo"] >= s["hi"], s).otherwise(
        F.when(F.element_at(values, F.floor((s["lo"] + s["hi"]) / 2).cast("int") + 1) <= order,
               F.struct((F.floor((s["lo"] + s["hi"]) / 2).cast("int") + 1).alias("lo"), s["hi"].alias("hi")))
        .otherwise(F.struct(s["lo"].alias("lo"), F.floor((s["lo"] + s["hi"]) / 2).cast("int").alias("hi")))))
    return F.coalesce(found["lo"], F.lit(0))


def with_next(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Rows (part, peek, id, text), dealt by id ranges and sorted, so that the row
    after each row is the next document; a part ends with a copy of the next
    part's first document (peek), the last one with the very first."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    firsts = (rows.select("id").repartitionByRange(parts, "id").groupBy(F.spark_partition_id().alias("p"))
              .agg(F.min("id").alias("first"), F.max(F.col("id").isNull()).alias("null")).collect())  # one row per part
    lowest = sorted({r["first"] for r in firsts if r["first"] is not None})
    cuts, has_null = lowest[1:], any(r["null"] for r in firsts)
    part = _parts_of(F.col("id"), cuts)
    head = F.col("id").isNull() if has_null else (F.col("id") == F.lit(lowest[0]) if lowest else F.lit(False))
    opens = F.col("id").isin(cuts) if len(cuts) < 200 else F.array_contains(F.array(*[F.lit(c) for c in cuts]), F.col("id"))
    before = F.when(head, F.lit(len(cuts))).when(F.coalesce(opens, F.lit(False)), part - 1)
    places = F.when(before.isNull(), F.array(F.struct(part.alias("part"), F.lit(False).alias("peek")))).otherwise(
        F.array(F.struct(part.alias("part"), F.lit(False).alias("peek")), F.struct(before.alias("part"), F.lit(True).alias("peek"))))
    dealt = rows.select(F.explode(places).alias("p"), "id", "text").select("p.part", "p.peek", "id", "text")
    return dealt.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("part", "peek", F.asc_nulls_first("id"), "text"), len(cuts) + 1


def edited(text: str, following: str) -> str:
    """The last half of the characters replaced by the first ones of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """One row per input row: id, n_chars, edited_text, fingerprint,
    edited_fingerprint, near_edited, near_next.

    Null texts count as empty; an empty text has an empty fingerprint, whose
    likeness is 1 to another empty one and 0 to others. Documents follow each
    other by id (null first), then text; the first follows the last; a single
    document follows itself. Other columns are ignored; an empty table gives an
    empty result."""
    arrow_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    dealt, _ = with_next(docs, id_col, text_col)
    names = ["id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = Walks(seed)
        held: list[tuple] = []  # (part, peek, id, text), the last one only as successor
        chars, id_type = 0, None

        def finish(rows: list[tuple]) -> pa.RecordBatch:
            pairs = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if not a[1]]
            texts = [a[3] for a, _ in pairs]
            after = [b[3] for _, b in pairs]
            changed = [edited(t, f) for t, f in zip(texts, after, strict=True)]
            distinct = {t: i for i, t in enumerate(dict.fromkeys([*texts, *after, *changed]))}
            prints = walks.fingerprints(list(distinct))
            of = [[prints[distinct[t]] for t in x] for x in (texts, changed, after)]
            return pa.RecordBatch.from_arrays(
                [pa.array([a[2] for a, _ in pairs], id_type), pa.array([len(t) for t in texts], pa.int64()), pa.array(changed, pa.string()),
                 pa.array(of[0], pa.string()), pa.array(of[1], pa.string()),
                 pa.array([walks.likeness(x, y) for x, y in zip(of[0], of[1], strict=True)], pa.float64()),
                 pa.array([walks.likeness(x, y) for x, y in zip(of[0], of[2], strict=True)], pa.float64())], names)

        for batch in batches:
            id_type = batch.column("id").type
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "peek", "id", "text")), strict=True):
                held.append(row)
                chars += len(row[3])
                if chars >= CHUNK_CHARS or len(held) > CHUNK_ROWS:
                    yield finish(held)
                    held, chars = [row], len(row[3])
        if len(held) > 1:
            yield finish(held)

    return dealt.mapInArrow(run, f"id {kind}, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, "
                                 "near_edited double, near_next double").withColumnRenamed("id", id_col)


# --- banding --------------------------------------------------------------

class Bands:
    """Buckets in which two fingerprints at least ``least`` alike meet with
    probability ``recall`` or more, over the random draw.

    Digits are drawn by the steps they stand for, as ``likeness`` weighs them.
    The reaches are lengths whose weights grow by ``ratio``; a fingerprint is
    posted under the largest reach inside it and under as many smaller ones as
    the shorter of two alike ones can be behind. Over the shorter one's reach at
    least 1 - (1 - least) * ratio of the weight agrees, so a band of ``digits``
    draws does with that to the power of ``digits``."""

    def __init__(self, walks: Walks, least: float, bands: int | None, digits: int, recall: float, seed: int):
        if not 0 < least <= 1 or not 0 < recall < 1:
            raise ValueError("least must be in (0, 1], recall in (0, 1)")
        self.walks, self.digits, self.seed = walks, digits, seed
        self.ratio = min(2 ** 0.25, 1 + least / (4 * max(1 - least, 1e-9)))
        self.behind = math.ceil(math.log(1 / least) / math.log(self.ratio))
        meet = (1 - (1 - least) * self.ratio) ** digits
        self.bands = bands or (math.ceil(math.log(1 - recall) / math.log1p(-meet)) if meet < 1 else 1)
        self.total = np.zeros(0)
        self.starts = np.zeros(0)  # weights at which the levels start
        self.drawn: dict[int, np.ndarray] = {}

    def _positions(self, level: int) -> np.ndarray:
        if level not in self.drawn:
            reach = int(np.searchsorted(self.total, self.starts[level])) + 1
            upto = self.total[:reach] / self.total[reach - 1]
            draws = np.random.default_rng([self.seed, level]).random((self.bands, self.digits))
            self.drawn[level] = np.searchsorted(upto, draws, side="right")
        return self.drawn[level]

    def keys(self, fp: str) -> np.ndarray:
        """The buckets of a fingerprint, each once, sorted."""
        if len(fp) > len(self.total):
            while len(self.walks.steps) < len(fp):
                self.walks._grow()
            self.total = np.cumsum(self.walks.weights)
            self.starts = self.ratio ** np.arange(math.ceil(math.log(self.total[-1]) / math.log(self.ratio)) + 1)
        top = int(np.searchsorted(self.starts, self.total[len(fp) - 1], side="right")) - 1
        data, out = np.frombuffer(fp.encode(), np.uint8), []
        for level in range(max(0, top - self.behind), top + 1):
            for band, drawn in enumerate(data[self._positions(level)]):
                out.append(hashlib.blake2b(b"%d %d " % (level, band) + drawn.tobytes(), digest_size=8).digest())
        return np.unique(np.frombuffer(b"".join(out), np.int64))


def _matrix(prints: list[str], width: int, behind: int) -> np.ndarray:
    """Digits as rows; ``behind`` stands after the end of a fingerprint."""
    out = np.full((len(prints), width), behind, np.uint8)
    for row, fp in zip(out, prints, strict=True):
        row[:len(fp)] = np.frombuffer(fp.encode(), np.uint8)
    return out


def _block_pairs(walks: Walks, left: list[str], right: list[str], least: float, same: bool) -> list[tuple[int, int, float]]:
    """(i, j, likeness) of all pairs of two blocks that reach ``least``; of a
    block with itself every pair once. The weights are powers of two, so the
    sums are those of ``Walks.likeness``."""
    width = max(map(len, [*left, *right]))
    while len(walks.steps) < width:
        walks._grow()
    total = np.cumsum(walks.weights[:width])
    x, y = _matrix(left, width, 0), _matrix(right, width, 1)
    ends, out = np.array([len(fp) for fp in right]), []
    for i, fp in enumerate(left):
        start = i + 1 if same else 0
        like = (y[start:] == x[i]) @ walks.weights[:width] / total[np.maximum(ends[start:], len(fp)) - 1]
        out += [(i, start + int(j), float(like[j])) for j in np.flatnonzero(like >= least)]
    return out


def near_documents(prints: DataFrame, id_col: str = "doc_id", print_col: str = "fingerprint", least: float = 0.8, bands: int | None = None,
                   digits: int = 6, seed: int = SEED, recall: float = 0.999) -> DataFrame:
    """Links (a, b, likeness) between documents whose fingerprints are at least
    ``least`` alike, found by bit-sampled banding.

    A pair that is exactly ``least`` alike is found with probability ``recall``
    or more, wherever its texts differ (see ``Bands``; ``bands`` overrides the
    number derived from it); pairs more alike are missed less. All different fingerprints of a bucket are compared with each other:
    those of short buckets as distinct pairs, those of long ones in blocks inside
    tasks, which only links leave.

    The smallest id of each fingerprint stands for its copies: every copy is
    linked to it (likeness 1), and it has the links to other fingerprints. So
    two documents are near if their smallest equals are one or are linked, and
    exact copies cost one link each. Null ids and empty fingerprints take no
    part."""
    kind = prints.schema[id_col].dataType.simpleString()
    n_parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written(prints.select(F.col(id_col).alias("id"), F.col(print_col).alias("fp")).where("id is not null and length(fp) > 0")
                   .dropDuplicates(["id", "fp"]), "print_rows")
    groups = written(rows.groupBy("fp").agg(F.min("id").alias("rep")).withColumn("key", F.md5("fp")), "print_groups")
    copies = rows.join(groups, "fp").where("id > rep").select(F.col("rep").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("likeness"))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn = Bands(Walks(seed), least, bands, digits, recall, seed)
        for batch in batches:
            keys = [drawn.keys(fp) for fp in batch.column("fp").to_pylist()]
            at = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(at, pa.int64())), pa.array(np.concatenate(keys) if keys else [], pa.int64())], ["key", "band"])

    posted = groups.select("key", "fp").mapInArrow(post, "key string, band long")
    sizes = posted.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(posted.join(sizes, "band"), "print_buckets")

    # short buckets: every pair once, whatever number of buckets it shares
    short = shared.where(F.col("n") <= LONG_BUCKET)
    pairs = (short.select("band", F.col("key").alias("p")).join(short.select("band", F.col("key").alias("q")), "band")
             .where("p < q").select("p", "q").distinct())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks = Walks(seed)
        for batch in batches:
            like = [walks.likeness(x, y) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(like, pa.float64())], ["a", "b", "likeness"])

    side = lambda k, c, f: groups.select(F.col("key").alias(k), F.col("rep").alias(c), F.col("fp").alias(f))
    from_short = (pairs.join(side("p", "a", "x"), "p").join(side("q", "b", "y"), "q").select("a", "b", "x", "y")
                  .mapInArrow(verify, f"a {kind}, b {kind}, likeness double").where(F.col("likeness") >= least))

    # long buckets: members dealt into blocks, every pair of blocks a group of its own
    blocks = F.ceil(F.col("n") / BUCKET_BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    dealt = (shared.where(F.col("n") > LONG_BUCKET).select("band", "key", blocks.alias("blocks")).select("band", "key", "blocks", mine.alias("mine"))
             .select("band", "key", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("band", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "key"))
    dealt = (dealt.join(groups, "key").repartition(n_parts, "band", "i", "j").sortWithinPartitions("band", "i", "j", "mine")
             .select("band", "i", "j", "mine", "rep", "fp"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walks, group, sides, id_type = Walks(seed), None, ([], []), None
        drawn = Bands(walks, least, bands, digits, recall, seed)

        def finish() -> pa.RecordBatch:
            links = []
            if group is not None:
                (band, i, j), (left, right) = group, sides
                right = left if i == j else right
                known: list[dict[int, np.ndarray]] = [{}, {}]

                def keys(which: int, at: int) -> np.ndarray:
                    if at not in known[which]:
                        known[which][at] = drawn.keys((left, right)[which][at][1])
                    return known[which][at]

                if left and right:
                    for p, q, like in _block_pairs(walks, [x[1] for x in left], [x[1] for x in right], least, i == j):
                        if np.intersect1d(keys(0, p), keys(1, q), assume_unique=True)[0] == band:  # in the first shared bucket only
                            links.append((left[p][0], right[q][0], like))
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], id_type), pa.array([x[1] for x in links], id_type),
                                               pa.array([x[2] for x in links], pa.float64())], ["a", "b", "likeness"])

        for batch in batches:
            id_type = batch.column("rep").type
            for band, i, j, member, rep, fp in zip(*(batch.column(c).to_pylist() for c in ("band", "i", "j", "mine", "rep", "fp")), strict=True):
                if group != (band, i, j):
                    if group is not None:
                        yield finish()
                    group, sides = (band, i, j), ([], [])
                sides[int(member != i)].append((rep, fp))
        if group is not None:
            yield finish()

    from_long = dealt.mapInArrow(compare, f"a {kind}, b {kind}, likeness double")
    found = from_short.unionByName(from_long).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness").where("a < b")
    return found.unionByName(copies).groupBy("a", "b").agg(F.max("likeness").alias("likeness"))
