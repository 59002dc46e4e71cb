"""Mixing sources to target weights, by fixed-length blocks.

1. The documents of a source, in a hashed order, form one stream of words, cut
   into blocks of ``block_words`` (the last one may be shorter).
2. Targets come from the weights: no source passes ``most`` times its size,
   what it cannot take is shared again among the others.
3. Every output shard draws which source fills each of its slots: multinomial
   counts, conditioned on the sums over all shards that meet the targets, so
   neither a target nor the limit of repeats depends on luck. That is an urn with
   as many balls of a source as it gets slots, drawn without replacement; a
   pseudorandom permutation of all slots is the draw, and no task needs the
   counts of more than its own rows (``Mix.counts`` are the drawn numbers).
4. The k-th ball of a source takes block perm(k mod blocks), with another
   pseudorandom permutation for each pass over the blocks: a block is
   taken ``most`` times at most, and one more time than another at most.
5. Slots and blocks are joined by (source, index).

All randomness comes from hashes of (seed, place): reruns agree."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from meterline.llm.common import maybe_broadcast, written
from meterline.llm.ordering import AT, numbered, ordered, running_sum, runs
from meterline.llm.shingles import mix as scramble

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Slots that one generated row stands for, level by level (no array is long).
CHUNKS = (1 << 24, 1 << 12, 1)
ROUNDS = 6


@dataclass(frozen=True)
class Mix:
    """``documents``: row, doc_id, size, src, source_size, target, start (words of the
    source before it). ``sources``: src, source, source_size, target, blocks, slots.
    ``spans``: what the mix takes, in shard, slot and document order: row, first
    word and number of words. ``slots``: shard, slot, src, block."""
    documents: DataFrame
    sources: DataFrame
    spans: DataFrame
    slots: DataFrame

    def counts(self) -> DataFrame:
        """(shard, src, slots): the numbers that the shards drew."""
        return self.slots.groupBy("shard", "src").agg(F.count(F.lit(1)).alias("slots"))


def weight_of(place: Column, weights: tuple[int, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))


def targets(sources: DataFrame, halves: int, most: int) -> DataFrame:
    """``sources`` (source_size, weight) plus ``target``: ``halves`` halves of all
    sizes shared by weight, no source above ``most`` times its size. Sources
    that exceed are held at their limit and the rest is shared again, until
    none exceeds; the comparisons are exact. Only sums reach the driver."""
    size, weight = F.col("source_size").cast("decimal(38,0)"), F.col("weight").cast("decimal(10,0)")
    full, held = F.lit(False), -1
    while True:
        n, words, at_limit, left = sources.agg(F.count(F.when(full, 1)), F.sum(size), F.sum(F.when(full, size)), F.sum(F.when(~full, weight))).first()
        rest, left = halves * int(words or 0) - 2 * most * int(at_limit or 0), int(left or 0)
        if n == held or left == 0:
            break
        held = n
        full = weight * F.lit(Decimal(rest)) > size * F.lit(Decimal(2 * most * left))
    share = F.col("weight") * (rest / (2 * left)) if left else F.lit(0.0)
    return sources.withColumn("target", F.when(full, F.col("source_size") * float(most)).otherwise(share).cast("double"))


def permute(place: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For each row the image of ``place`` under the permutation of 0..n-1 that
    ``key`` names: a Feistel network over the least power of four that holds
    n, walked until the value is below n."""
    place, n, key = place.astype(np.uint64), n.astype(np.uint64), key.astype(np.int64).view(np.uint64)
    bits = np.frexp(np.maximum(n.astype(np.float64) - 1, 1))[1]
    half = np.maximum((bits + 1) // 2, 1).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = place.copy(), np.arange(len(place))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(ROUNDS):
            left, right = right, left ^ (scramble(scramble(right + k) + np.uint64(r)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


@F.pandas_udf(LongType())
def _permuted(place: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(permute(place.to_numpy(), n.to_numpy(), key.to_numpy()))


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.monotonically_increasing_id().alias("tie"))


def _slots(sources: DataFrame, total: int, shard_slots: int, seed: int, parts: int) -> DataFrame:
    """(shard, slot, src, block) of all slots of the mix, from sources (src,
    blocks, slots, ball: the slots of the sources before it)."""
    pieces = sources.where("slots > 0").select("src", "blocks", "slots", "ball", F.lit(0).cast("long").alias("from"), F.col("slots").alias("to"))
    for width in CHUNKS:
        at = F.explode(F.sequence(F.col("from"), F.col("to") - 1, F.lit(width).cast("long")))
        pieces = pieces.withColumn("at", at).withColumn("to", F.least("to", F.col("at") + width)).drop("from").withColumnRenamed("at", "from")
        pieces = pieces.repartition(parts) if width > 1 else pieces
    k = F.col("from")
    turn = F.floor(k / F.col("blocks"))
    block = _permuted(k % F.col("blocks"), F.col("blocks"), F.xxhash64(F.lit(seed), F.lit("block"), "src", turn))
    place = _permuted(F.col("ball") + k, F.lit(total).cast("long"), F.xxhash64(F.lit(seed), F.lit("urn")))
    drawn = pieces.select("src", block.alias("block"), place.alias("place"))
    return drawn.select(F.floor(F.col("place") / shard_slots).cast("long").alias("shard"), (F.col("place") % shard_slots).alias("slot"), "src", "block")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, halves: int = 3, most: int = 2,
        block_words: int = 64, shard_slots: int = 1 << 14, seed: int = 29) -> Mix:
    """A mix of the sources of ``docs`` (doc_id, source, text; other columns play
    no part) by ``weights``, dealt to the sources by code point and null last,
    over and over. ``halves`` halves of all words are taken in all, from no
    source more than ``most`` times its words.

    Null, empty and blank texts have no words and are never taken; rows of one
    id are rows of their own (equal ones are interchangeable); a source
    without words has target 0. An empty table gives an empty mix. A long
    text is many blocks. What a source takes differs from its target by less than two blocks."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_source = F.col("source").asc_nulls_last()
    key = F.xxhash64(F.lit(seed), "doc_id", "size")
    rows = ordered(written(_sized(docs), "mix_sized"), [by_source, key, F.col("doc_id"), F.col("size"), F.col("tie")], "mix_rows")
    parts_of = written(runs(rows, ["source"], F.col("size")), "mix_runs")
    sizes = parts_of.groupBy("source").agg(F.sum("__n").alias("source_size"))
    sources = numbered(sizes, [], [by_source], "src", "mix_sources").withColumn("weight", weight_of(F.col("src"), weights))
    sources = targets(written(sources, "mix_weights"), halves, most)
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    wanted = F.floor(F.col("target") * F.col("blocks") / F.col("source_size") + 0.5)
    sources = ordered(sources.withColumn("blocks", blocks).withColumn(
        "slots", F.when(F.col("source_size") > 0, F.least(F.col("blocks") * most, wanted)).otherwise(0).cast("long")), [F.col("src")], "mix_targets")
    sources = written(running_sum(sources, written(runs(sources, [], F.col("slots")), "mix_balls"), [], "slots", "ball"), "mix_sources")
    n_sources, total = sources.agg(F.count(F.lit(1)), F.coalesce(F.sum("slots"), F.lit(0))).first()

    numbers = sources.select(F.col("source").alias("s"), "src", "source_size", "target")
    starts = written(parts_of.join(maybe_broadcast(numbers, n_sources, 128), F.col("source").eqNullSafe(F.col("s"))).drop("s"), "mix_starts")
    documents = written(running_sum(rows, starts, ["source"], "size", "start").select(
        F.col(AT).alias("row"), "doc_id", "size", "src", "source_size", "target", "start"), "mix_documents")

    start, end = F.col("start"), F.col("start") + F.col("size")
    first, last = F.floor(start / block_words), F.floor((end - 1) / block_words)
    pieces = documents.where("size > 0").select("row", "src", start.alias("start"), end.alias("end"), F.explode(F.sequence(first, last)).alias("block"))
    a, b = F.greatest(F.col("start"), F.col("block") * block_words), F.least(F.col("end"), (F.col("block") + 1) * block_words)
    pieces = pieces.select("src", "block", "row", (a - F.col("start")).alias("first_word"), (b - a).alias("words"))
    slots = _slots(sources, total, shard_slots, seed, parts)
    # Spark cannot foresee how many rows a generated table has: a hint keeps it from being broadcast
    spans = slots.hint("merge").join(pieces, ["src", "block"]).select("shard", "slot", "row", "first_word", "words")
    return Mix(documents, sources.select("src", "source", "source_size", "target", "blocks", "slots"), spans, slots)


def taken_words(mix: Mix) -> DataFrame:
    """The documents of a mix plus ``taken``: the words it takes of each, repeats counted."""
    taken = mix.spans.groupBy("row").agg(F.sum("words").alias("taken"))
    return mix.documents.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
