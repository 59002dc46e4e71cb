"""How far the sources of a language are apart in its common terms, exactly.

A source's count of a term is its level, and a level has one price (a smoothed
frequency in whole billionths). For a block of terms and two blocks of sources
the indicator columns of (source, level) are multiplied by each other: the
product holds, for every two sources, the joint table "how many terms have
level c here and level d there". Each cell of a table costs the difference of
its two prices; the sum over the cells of all blocks is the divergence. The
products have entries of at most ``TERMS``, exact in single precision; prices
and sums are 64-bit integers.

Counting reads every text once and pre-aggregates per task; terms, sources and
their pairs are dealt in blocks, so no task holds a language or a source."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import arrow_batches, maybe_broadcast, written
from meterline.llm.ordering import numbered

LEAST_DOCS = 30
TOP_TERMS = 50
BILLION = 1_000_000_000
ADDED = 5
#: Terms and sources of a block of the product, and its indicator columns at most.
TERMS, SOURCES, COLUMNS = 1024, 32, 2048
#: Entries of a task's table of counts, and bytes of a text, that are handled at once.
ENTRIES, CHUNK = 200_000, 1 << 20
#: Every byte below 0x80 but the letters separates terms; A-Z become a-z.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms_of(data: bytes) -> Counter:
    """The terms of a UTF-8 text and how often each occurs."""
    found: Counter = Counter()
    at = 0
    while at < len(data):
        part = data[at:at + CHUNK].translate(_TABLE)
        if at + CHUNK < len(data) and part[-1:] != b" ":  # end at a separator
            cut = part.rfind(b" ") + 1
            if cut:
                part = part[:cut]
            else:  # one term of more than a chunk
                rest = data[at:].translate(_TABLE)
                end = rest.find(b" ")
                part = rest if end < 0 else rest[:end]
        found.update(part.split())
        at += len(part)
    return found


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
    docs: dict[tuple[str, str], Counter] = defaultdict(Counter)
    entries = 0

    def flush() -> Iterator[pa.RecordBatch]:
        rows = [(*group, term, n, docs[group][term]) for group, c in counts.items() for term, n in c.items()]
        counts.clear()
        docs.clear()
        for i in range(0, len(rows), 50_000):
            lang, source, term, n, d = zip(*rows[i:i + 50_000], strict=True)
            term = pa.array(term, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), term, pa.array(n, pa.int64()), pa.array(d, pa.int64())],
                                             ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"], strict=True):
            buffer = text.as_buffer()
            found = terms_of(buffer.to_pybytes() if buffer is not None else b"")
            group = counts[lang, source]
            entries -= len(group)
            group.update(found)
            group[b""] += 0  # a group without terms occurs too
            entries += len(group)
            docs[lang, source].update(found.keys())
            if entries > ENTRIES:
                yield from flush()
                entries = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): the occurrences in each group and the
    documents that have the term; the empty term marks the groups that occur.
    Null text, lang and source count as empty ones."""
    arrow_batches(docs.sparkSession)
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    partial = read.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def price(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 kept)), exactly."""
    over = (n + ADDED).cast("decimal(28,0)") * F.lit(BILLION).cast("decimal(10,0)")
    under = (total.cast("decimal(28,0)") + kept.cast("decimal(28,0)") * ADDED).cast("decimal(30,0)")
    return F.when(kept > 0, 1 + F.call_function("div", over, under))


def _levels(groups: np.ndarray, n: np.ndarray, p: np.ndarray, terms: np.ndarray, size: int, zero: np.ndarray):
    """The indicator matrix of a block of ``size`` terms: columns in (source,
    level) order, each with its price; and where each source's columns begin."""
    count = len(zero)
    level = np.zeros((size, count), np.int64)
    cost = np.broadcast_to(zero, (size, count)).copy()
    level[terms, groups] = n
    cost[terms, groups] = p
    codes, begins, prices = np.zeros((size, count), np.int64), np.zeros(count, np.int64), []
    width = 0
    for g in range(count):
        _, first, code = np.unique(level[:, g], return_index=True, return_inverse=True)
        codes[:, g], begins[g] = code + width, width
        prices.append(cost[first, g])
        width += len(first)
    hot = np.zeros((size, width), np.float32)
    hot[np.arange(size)[:, None], codes] = 1
    return hot, np.concatenate(prices), begins


def _priced(a: tuple, b: tuple) -> np.ndarray:
    """Sums over the joint tables of every source of ``a`` with every source of ``b``."""
    joint = (a[0].T @ b[0]).astype(np.int64)
    joint *= np.abs(a[1][:, None] - b[1][None, :])
    return np.add.reduceat(np.add.reduceat(joint, a[2], axis=0), b[2], axis=1)


def _block(rows: pd.DataFrame, size: int, a: np.ndarray, b: np.ndarray, zero: dict) -> np.ndarray:
    """The priced product of one block of terms, in halves while it has too many columns."""
    def side(ids):
        mine = rows[rows["grp"].isin(ids)]
        return (np.searchsorted(ids, mine["grp"].to_numpy()), mine["n"].to_numpy(), mine["p"].to_numpy(), mine["term"].to_numpy(), size,
                np.array([zero[i] for i in ids], np.int64))

    widest = max(len(a), len(b)) + rows.groupby("grp")["n"].nunique().sum() if len(rows) else 0
    if size > 1 and widest > COLUMNS:
        half = size // 2
        low = rows[rows["term"] < half]
        high = rows[rows["term"] >= half]
        return _block(low, half, a, b, zero) + _block(high.assign(term=high["term"] - half), size - half, a, b, zero)
    left = _levels(*side(a))
    return _priced(left, left if a is b else _levels(*side(b)))


def _product(rows: pd.DataFrame) -> pd.DataFrame:
    """All pairs of one cell (lang, block of terms, two blocks of sources): rows
    without a term name the sources and their price of level 0."""
    head = rows[rows["term"] < 0]
    zero = dict(zip(head["grp"], head["p"], strict=True))
    ids = np.sort(head["grp"].to_numpy())
    first, second = rows["a"].iloc[0], rows["b"].iloc[0]
    a = ids[ids // SOURCES == first]
    b = a if first == second else ids[ids // SOURCES == second]
    size = int(head["size"].iloc[0])
    body = rows[rows["term"] >= 0]
    total = _block(body, size, a, b, zero) if size else np.zeros((len(a), len(b)), np.int64)
    i, j = np.meshgrid(a, b, indexing="ij")
    pair = i < j
    return pd.DataFrame({"lang": rows["lang"].iloc[0], "x": i[pair], "y": j[pair], "value": total[pair]})


def joint_prices(counts: DataFrame, groups: DataFrame, n_groups: int) -> DataFrame:
    """(lang, x, y, value) for all pairs x < y of a language's sources.

    ``counts``: lang, grp, term (dense per language, by falling frequency, so that
    a block has few levels), n and p of every positive count. ``groups``: lang, grp (dense per
    language), kept (terms of the language) and p0, the price of level 0; ``n_groups`` is their counted number."""
    size = groups.groupBy("lang").agg(F.max("grp").alias("top"))
    wide = groups.join(maybe_broadcast(size, n_groups, 64), "lang").withColumn("mine", F.floor(F.col("grp") / SOURCES)).withColumn("last", F.floor(F.col("top") / SOURCES))
    # a block of sources takes part in the cells (i, mine), i <= mine, and (mine, j), mine <= j
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))
    cells = [F.least("mine", "o").alias("a"), F.greatest("mine", "o").alias("b")]
    terms = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.floor((F.col("kept") - 1) / TERMS))))
    heads = (wide.withColumn("o", others).select("lang", "grp", "kept", "p0", *cells).withColumn("t", terms)
             .select("lang", "t", "a", "b", "grp", F.lit(-1).cast("long").alias("term"), F.lit(0).cast("long").alias("n"), F.col("p0").alias("p"),
                     F.least(F.lit(TERMS), F.col("kept") - F.col("t") * TERMS).cast("long").alias("size")))
    body = (counts.withColumn("mine", F.floor(F.col("grp") / SOURCES)).join(maybe_broadcast(wide.select("lang", "grp", "last"), n_groups, 64), ["lang", "grp"])
            .withColumn("o", others).select("lang", F.floor(F.col("term") / TERMS).alias("t"), *cells, "grp", (F.col("term") % TERMS).alias("term"),
                                            "n", "p", F.lit(0).cast("long").alias("size")))
    products = heads.unionByName(body).groupBy("lang", "t", "a", "b").applyInPandas(_product, "lang string, x long, y long, value long")
    return products.groupBy("lang", "x", "y").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """The audit of ``docs`` (text, lang, source; other columns play no part):
    lang, source, part, item, value, rank.

    Null text, lang and source are empty ones; rows that repeat count again; a
    group without terms keeps its rows in part ``pair`` (with value 0 in a language
    without kept terms); a language's only source has none. Ties go by the item in UTF-8
    order. An empty table gives an empty result. Long texts are counted whole, piece by piece."""
    found = written(term_counts(docs), "audit_counts")
    real = found.where("term <> ''")
    frequent = real.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).select("lang", "term")
    used = written(real.select("lang", "source", "term", "n").join(frequent, ["lang", "term"]), "audit_kept")
    by_lang = written(used.groupBy("lang", "term").agg(F.sum("n").alias("n")), "audit_terms")
    terms = numbered(by_lang, ["lang"], [F.col("lang"), F.col("n").desc(), F.col("term")], "number", "audit_order")
    langs = written(by_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total")), "audit_langs")
    langs = maybe_broadcast(langs, langs.count(), 64)
    terms = terms.join(langs, "lang").select("lang", "term", "number", price(F.col("n"), F.col("lang_total"), F.col("kept")).alias("q"))

    seen = found.where("term = ''").select("lang", "source")
    groups = numbered(seen, ["lang"], [F.col("lang"), F.col("source")], "grp", "audit_groups")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", "grp", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"))
    groups = written(groups.withColumn("p0", price(F.lit(0), F.col("total"), F.col("kept"))), "audit_sources")
    n_groups = groups.count()
    few = maybe_broadcast(groups.select("lang", "source", "grp", "total", "kept"), n_groups, 128)
    priced = written(used.join(few, ["lang", "source"]).join(terms, ["lang", "term"]).select(
        "lang", "source", "grp", "term", "number", "n", price(F.col("n"), F.col("total"), F.col("kept")).alias("p"), "q"), "audit_prices")

    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    high = (priced.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
            .withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top))

    pairs = written(joint_prices(priced.select("lang", "grp", F.col("number").alias("term"), "n", "p"),
                                 groups.select("lang", "grp", "kept", "p0"), n_groups), "audit_pairs")
    both = pairs.unionByName(pairs.select("lang", F.col("y").alias("x"), F.col("x").alias("y"), "value"))
    names = groups.select("lang", "grp", "source")
    x = maybe_broadcast(names.select("lang", F.col("grp").alias("x"), "source"), n_groups, 128)
    y = maybe_broadcast(names.select("lang", F.col("grp").alias("y"), F.col("source").alias("item")), n_groups, 128)
    apart = (both.join(x, ["lang", "x"]).join(y, ["lang", "y"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
             .withColumn("rank", F.row_number().over(by_value)))
    return apart.unionByName(high).select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
