"""Near-duplicate documents by a signature-coordinate inverted join.

1. Every document gets its set of five-word shingles and a MinHash signature
   of ``coordinates`` values. Rows with equal sets form one class, which gets a
   number; the classes are the nodes of all that follows, so that different
   texts of one id stay apart.
2. Representatives are posted under their (coordinate, value) pairs. A pair of
   documents is of interest if it collides in at least ``matches``
   coordinates. Ordered by posting-list length, two such documents share one
   of their first ``coordinates - matches + 1`` pairs (prefix), so the longer
   lists are skipped; a document that shares fewer than ``matches`` pairs with
   anybody leaves at once.
3. Collisions are counted over whole signatures, and pairs at or above
   ``matches`` are confirmed on their full shingle sets.

Pairs inside a posting list are not enumerated: what is asked for is the
links' components. Each list first tries its members against one centre (the
member with the most collisions overall). Members in the centre's component
need no further pairs among themselves, so only pairs across components are
left. For those, an exact bound helps: a document's intersection with any other
is at most the number of its shingles that occur twice at all. Centre rounds go
on while each halves the work left; the last step takes every remaining pair:
short lists by a join, long ones in blocks inside tasks, from which only links
come out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import arrow_batches, written
from meterline.llm.components import components
from meterline.llm.shingles import coordinates as draw_coordinates
from meterline.llm.shingles import shingle_set, signature

COORDINATES = 48
MATCHES = 24  # of 48: a pair at Jaccard 0.75 falls below with probability 6e-5
WIDTH = 5
PERCENT = 75
CENTRE_ROUNDS = 4
LONG_LIST = 32  # longer lists are compared in blocks inside tasks, without emitting pairs
BLOCK = 256


def signatures(docs: DataFrame, id_col: str, text_col: str, coordinates: int, width: int, seed: int) -> DataFrame:
    """(id, text_key, n, set_key, sig) of every row; set_key and sig are null for
    texts without words."""
    mul, add = draw_coordinates(coordinates, seed)
    kind = docs.schema[id_col].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, key, sig = [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py() or b"", width)
                n.append(len(s))
                key.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sig.append(signature(s, mul, add).astype(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.list_(pa.int64()))],
                ["id", "text_key", "n", "set_key", "sig"])

    text = F.col(text_col).cast("string").cast("binary")
    return docs.select(F.col(id_col), text, F.xxhash64(text)).mapInArrow(sign, f"id {kind}, text_key long, n long, set_key binary, sig array<long>")


def prefix_postings(reps: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(rep, weight, pair): each representative under the pairs of its prefix;
    weight is the number of its collisions with all others."""
    pairs = reps.select("rep", F.posexplode("sig").alias("c", "v")).select(
        "rep", (F.shiftleft(F.col("c").cast("long"), 32) + F.col("v")).alias("pair"))
    lists = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = pairs.join(lists, "pair").groupBy("rep").agg(
        F.array_sort(F.collect_list(F.struct("size", "pair"))).alias("shared"))  # at most one per coordinate
    weight = F.aggregate("shared", F.lit(0).cast("long"), lambda s, x: s + x["size"])
    prefix = F.slice("shared", F.lit(1), F.size("shared") - (matches - 1))
    return (shared.where(F.size("shared") >= matches)
            .select("rep", weight.alias("weight"), F.explode(prefix).alias("p")).select("rep", "weight", F.col("p.pair").alias("pair")))


def set_table(docs: DataFrame, active: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(rep, n, sig, items) of the active classes, once each; items: their shingle
    hashes as bytes, taken from the class's first row. A row that only shares
    the id and the text's hash with it is known by its set and left out."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, mine = [], []
            for i, (t, key) in enumerate(zip(batch.column("t"), batch.column("set_key"), strict=True)):
                data = shingle_set(t.as_py() or b"", width).tobytes()
                if xxhash.xxh3_128_digest(data) == key.as_py():
                    items.append(data)
                    mine.append(i)
            at = pa.array(mine, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in ("rep", "n", "sig")), pa.array(items, pa.binary())], ["rep", "n", "sig", "items"])

    text = F.col(text_col).cast("string").cast("binary")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("t"))
    return texts.join(active, ["id", "text_key"]).select("rep", "n", "sig", "set_key", "t").mapInArrow(
        sets, "rep long, n long, sig array<long>, items binary").dropDuplicates(["rep"])


def confirm(pairs: DataFrame, sets: DataFrame, matches: int, percent: int) -> DataFrame:
    """The pairs (a, b) that collide in ``matches`` coordinates and reach the
    Jaccard threshold on their full sets."""
    kind = pairs.schema["a"].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sa, sb = (np.stack([np.asarray(x) for x in batch.column(c).to_numpy(zero_copy_only=False)]) if len(batch) else np.zeros((0, 1)) for c in ("sig_a", "sig_b"))
            good = np.flatnonzero((sa == sb).sum(1) >= matches)
            keep = []
            for i in good:
                x = np.frombuffer(batch.column("items_a")[int(i)].as_buffer(), np.uint64)
                y = np.frombuffer(batch.column("items_b")[int(i)].as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")], ["a", "b"])

    side = lambda s: sets.select(F.col("rep").alias(s), F.col("sig").alias(f"sig_{s}"), F.col("items").alias(f"items_{s}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sig_a", "sig_b", "items_a", "items_b")
            .mapInArrow(check, f"a {kind}, b {kind}").distinct())


def _possible(n1: Column, c1: Column, n2: Column, c2: Column, percent: int) -> Column:
    """Whether two sets of n1 and n2 items, c1 and c2 of them not unique in the
    corpus, can reach the threshold at all."""
    most = F.least(c1, c2)
    return most * (100 + percent) >= (n1 + n2) * percent


def _block_links(side: list[dict], matches: int, percent: int) -> list[tuple]:
    """Links of one block pair, as few as connect what is connected: components
    that an earlier link has joined are not compared again."""
    us, vs = side
    equal = np.zeros((len(us["rep"]), len(vs["rep"])), np.int16)
    su, sv = np.asarray(us["sig"]), np.asarray(vs["sig"])
    for k in range(su.shape[1]):
        equal += su[:, k, None] == sv[None, :, k]
    parent: dict = {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out = []
    for i, x in enumerate(us["items"]):
        for j in np.flatnonzero(equal[i] >= matches):
            y = vs["items"][j]
            p, q = find(us["label"][i]), find(vs["label"][j])
            if p == q or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                parent[max(p, q)] = min(p, q)
                out.append((min(us["rep"][i], vs["rep"][j]), max(us["rep"][i], vs["rep"][j])))
    return out


def long_list_links(open_: DataFrame, sets: DataFrame, matches: int, percent: int) -> DataFrame:
    """Links (a, b) inside long lists. Lists with the same largest component form
    a family; its outsiders (of any other component) are compared with all its
    members. Outsiders and members are dealt into blocks, each pair of blocks is
    a group of its own, and only links leave a group."""
    kind = sets.schema["rep"].dataType.simpleString()
    members = written(open_.groupBy("top", "rep").agg(F.min("label").alias("label"), F.max((F.col("label") != F.col("top")).cast("int")).alias("out")), "families")
    counts = written(members.groupBy("top").agg(F.ceil(F.sum("out") / BLOCK).cast("int").alias("bu"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("bv"))
                     .where("bu > 0"), "family_sizes")
    dealt = members.join(counts, "top")
    mine = lambda b: F.pmod(F.xxhash64("rep"), F.col(b)).cast("int")
    every = lambda b: F.explode(F.sequence(F.lit(0), F.col(b) - 1))
    rows = (dealt.where("out = 1").select("top", mine("bu").alias("i"), every("bv").alias("j"), F.lit(0).alias("side"), "rep", "label")
            .unionByName(dealt.select("top", every("bu").alias("i"), mine("bv").alias("j"), F.lit(1).alias("side"), "rep", "label")))
    n = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (rows.join(sets.select("rep", "sig", "items"), "rep").repartition(n, "top", "i", "j")
            .sortWithinPartitions("top", "i", "j", "side", "rep").select("top", "i", "j", "side", "rep", "label", "sig", "items"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, side, rep_type = None, [], None

        def finish() -> list[tuple]:
            return _block_links(side, matches, percent) if side and side[0]["rep"] and side[1]["rep"] else []

        def flush(links: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], rep_type) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            rep_type, links = batch.column("rep").type, []
            heads = zip(*(batch.column(c).to_pylist() for c in ("top", "i", "j", "side", "rep", "label")), strict=True)
            for at, (top, i, j, which, rep, label) in enumerate(heads):
                if key != (top, i, j):
                    links += finish()
                    key, side = (top, i, j), [{c: [] for c in ("rep", "label", "sig", "items")} for _ in range(2)]
                to = side[which]
                to["rep"].append(rep)
                to["label"].append(label)
                to["sig"].append(batch.column("sig")[at].values.to_numpy().copy())
                to["items"].append(np.frombuffer(batch.column("items")[at].as_py(), np.uint64))
            yield flush(links)
        if key is not None:
            yield flush(finish())

    return rows.mapInArrow(compare, f"a {kind}, b {kind}").distinct()


def _known_labels(links: DataFrame) -> DataFrame:
    """(rep, label): some representative that each one is surely connected with,
    the smallest over two steps. Equal labels mean one component; unequal ones
    may still be one."""
    both = links.select(F.col("a").alias("rep"), F.col("b").alias("label")).unionByName(links.select(F.col("b").alias("rep"), F.col("a").alias("label")))
    near = both.groupBy("rep").agg(F.min("label").alias("label")).select("rep", F.least("rep", "label").alias("label"))
    far = near.select(F.col("rep").alias("label"), F.col("label").alias("next"))
    return near.join(far, "label", "left").select("rep", F.coalesce("next", "label").alias("label"))


def link_components(postings: DataFrame, facts: DataFrame, sets: DataFrame, matches: int, percent: int) -> DataFrame:
    """(node, root) of the representatives that have a link."""
    kind = sets.schema["rep"].dataType.simpleString()
    # too many shingles of its own: such a document reaches the threshold with nobody
    posted = written(postings.join(facts.where(F.col("c") * 100 >= F.col("n") * percent), "rep"), "postings")
    size = posted.count()
    links, before, turn = sets.sparkSession.createDataFrame([], f"a {kind}, b {kind}"), None, 0
    fields = ("rep", "n", "c", "label")
    while size:
        if turn == 0:
            now = posted.withColumn("label", F.col("rep"))
        else:
            now = posted.join(_known_labels(links), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        groups = now.groupBy("pair", "label").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n"))
        lists = (groups.groupBy("pair").agg(F.max(F.struct("k", "label")).alias("top"), F.sum("k").alias("size"), F.count(F.lit(1)).alias("labels"), F.min("n").alias("least_n"))
                 .where("labels > 1").select("pair", F.col("top.label").alias("top"), F.col("top.k").alias("k"), "size", "least_n"))
        # members that cannot reach the threshold even with the list's smallest set leave the list
        fit = F.col("c") * (100 + percent) >= (F.col("n") + F.col("least_n")) * percent
        open_ = written(now.join(lists, "pair").where(fit), "open_lists")
        left = open_.where("label <> top").agg(F.sum("size")).first()[0] or 0
        if not left:
            break
        last = left <= 4 * size or turn == CENTRE_ROUNDS or (turn > 0 and 2 * left > before)
        if last:  # every pair across components: members outside the list's largest component against all
            near = open_.where(F.col("size") <= LONG_LIST)
            one = near.where("label <> top").select("pair", *[F.col(c).alias(f"{c}_1") for c in fields])
            two = near.select("pair", *[F.col(c).alias(f"{c}_2") for c in fields])
            pairs = one.join(two, (one["pair"] == two["pair"]) & (F.col("label_1") != F.col("label_2"))
                             & _possible(F.col("n_1"), F.col("c_1"), F.col("n_2"), F.col("c_2"), percent))
        else:
            order = F.struct("weight", "rep") if turn == 0 else F.struct(F.xxhash64(F.lit(turn), "rep").alias("weight"), "rep")
            centre = open_.groupBy("pair").agg(F.max(F.struct(order.alias("o"), "n", "c", "label")).alias("m")).select(
                "pair", F.col("m.o.rep").alias("rep_2"), F.col("m.n").alias("n_2"), F.col("m.c").alias("c_2"), F.col("m.label").alias("label_2"))
            pairs = open_.select("pair", *[F.col(c).alias(f"{c}_1") for c in fields]).join(centre, "pair").where(
                (F.col("label_1") != F.col("label_2")) & _possible(F.col("n_1"), F.col("c_1"), F.col("n_2"), F.col("c_2"), percent))
        pairs = pairs.select(F.least("rep_1", "rep_2").alias("a"), F.greatest("rep_1", "rep_2").alias("b")).distinct()
        found = confirm(pairs, sets, matches, percent)
        if last:
            found = found.unionByName(long_list_links(open_.where(F.col("size") > LONG_LIST), sets, matches, percent))
        links = written(links.unionByName(found), "near_links")
        if last:
            break
        before, turn = left, turn + 1
    return components(links)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", coordinates: int = COORDINATES,
                    matches: int = MATCHES, width: int = WIDTH, percent: int = PERCENT, seed: int = 5) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Rows link when 100 * |A & B| >= percent * |A | B| on their shingle sets;
    component_id is the smallest id among the rows reachable, kept says id =
    component_id. Null or wordless texts have an empty set and link with nothing.
    Every row is a document of its own: an equal id alone links nothing, and
    rows of one id with different texts may lie in different components. A row
    with a null id takes its class's component and is never kept; it links no
    others. An empty table gives an empty result; other columns are ignored."""
    spark = docs.sparkSession
    arrow_batches(spark)
    signed = written(signatures(docs, id_col, text_col, coordinates, width, seed), "signatures")
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "text_key"))).alias("first")
    classes = signed.where("set_key is not null").groupBy("set_key").agg(first, F.min("n").alias("n"), F.min("sig").alias("sig")).where("first is not null")
    # numbers of the classes: fixed once they are written
    reps = written(classes.select(F.monotonically_increasing_id().alias("rep"), "first.id", "first.text_key", "set_key", "n", "sig"), "classes")
    postings = written(prefix_postings(reps, coordinates, matches), "prefix")
    active = reps.join(postings.select("rep").distinct(), "rep", "left_semi")
    sets = written(set_table(docs, active, id_col, text_col, width), "sets")

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, data in zip(batch.column("rep"), batch.column("items"), strict=True):
                x = np.frombuffer(data.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([rep.as_py()] * len(x), batch.column("rep").type), pa.array(x)], ["rep", "item"])

    owners = sets.select("rep", "items").mapInArrow(items, "rep long, item long").groupBy("item").agg(
        F.count(F.lit(1)).alias("k"), F.min("rep").alias("rep"))
    unique = owners.where("k = 1").groupBy("rep").agg(F.count(F.lit(1)).alias("alone"))
    facts = sets.groupBy("rep").agg(F.max("n").alias("n")).join(unique, "rep", "left").select("rep", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("c"))
    labels = link_components(postings, facts, sets, matches, percent)
    nodes = reps.select("set_key", "id", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_key", "id", F.coalesce("root", "rep").alias("root"))
    least = nodes.groupBy("root").agg(F.min("id").alias("component"))
    rooted = nodes.select("set_key", "root").join(least, "root").select("set_key", "component")
    return signed.select("id", "n", "set_key").join(rooted, "set_key", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(False)).alias("kept"))
