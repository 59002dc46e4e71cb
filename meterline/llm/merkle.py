"""Merkle manifest of a dataset: a hash tree over every source's documents, a
tree over the sources, and each document's audit path, by lag and lead windows.

The rows of a source stand in one gapless order. In level k the row at position
p holds a node when 3^k divides p, so the siblings of that node stand exactly
3^k and 2 * 3^k rows before or after it: ``lag`` and ``lead`` with these fixed
offsets fetch them, masked by the node's slot in its run of three and by the
run's length, and the first child's row hashes the parent. Rows are dealt by
(group, block of 3^LEVELS positions); a run never crosses a block, so one sort
serves LEVELS levels and no group has to fit a task. What a block yields is a
row of the next, 3^LEVELS times smaller pass.

Only what is read again is written, in few files: for every file on a ``file:``
path Hadoop starts processes that set its mode, and such a process shares the
executor's memory, and counts as so much more, until it runs its own program."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import maybe_broadcast, written
from meterline.llm.ordering import AT, PART, ordered, runs, with_runs

ARITY = 3
#: Levels of one pass: blocks of 243 rows.
LEVELS = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts (UTF-8)."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> tuple[Column, Column]:
    """The parts of a field as the leaf hashes it: ``-`` and nothing for null,
    else its length in UTF-8 bytes with a colon, and the value."""
    text = value.cast("string")
    head = F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":")))
    return head, F.coalesce(text, F.lit(""))


def leaf(text: Column | str = "text") -> Column:
    """The leaf of a documents row, with ``text`` in place of its text; a long
    text is copied once."""
    text = F.col(text) if isinstance(text, str) else text
    return digest(*[part for name in FIELDS for part in field(text if name == "text" else F.col(name))])


def _levels_of(n: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def _pass(nodes: DataFrame, levels: int, keep: list[str]) -> DataFrame:
    """``levels`` levels over nodes (grp, pos, hash, n): the block, ``path`` (the
    left and right siblings' digests, level by level) and ``up``, the block's node after them (on its
    first row)."""
    block = ARITY ** levels
    rows = nodes.withColumn("block", F.floor(F.col("pos") / block).cast("long")).withColumn("h0", F.col("hash"))
    inside = Window.partitionBy("grp", "block").orderBy("pos")
    for k in range(levels):
        step = ARITY ** k
        held = F.col("pos") % step == 0  # the row holds a node of this level
        here, n = F.col(f"h{k}"), F.ceil(F.col("n") / step)
        rows = rows.withColumns({"b1": F.lag(here, step).over(inside), "b2": F.lag(here, 2 * step).over(inside),
                                 "a1": F.lead(here, step).over(inside), "a2": F.lead(here, 2 * step).over(inside)})
        at = F.floor(F.col("pos") / step)
        slot = at % ARITY
        run = F.least(F.lit(ARITY), n - (at - slot))

        def masked(name: str, condition: Column) -> Column:
            return F.when(condition, F.col(name)).otherwise(F.lit(""))

        left = F.concat(masked("b2", slot == 2), masked("b1", slot >= 1))
        right = F.concat(masked("a1", slot + 1 < run), masked("a2", slot + 2 < run))
        parent = F.when(n > 1, digest(here, right)).otherwise(here)
        rows = rows.withColumns({
            f"s{k}": F.when(held, F.when(n > 1, F.array(F.struct(left.alias("left"), right.alias("right")))).otherwise(F.array().cast(_PATH))),
            f"h{k + 1}": F.when(F.col("pos") % (step * ARITY) == 0, parent)}).drop("b1", "b2", "a1", "a2")
    # A node's row is the first of its subtree: filled forward, every row has its ancestors' siblings.
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    path = F.concat(*[F.last(f"s{k}", ignorenulls=True).over(so_far) for k in range(levels)])
    return rows.select("grp", "pos", "n", "block", path.alias("path"), F.col(f"h{levels}").alias("up"), *keep)


def audit_paths(nodes: DataFrame, most: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """From (grp, pos, hash, n), gapless positions and sizes of every group of at
    most ``most`` nodes: (grp, pos, path, top), the siblings of every level up
    to the group's top digest, and that digest, and the columns to ``keep``. A
    single node is its top."""
    if most <= 1:
        return nodes.select("grp", "pos", F.array().cast(_PATH).alias("path"), F.col("hash").alias("top"), *keep)
    levels = min(LEVELS, _levels_of(most))
    block = ARITY ** levels
    done = written(_pass(nodes, levels, list(keep)), "merkle_pass")
    heads = done.where(F.col("up").isNotNull()).select(
        "grp", F.col("block").alias("pos"), F.col("up").alias("hash"), F.ceil(F.col("n") / block).cast("long").alias("n"))
    above = audit_paths(heads, -(-most // block))
    width = 100 + 140 * max(1, _levels_of(-(-most // block)))
    above = above.select(F.col("grp").alias("g"), F.col("pos").alias("b"), F.col("path").alias("rest"), "top")
    joined = done.join(maybe_broadcast(above, heads.count(), width), (F.col("grp") == F.col("g")) & (F.col("block") == F.col("b")))
    return joined.select("grp", "pos", F.concat("path", "rest").alias("path"), "top", *keep)


def fold(start: Column, path: Column) -> Column:
    """The digest at the end of ``path`` when it begins with ``start``."""
    return F.aggregate(path, start, lambda node, step: digest(step["left"], node, step["right"]))


def path_digest(path: Column) -> Column:
    """H of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


def _numbered_runs(parts: DataFrame, n_sources: int) -> DataFrame:
    """The ``runs`` of the ordered rows with ``grp``, their source's 0-based place
    among the sources, and ``n``, its rows. The order begins with the source, so
    a source follows those whose first run is in an earlier partition, or
    earlier in its own."""
    first = parts.where("__start = 0").select(F.col("source").alias("s"), PART, "__first")
    before = Window.partitionBy(F.lit(0)).orderBy("p").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    opened = first.groupBy(F.col(PART).alias("p")).agg(F.count(F.lit(1)).alias("k")).select(
        "p", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("earlier"))
    inside = F.row_number().over(Window.partitionBy(PART).orderBy("__first")) - 1
    numbers = first.withColumn("inside", inside).join(opened, F.col(PART) == F.col("p")).select(
        "s", (F.col("earlier") + F.col("inside")).cast("long").alias("grp"))
    sized = parts.withColumn("n", F.sum("__n").over(Window.partitionBy("source")))
    return sized.join(maybe_broadcast(numbers, n_sources, 128), F.col("source").eqNullSafe(F.col("s"))).select(
        "source", PART, "__first", "__start", "grp", "n")


def manifest(docs: DataFrame, tampered_text: Column | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, lang, n_chars, text; other
    columns play no part, whatever their names): doc_id, source, ``leaf``,
    ``tampered_leaf`` (the leaf with ``tampered_text`` for its text; the leaf
    itself where that is null or not given), ``path``, ``source_path``
    (arrays of left and right siblings, below and above the subroot),
    ``subroot`` and ``root``.

    Leaves of a source ascend by doc_id, null ids first; rows of one id by
    their leaves, so equal rows are interchangeable and the root depends on the
    rows alone. A null source is a source of its own, before the others; null
    and empty texts differ. One source, one document or one row in all is its
    own top. An empty table gives an empty result."""
    other = F.lit(None).cast("string") if tampered_text is None else tampered_text
    texts = docs.select(*FIELDS, other.alias("__other"))
    leaves = texts.select("doc_id", "source", leaf().alias("leaf"), F.when(F.col("__other").isNotNull(), leaf("__other")).alias("other"),
                          F.monotonically_increasing_id().alias("tie"))
    leaves = written(leaves, "merkle_leaves")
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("tie")]
    rows = ordered(leaves, order, "merkle_rows", leaves.count())
    parts = written(runs(rows, ["source"]), "merkle_runs")
    sizes = parts.groupBy("source").agg(F.sum("__n").alias("n"))
    n_sources, most = sizes.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    starts = _numbered_runs(parts, n_sources)
    placed = with_runs(rows, starts, ["source"], parts.count()).select(
        "grp", (F.col("__start") + F.col(AT) - F.col("__first")).alias("pos"), "n", F.col("leaf").alias("hash"), "doc_id", "source", "other")
    below = audit_paths(placed.withColumn("leaf", F.col("hash")), most, ("doc_id", "source", "leaf", "other"))

    subroots = below.where("pos = 0").select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("pos"), F.col("top").alias("hash"),
                                             F.lit(n_sources).cast("long").alias("n"))
    tops = audit_paths(subroots, n_sources).select(
        F.col("pos").alias("grp"), F.col("path").alias("source_path"), F.col("top").alias("root"))
    width = 200 + 140 * max(1, _levels_of(n_sources))
    return below.withColumnRenamed("top", "subroot").join(maybe_broadcast(tops, n_sources, width), "grp").select(
        "doc_id", "source", "leaf", F.coalesce("other", "leaf").alias("tampered_leaf"), "path", "source_path", "subroot", "root")


def verify(audit: DataFrame) -> DataFrame:
    """The rows of ``manifest`` with ``proof_sha256`` (H of all siblings),
    ``folded_root`` (from the tampered leaf along the original siblings) and
    ``verified`` (whether that is the root)."""
    whole = F.concat("path", "source_path")
    return (audit.withColumns({"proof_sha256": path_digest(whole), "folded_root": fold(F.col("tampered_leaf"), whole)})
            .withColumn("verified", F.col("folded_root") == F.col("root")))
