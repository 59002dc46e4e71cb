"""Check results of a partitioned model, kept by partition and merged.

A load touches a few partitions of a large model; its checks need not read the
others again. For every partition the store keeps what each check needs, in a
form that adds up over partitions: (check, key, n), where

* row checks (not_null, accepted_range, expression, date_past) hold their failing rows,
* row_count holds the rows,
* accepted_values holds the rows of each value outside the list,
* unique and relationships hold the rows of each key.

``refresh`` reads touched partitions twice at most, whatever the number of checks
(once for the checks that sum rows, once for those by key), counts before it
shuffles and replaces these partitions (dynamic partition overwrite).
``report`` sums the parts and decides: a value that is bad in two partitions is
one bad value, a key that occurs in two partitions is not unique, and keys meet
the parents as they are now, so that a parent that has gone shows without reading
the model again."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.joins import dimension, is_literal
from meterline.operators import quality as Q

SUMMED = ("not_null", "accepted_range", "expression", "date_past", "row_count")
TOUCHED = -1  # check number of a partition's marker row


def in_partitions(by: tuple[str, ...], partitions: Iterable[tuple]) -> Column:
    """Whether a row lies in one of the partitions; None stands for null. A value of
    the first column is compared once, however many partitions have it."""
    rest: dict[object, list[tuple]] = {}
    for values in partitions:
        if len(values) != len(by):
            raise ValueError(f"{values} are not values of {by}")
        rest.setdefault(values[0], []).append(tuple(values[1:]))
    c, wanted = F.col(by[0]), F.lit(False)
    if len(by) == 1:
        wanted = c.isin([v for v in rest if v is not None])
        return F.coalesce(wanted | c.isNull() if None in rest else wanted, F.lit(False))
    for v, values in rest.items():
        wanted = wanted | ((c.isNull() if v is None else c == F.lit(v)) & in_partitions(by[1:], values))
    return F.coalesce(wanted, F.lit(False))


class SuiteStore:
    """The stored checks of one model. ``checks`` are those of the model alone;
    a store written for other checks is refused."""

    def __init__(self, spark: SparkSession, checks: list[Q.Check], path: str, by: tuple[str, ...]):
        if len({ch.model for ch in checks}) != 1:
            raise ValueError("a store keeps the checks of one model")
        self.spark, self.checks, self.path, self.by = spark, checks, path.rstrip("/"), by
        text = repr([(ch.kind, ch.column, sorted((k, str(v)) for k, v in ch.args.items())) for ch in checks])
        self.suite = hashlib.sha256(text.encode()).hexdigest()[:16]

    def _read(self) -> DataFrame | None:
        kinds = {c: "INT" for c in self.by}
        try:
            return self.spark.read.schema(", ".join(["suite STRING", "batch BIGINT", "cid INT", "key STRING", "n BIGINT", *(f"{c} {t}" for c, t in kinds.items())])).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _sums(self, df: DataFrame) -> DataFrame | None:
        """(partition, cid, key, n) of the checks that sum rows: one row per partition is
        aggregated, then unfolded."""
        sums = {i: F.count(F.lit(1)) if ch.kind == "row_count" else F.sum(Q._row_indicator(ch)) for i, ch in enumerate(self.checks) if ch.kind in SUMMED}
        if not sums:
            return None
        total = df.groupBy(*self.by).agg(*[n.cast("bigint").alias(f"n{i}") for i, n in sums.items()])
        each = F.array(*[F.struct(F.lit(i).alias("cid"), F.lit(None).cast("string").alias("key"), F.col(f"n{i}").alias("n")) for i in sums])
        return total.select(*self.by, F.explode(each).alias("e")).select(*self.by, "e.*").where("n > 0")

    def _keyed(self, df: DataFrame, models: Mapping[str, DataFrame]) -> DataFrame | None:
        """(partition, cid, key, n) of the checks by key: a grouping set each. A row brings
        a check a struct of its key, or null where it brings nothing."""
        keys = {}
        for i, ch in enumerate(self.checks):
            c = F.col(ch.column) if ch.column else None
            if ch.kind in SUMMED:
                continue
            if ch.kind == "accepted_values":
                when, key = ~c.isin(ch.args["values"]), c
            elif ch.kind == "unique":
                when, key = c.isNotNull(), c
            elif ch.kind == "relationships":
                form, _ = Q._norm_keys(df.schema[ch.column].dataType, models[ch.args["to"]].schema[ch.args["field"]].dataType)
                when, key = c.isNotNull(), form(c)
            else:
                raise ValueError(f"unknown check kind {ch.kind}")
            keys[i] = F.when(when, F.struct(key.cast("string").alias("key")))
        if not keys:
            return None
        rows = df.select(*self.by, *[k.alias(f"k{i}") for i, k in keys.items()])
        by, names = [F.col(c) for c in self.by], [f"k{i}" for i in keys]
        counts = rows.groupingSets([[*by, F.col(k)] for k in names], *by, *[F.col(k) for k in names]).agg(F.count(F.lit(1)).alias("n"))
        entry = F.coalesce(*[F.when(F.col(f"k{i}").isNotNull(), F.struct(F.lit(i).alias("cid"), F.col(f"k{i}.key").alias("key"))) for i in keys])
        return counts.select(*self.by, entry.alias("e"), "n").where("e is not null").select(*self.by, "e.*", "n")

    def refresh(self, batch: int, df: DataFrame, models: Mapping[str, DataFrame], partitions: Iterable[tuple]) -> list[tuple]:
        """Bring ``partitions`` up to the state in which ``batch`` left the model;
        a partition that this batch or a later one has already been through is left
        alone. Returns the partitions that were read."""
        todo, stored = list(dict.fromkeys(tuple(p) for p in partitions)), self._read()
        if stored is not None and todo:
            marks = stored.where((F.col("cid") == TOUCHED) & in_partitions(self.by, todo)).collect()  # a row a partition asked for
            if any(m["suite"] != self.suite for m in marks):
                raise ValueError("the store holds other checks; give the suite a folder of its own")
            done = {tuple(m[c] for c in self.by): m["batch"] for m in marks}
            todo = [p for p in todo if done.get(p, batch - 1) < batch]
        if not todo:
            return []
        rows = df.where(in_partitions(self.by, todo)).withColumns({c: F.col(c).cast("int") for c in self.by})
        parts = [p for p in (self._sums(rows), self._keyed(rows, models)) if p is not None]
        marks = self.spark.createDataFrame([(*p, TOUCHED, None, 0) for p in todo], ", ".join([*(f"{c} INT" for c in self.by), "cid INT, key STRING, n BIGINT"]))
        for p in parts:
            marks = marks.unionByName(p)
        out = marks.select(F.lit(self.suite).alias("suite"), F.lit(batch).cast("bigint").alias("batch"), "cid", "key", "n", *self.by)
        (out.hint("rebalance", *self.by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.by).parquet(self.path))
        return todo

    def report(self, model: DataFrame, models: Mapping[str, DataFrame]) -> DataFrame:
        """One row per check, as ``quality.run_suite`` gives on the whole model. Of
        ``model`` only the schema is looked at."""
        stored = self._read()
        if stored is None:
            raise ValueError("the store was never refreshed")
        total = stored.where(F.col("cid") != TOUCHED).groupBy("cid", "key").agg(F.sum("n").alias("n"))
        linked = [(i, ch) for i, ch in enumerate(self.checks) if ch.kind == "relationships"]
        if linked:
            parents = None
            for i, ch in linked:
                parent = models[ch.args["to"]]
                _, form = Q._norm_keys(model.schema[ch.column].dataType, parent.schema[ch.args["field"]].dataType)
                keys = parent.select(F.lit(i).alias("cid"), form(F.col(ch.args["field"])).alias("key"))
                parents = keys if parents is None else parents.unionByName(keys)
            parents = parents.distinct()
            literal = all(is_literal(models[ch.args["to"]]) for _, ch in linked)
            total = total.join(F.broadcast(parents) if literal else dimension(parents), ["cid", "key"], "left_anti")
        aggs = []
        for i, ch in enumerate(self.checks):
            mine = F.col("cid") == i
            if ch.kind == "row_count":
                failures = F.when(F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0)) == 0, F.lit(1)).otherwise(F.lit(0))
            elif ch.kind == "accepted_values":
                failures = F.count_if(mine)
            elif ch.kind == "unique":
                failures = F.count_if(mine & (F.col("n") > 1))
            else:
                failures = F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0))
            aggs.append(failures.cast("bigint").alias(f"f{i}"))
        rows = Q._rows_from_counts(total.agg(*aggs), self.checks)
        return rows.withColumn("status", Q._status(F.col("failures"), F.col("severity")))
