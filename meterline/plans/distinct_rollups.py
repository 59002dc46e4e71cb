"""Rollups of exact distinct counts.

A distinct count is not additive, a set is. The values are numbered densely once
(a dictionary), and a rollup keeps, for each combination of dimensions and period, the set of numbers
as bitmaps of 32,768 bits. Coarser queries unite bitmaps (bitwise or) and count
bits, so one daily rollup answers days, months and years, and any subset
of its dimensions, exactly.

The fact is read twice, with partial aggregation before every shuffle; a value that
has a third of all rows is one row per combination by the time it meets the
dictionary. Merging shuffles bitmaps, at most one per combination and bucket."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.plans.cubes import CubeQuery, CubeSet, filter_expr, out_name
from meterline.plans.rollups import can_serve, pre_aggregation
from meterline.session import scratch_path

_PLACE_BITS = 33  # monotonically_increasing_id: partition << 33 | place in it


def numbered_values(values: DataFrame, path: str) -> DataFrame:
    """(value, id): the distinct non-null values numbered 1, 2, 3 ... without gaps,
    written at ``path``. Every partition numbers its own values; the counts
    of the partitions before it (one row each) shift them."""
    spark, (name,) = values.sparkSession, values.columns
    placed = values.where(F.col(name).isNotNull()).distinct().withColumn("at", F.monotonically_increasing_id())
    placed.write.mode("overwrite").parquet(f"{path}/placed")
    placed = spark.read.parquet(f"{path}/placed")
    part = F.shiftright("at", _PLACE_BITS)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")).select(
        "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1 - F.col("first")).alias("shift"))
    out = placed.join(F.broadcast(shift), part == F.col("part")).select(F.col(name).alias("value"), (F.col("at") + F.col("shift")).alias("id"))
    out.write.mode("overwrite").parquet(f"{path}/ids")
    return spark.read.parquet(f"{path}/ids")


class DistinctRollup:
    """A pre-aggregation whose measures are all ``count_distinct``."""

    def __init__(self, cubes: CubeSet, cube_name: str, pa_name: str):
        self.cubes, self.cube = cubes, cubes[cube_name]
        self.pa = pre_aggregation(self.cube, pa_name)
        self.stored: dict[str, DataFrame] = {}
        if any(self.cube.measure(m).type != "count_distinct" for m in self.pa.measures):
            raise ValueError(f"{pa_name}: distinct rollups hold distinct counts only")

    def _groups(self) -> list[tuple[str, Column]]:
        """(output name, expression) of the stored dimensions and the period."""
        out = [(out_name(f"{self.cube.name}.{d}"), F.col(self.cube.dimension(d).sql)) for d in self.pa.dimensions]
        if self.pa.time_dimension:
            ts = F.col(self.cube.dimension(self.pa.time_dimension).sql).cast("timestamp_ntz")
            out.append((out_name(f"{self.cube.name}.{self.pa.time_dimension}", self.pa.granularity), F.date_trunc(self.pa.granularity, ts).cast("timestamp_ntz")))
        return out

    def build(self, spark: SparkSession, tables: Mapping[str, DataFrame], path: str | None = None) -> None:
        """Write the bitmaps of every measure below ``path``."""
        path = path or scratch_path(spark, "distinct_rollup")
        fact, groups = tables[self.cube.table], self._groups()
        names = [n for n, _ in groups]
        for measure in self.pa.measures:
            value = F.col(self.cube.measure(measure).sql)
            ids = numbered_values(fact.select(value.alias("value")), f"{path}/{measure}")
            rows = fact.select(*[c.alias(n) for n, c in groups], value.alias("__value")).distinct()
            # combinations without any value keep a row, so that they are counted as 0
            sets = rows.join(ids, F.col("__value") == F.col("value"), "left").groupBy(*names, F.bitmap_bucket_number("id").alias("__bucket")).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("__bits"))
            sets.write.mode("overwrite").parquet(f"{path}/{measure}/sets")
            self.stored[measure] = spark.read.parquet(f"{path}/{measure}/sets")

    def serve(self, q: CubeQuery) -> DataFrame:
        """Answer ``q`` (whole periods); equals the query on the base table."""
        if not can_serve(self.cube, self.pa, q) or any(td.date_range for td in q.time_dimensions):
            raise ValueError(f"{self.pa.name} cannot answer this query")
        group = [F.col(out_name(d)) for d in q.dimensions]
        for td in q.time_dimensions:
            if td.granularity:
                stored = F.col(out_name(td.member, self.pa.granularity))
                group.append(F.date_trunc(td.granularity, stored).cast("timestamp_ntz").alias(out_name(td.member, td.granularity)))
        names = [out_name(d) for d in q.dimensions] + [out_name(t.member, t.granularity) for t in q.time_dimensions if t.granularity]
        out = None
        for member in q.measures:
            sets = self.stored[member.split(".", 1)[1]]
            for f in q.filters:
                sets = sets.where(filter_expr(F.col(out_name(f.member)), f))
            united = sets.groupBy(*group, "__bucket").agg(F.bitmap_or_agg("__bits").alias("__bits"))
            # the null bucket stands for rows without a value
            count = F.coalesce(F.sum(F.when(F.col("__bucket").isNotNull(), F.bitmap_count("__bits"))), F.lit(0)).cast("bigint")
            counts = united.groupBy(*names).agg(count.alias(out_name(member)))
            if out is None:
                out = counts
            else:
                counts = counts.withColumnsRenamed({n: f"__right_{n}" for n in names})
                same = F.lit(True)
                for n in names:
                    same = same & F.col(n).eqNullSafe(F.col(f"__right_{n}"))
                out = out.join(counts, same).select(*out.columns, out_name(member))
        if q.order:
            out = out.orderBy(*[F.col(out_name(m)).desc_nulls_last() if d == "desc" else F.col(out_name(m)).asc_nulls_last() for m, d in q.order])
        return out if q.limit is None else out.limit(q.limit)
