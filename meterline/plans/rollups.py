"""Pre-aggregations (rollups): build, store, and answer coarser queries from them.

A rollup keeps every measure in additive parts (``count`` -> count, ``sum``
-> sum, ``avg`` -> sum + non-null count, ``min``/``max`` as is; sums are
decimals when the cube set is exact, so re-aggregation is exact), so any query
whose dimensions are a subset of the rollup's, at the same or a coarser
time grain, is answered by re-aggregating the (small) rollup instead of
the fact. A date range is cut into the whole periods of the rollup inside it
and two ragged edges, whose parts come from the fact; the parts of both are merged
once. ``refresh_every`` stays metadata: scheduling is external.

``PartitionedRollup`` keeps a rollup's parts by the fact's partitions, so that a
load refreshes only those that it touched.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from typing import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.columns import beyond_exact, exact_total

from meterline.plans.cubes import (
    DATE_ONLY, GRANULARITIES, Cube, CubeQuery, CubeSet, Measure, PreAggregation, TimeDimension, filter_expr, out_name,
)

COARSER = {"day": {"day", "week", "month", "quarter", "year"},
           "hour": {"hour", "day", "week", "month", "quarter", "year"},
           "month": {"month", "quarter", "year"}, "week": {"week"},
           "quarter": {"quarter", "year"}, "year": {"year"}}


def _parts(m: Measure, col: Column | None, scale: int | None) -> list[tuple[str, Column]]:
    scale = scale if m.scale is None else m.scale

    def total(c):
        """The exact decimal total, and for values beyond it the plain one."""
        if scale is None:
            return [("sum", F.sum(c))]
        odd = beyond_exact(c, scale)
        return [("sum", exact_total(F.when(~odd, c), scale)), ("plain", F.sum(F.when(odd, c)))]
    if m.type == "count":
        return [("count", F.count(F.lit(1)) if col is None else F.count(col))]
    if m.type == "sum":
        return total(col)
    if m.type == "avg":
        return [*total(col), ("count", F.count(col))]
    if m.type in ("min", "max"):
        return [(m.type, getattr(F, m.type)(col))]
    raise ValueError(f"measure type {m.type} cannot be rolled up")


def _part_col(member: str, part: str) -> str:
    return f"{out_name(member)}__{part}"


def _base_query(cube: Cube, pa: PreAggregation) -> CubeQuery:
    tds = ()
    if pa.time_dimension:
        tds = (TimeDimension(f"{cube.name}.{pa.time_dimension}", pa.granularity),)
    return CubeQuery(measures=tuple(f"{cube.name}.{m}" for m in pa.measures),
                     dimensions=tuple(f"{cube.name}.{d}" for d in pa.dimensions), time_dimensions=tds)


def pre_aggregation(cube: Cube, name: str) -> PreAggregation:
    return next(p for p in cube.pre_aggregations if p.name == name)


def build_rollup(cubes: CubeSet, cube_name: str, pa_name: str, tables: Mapping[str, DataFrame],
                 extra: tuple[str, ...] = ()) -> DataFrame:
    """The rollup table: one row per dimension combination (and per value of the
    ``extra`` columns of the cube's table), additive measure parts."""
    cube = cubes[cube_name]
    pa = pre_aggregation(cube, pa_name)
    q = _base_query(cube, pa)
    _, df = cubes.source(q, tables)
    group = [F.col(cube.dimension(d).sql).alias(out_name(f"{cube.name}.{d}")) for d in pa.dimensions]
    if pa.time_dimension:
        ts = F.col(cube.dimension(pa.time_dimension).sql).cast("timestamp_ntz")
        group.append(F.date_trunc(pa.granularity, ts).cast("timestamp_ntz")
                     .alias(out_name(f"{cube.name}.{pa.time_dimension}", pa.granularity)))
    aggs = []
    for mname in pa.measures:
        m = cube.measure(mname)
        col = None if m.sql is None else F.col(m.sql)
        aggs += [c.alias(_part_col(f"{cube.name}.{mname}", p)) for p, c in _parts(m, col, cubes.exact_scale)]
    return df.groupBy(*group, *extra).agg(*aggs)


_MERGE = {"count": F.sum, "sum": F.sum, "plain": F.sum, "min": F.min, "max": F.max}


def merge_parts(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of one key merged into one: every other column is a measure part."""
    found = [c for c in parts.columns if c not in keys]
    kinds = {f.name: f.dataType for f in parts.schema.fields}
    return parts.groupBy(*keys).agg(*[_MERGE[c.rsplit("__", 1)[1]](c).cast(kinds[c]).alias(c) for c in found])


def _final(m: Measure, member: str, reagg: bool, scale: int | None) -> Column:
    def part(p):
        c = F.col(_part_col(member, p))
        if not reagg:
            return c
        return _MERGE[p](c)

    def total():
        exact = part("sum").cast("double")
        if (scale if m.scale is None else m.scale) is None:
            return exact
        return F.when(part("plain").isNotNull(), F.coalesce(exact, F.lit(0.0)) + part("plain")).otherwise(exact)
    if m.type == "count":
        return F.coalesce(part("count"), F.lit(0)).cast("bigint")  # no rollup row: nothing was counted
    if m.type == "sum":
        return total()
    if m.type == "avg":
        n = part("count")
        return F.when(n > 0, total() / n)
    return part(m.type)


def finalize(rollup: DataFrame, cubes: CubeSet, cube_name: str, pa_name: str) -> DataFrame:
    """Rollup rows with the measures' final values (averages divided out)."""
    cube = cubes[cube_name]
    pa = pre_aggregation(cube, pa_name)
    dims = [out_name(f"{cube.name}.{d}") for d in pa.dimensions]
    if pa.time_dimension:
        dims.append(out_name(f"{cube.name}.{pa.time_dimension}", pa.granularity))
    return rollup.select(*dims, *[_final(cube.measure(m), f"{cube.name}.{m}", False, cubes.exact_scale).alias(out_name(f"{cube.name}.{m}"))
                                  for m in pa.measures])


def can_serve(cube: Cube, pa: PreAggregation, q: CubeQuery) -> bool:
    pre = f"{cube.name}."
    if not all(m.startswith(pre) and m[len(pre):] in pa.measures for m in q.measures):
        return False
    dims = set(pa.dimensions)
    if not all(d.startswith(pre) and d[len(pre):] in dims for d in q.dimensions):
        return False
    if not all(f.member.startswith(pre) and f.member[len(pre):] in dims for f in q.filters):
        return False
    for td in q.time_dimensions:
        if td.member != f"{pre}{pa.time_dimension}":
            return False
        if td.granularity and td.granularity not in COARSER.get(pa.granularity, set()):
            return False
    return True


MICROSECOND = dt.timedelta(microseconds=1)


def half_open(date_range: tuple[str, str]) -> tuple[dt.datetime, dt.datetime]:
    """A query's inclusive range as [from, to): a bound that is a date alone
    stands for the whole day."""
    lo, hi = (dt.datetime.fromisoformat(str(x)) for x in date_range)
    return lo, hi + (dt.timedelta(days=1) if DATE_ONLY.fullmatch(str(date_range[1])) else MICROSECOND)


def period_start(at: dt.datetime, granularity: str) -> dt.datetime:
    """The first instant of the period that holds ``at`` (weeks begin on Monday)."""
    at = at.replace(microsecond=0)
    zero = {"second": {}, "minute": {"second": 0}, "hour": {"minute": 0, "second": 0}}
    if granularity in zero:
        return at.replace(**zero[granularity])
    day = at.replace(hour=0, minute=0, second=0)
    if granularity == "week":
        return day - dt.timedelta(days=day.weekday())
    month = {"day": None, "month": day.month, "quarter": day.month - (day.month - 1) % 3, "year": 1}[granularity]
    return day if month is None else day.replace(month=month, day=1)


def next_period(at: dt.datetime, granularity: str) -> dt.datetime:
    """The start of the period after the one that holds ``at``."""
    start = period_start(at, granularity)
    step = {"second": dt.timedelta(seconds=1), "minute": dt.timedelta(minutes=1), "hour": dt.timedelta(hours=1), "day": dt.timedelta(days=1),
            "week": dt.timedelta(days=7), "month": dt.timedelta(days=31), "quarter": dt.timedelta(days=92), "year": dt.timedelta(days=366)}
    return period_start(start + step[granularity], granularity)


Span = tuple[dt.datetime, dt.datetime]


def split_range(lo: dt.datetime, hi: dt.datetime, granularity: str) -> tuple[Span | None, list[Span]]:
    """[lo, hi) as the whole periods in it (None if there are none) and what is
    left at either end."""
    start = lo if period_start(lo, granularity) == lo else next_period(lo, granularity)
    end = period_start(hi, granularity)
    if start >= end:
        return None, [(lo, hi)] if lo < hi else []
    return (start, end), [span for span in ((lo, start), (end, hi)) if span[0] < span[1]]


def _during(ts: Column, spans: list[Span]) -> Column:
    out = F.lit(False)
    for lo, hi in spans:
        out = out | ((ts >= F.lit(lo.isoformat(" ")).cast("timestamp_ntz")) & (ts < F.lit(hi.isoformat(" ")).cast("timestamp_ntz")))
    return out


class _WithTable(Mapping):
    """``tables`` with one of them replaced; the others stay unbuilt until used."""

    def __init__(self, tables: Mapping[str, DataFrame], name: str, df: DataFrame):
        self.tables, self.name, self.df = tables, name, df

    def __getitem__(self, key: str) -> DataFrame:
        return self.df if key == self.name else self.tables[key]

    def __iter__(self):
        return iter(self.tables)

    def __len__(self) -> int:
        return len(self.tables)


def edge_rows(cube: Cube, column: str, fact: DataFrame, spans: list[Span]) -> DataFrame:
    """The fact's rows in the spans; of a fact partitioned by month only the
    months that the spans touch are opened."""
    df = fact.where(_during(F.col(column).cast("timestamp_ntz"), spans))
    months = dict(cube.month_partitions).get(column)
    if months and set(months) <= set(fact.columns):
        touched = F.lit(False)
        for lo, hi in spans:
            last = hi - MICROSECOND
            month = F.col(months[0]) * 12 + F.col(months[1])
            touched = touched | ((month >= lo.year * 12 + lo.month) & (month <= last.year * 12 + last.month))
        df = df.where(touched)
    return df


def _in_range(rollup: DataFrame, cubes: CubeSet, cube: Cube, pa: PreAggregation, td: TimeDimension,
              tables: Mapping[str, DataFrame] | None) -> DataFrame:
    """Parts of exactly the rows in the range: whole periods from the rollup,
    edges from the fact."""
    whole, edges = split_range(*half_open(td.date_range), pa.granularity)
    kept = rollup.where(_during(F.col(out_name(td.member, pa.granularity)), [whole] if whole else []))
    if not edges:
        return kept
    if tables is None:
        raise ValueError(f"{pa.name} answers whole {pa.granularity}s only; the edges of this range need the tables")
    column = cube.dimension(pa.time_dimension).sql
    rows = edge_rows(cube, column, tables[cube.table], edges)
    return kept.unionByName(build_rollup(cubes, cube.name, pa.name, _WithTable(tables, cube.table, rows)).select(*kept.columns))


def serve(rollup: DataFrame, cubes: CubeSet, cube_name: str, pa_name: str, q: CubeQuery,
          tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Answer ``q`` from the rollup; equals ``cubes.query(q, tables)`` on the base
    table. ``tables`` are needed only for a date range that cuts a period of the
    rollup, and of the base table only the edges are read."""
    cube = cubes[cube_name]
    pa = pre_aggregation(cube, pa_name)
    if not can_serve(cube, pa, q):
        raise ValueError(f"{pa_name} cannot answer this query")
    df = rollup
    ranged = [td for td in q.time_dimensions if td.date_range]
    if len(ranged) > 1:
        raise ValueError("one date range at a time")
    for td in ranged:
        df = _in_range(df, cubes, cube, pa, td, tables)
    for f in q.filters:
        df = df.where(filter_expr(F.col(out_name(f.member)), f))
    group = [F.col(out_name(d)) for d in q.dimensions]
    for td in q.time_dimensions:
        if td.granularity:
            src = F.col(out_name(td.member, pa.granularity))
            group.append(F.date_trunc(td.granularity, src).cast("timestamp_ntz").alias(out_name(td.member, td.granularity)))
    aggs = [_final(cube.measure(m.split(".", 1)[1]), m, True, cubes.exact_scale).alias(out_name(m)) for m in q.measures]
    out = df.groupBy(*group).agg(*aggs) if aggs else df.select(*group).distinct()
    if q.order:
        out = out.orderBy(*[F.col(out_name(m)).desc_nulls_last() if d == "desc" else F.col(out_name(m)).asc_nulls_last()
                            for m, d in q.order])
    if q.limit is not None:
        out = out.limit(q.limit)
    return out


def materialize(spark: SparkSession, rollup: DataFrame, path: str) -> DataFrame:
    """Write the rollup (full refresh) and read it back: the stored table
    answers later queries and cuts the lineage to the fact."""
    rollup.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


assert set(COARSER) <= set(GRANULARITIES)


class PartitionedRollup:
    """A stored rollup whose parts are kept by the partition columns of the fact.

    ``refresh(batch, partitions)`` recomputes the parts of the partitions that a
    load touched and overwrites just them (dynamic partition overwrite). A partition
    remembers the batch that refreshed it last: a batch that comes again,
    or late, changes nothing. Parts of all partitions are merged when the rollup is read, so a rollup
    without a time dimension can be refreshed by month too. Rows that vanish
    from the fact vanish here; a partition left empty keeps no parts."""

    def __init__(self, spark: SparkSession, cubes: CubeSet, cube_name: str, pa_name: str, path: str, partition_by: tuple[str, str]):
        self.spark, self.cubes, self.cube, self.path, self.by = spark, cubes, cubes[cube_name], path.rstrip("/"), partition_by
        self.pa = pre_aggregation(self.cube, pa_name)

    def _read(self, folder: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/{folder}")
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def batches(self) -> dict[tuple, int]:
        """The last batch of every partition (a calendar of months, not data)."""
        done = self._read("batches")
        return {} if done is None else {(r[0], r[1]): r[2] for r in done.groupBy(*self.by).agg(F.max("batch")).collect()}

    def _parts_of(self, tables: Mapping[str, DataFrame], partitions: Iterable[tuple] | None) -> DataFrame:
        fact = tables[self.cube.table]
        if partitions is not None:
            wanted = F.lit(False)
            for values in partitions:
                one = F.lit(True)
                for c, v in zip(self.by, values, strict=True):
                    one = one & (F.col(c).isNull() if v is None else F.col(c) == v)
                wanted = wanted | one
            fact = fact.where(wanted)
        return build_rollup(self.cubes, self.cube.name, self.pa.name, _WithTable(tables, self.cube.table, fact), self.by)

    def refresh(self, batch: int, tables: Mapping[str, DataFrame], partitions: Iterable[tuple]) -> list[tuple]:
        """Bring the parts of ``partitions`` up to the state that ``batch`` left the
        fact in; returns the partitions recomputed."""
        done = self.batches()
        todo = [p for p in dict.fromkeys(tuple(p) for p in partitions) if done.get(p, -1) < batch]
        if not todo:
            return []
        parts = self._parts_of(tables, todo)
        # a marker row per partition: one that is left empty is overwritten as well
        markers = self.spark.createDataFrame([(*p, True) for p in todo], f"{self.by[0]} INT, {self.by[1]} INT, marker BOOLEAN")
        markers = markers.select(*[F.col(c).cast(parts.schema[c].dataType) for c in self.by], "marker")
        out = parts.withColumn("marker", F.lit(False)).unionByName(markers, allowMissingColumns=True)
        (out.coalesce(max(1, len(todo) // 8)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.by).parquet(f"{self.path}/parts"))
        (self.spark.createDataFrame([(*p, batch) for p in todo], f"{self.by[0]} INT, {self.by[1]} INT, batch BIGINT")
             .coalesce(1).write.mode("append").parquet(f"{self.path}/batches"))
        return todo

    def table(self) -> DataFrame:
        """The rollup: what ``build_rollup`` gives on the fact as it was refreshed."""
        parts = self._read("parts")
        if parts is None:
            raise ValueError(f"{self.pa.name} was never refreshed")
        parts = parts.where("not marker").drop("marker", *self.by)
        return merge_parts(parts, [c for c in parts.columns if "__" not in c])


class RollupStore:
    """Materialized rollups, and query routing to them.

    ``query`` answers from the smallest stored rollup that can serve the query
    (same cube, subset of its dimensions and measures, same or coarser time
    grain, filters on its dimensions; written rollups know their rows, others
    come last in the order of building) and falls back to the base tables."""

    def __init__(self, cubes: CubeSet):
        self.cubes = cubes
        self.stored: dict[tuple[str, str], DataFrame] = {}
        self.rows: dict[tuple[str, str], int] = {}

    def build(self, spark: SparkSession, cube_name: str, pa_name: str, tables: Mapping[str, DataFrame],
              path: str | None = None) -> DataFrame:
        """Build a rollup; write it (full refresh) when ``path`` is given."""
        ro = build_rollup(self.cubes, cube_name, pa_name, tables)
        if path:
            ro = materialize(spark, ro, path)
            self.rows[(cube_name, pa_name)] = ro.count()
        self.stored[(cube_name, pa_name)] = ro
        return ro

    def route(self, q: CubeQuery) -> tuple[str, str] | None:
        """The rollup that answers ``q`` with the fewest rows to read."""
        able = [at for at in self.stored if can_serve(self.cubes[at[0]], pre_aggregation(self.cubes[at[0]], at[1]), q)]
        return min(able, key=lambda at: self.rows.get(at, float("inf")), default=None)

    def query(self, q: CubeQuery, tables: Mapping[str, DataFrame]) -> DataFrame:
        hit = self.route(q)
        if hit is None:
            return self.cubes.query(q, tables)
        return serve(self.stored[hit], self.cubes, hit[0], hit[1], q, tables)
