"""Which rollups to keep: exact row counts of the lattice of dimension subsets that
a workload of cube queries spans, and a greedy choice by benefit.

The lattice has a node for what each query needs (dimensions, filters' members,
time grain) and for every union of such needs: a smaller rollup than a union's
answers less. All nodes are counted by one Spark job over the distinct rows of
the largest one (grouping sets); only the counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.plans.cubes import GRANULARITIES, Cube, CubeQuery, CubeSet, PreAggregation
from meterline.plans.rollups import COARSER, can_serve

MAX_NODES = 4096
RANGE_GRAIN = "day"  # of a query that only cuts a date range
ADDITIVE = ("count", "sum", "avg", "min", "max")

Node = tuple[tuple[str, ...], str | None]  # dimensions in order of name, grain


@dataclass(frozen=True)
class Advice:
    """A rollup worth keeping: its rows, and the weighted rows that the workload
    no longer reads once it stands beside those chosen before."""
    rollup: PreAggregation
    rows: int
    benefit: float


def common_grain(a: str | None, b: str | None) -> str | None:
    """The coarsest grain from which both can be answered."""
    if a is None or b is None:
        return a or b
    return next(g for g in reversed(GRANULARITIES) if {a, b} <= COARSER.get(g, set()))


def need(cube: Cube, q: CubeQuery) -> Node | None:
    """What a rollup must hold to answer ``q``; None where no rollup can: members
    of other cubes, measures that do not add up, two time dimensions, a grain
    below the hour."""
    pre = f"{cube.name}."
    times = {td.member for td in q.time_dimensions}
    named = [*q.measures, *q.dimensions, *(f.member for f in q.filters), *times]
    grains = [td.granularity or RANGE_GRAIN for td in q.time_dimensions]
    if len(times) > 1 or not all(m.startswith(pre) for m in named) or not all(g in COARSER["hour"] for g in grains):
        return None
    if not all(cube.measure(m[len(pre):]).type in ADDITIVE for m in q.measures):
        return None
    grain = None
    for g in grains:
        grain = common_grain(grain, g)
    return tuple(sorted({m[len(pre):] for m in (*q.dimensions, *(f.member for f in q.filters))})), grain


def lattice(cube: Cube, queries: Sequence[CubeQuery]) -> list[Node]:
    """The needs of the queries and all unions of them, smallest first."""
    needs = {n for n in (need(cube, q) for q in queries) if n is not None}
    nodes: set[Node] = set()
    for dims, grain in sorted(needs, key=str):
        nodes |= {(tuple(sorted({*dims, *d})), common_grain(grain, g)) for d, g in nodes} | {(dims, grain)}
        if len(nodes) > MAX_NODES:
            raise ValueError(f"the workload spans more than {MAX_NODES} rollups; advise on parts of it")
    return sorted(nodes, key=lambda n: (len(n[0]), str(n)))


def _time_member(cube: Cube, queries: Sequence[CubeQuery]) -> str | None:
    """The one time dimension that the workload's rollups keep."""
    found = {td.member.split(".", 1)[1] for q in queries if need(cube, q) is not None for td in q.time_dimensions}
    if len(found) > 1:
        raise ValueError("advise on one time dimension at a time")
    return next(iter(found), None)


def lattice_rows(cubes: CubeSet, cube_name: str, queries: Sequence[CubeQuery], tables: Mapping[str, DataFrame]) -> DataFrame:
    """(dimensions, granularity, n_rows) of every node: the exact number of rows
    that its rollup would have. Null values are values; an empty table gives 0
    rows, and the rollup without dimensions has one row otherwise."""
    cube, nodes = cubes[cube_name], lattice(cubes[cube_name], queries)
    spark = tables[cube.table].sparkSession
    schema = "dimensions ARRAY<STRING>, granularity STRING, mask BIGINT"
    dims, grains = sorted({d for ds, _ in nodes for d in ds}), sorted({g for _, g in nodes if g})
    used = [q for q in queries if need(cube, q) is not None]
    if not nodes:
        return spark.createDataFrame([], schema).select("dimensions", "granularity", F.lit(0).cast("long").alias("n_rows"))
    _, df = cubes.source(CubeQuery(measures=used[0].measures, dimensions=tuple(f"{cube.name}.{d}" for d in dims)), tables)
    columns = [F.col(cube.dimension(d).sql).alias(f"d_{d}") for d in dims]
    if grains:
        at = F.col(cube.dimension(_time_member(cube, queries)).sql).cast("timestamp_ntz")
        columns += [F.date_trunc(g, at).alias(f"t_{g}") for g in grains]
    names = [*(f"d_{d}" for d in dims), *(f"t_{g}" for g in grains), "one"]
    finest = df.select(*columns, F.lit(1).alias("one")).distinct()  # ``one`` gives the node without columns a column
    sets = [[*(f"d_{d}" for d in ds), *([f"t_{g}"] if g else []), "one"] for ds, g in nodes]
    counted = (finest.groupingSets([[F.col(c) for c in s] for s in sets], *names).agg(F.grouping_id().alias("mask"))
               .groupBy("mask").agg(F.count(F.lit(1)).alias("n_rows")))
    masks = [sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in s) for s in sets]
    listed = spark.createDataFrame([(list(ds), g, m) for (ds, g), m in zip(nodes, masks, strict=True)], schema)
    all_nodes = counted.unionByName(listed.select("mask", F.lit(0).cast("long").alias("n_rows"))).groupBy("mask").agg(F.sum("n_rows").alias("n_rows"))
    return all_nodes.join(F.broadcast(listed), "mask").select("dimensions", "granularity", "n_rows")  # at most MAX_NODES rows


def advise(cubes: CubeSet, cube_name: str, queries: Sequence[CubeQuery], tables: Mapping[str, DataFrame], k: int,
           weights: Sequence[float] | None = None) -> list[Advice]:
    """At most ``k`` rollups, in the order of choice. A query costs the rows of the
    smallest chosen rollup that answers it, or those of the fact; each step takes
    the rollup that saves most weighted rows (ties: fewer rows, then by name),
    and none that saves nothing. Each rollup keeps all additive measures of the
    workload. ``weights`` are the queries' frequencies (1 each if not given)."""
    cube = cubes[cube_name]
    weights = [1.0] * len(queries) if weights is None else list(weights)
    if len(weights) != len(queries):
        raise ValueError("one weight a query")
    usable = [(q, w) for q, w in zip(queries, weights, strict=True) if need(cube, q) is not None]
    measures = tuple(dict.fromkeys(m.split(".", 1)[1] for q, _ in usable for m in q.measures))
    time = _time_member(cube, queries)
    offers = []
    for r in lattice_rows(cubes, cube_name, queries, tables).collect():  # one row a node
        name = "_".join(["advised", *r.dimensions, *([r.granularity] if r.granularity else [])])
        offers.append((PreAggregation(name, measures, tuple(r.dimensions), time if r.granularity else None, r.granularity), r.n_rows))
    cost = [float(tables[cube.table].count())] * len(usable)
    serves = [[can_serve(cube, pa, q) for q, _ in usable] for pa, _ in offers]
    chosen: list[Advice] = []
    while len(chosen) < k and offers:
        gains = [sum(w * max(0.0, c - rows) for (_, w), c, can in zip(usable, cost, serves[i], strict=True) if can)
                 for i, (_, rows) in enumerate(offers)]
        best = min(range(len(offers)), key=lambda i: (-gains[i], offers[i][1], offers[i][0].name))
        if gains[best] <= 0:
            break
        pa, rows = offers[best]
        chosen.append(Advice(pa, rows, gains[best]))
        cost = [min(c, rows) if can else c for c, can in zip(cost, serves[best], strict=True)]
    return chosen


def with_rollups(cube: Cube, advice: Sequence[Advice]) -> Cube:
    """The cube with the advised rollups beside its own, for a ``CubeSet`` whose
    ``RollupStore`` builds and routes to them."""
    return replace(cube, pre_aggregations=(*cube.pre_aggregations, *(a.rollup for a in advice)))
