import itertools

import pytest
from pyspark.sql import functions as F

from meterline.plans import rollups
from meterline.plans.cubes import CubeQuery, CubeSet, Filter, TimeDimension
from meterline.plans.rollup_advisor import advise, common_grain, lattice, lattice_rows, need, with_rollups
from tests.test_rollup_refresh import CUBES, TRIPS, ZONES, rows, trips

AT = "T.at"
WORKLOAD = [CubeQuery(("T.n",), ("T.who",)),
            CubeQuery(("T.fare",), ("T.zone",)),
            CubeQuery(("T.n", "T.mean"), (), (TimeDimension(AT, "month"),)),
            CubeQuery(("T.low",), ("T.who",), (TimeDimension(AT, "day"),)),
            CubeQuery(("T.n",), (), filters=(Filter("T.zone", "equals", ("1",)),)),
            CubeQuery(("T.riders",), ("T.who",)),  # does not add up
            CubeQuery(("T.n",), ("Z.name",))]  # another cube's member
WEIGHTS = [5, 1, 3, 2, 1, 9, 9]


def test_needs_and_grains():
    assert [need(TRIPS, q) for q in WORKLOAD] == [(("who",), None), (("zone",), None), ((), "month"), (("who",), "day"), (("zone",), None), None, None]
    assert common_grain("week", "month") == "day" and common_grain("day", "hour") == "hour" and common_grain(None, "year") == "year"
    assert need(TRIPS, CubeQuery(("T.n",), (), (TimeDimension(AT, "minute"),))) is None
    found = lattice(TRIPS, WORKLOAD)
    assert (("who", "zone"), "day") in found and (("who",), "month") in found and (("zone",), "month") in found and len(found) == len(set(found))


def test_rows_of_every_node_are_those_of_its_rollup(spark):
    df = trips(spark)
    truncated = {g: F.date_trunc(g, "at") for g in ("month", "day")}
    counted = {(tuple(r.dimensions), r.granularity): r.n_rows for r in lattice_rows(CUBES, "T", WORKLOAD, {"trips": df}).collect()}
    assert sorted(counted, key=str) == sorted(lattice(TRIPS, WORKLOAD), key=str)
    for (dims, grain), n in counted.items():
        assert n == df.select(F.lit(1), *dims, *([truncated[grain]] if grain else [])).distinct().count()
    assert {r.n_rows for r in lattice_rows(CUBES, "T", WORKLOAD, {"trips": df.where("false")}).collect()} == {0}
    assert lattice_rows(CUBES, "T", WORKLOAD[5:], {"trips": df}).count() == 0


def test_choice_is_greedy_by_benefit(spark):
    tables = {"trips": trips(spark)}
    counted = [((tuple(r.dimensions), r.granularity), r.n_rows) for r in lattice_rows(CUBES, "T", WORKLOAD, tables).collect()]
    usable = [(need(TRIPS, q), w) for q, w in zip(WORKLOAD, WEIGHTS, strict=True) if need(TRIPS, q)]

    def answers(node, wanted):
        (dims, grain), (d, g) = node, wanted
        return set(d) <= set(dims) and (g is None or (grain is not None and g in rollups.COARSER[grain]))

    def total(picked):
        return sum(w * min([400, *(n for node, n in picked if answers(node, want))]) for want, w in usable)

    got, picked = advise(CUBES, "T", WORKLOAD, tables, 3, WEIGHTS), []
    for a in got:
        best = min(counted, key=lambda c: total([*picked, c]))
        assert total(picked) - total([*picked, best]) == a.benefit
        picked.append(((a.rollup.dimensions, a.rollup.granularity), a.rows))
        assert total(picked) == total([*picked[:-1], best])
    assert total(picked) <= 400 * sum(w for _, w in usable)
    best_pair = min(total(list(p)) for p in itertools.combinations(counted, 3))
    full = total([])
    assert full - total(picked) >= (1 - 1 / 2.718281828) * (full - best_pair)  # the bound of a greedy choice


def test_advised_rollups_answer_the_workload(spark, tmp_dir):
    tables = {"trips": trips(spark)}
    advice = advise(CUBES, "T", WORKLOAD, tables, 10, WEIGHTS)
    cubes = CubeSet([with_rollups(TRIPS, advice), ZONES])
    store = rollups.RollupStore(cubes)
    for a in advice:
        assert store.build(spark, "T", a.rollup.name, tables, path=f"{tmp_dir}/advised/{a.rollup.name}").count() == a.rows
    for q in WORKLOAD[:5]:
        assert store.route(q) is not None and rows(store.query(q, tables)) == rows(CUBES.query(q, tables))
    assert advise(CUBES, "T", WORKLOAD[5:], tables, 3) == []
    assert advise(CUBES, "T", WORKLOAD, {"trips": tables["trips"].where("false")}, 3) == []
    with pytest.raises(ValueError, match="weight"):
        advise(CUBES, "T", WORKLOAD, tables, 1, [1.0])
