"""Every registered query: no Python evaluation, no sort-merge join (all
lookups are checked broadcasts), a stable schema across calls."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from meterline.plans.registry import QUERIES
from tests.conftest import SF001

NAMES = sorted(QUERIES)


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue().split("\n\n")[0]


@pytest.mark.parametrize("name", NAMES)
def test_plan_and_schema(spark, name):
    q = E.queries()[name]
    a, b = q(spark, SF001), q(spark, SF001)
    assert a.schema == b.schema
    tree = formatted(a)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "SortMergeJoin",
                "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in tree, f"{name}: {bad}"
