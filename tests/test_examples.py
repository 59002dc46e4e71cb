import meterline as ml
from examples.quickstart import main
from tests.conftest import SF001


def test_quickstart(spark):
    out = main(SF001)
    assert out["fct_rows"] > 0 and out["checks"] == 36 and out["cube_rows"] > 0 and out["routed"]


def test_public_api_names():
    for name in ml.__all__:
        assert getattr(ml, name) is not None
