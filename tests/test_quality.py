import datetime as dt

from pyspark.sql import functions as F

from meterline.operators import quality as Q


def report(spark, models, checks):
    return {r.test_name: r for r in Q.run_suite(models, checks).collect()}


def test_row_checks_fused_and_null_semantics(spark):
    df = spark.createDataFrame([(1, 5.0, "a"), (None, 250.0, "b"), (3, None, "z"), (4, -1.0, None)],
                               "k int, d double, v string")
    checks = [Q.not_null("t", "k"), Q.accepted_range("t", "d", 0, 200),
              Q.accepted_values("t", "v", ["a", "b"]), Q.row_count_positive("t"),
              Q.expression_is_true("t", "d", "d < 100"),
              Q.date_in_past("t", "k", 3)]
    r = report(spark, {"t": df}, checks)
    assert r["not_null__t__k"].failures == 1
    assert r["accepted_range__t__d"].failures == 2          # NULL passes
    assert r["accepted_values__t__v"].failures == 1         # distinct 'z'; NULL passes
    assert r["row_count__t"].failures == 0
    assert r["expression__t__d"].failures == 1              # NULL is not a failure
    assert r["date_past__t__k"].failures == 2


def test_empty_table_fails_row_count(spark):
    df = spark.createDataFrame([], "k int")
    r = report(spark, {"t": df}, [Q.row_count_positive("t")])
    assert r["row_count__t"].failures == 1 and r["row_count__t"].status == "fail"


def test_unique_counts_duplicated_values(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,), (3,), (3,)], "k int")
    assert report(spark, {"t": df}, [Q.unique("t", "k")])["unique__t__k"].failures == 2


def test_relationships_hot_key_and_warn(spark):
    rows = [("1.0",)] * 300 + [("7",)] * 100 + [(None,)] * 5 + [("x",)]
    child = spark.createDataFrame(rows, "k string")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    r = report(spark, {"c": child, "p": parent}, [Q.relationships("c", "k", "p", "pk", "warn")])
    row = r["relationships__c__k__p"]
    assert row.failures == 101 and row.status == "warn"
    orph = {x.k: x.orphan_rows for x in Q.orphans(child, "k", parent, "pk").collect()}
    assert orph == {"7": 100, "x": 1}


def test_reference_suite_has_36_checks(spark):
    checks = Q.reference_suite(today=dt.date(2025, 6, 1))
    assert len(checks) == 36
    kinds = {}
    for c in checks:
        kinds[c.kind] = kinds.get(c.kind, 0) + 1
    assert kinds == {"not_null": 18, "unique": 4, "relationships": 5, "accepted_values": 3,
                     "accepted_range": 2, "row_count": 3, "expression": 1}
    assert len({c.name for c in checks}) == 36


def test_fused_path_on_empty_model(spark):
    child = spark.createDataFrame([], "k string, v double")
    parent = spark.createDataFrame([(1,)], "pk int")
    checks = [Q.row_count_positive("c"), Q.not_null("c", "k"), Q.accepted_range("c", "v", 0, 1),
              Q.relationships("c", "k", "p", "pk")]
    r = report(spark, {"c": child, "p": parent}, checks)
    assert r["row_count__c"].failures == 1 and r["row_count__c"].status == "fail"
    assert r["not_null__c__k"].failures == 0 and r["relationships__c__k__p"].failures == 0


def test_relationships_and_orphans_share_one_key_rule(spark):
    child = spark.createDataFrame([(1.0,), (2.0,), (9.0,), (None,)], "k double")
    parent = spark.createDataFrame([("1",), ("2",)], "id string")
    report = Q.run_suite({"child": child, "parent": parent}, [Q.relationships("child", "k", "parent", "id")]).collect()
    assert report[0]["failures"] == 1
    assert [tuple(r) for r in Q.orphans(child, "k", parent, "id").collect()] == [(9.0, 1)]
