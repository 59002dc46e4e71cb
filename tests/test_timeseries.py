"""Revenue patterns vs brute force on hand-made rows with one hot customer."""

import datetime as dt
from collections import defaultdict
from decimal import Decimal

from meterline.operators import timeseries as T


def orders(spark):
    rows, oid = [], 0
    d0 = dt.date(2024, 1, 1)
    for day in range(120):
        for _ in range(30):                    # hot customer: a third of all orders or more
            rows.append((oid, 1, d0 + dt.timedelta(days=day), Decimal("10.50"))); oid += 1
        for c in range(2, 2 + day % 7):
            rows.append((oid, c, d0 + dt.timedelta(days=day + c), Decimal("3.25"))); oid += 1
    rows.append((oid, None, d0, Decimal("1.00")))
    return rows, spark.createDataFrame(rows, "order_id long, customer_id long, order_date date, revenue decimal(12,2)")


def test_cohort_revenue_brute_force(spark):
    rows, df = orders(spark)
    first = {}
    for _, c, d, _ in rows:
        if c is not None:
            first[c] = min(first.get(c, d), d)
    want = defaultdict(lambda: [set(), Decimal(0)])
    for _, c, d, rev in rows:
        if c is None:
            continue
        k = (first[c], (d.year - first[c].year) * 12 + d.month - first[c].month)
        want[k][0].add(c); want[k][1] += rev
    got = {(r.cohort_date, r.months_since_first): (r.active_customers, r.cohort_revenue)
           for r in T.cohort_revenue(df).collect()}
    assert got == {k: (len(v[0]), v[1]) for k, v in want.items()}


def test_daily_revenue_brute_force(spark):
    rows, df = orders(spark)
    cust = spark.createDataFrame([(c, f"S{c % 3}", f"R{c % 2}") for c in range(1, 8)],
                                 "customer_id long, customer_segment string, customer_region string")
    seg = {c: (f"S{c % 3}", f"R{c % 2}") for c in range(1, 8)}
    want = defaultdict(lambda: [Decimal(0), set(), 0])
    for _, c, d, rev in rows:
        k = (d,) + (seg.get(c, (None, None)))
        want[k][0] += rev; want[k][2] += 1
        if c is not None:
            want[k][1].add(c)
    got = {(r.order_date, r.customer_segment, r.customer_region): (r.daily_revenue, r.unique_customers, r.order_count)
           for r in T.daily_revenue(df.withColumnRenamed("revenue", "order_amount"), cust).collect()}
    assert got == {k: (v[0], len(v[1]), v[2]) for k, v in want.items()}


def test_rolling_revenue_brute_force(spark):
    rows, df = orders(spark)
    daily = defaultdict(Decimal)
    for _, _, d, rev in rows:
        daily[d] += rev
    days = sorted(daily)
    got = {r.order_date: (r.revenue_7day_avg, r.revenue_30day_avg)
           for r in T.rolling_revenue(df, amount="revenue").collect()}
    for i, d in enumerate(days):
        w7 = [daily[x] for x in days[max(0, i - 6):i + 1]]
        w30 = [daily[x] for x in days[max(0, i - 29):i + 1]]
        assert abs(got[d][0] - float(sum(w7)) / len(w7)) < 1e-4
        assert abs(got[d][1] - float(sum(w30)) / len(w30)) < 1e-4


def test_rolling_revenue_partitioned_brute_force(spark):
    rows, df = orders(spark)
    df = df.withColumn("region", (df.customer_id % 2).cast("string"))
    daily = defaultdict(Decimal)
    for _, c, d, rev in rows:
        daily[(None if c is None else str(c % 2), d)] += rev
    got = {(r.region, r.order_date): r.revenue_7day_avg
           for r in T.rolling_revenue(df, amount="revenue", partition_by=["region"], windows=(7,)).collect()}
    for region in {k[0] for k in daily}:
        days = sorted(d for g, d in daily if g == region)
        for i, d in enumerate(days):
            w = [daily[(region, x)] for x in days[max(0, i - 6):i + 1]]
            assert abs(got[(region, d)] - float(sum(w)) / len(w)) < 1e-4
