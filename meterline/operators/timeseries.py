"""Revenue patterns: daily revenue by segment, cohorts, rolling averages.

Skew: a single customer may own a large share of orders. Every plan here
first aggregates orders per (customer, day) or (customer, month) with
map-side partial aggregation, so a hot customer shrinks to a handful of
rows per partition before any shuffle join or window keyed by customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.columns import month_boundaries, round_to
from meterline.defaults import BROADCAST_MAX_ROWS
from meterline.functions.joins import dimension


def daily_revenue(orders: DataFrame, customers: DataFrame, amount: str = "order_amount",
                  broadcast_rows: int | None = BROADCAST_MAX_ROWS) -> DataFrame:
    """Revenue, distinct customers and orders by date x segment x region
    (orders left-joined to customers). The customer dimension is broadcast
    when a bounded count proves it small; otherwise it is a shuffle join of
    the pre-aggregated (date, customer) rows."""
    per_cust_day = orders.groupBy("order_date", "customer_id").agg(
        F.sum(amount).alias("rev"), F.count("order_id").alias("n"))
    cust = customers.select("customer_id", "customer_segment", "customer_region")
    cust = dimension(cust, broadcast_rows) if broadcast_rows else cust
    j = per_cust_day.join(cust, "customer_id", "left")
    return j.groupBy("order_date", "customer_segment", "customer_region").agg(
        F.sum("rev").alias("daily_revenue"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.sum("n").alias("order_count"))


def cohort_revenue(orders: DataFrame, amount: str = "revenue") -> DataFrame:
    """Cohorts by first order date: months since first order, active
    customers and revenue.

    Orders are reduced to one row per (customer, month) first; the first
    date per customer is a window over those few rows. Within a cohort and
    month offset each customer occurs once, so ``count`` is the distinct count."""
    monthly = (orders.where(F.col("customer_id").isNotNull())
                     .groupBy("customer_id", F.trunc("order_date", "month").alias("order_month"))
                     .agg(F.sum(amount).alias("rev"), F.min("order_date").alias("first_in_month")))
    w = Window.partitionBy("customer_id")
    with_cohort = monthly.withColumn("cohort_date", F.min("first_in_month").over(w))
    return (with_cohort
            .withColumn("months_since_first", month_boundaries("cohort_date", "order_month"))
            .groupBy("cohort_date", "months_since_first")
            .agg(F.count("customer_id").alias("active_customers"),
                 F.sum("rev").alias("cohort_revenue")))


def rolling_revenue(orders: DataFrame, amount: str = "order_amount", date_col: str = "order_date",
                    windows: tuple[int, ...] = (7, 30), partition_by: list[str] | None = None,
                    digits: int = 4) -> DataFrame:
    """Daily revenue with trailing averages over the last N daily rows.

    The window runs on one row per day (per partition key), so even without
    ``partition_by`` the single ordered partition stays calendar-sized."""
    keys = list(partition_by or [])
    daily = orders.groupBy(*keys, date_col).agg(F.sum(amount).alias("daily_revenue"))
    w = Window.partitionBy(*keys).orderBy(date_col) if keys else Window.orderBy(date_col)
    cols = [F.col(c) for c in keys] + [F.col(date_col), F.col("daily_revenue")]
    for n in windows:
        frame = w.rowsBetween(-(n - 1), 0)
        # exact decimal frame sum, then one division: same value on any engine
        avg = F.sum("daily_revenue").over(frame).cast("double") / F.count("daily_revenue").over(frame)
        cols.append(round_to(avg, digits).alias(f"revenue_{n}day_avg"))
    return daily.select(*cols)
