"""Revenue by day, region and product, and what a dashboard sums from it.

Money is added as decimals, so that sums do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money_sum(c: Column) -> Column:
    return F.sum(c.cast("decimal(20,4)"))


def daily_revenue(sales: DataFrame) -> DataFrame:
    """From sales (order_id, customer_id, order_date, product, amount, region)."""
    total = money_sum(F.col("amount"))
    return sales.groupBy(F.to_date("order_date").alias("order_date"), "region", "product").agg(
        total.cast("double").alias("revenue"),
        F.countDistinct("order_id").alias("order_count"),
        F.countDistinct("customer_id").alias("customer_count"),
        (total.cast("double") / F.countDistinct("order_id")).alias("avg_order_value"),
    )


def between(mart: DataFrame, region: str | None, start: str, end: str) -> DataFrame:
    """Rows of a region (all, if none is named) and a closed range of dates."""
    dated = mart.filter(F.col("order_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return dated.filter(F.col("region") == region) if region else dated


def kpis(mart: DataFrame) -> DataFrame:
    """Totals, and the mean of the rows' averages."""
    return mart.agg(money_sum(F.col("revenue")).cast("double").alias("revenue"), F.sum("order_count").alias("orders"), F.sum("customer_count").alias("customers"), F.avg(F.col("avg_order_value").cast("decimal(18,4)")).cast("double").alias("avg_order_value"))


def revenue_by(mart: DataFrame, column: str) -> DataFrame:
    return mart.groupBy(column).agg(money_sum(F.col("revenue")).cast("double").alias("revenue")).orderBy(F.col("revenue").desc(), column)


def new_days(sales: DataFrame, mart: DataFrame) -> DataFrame:
    """The days of the mart that an increment has to build again: from its last day on."""
    # one value, known before the sales are read: no join, and the scan sees the condition
    last = mart.agg(F.coalesce(F.max("order_date"), F.lit("0001-01-01").cast("date"))).scalar()
    return daily_revenue(sales.filter(F.to_date("order_date") >= last))


def customer_bitmaps(sales: DataFrame, number: Column) -> DataFrame:
    """order_date, region, product, bucket, customers: which customers bought, as sets that merge exactly.

    ``number`` is a customer's number, a long. A set holds the numbers of its
    bucket of 32,768 as their distinct places in it: a day's few customers take
    a few bytes, not a whole bitmap.
    """
    held = sales.withColumns({"_number": number.cast("long"), "_day": F.to_date("order_date")}).filter("_number is not null")
    place = F.bitmap_bit_position("_number").cast("short")
    return held.groupBy(F.col("_day").alias("order_date"), "region", "product", F.bitmap_bucket_number("_number").alias("bucket")).agg(F.collect_set(place).alias("customers"))


def distinct_customers(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """by, customers: true distinct customers, from the sets alone."""
    merged = bitmaps.select(*by, "bucket", F.explode("customers").alias("_place")).distinct()
    return merged.groupBy(*by).agg(F.count("*").alias("customers"))


def dashboard(mart: DataFrame) -> DataFrame:
    """region, product, level, revenue, orders, n_rows: all groupings of a dashboard from one aggregate.

    ``level`` is 0 for cells, 1 by region, 2 by product and 3 for the one row of
    totals; a column that a level does not group by is null. An empty mart has no
    rows, not even totals.
    """
    sets = [["region", "product"], ["region"], ["product"], []]
    sums = (money_sum(F.col("revenue")).cast("double").alias("revenue"), F.sum("order_count").alias("orders"), F.count("*").alias("n_rows"))
    grouped = mart.groupingSets([[F.col(c) for c in s] for s in sets], "region", "product")
    return grouped.agg(F.grouping_id().cast("int").alias("level"), *sums).select("region", "product", "level", "revenue", "orders", "n_rows")
