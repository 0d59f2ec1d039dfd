"""Parameterized commerce dashboard queries over the landed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions import labels
from tidemill.functions.scalars import days_between, mean, ratio
from tidemill.operators.ranking import Ordering, add_tiles
from tidemill.session import materialize

GRANULARITY = {"daily": "day", "weekly": "week", "monthly": "month"}


def date_range(
    column: str, start: str | None = None, end: str | None = None, end_inclusive_day: bool = False
) -> Column:
    """Inclusive range on a timestamp. A plain end date means its midnight; with
    `end_inclusive_day` the whole end day is kept."""
    keep = F.lit(True)
    if start:
        keep = keep & (F.col(column) >= F.lit(start).cast("timestamp"))
    if end and end_inclusive_day:
        keep = keep & (F.col(column) < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))
    elif end:
        keep = keep & (F.col(column) <= F.lit(end).cast("timestamp"))
    return keep


def _paid(items: DataFrame) -> Column:
    return items["price"] + items["freight_value"]


def _in_range(orders: DataFrame, **when) -> DataFrame:
    return orders.where(date_range("order_purchase_timestamp", **when))


def _delivery_days() -> Column:
    return days_between(F.col("order_delivered_customer_date"), F.col("order_purchase_timestamp"))


def kpis(orders: DataFrame, items: DataFrame, reviews: DataFrame, dedupe: bool = False, **when) -> DataFrame:
    """Headline figures of delivered orders, one row.

    By default an order with several items and reviews counts once per pair, as item and review
    rows are joined before summing. Sums over pairs equal item sums times review counts, so
    the pairs themselves are never produced: both sides are totalled per order first.
    dedupe=True counts each item, order and review once.
    """
    delivered = _in_range(orders.where(F.col("order_status") == "delivered"), **when)
    lines = items.groupBy("order_id").agg(
        F.count("*").alias("lines"), F.sum(items["price"] + items["freight_value"]).alias("paid")
    )
    scores = reviews.groupBy("order_id").agg(
        F.count("*").alias("reviews"), F.count("review_score").alias("scored"), F.sum("review_score").alias("score")
    )
    per_order = delivered.join(lines, "order_id", "left").join(scores, "order_id", "left")
    line_copies = F.lit(1) if dedupe else F.greatest(F.coalesce("reviews", F.lit(0)), F.lit(1))
    review_copies = F.lit(1) if dedupe else F.greatest(F.coalesce("lines", F.lit(0)), F.lit(1))
    order_copies = line_copies * review_copies
    days = _delivery_days()
    revenue = F.coalesce(F.sum(F.col("paid") * line_copies).cast("double"), F.lit(0.0))
    judged = F.col("order_delivered_customer_date").isNotNull() & F.col("order_estimated_delivery_date").isNotNull()
    on_time = F.col("order_delivered_customer_date") <= F.col("order_estimated_delivery_date")
    # The joins keep every delivered order once; customers are made unique before they are counted.
    customers = delivered.groupBy("customer_id").agg(F.lit(1).alias("one")).agg(F.count("customer_id")).scalar()
    totals = per_order.agg(
        F.count("*").alias("total_orders"),
        F.round(revenue, 2).alias("total_revenue"),
        F.round(
            F.coalesce(F.try_divide(revenue, F.sum(F.col("lines") * line_copies).cast("double")), F.lit(0.0)), 2
        ).alias("avg_order_value"),
        F.round(ratio(F.sum(days * order_copies), F.sum(F.when(days.isNotNull(), order_copies))), 1).alias("avg_delivery_days"),
        F.round(
            ratio(F.sum(F.col("score") * review_copies), F.sum(F.col("scored") * review_copies)), 2
        ).alias("avg_review_score"),
        F.round(ratio(F.count_if(judged & on_time) * 100, F.count_if(judged)), 1).alias("on_time_delivery_pct"),
    )
    return totals.select("total_orders", customers.alias("total_customers"), *totals.columns[1:])


def revenue_trends(
    orders: DataFrame, items: DataFrame, granularity: str = "monthly", limit: int | None = None, **when
) -> DataFrame:
    """Revenue and orders per period without canceled orders, oldest first; with `limit` the newest periods only."""
    kept = _in_range(orders.where(F.col("order_status") != "canceled"), **when)
    unit = GRANULARITY.get(granularity, "month")
    # One row per order first: the distinct order count becomes a plain count.
    per_order = items.groupBy("order_id").agg(F.sum(_paid(items)).alias("paid"))
    periods = (
        kept.join(per_order, "order_id")
        .groupBy(F.to_date(F.date_trunc(unit, "order_purchase_timestamp")).alias("period"))
        .agg(
            F.round(F.coalesce(F.sum("paid"), F.lit(0)).cast("double"), 2).alias("revenue"),
            F.count("*").alias("order_count"),
        )
    )
    if limit is not None:
        periods = periods.orderBy(F.desc("period")).limit(limit)
    return periods.orderBy("period")


def top_products(
    orders: DataFrame, items: DataFrame, products: DataFrame, reviews: DataFrame, limit: int = 20, **when
) -> DataFrame:
    """Category ranking by revenue; item rows repeat per review of their order."""
    kept = _in_range(orders.where(F.col("order_status") != "canceled"), **when).select("order_id")
    scores = reviews.groupBy("order_id").agg(
        F.count("*").alias("reviews"), F.count("review_score").alias("scored"), F.sum("review_score").alias("score")
    )
    # Items move once, by order. All sums are linear in the item rows, so those need no totals per product and order
    # first: such totals hardly reduce them, and each one more grouping in a task holds all its rows once more.
    sold = (
        items.select("order_id", "product_id", _paid(items).alias("paid"))
        .join(kept.join(scores, "order_id", "left"), "order_id")
        .join(products.select("product_id", "product_category_name"), "product_id")
    )
    copies = F.greatest(F.coalesce("reviews", F.lit(0)), F.lit(1))
    return (
        sold.groupBy(F.coalesce("product_category_name", F.lit("unknown")).alias("product_category"))
        .agg(
            F.round(F.sum(F.col("paid") * copies).cast("double"), 2).alias("revenue"),
            F.countDistinct("order_id").alias("order_count"),
            F.round(ratio(F.sum("score"), F.sum("scored")), 2).alias("avg_review_score"),
        )
        .orderBy(F.desc("revenue"), "product_category")
        .limit(limit)
    )


def customer_money(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Newest order, order count and money per customer id over delivered orders with items."""
    paid = items.groupBy("order_id").agg(F.sum(_paid(items)).alias("paid"))
    return (
        orders.where(F.col("order_status") == "delivered")
        .join(paid, "order_id")
        .groupBy("customer_id")
        .agg(
            F.max("order_purchase_timestamp").alias("last_order"),
            F.count("*").alias("frequency"),
            F.sum("paid").alias("monetary"),
        )
    )


def customer_segments(
    orders: DataFrame, items: DataFrame, recency: str = "reference"
) -> DataFrame:
    """Size and mean money of the five dashboard segments, with their share in percent."""
    base = materialize(customer_money(orders, items), "customer-money")
    key = "customer_id"
    scored = add_tiles(
        base,
        {
            "r": Ordering("last_order", key, descending=recency == "reference"),
            "f": Ordering("frequency", key),
            "m": Ordering("monetary", key),
        },
    )
    segment = labels.score_segment(
        F.col("r"), F.col("f"), F.col("m"), fv.RFM_DASHBOARD_SEGMENTS, fv.RFM_DASHBOARD_REMAINDER
    )
    counts = scored.groupBy(segment.alias("segment")).agg(
        F.count("*").alias("customer_count"), F.round(mean(F.col("monetary")), 2).alias("avg_monetary")
    )
    return percent_of_total(counts, "customer_count", "pct_of_total").orderBy(F.desc("customer_count"), "segment")


def percent_of_total(counts: DataFrame, count: str, out: str, digits: int = 1) -> DataFrame:
    """Share of each group; the window holds one row per group."""
    whole = F.sum(count).over(W.partitionBy())
    return counts.withColumn(out, F.round(ratio(F.col(count), whole) * 100, digits))


def delivery_performance(orders: DataFrame, items: DataFrame, **when) -> DataFrame:
    """Delivery time and punctuality of delivered orders, and the mean freight of their items."""
    delivered = _in_range(orders.where(F.col("order_status") == "delivered"), **when)
    arrived, promised = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    freight = items.groupBy("order_id").agg(
        F.sum("freight_value").alias("freight"), F.count("freight_value").alias("freights")
    )
    zero = F.lit(0.0)

    def arrived_pct(condition: Column) -> Column:
        return F.round(F.coalesce(ratio(F.count_if(arrived.isNotNull() & condition) * 100, F.count(arrived)), zero), 1)

    return delivered.join(freight, "order_id", "left").agg(
        F.round(F.coalesce(F.avg(_delivery_days()), zero), 1).alias("avg_delivery_days"),
        arrived_pct(arrived <= promised).alias("on_time_pct"),
        arrived_pct(arrived > promised).alias("late_pct"),
        F.round(F.coalesce(ratio(F.sum("freight"), F.sum("freights")), zero), 2).alias("avg_freight_value"),
        F.count(arrived).alias("total_delivered"),
    )


def order_status_distribution(orders: DataFrame) -> DataFrame:
    counts = orders.groupBy(F.col("order_status").alias("status")).agg(F.count("*").alias("count"))
    return percent_of_total(counts, "count", "pct").orderBy(F.desc("count"), "status")
