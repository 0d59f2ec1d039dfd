"""Commerce facts, dimensions and marts.

Shuffle design: everything at order grain (orders, item / payment / review totals) is hashed on
order_id once and joined without moving again; dimension rows join after the large side has been
aggregated, so a hot product or seller is reduced map-side before any join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions import labels
from tidemill.functions.scalars import days_between, mean, ratio
from tidemill.operators.ranking import (
    Ordering,
    add_tiles,
    distinct_counts,
    group_percentiles,
    table_percentiles,
    top_per_group,
)
from tidemill.operators.timeseries import dated, moving_avg
from tidemill.plans import adapters, commerce_staging
from tidemill.session import materialize
from tidemill.sources.keyed import KeyedTable, follow, summed_view


# --- order grain ------------------------------------------------------------------------


def review_means(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(F.avg("review_score").alias("avg_score"))


def orders_enriched(orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders with item, payment and review totals; orders without any keep zeros."""
    item_totals = items.groupBy("order_id").agg(
        F.count("*").alias("total_items"),
        F.sum("price").alias("total_product_value"),
        F.sum("freight_value").alias("total_freight"),
        (F.sum("price") + F.sum("freight_value")).alias("total_order_value"),
    )
    variety = distinct_counts(items, "order_id", {"product_id": "unique_products", "seller_id": "unique_sellers"})
    payment_totals = payments.groupBy("order_id").agg(
        F.count("*").alias("payment_count"),
        F.sum("payment_value").alias("total_paid"),
        F.max("payment_type").alias("primary_payment_type"),
        F.max("installments").alias("max_installments"),
    )
    review_totals = reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("avg_review_score"),
        F.count("*").alias("review_count"),
        F.bool_or("has_comment").alias("has_review_comment"),
    )
    zero_filled = [
        "total_items", "total_product_value", "total_freight", "total_order_value",
        "unique_products", "unique_sellers", "payment_count", "total_paid", "review_count",
    ]
    joined = orders
    for totals in (item_totals, *variety, payment_totals, review_totals):
        joined = joined.join(totals, "order_id", "left")
    return joined.withColumns(
        {
            **{c: F.coalesce(F.col(c), F.lit(0)) for c in zero_filled},
            "has_review_comment": F.coalesce("has_review_comment", F.lit(False)),
        }
    )


def fct_orders(enriched: DataFrame, customers: DataFrame) -> DataFrame:
    who = customers.select("customer_id", "customer_unique_id")
    return enriched.join(who, "customer_id", "left").select(
        "order_id", "customer_id", "customer_unique_id",
        F.to_date("purchased_at").alias("order_date"),
        "order_status", "is_delivered", "is_canceled", "days_to_deliver", "delivery_delta_days",
        "total_items", "total_product_value", "total_freight", "total_order_value", "total_paid",
        "unique_products", "unique_sellers", "primary_payment_type", "max_installments",
        "avg_review_score", "review_count", "has_review_comment",
    )


def order_days(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", F.to_date("purchased_at").alias("order_date"), "order_status")


def dated_categories(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Item rows with order date and product category: all that daily category totals need."""
    category = products.select("product_id", F.col("category").alias("product_category"))
    return items.join(order_days(orders), "order_id").join(category, "product_id", "left")


def fct_order_items(items: DataFrame, orders: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    where = sellers.select("seller_id", F.col("state").alias("seller_state"))
    return dated_categories(items, orders, products).join(where, "seller_id", "left").select(
        "order_id", "item_seq", "product_id", "seller_id", "order_date", "order_status",
        "product_category", "seller_state", "price", "freight_value", "total_item_value",
    )


# --- customers, products, sellers ---------------------------------------------------------


def customer_metrics(customers: DataFrame, enriched: DataFrame) -> DataFrame:
    """Totals per person; a person may own several customer ids.

    Orders are reduced to their customer id before they meet the customers.
    """
    averaged = ("total_order_value", "avg_review_score", "days_to_deliver")
    own = enriched.groupBy("customer_id").agg(
        F.count("*").alias("orders"),
        F.min("purchased_at").alias("first"),
        F.max("purchased_at").alias("last"),
        F.sum("total_items").alias("items"),
        *[F.sum(c).alias(c) for c in averaged],
        *[F.count(c).alias(f"{c}_n") for c in averaged],
    )

    def average(c: str) -> Column:
        return ratio(F.sum(c), F.sum(f"{c}_n"))

    return (
        customers.join(own, "customer_id")
        .groupBy("customer_unique_id")
        .agg(
            F.min("city").alias("city"),
            F.min("state").alias("state"),
            F.sum("orders").alias("order_count"),
            F.sum("total_order_value").alias("total_spend"),
            average("total_order_value").alias("avg_order_value"),
            F.min("first").alias("first_order_at"),
            F.max("last").alias("last_order_at"),
            average("avg_review_score").alias("avg_review_score"),
            F.sum("items").alias("total_items_bought"),
            average("days_to_deliver").alias("avg_delivery_days"),
        )
        .withColumn("customer_lifetime_days", days_between(F.col("last_order_at"), F.col("first_order_at")))
    )


def _weighted_mean(value: str, weight: str = "n") -> Column:
    """Mean of an order-level value over item rows, from one row per order and its row count."""
    known = F.when(F.col(value).isNotNull(), F.col(weight))
    return ratio(F.sum(F.col(value) * F.col(weight)), F.sum(known))


def _per_order_of(items: DataFrame, key: str, per_order: DataFrame, *order_values: str) -> DataFrame:
    """One row per (key, order): item totals and the order's values.

    The join hashes items on order_id, which also serves the grouping; the hot key is reduced to
    its orders before anything moves by key. Counting rows then counts distinct orders.
    """
    return (
        items.join(per_order, "order_id", "left")
        .groupBy(key, "order_id")
        .agg(
            F.count("*").alias("n"),
            F.sum("item_seq").alias("units"),
            F.sum("price").alias("price"),
            F.count("price").alias("prices"),
            F.sum("freight_value").alias("freight"),
            *[F.max(c).alias(c) for c in order_values],
        )
    )


def product_performance(products: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Sales per product. The review mean weighs each order once per item row."""
    (variety,) = distinct_counts(items, "product_id", {"seller_id": "unique_sellers"})
    sold = _per_order_of(items, "product_id", review_means(reviews), "avg_score").groupBy("product_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("units").alias("total_units_sold"),
        F.sum("n").alias("item_rows"),
        F.sum("price").alias("total_revenue"),
        ratio(F.sum("price"), F.sum("prices")).alias("avg_price"),
        F.sum("freight").alias("total_freight_cost"),
        _weighted_mean("avg_score").alias("avg_review_score"),
    )
    shown = products.select("product_id", "category", "weight_g", "volume_cm3")
    return shown.join(sold, "product_id").join(variety, "product_id", "left")


def seller_performance(sellers: DataFrame, items: DataFrame, orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Sales per seller. `delivery_rate` divides delivered item rows by orders, so it may exceed 1."""
    per_order = orders.select("order_id", "days_to_deliver", "is_delivered").join(
        review_means(reviews), "order_id", "full"
    )
    (variety,) = distinct_counts(items, "seller_id", {"product_id": "unique_products"})
    delivered_rows = F.sum(F.when(F.col("is_delivered"), F.col("n")).otherwise(0))
    orders_total = F.count("order_id")
    located = _per_order_of(items, "seller_id", per_order, "days_to_deliver", "is_delivered", "avg_score")
    sold = located.groupBy("seller_id").agg(
        orders_total.alias("total_orders"),
        F.sum("n").alias("total_items_sold"),
        F.sum("price").alias("total_revenue"),
        ratio(F.sum("price"), F.sum("prices")).alias("avg_item_price"),
        F.sum("freight").alias("total_freight"),
        _weighted_mean("days_to_deliver").alias("avg_delivery_days"),
        _weighted_mean("avg_score").alias("avg_review_score"),
        ratio(delivered_rows, orders_total).alias("delivery_rate"),
        ratio(F.count_if("is_delivered"), orders_total).alias("delivery_rate_orders"),
    )
    return sellers.select("seller_id", "city", "state").join(sold, "seller_id").join(variety, "seller_id", "left")


def dim_products(performance: DataFrame) -> DataFrame:
    return performance.drop("item_rows")


def dim_sellers(performance: DataFrame) -> DataFrame:
    return performance.drop("total_freight", "delivery_rate_orders")


def dim_customers(metrics: DataFrame) -> DataFrame:
    """Customers with a spend tier by the quartiles of positive spend.

    `metrics` is read twice (quartiles, then rows): pass a materialized frame.
    """
    spenders = metrics.where(F.col("total_spend") > 0)
    cuts = table_percentiles(spenders, "total_spend", "customer_unique_id", [0.75, 0.5, 0.25])
    spend = F.col("total_spend").cast("double")
    *tiers, lowest = fv.SPEND_TIERS
    rules = [(spend >= F.lit(cut), tier) for cut, tier in zip(cuts, tiers)]
    return metrics.withColumn("customer_segment", labels.first_match(rules, lowest))


def mart_customers(base: DataFrame, recency: str = "reference") -> DataFrame:
    """RFM scores, segment, yearly value and churn flag per customer.

    recency="reference" gives the newest buyers score 1; "corrected" gives them score 5.
    `base` is read once per score: pass a materialized frame.
    """
    active = base.where(F.col("order_count") > 0)
    key = "customer_unique_id"
    scored = add_tiles(
        active,
        {
            "recency_score": Ordering("last_order_at", key, descending=recency == "reference"),
            "frequency_score": Ordering("order_count", key),
            "monetary_score": Ordering("total_spend", key),
        },
        tiles=5,
    )
    r, f, m = (F.col(f"{n}_score") for n in ("recency", "frequency", "monetary"))
    lifetime = F.col("customer_lifetime_days")
    yearly = F.round(ratio(F.col("total_spend"), lifetime) * 365, 2)
    newest = base.agg(F.max("last_order_at")).scalar()
    return scored.select(
        key, "city", "state", "customer_segment",
        "order_count", "total_spend", "avg_order_value", "total_items_bought",
        "first_order_at", "last_order_at", "customer_lifetime_days",
        "avg_review_score", "avg_delivery_days",
        "recency_score", "frequency_score", "monetary_score",
        (r + f + m).alias("rfm_total"),
        F.concat(r, f, m).alias("rfm_code"),
        labels.score_segment(r, f, m, fv.RFM_SEGMENTS, fv.RFM_REMAINDER).alias("rfm_segment"),
        F.when(lifetime > 0, yearly).otherwise(F.col("total_spend").cast("double")).alias("estimated_annual_value"),
        (F.col("last_order_at") < newest - F.make_dt_interval(days=F.lit(fv.CHURN_DAYS))).alias("is_churned"),
    )


def dim_geography(
    customers_raw: DataFrame, sellers_raw: DataFrame, geolocation_raw: DataFrame, regions: DataFrame | None = None
) -> DataFrame:
    """One row per zip prefix. `regions` (state, region) replaces the built-in state list."""
    points = (
        geolocation_raw.where(F.col("geolocation_zip_code_prefix").isNotNull())
        .groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"))
        .agg(
            mean(F.col("geolocation_lat")).alias("latitude"),
            mean(F.col("geolocation_lng")).alias("longitude"),
        )
    )
    places = [
        df.select(*[F.col(f"{who}_{c}").alias(c) for c in ("zip_code_prefix", "city", "state")])
        for who, df in (("customer", customers_raw), ("seller", sellers_raw))
    ]
    # max() ignores repeats, so the two lists need no separate DISTINCT before it.
    one_per_zip = (
        places[0].unionByName(places[1])
        .where(F.col("zip_code_prefix").isNotNull())
        .groupBy("zip_code_prefix")
        .agg(F.max("city").alias("city"), F.max("state").alias("state"))
    )
    if regions is None:
        named = one_per_zip.withColumn("region", labels.state_region(F.col("state")))
    else:
        named = one_per_zip.join(regions, "state", "left").withColumn(
            "region", F.coalesce("region", F.lit(fv.UNKNOWN_REGION))
        )
    return named.join(points, "zip_code_prefix", "left").select(
        "zip_code_prefix", "city", "state", "region", "latitude", "longitude"
    )


def _calendar(bounds: DataFrame, name: str) -> DataFrame:
    """Every day between the two dates of a one-row frame (first, last)."""
    return bounds.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias(name))


def dim_time(orders: DataFrame) -> DataFrame:
    day = F.to_date("purchased_at")
    bounds = orders.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    d = F.col("date_key")
    weekday = F.extract(F.lit("DAYOFWEEK_ISO"), d)
    return _calendar(bounds, "date_key").select(
        "date_key",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        weekday.isin(6, 7).alias("is_weekend"),
        F.date_format(d, "yyyy-q").alias("year_quarter"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
    )


def dim_date(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """Calendar rows for a frame (first, last), with holidays from an input table of dates.

    Fiscal years start on 1 October; a trading day is a weekday that is no holiday.
    """
    free = holidays.select(F.col("holiday").alias("full_date")).distinct().withColumn("is_us_holiday", F.lit(True))
    d = F.col("full_date")
    fiscal = F.add_months(d, 3)
    base = _calendar(days, "full_date").join(free, "full_date", "left")
    holiday = F.coalesce("is_us_holiday", F.lit(False))
    weekday = F.extract(F.lit("DAYOFWEEK_ISO"), d)
    return base.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        "full_date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("quarter_name"),
        (weekday >= 6).alias("is_weekend"),
        holiday.alias("is_us_holiday"),
        ((weekday < 6) & ~holiday).alias("is_trading_day"),
        F.year(fiscal).alias("fiscal_year"),
        F.quarter(fiscal).alias("fiscal_quarter"),
    )


# --- sales and logistics marts ------------------------------------------------------------


def _sales_totals(fact: DataFrame, period: Column, name: str, freight: str) -> DataFrame:
    return fact.groupBy(period.alias(name)).agg(
        F.count("*").alias("order_count"),
        F.sum("total_order_value").alias("gross_revenue"),
        F.sum("total_product_value").alias("net_revenue"),
        F.sum("total_freight").alias(freight),
        mean(F.col("total_order_value")).alias("avg_order_value"),
        F.sum("total_items").alias("items_sold"),
        F.countDistinct("customer_unique_id").alias("unique_customers"),
        F.avg("avg_review_score").alias("avg_review"),
        F.count_if("is_canceled").alias("canceled_orders"),
    )


def daily_sales(fact: DataFrame) -> DataFrame:
    daily = _sales_totals(fact, F.col("order_date"), "order_date", "total_freight")
    pct = F.round(ratio(F.col("canceled_orders"), F.col("order_count")) * 100, 2)
    return daily.withColumn("cancellation_rate_pct", pct)


def running_total(daily: DataFrame, value: str, order: str, out: str) -> DataFrame:
    """Sum of all rows up to and including the current order value."""
    upto = W.orderBy(order).rangeBetween(W.unboundedPreceding, 0)
    return daily.withColumn(out, F.sum(value).over(upto))


def top_category_per_day(categories: DataFrame) -> DataFrame:
    totals = (
        categories.where(F.col("product_category").isNotNull())
        .groupBy("order_date", F.col("product_category").alias("top_category"))
        .agg(F.sum("total_item_value").alias("top_category_revenue"))
    )
    return top_per_group(totals, ["order_date"], "top_category_revenue", "top_category")


def top_payment_per_day(orders: DataFrame, payments: DataFrame) -> DataFrame:
    totals = (
        order_days(orders).join(payments, "order_id")
        .groupBy("order_date", F.col("payment_type").alias("top_payment_type"))
        .agg(F.sum("payment_value").alias("top_payment_total"))
    )
    return top_per_group(totals, ["order_date"], "top_payment_total", "top_payment_type")


def mart_sales(fact: DataFrame, orders: DataFrame, categories: DataFrame, payments: DataFrame) -> DataFrame:
    """Daily sales with leaders, running totals and weekly means; one row per day."""
    daily = (
        daily_sales(fact)
        .join(top_category_per_day(categories), "order_date", "left")
        .join(top_payment_per_day(orders, payments), "order_date", "left")
    )
    daily = running_total(daily, "gross_revenue", "order_date", "cumulative_revenue")
    daily = running_total(daily, "order_count", "order_date", "cumulative_orders")
    return daily.withColumns(
        {
            "revenue_7d_avg": moving_avg(F.col("gross_revenue"), 7, "order_date"),
            "orders_7d_avg": moving_avg(F.col("order_count"), 7, "order_date"),
        }
    )


def growth_pct(c: str, order: str, digits: int = 1) -> Column:
    before = F.lag(c).over(dated(order))
    return F.round(ratio(F.col(c) - before, before) * 100, digits)


def mart_sales_monthly(fact: DataFrame) -> DataFrame:
    monthly = _sales_totals(fact, F.trunc("order_date", "month"), "month", "freight_revenue")
    return monthly.withColumns(
        {
            "year_month": F.date_format("month", "yyyy-MM"),
            "revenue_mom_pct": growth_pct("gross_revenue", "month"),
            "orders_mom_pct": growth_pct("order_count", "month"),
        }
    )


def daily_logistics(placed: DataFrame) -> DataFrame:
    """Delivered orders per day: times, freight, punctuality; exact median and 95th percentile.

    `placed` is the enriched orders with `order_date`; no customer is needed.
    """
    done = placed.where(F.col("is_delivered"))
    late = F.col("delivery_delta_days") < 0
    daily = done.groupBy("order_date").agg(
        F.count("*").alias("delivered_orders"),
        F.avg("days_to_deliver").alias("avg_delivery_days"),
        mean(F.col("total_freight")).alias("avg_freight"),
        F.sum("total_freight").alias("total_freight"),
        (ratio(F.count_if(F.col("delivery_delta_days") >= 0), F.count("*")) * 100).alias("on_time_rate_pct"),
        F.avg("avg_review_score").alias("avg_review"),
        F.count_if(late).alias("late_deliveries"),
        F.avg(F.when(late, F.abs("delivery_delta_days"))).alias("avg_late_days"),
    )
    middle = group_percentiles(
        done, ["order_date"], "days_to_deliver", {"median_delivery_days": 0.5, "p95_delivery_days": 0.95}
    )
    return daily.join(middle, "order_date", "left")


def mart_logistics(placed: DataFrame) -> DataFrame:
    return daily_logistics(placed).withColumns(
        {
            "delivery_days_7d_avg": moving_avg(F.col("avg_delivery_days"), 7, "order_date"),
            "on_time_rate_7d_avg": moving_avg(F.col("on_time_rate_pct"), 7, "order_date"),
        }
    )


def logistics_by_state(placed: DataFrame, customers: DataFrame) -> DataFrame:
    where = customers.select("customer_id", "state")
    on_time = ratio(F.count_if(F.col("delivery_delta_days") >= 0), F.count("*")) * 100
    return (
        placed.where(F.col("is_delivered"))
        .join(where, "customer_id")
        .where(F.col("state").isNotNull())
        .groupBy("state")
        .agg(
            F.count("*").alias("total_deliveries"),
            F.round(F.avg("days_to_deliver"), 1).alias("avg_delivery_days"),
            F.round(mean(F.col("total_freight")), 2).alias("avg_freight"),
            F.round(on_time, 1).alias("on_time_rate_pct"),
            F.round(F.avg("avg_review_score"), 2).alias("avg_review"),
            F.round(mean(F.col("total_order_value")), 2).alias("avg_order_value"),
            F.sum("total_freight").alias("total_freight_revenue"),
        )
        .orderBy(F.desc("total_deliveries"), "state")
    )


def daily_revenue(placed: DataFrame) -> DataFrame:
    return placed.groupBy("order_date").agg(
        F.sum("total_order_value").alias("revenue"), F.count("*").alias("order_count")
    )


def maintained_daily_revenue(orders: KeyedTable, batches: list[DataFrame], path: str) -> DataFrame:
    """`daily_revenue` kept up to date while batches of orders are merged: each reads and writes the months of its own days only."""
    view = summed_view(orders.spark, path, "order_date", F.year("order_date") * 12 + F.month("order_date"))
    for batch in batches:
        orders.merge(batch)
        follow(orders, view, {"revenue": "total_order_value"})
    return view.read().select("order_date", "revenue", F.col("row_count").alias("order_count"))


# --- the model as one object ---------------------------------------------------------------


@dataclass
class Commerce:
    """Lazy model graph over the given tables; each table is declared once."""

    spark: SparkSession
    sf: str

    def _raw(self, name: str) -> DataFrame:
        return getattr(adapters, f"raw_{name}")(self.spark, self.sf)

    @cached_property
    def orders(self) -> DataFrame:
        return commerce_staging.orders(self._raw("orders"))

    @cached_property
    def items(self) -> DataFrame:
        return commerce_staging.order_items(self._raw("order_items"))

    @cached_property
    def customers(self) -> DataFrame:
        return commerce_staging.customers(self._raw("customers"))

    @cached_property
    def sellers(self) -> DataFrame:
        return commerce_staging.sellers(self._raw("sellers"))

    @cached_property
    def products(self) -> DataFrame:
        return commerce_staging.products(self._raw("products"), self._raw("translation"))

    @cached_property
    def payments(self) -> DataFrame:
        return commerce_staging.payments(self._raw("payments"))

    @cached_property
    def reviews(self) -> DataFrame:
        return commerce_staging.reviews(self._raw("reviews"))

    @cached_property
    def enriched(self) -> DataFrame:
        return orders_enriched(self.orders, self.items, self.payments, self.reviews)

    @cached_property
    def placed(self) -> DataFrame:
        """Enriched orders with their date: for plans that need no customer."""
        return self.enriched.withColumn("order_date", F.to_date("purchased_at"))

    @cached_property
    def fact(self) -> DataFrame:
        return fct_orders(self.enriched, self.customers)

    @cached_property
    def item_facts(self) -> DataFrame:
        return fct_order_items(self.items, self.orders, self.products, self.sellers)

    @cached_property
    def categories(self) -> DataFrame:
        return dated_categories(self.items, self.orders, self.products)

    @cached_property
    def sales(self) -> DataFrame:
        return mart_sales(self.fact, self.orders, self.categories, self.payments)

    @cached_property
    def metrics(self) -> DataFrame:
        """Customer totals, written once: the quartiles, tiles and rows all read them."""
        return materialize(customer_metrics(self.customers, self.enriched), "customer-metrics")

    @cached_property
    def dim_customers(self) -> DataFrame:
        return dim_customers(self.metrics)
