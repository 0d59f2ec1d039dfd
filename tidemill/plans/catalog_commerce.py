"""Registered commerce queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions.scalars import ratio
from tidemill.operators.timeseries import moving_avg
from tidemill.plans import adapters as ad
from tidemill.plans import commerce as cm
from tidemill.plans import dashboard as db
from tidemill.plans.commerce import Commerce
from tidemill.plans.oracle_tables import segment_case
from tidemill.plans.registry import register
from tidemill.session import scratch_path
from tidemill.sources.keyed import KeyedTable

# --- staging ------------------------------------------------------------------------------

register(
    "stg_orders",
    "i: order_id customer_id | s: order_status | t: purchased_at approved_at shipped_at delivered_at "
    "estimated_delivery_at | b: is_delivered is_canceled | f: days_to_deliver hours_to_approve delivery_delta_days",
    "SELECT * FROM x_o",
)(lambda s, sf: Commerce(s, sf).orders)

register(
    "stg_order_items",
    "i: order_id item_seq product_id seller_id | t: shipping_limit_at | f2: price freight_value total_item_value",
    "SELECT *, price + freight_value AS total_item_value FROM x_ri",
)(lambda s, sf: Commerce(s, sf).items)

register(
    "stg_customers", "i: customer_id customer_unique_id | s: zip_code city state", "SELECT * FROM x_c"
)(lambda s, sf: Commerce(s, sf).customers)

register("stg_sellers", "i: seller_id | s: zip_code city state", "SELECT * FROM x_s")(
    lambda s, sf: Commerce(s, sf).sellers
)

register(
    "stg_products",
    "i: product_id | s: category_pt category | i: name_length description_length photos_qty weight_g length_cm "
    "height_cm width_cm volume_cm3",
    "SELECT * FROM x_p",
)(lambda s, sf: Commerce(s, sf).products)

register(
    "stg_payments", "i: order_id payment_seq | s: payment_type | i: installments | f2: payment_value",
    "SELECT * FROM x_pay",
)(lambda s, sf: Commerce(s, sf).payments)

register(
    "stg_reviews",
    "i: review_id order_id review_score | s: comment_title comment_message | t: created_at answered_at "
    "| b: has_comment | f: response_time_hours",
    "SELECT * FROM x_rev",
)(lambda s, sf: Commerce(s, sf).reviews)

# --- joins --------------------------------------------------------------------------------


@register(
    "join_inner_equi",
    "i: customer_unique_id orders | f2: value",
    "SELECT customer_unique_id, count(*) AS orders, sum(total_order_value) AS value "
    "FROM x_c JOIN x_enriched USING (customer_id) GROUP BY 1",
)
def _join_inner(s, sf):
    m = Commerce(s, sf)
    return (
        m.customers.join(m.enriched, "customer_id").groupBy("customer_unique_id")
        .agg(F.count("*").alias("orders"), F.sum("total_order_value").alias("value"))
    )


_ENRICHED = (
    "i: order_id customer_id | s: order_status | i: total_items | f2: total_product_value total_freight "
    "total_order_value | i: unique_products unique_sellers payment_count | f2: total_paid | s: primary_payment_type "
    "| i: max_installments | f: avg_review_score | i: review_count | b: has_review_comment"
)
register("orders_enriched", _ENRICHED, "SELECT * FROM x_enriched")(lambda s, sf: Commerce(s, sf).enriched)


@register(
    "join_left_equi",
    "i: order_id | f2: total_paid | i: payment_count",
    "SELECT o.order_id, coalesce(sum(payment_value), 0) AS total_paid, count(payment_value) AS payment_count "
    "FROM x_o o LEFT JOIN x_pay p USING (order_id) GROUP BY 1",
)
def _join_left(s, sf):
    m = Commerce(s, sf)
    paid = m.payments.groupBy("order_id").agg(F.sum("payment_value").alias("v"), F.count("*").alias("n"))
    return m.orders.select("order_id").join(paid, "order_id", "left").select(
        "order_id", F.coalesce("v", F.lit(0)).alias("total_paid"), F.coalesce("n", F.lit(0)).alias("payment_count")
    )


@register(
    "join_left_fanout",
    "i: order_id item_seq product_id seller_id review_id review_score",
    "SELECT i.*, r.review_id, r.review_score FROM x_ri i LEFT JOIN x_rev r USING (order_id)",
)
def _join_fanout(s, sf):
    m = Commerce(s, sf)
    return m.items.join(m.reviews, "order_id", "left")


@register(
    "join_cross_scalar",
    "i: customer_unique_id | f2: total_spend | f: share_of_max",
    "SELECT customer_unique_id, total_spend, CAST(total_spend AS DOUBLE) / CAST(m AS DOUBLE) AS share_of_max "
    "FROM x_metrics, (SELECT max(total_spend) AS m FROM x_metrics)",
)
def _join_scalar(s, sf):
    m = Commerce(s, sf).metrics
    top = m.agg(F.max("total_spend")).scalar()
    return m.withColumn("share_of_max", ratio(F.col("total_spend"), top))


@register(
    "subquery_scalar",
    "i: customer_unique_id | t: last_order_at | b: is_churned",
    "SELECT customer_unique_id, last_order_at, "
    "last_order_at < (SELECT max(last_order_at) FROM x_metrics) - INTERVAL 90 DAY AS is_churned FROM x_metrics",
)
def _subquery_scalar(s, sf):
    m = Commerce(s, sf).metrics
    newest = m.agg(F.max("last_order_at")).scalar()
    return m.withColumn("is_churned", F.col("last_order_at") < newest - F.expr("interval 90 days"))


@register(
    "dim_lookup",
    "i: order_id item_seq product_id seller_id | s: product_category seller_state | f2: price",
    "SELECT i.*, p.category AS product_category, s.state AS seller_state FROM x_ri i "
    "LEFT JOIN x_p p USING (product_id) LEFT JOIN x_s s USING (seller_id)",
)
def _dim_lookup(s, sf):
    m = Commerce(s, sf)
    return (
        m.items.join(m.products.select("product_id", F.col("category").alias("product_category")), "product_id", "left")
        .join(m.sellers.select("seller_id", F.col("state").alias("seller_state")), "seller_id", "left")
    )


# --- facts and dimensions -----------------------------------------------------------------

register(
    "fct_orders",
    "i: order_id customer_id customer_unique_id | d: order_date | s: order_status | b: is_delivered is_canceled "
    "| f: days_to_deliver delivery_delta_days | i: total_items | f2: total_product_value total_freight "
    "total_order_value total_paid | i: unique_products unique_sellers | s: primary_payment_type "
    "| i: max_installments | f: avg_review_score | i: review_count | b: has_review_comment",
    "SELECT * FROM x_fact",
)(lambda s, sf: Commerce(s, sf).fact)

register(
    "fct_order_items",
    "i: order_id item_seq product_id seller_id | d: order_date | s: order_status product_category seller_state "
    "| f2: price freight_value total_item_value",
    "SELECT * FROM x_itemfact",
)(lambda s, sf: Commerce(s, sf).item_facts)

_METRICS = (
    "i: customer_unique_id | s: city state | i: order_count | f2: total_spend | e: avg_order_value "
    "| t: first_order_at last_order_at | f: avg_review_score | i: total_items_bought | f: avg_delivery_days "
    "customer_lifetime_days"
)


@register("customer_metrics", _METRICS, "SELECT * FROM x_metrics")
def _customer_metrics(s, sf):
    m = Commerce(s, sf)
    return cm.customer_metrics(m.customers, m.enriched)


_TIERS = _METRICS + " | s: customer_segment"
register("dim_customers", _TIERS, "SELECT * FROM x_tiers")(lambda s, sf: Commerce(s, sf).dim_customers)
register("customer_segment", "i: customer_unique_id | s: customer_segment", "SELECT * FROM x_tiers")(
    lambda s, sf: cm.dim_customers(Commerce(s, sf).metrics)
)

_PRODUCT_SQL = """
SELECT p.product_id, p.category, p.weight_g, p.volume_cm3, count(DISTINCT i.order_id) AS total_orders,
       sum(i.item_seq) AS total_units_sold, count(*) AS item_rows, sum(i.price) AS total_revenue,
       CAST(sum(i.price) AS DOUBLE) / count(*) AS avg_price, sum(i.freight_value) AS total_freight_cost,
       count(DISTINCT i.seller_id) AS unique_sellers, avg(r.score) AS avg_review_score
FROM x_p p JOIN x_ri i USING (product_id) LEFT JOIN x_revmean r ON r.order_id = i.order_id
GROUP BY p.product_id, p.category, p.weight_g, p.volume_cm3
"""
_PRODUCT = (
    "i: product_id | s: category | i: weight_g volume_cm3 total_orders total_units_sold | f2: total_revenue "
    "| e: avg_price | f2: total_freight_cost | i: unique_sellers | f: avg_review_score"
)


def _products(s, sf):
    m = Commerce(s, sf)
    return cm.product_performance(m.products, m.items, m.reviews)


register("product_performance", _PRODUCT + " | i: item_rows", _PRODUCT_SQL)(_products)
register("dim_products", _PRODUCT, _PRODUCT_SQL)(lambda s, sf: cm.dim_products(_products(s, sf)))
register("project_mart", _PRODUCT, _PRODUCT_SQL)(lambda s, sf: cm.dim_products(_products(s, sf)))

_SELLER_SQL = """
SELECT s.seller_id, s.city, s.state, count(DISTINCT i.order_id) AS total_orders, count(*) AS total_items_sold,
       sum(i.price) AS total_revenue, CAST(sum(i.price) AS DOUBLE) / count(*) AS avg_item_price,
       sum(i.freight_value) AS total_freight, count(DISTINCT i.product_id) AS unique_products,
       avg(o.days_to_deliver) AS avg_delivery_days, avg(r.score) AS avg_review_score,
       CAST(count(*) FILTER (o.is_delivered) AS DOUBLE) / count(DISTINCT i.order_id) AS delivery_rate,
       CAST(count(DISTINCT i.order_id) FILTER (o.is_delivered) AS DOUBLE) / count(DISTINCT i.order_id) AS delivery_rate_orders
FROM x_s s JOIN x_ri i USING (seller_id) LEFT JOIN x_o o ON o.order_id = i.order_id
LEFT JOIN x_revmean r ON r.order_id = i.order_id
GROUP BY 1, 2, 3
"""
_SELLER = (
    "i: seller_id | s: city state | i: total_orders total_items_sold | f2: total_revenue | e: avg_item_price "
    "| i: unique_products | f: avg_delivery_days avg_review_score delivery_rate"
)


def _sellers(s, sf):
    m = Commerce(s, sf)
    return cm.seller_performance(m.sellers, m.items, m.orders, m.reviews)


register("seller_performance", _SELLER + " | f2: total_freight | f: delivery_rate_orders", _SELLER_SQL)(_sellers)
register("dim_sellers", _SELLER, _SELLER_SQL)(lambda s, sf: cm.dim_sellers(_sellers(s, sf)))

_GEO_SQL = """
WITH places AS (
  SELECT CAST(c_custkey % 997 AS VARCHAR) AS z, ' ' || lower(c_mktsegment) || ' town ' AS city, lower(n_name) AS state
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION SELECT CAST(s_suppkey % 1009 AS VARCHAR), 'port ' || lower(n_name), lower(n_name)
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
), one AS (SELECT z, max(city) AS city, max(state) AS state FROM places GROUP BY z),
pts AS (SELECT CAST(c_custkey % 997 AS VARCHAR) AS z, avg(c_custkey % 180 - 90) AS lat, avg(c_custkey % 360 - 180) AS lng
        FROM customer GROUP BY 1)
SELECT z AS zip_code_prefix, city, state, coalesce(r_name, 'Desconhecido') AS region, lat AS latitude, lng AS longitude
FROM one LEFT JOIN pts USING (z) LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON lower(n_name) = state
"""


@register("dim_geography", "s: zip_code_prefix city state region | f: latitude longitude", _GEO_SQL)
def _geography(s, sf):
    return cm.dim_geography(
        ad.raw_customers(s, sf), ad.raw_sellers(s, sf), ad.raw_geolocation(s, sf), ad.region_of_state(s, sf)
    )


_PLACES = "SELECT zip_code, city, state FROM x_c UNION {} SELECT zip_code, city, state FROM x_s"


@register("union_distinct", "s: zip_code city state", _PLACES.format(""))
def _union_distinct(s, sf):
    m = Commerce(s, sf)
    cols = ["zip_code", "city", "state"]
    return m.customers.select(cols).unionByName(m.sellers.select(cols)).distinct()


@register("distinct_rows", "s: zip_code city state", "SELECT DISTINCT zip_code, city, state FROM x_c")
def _distinct_rows(s, sf):
    return Commerce(s, sf).customers.select("zip_code", "city", "state").distinct()


_DAYS_SQL = """
SELECT CAST(d AS DATE) AS date_key, year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
       weekofyear(d) AS week_of_year, isodow(d) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend,
       year(d) || '-' || quarter(d) AS year_quarter, strftime(d, '%Y-%m') AS year_month
FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)
"""
register(
    "dim_time",
    "d: date_key | i: year quarter month | s: month_name | i: week_of_year day_of_week | s: day_name | b: is_weekend "
    "| s: year_quarter year_month",
    _DAYS_SQL,
)(lambda s, sf: cm.dim_time(Commerce(s, sf).orders))


@register(
    "dim_date",
    "i: date_key | d: full_date | i: year quarter month week_of_year day_of_month day_of_week day_of_year "
    "| s: month_name day_name quarter_name | b: is_weekend is_us_holiday is_trading_day | i: fiscal_year fiscal_quarter",
    """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, year(d) AS year,
       quarter(d) AS quarter, month(d) AS month, weekofyear(d) AS week_of_year, day(d) AS day_of_month,
       isodow(d) AS day_of_week, dayofyear(d) AS day_of_year, monthname(d) AS month_name, dayname(d) AS day_name,
       'Q' || quarter(d) AS quarter_name, isodow(d) > 5 AS is_weekend, h AS is_us_holiday,
       isodow(d) < 6 AND NOT h AS is_trading_day, year(d + INTERVAL 3 MONTH) AS fiscal_year,
       quarter(d + INTERVAL 3 MONTH) AS fiscal_quarter
FROM (SELECT d, d IN (SELECT o_orderdate FROM orders WHERE month(o_orderdate) = 12 AND day(o_orderdate) = 25) AS h
      FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders))
""",
)
def _dim_date(s, sf):
    day = F.to_date("o_orderdate")
    o = ad.table(s, sf, "orders")
    bounds = o.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    christmas = o.where((F.month(day) == 12) & (F.dayofmonth(day) == 25)).select(day.alias("holiday"))
    return cm.dim_date(bounds, christmas)


# --- marts --------------------------------------------------------------------------------

_DAILY = (
    "d: order_date | i: order_count | f2: gross_revenue net_revenue total_freight | e: avg_order_value "
    "| i: items_sold unique_customers | f: avg_review | i: canceled_orders | f2: cancellation_rate_pct"
)
register("daily_sales", _DAILY, "SELECT * FROM x_daily")(lambda s, sf: cm.daily_sales(Commerce(s, sf).fact))


register(
    "mart_sales",
    _DAILY + " | s: top_category | f2: top_category_revenue | s: top_payment_type | f2: top_payment_total "
    "cumulative_revenue | i: cumulative_orders | f4: revenue_7d_avg orders_7d_avg",
    """
SELECT d.*, top_category, top_category_revenue, top_payment_type, top_payment_total,
       sum(gross_revenue) OVER (ORDER BY order_date) AS cumulative_revenue,
       sum(order_count) OVER (ORDER BY order_date) AS cumulative_orders,
       avg(CAST(gross_revenue AS DOUBLE)) OVER w AS revenue_7d_avg, avg(order_count) OVER w AS orders_7d_avg
FROM x_daily d LEFT JOIN x_topcat USING (order_date) LEFT JOIN x_toppay USING (order_date)
WINDOW w AS (ORDER BY order_date ROWS 6 PRECEDING)
""",
)(lambda s, sf: Commerce(s, sf).sales)

register(
    "top1_per_group",
    "d: order_date | s: top_category | f2: top_category_revenue",
    "SELECT * FROM x_topcat",
)(lambda s, sf: cm.top_category_per_day(Commerce(s, sf).categories))

register(
    "top_payment_per_day", "d: order_date | s: top_payment_type | f2: top_payment_total", "SELECT * FROM x_toppay"
)(lambda s, sf: cm.top_payment_per_day(Commerce(s, sf).orders, Commerce(s, sf).payments))

register(
    "running_total",
    "d: order_date | f2: gross_revenue cumulative_revenue",
    "SELECT order_date, gross_revenue, sum(gross_revenue) OVER (ORDER BY order_date) AS cumulative_revenue FROM x_daily",
)(
    lambda s, sf: cm.running_total(
        cm.daily_sales(Commerce(s, sf).fact), "gross_revenue", "order_date", "cumulative_revenue"
    )
)

register(
    "moving_avg_7d",
    "d: order_date | f4: revenue_7d_avg",
    "SELECT order_date, avg(CAST(gross_revenue AS DOUBLE)) OVER (ORDER BY order_date ROWS 6 PRECEDING) AS revenue_7d_avg "
    "FROM x_daily",
)(
    lambda s, sf: cm.daily_sales(Commerce(s, sf).fact).withColumn(
        "revenue_7d_avg", moving_avg(F.col("gross_revenue"), 7, "order_date")
    )
)

_MONTHLY_SQL = """
SELECT *, strftime(month, '%Y-%m') AS year_month,
       round(CAST(gross_revenue - lag(gross_revenue) OVER w AS DOUBLE) / CAST(lag(gross_revenue) OVER w AS DOUBLE) * 100, 1) AS revenue_mom_pct,
       round(CAST(order_count - lag(order_count) OVER w AS DOUBLE) / lag(order_count) OVER w * 100, 1) AS orders_mom_pct
FROM (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(*) AS order_count,
             sum(total_order_value) AS gross_revenue, sum(total_product_value) AS net_revenue,
             sum(total_freight) AS freight_revenue, CAST(sum(total_order_value) AS DOUBLE) / count(*) AS avg_order_value,
             sum(total_items) AS items_sold, count(DISTINCT customer_unique_id) AS unique_customers,
             avg(avg_review_score) AS avg_review, count(*) FILTER (is_canceled) AS canceled_orders
      FROM x_fact GROUP BY 1)
WINDOW w AS (ORDER BY month)
"""
_MONTHLY = (
    "d: month | s: year_month | i: order_count | f2: gross_revenue net_revenue freight_revenue | e: avg_order_value "
    "| i: items_sold unique_customers | f: avg_review | i: canceled_orders | f1: revenue_mom_pct orders_mom_pct"
)
register("monthly_sales", _MONTHLY, _MONTHLY_SQL)(lambda s, sf: cm.mart_sales_monthly(Commerce(s, sf).fact))
register("mom_growth", "d: month | f1: revenue_mom_pct orders_mom_pct", _MONTHLY_SQL)(
    lambda s, sf: cm.mart_sales_monthly(Commerce(s, sf).fact)
)

@register(
    "mv_daily_revenue",
    "d: order_date | f2: revenue | i: order_count",
    "SELECT order_date, sum(total_order_value) AS revenue, count(*) AS order_count FROM x_fact GROUP BY 1",
)
def _daily_revenue(s, sf):
    """Most orders as they were first seen, then the rest and the corrected ones; the view follows both steps."""
    placed = Commerce(s, sf).placed.select("order_id", "order_date", "total_order_value")
    orders = KeyedTable(s, scratch_path(s, "orders"), ["order_id"], buckets=16)
    early = F.pmod(F.xxhash64("order_id"), F.lit(10))
    wrong = early == 1  # seen first with another day and value
    first = placed.where(early > 0).withColumns(
        {
            "order_date": F.when(wrong, F.date_add("order_date", 1)).otherwise(F.col("order_date")),
            "total_order_value": F.when(wrong, F.col("total_order_value") * 2).otherwise(F.col("total_order_value")).cast(placed.schema["total_order_value"].dataType),
        }
    )
    return cm.maintained_daily_revenue(orders, [first, placed.where(early <= 1)], scratch_path(s, "revenue"))

_LOGDAY = (
    "d: order_date | i: delivered_orders | f: avg_delivery_days median_delivery_days p95_delivery_days "
    "| e: avg_freight | f2: total_freight | f: on_time_rate_pct avg_review | i: late_deliveries | f: avg_late_days"
)
register("daily_logistics", _LOGDAY, "SELECT * FROM x_logday")(lambda s, sf: cm.daily_logistics(Commerce(s, sf).placed))
register(
    "mart_logistics",
    _LOGDAY + " | f: delivery_days_7d_avg on_time_rate_7d_avg",
    "SELECT *, avg(avg_delivery_days) OVER w AS delivery_days_7d_avg, avg(on_time_rate_pct) OVER w AS on_time_rate_7d_avg "
    "FROM x_logday WINDOW w AS (ORDER BY order_date ROWS 6 PRECEDING)",
)(lambda s, sf: cm.mart_logistics(Commerce(s, sf).placed))

register(
    "logistics_by_state",
    "s: state | i: total_deliveries | f1: avg_delivery_days | f2: avg_freight | f1: on_time_rate_pct "
    "| f2: avg_review avg_order_value total_freight_revenue",
    """
SELECT c.state, count(*) AS total_deliveries, avg(days_to_deliver) AS avg_delivery_days,
       CAST(sum(total_freight) AS DOUBLE) / count(*) AS avg_freight,
       100.0 * count(*) FILTER (delivery_delta_days >= 0) / count(*) AS on_time_rate_pct,
       avg(avg_review_score) AS avg_review, CAST(sum(total_order_value) AS DOUBLE) / count(*) AS avg_order_value,
       sum(total_freight) AS total_freight_revenue
FROM x_fact JOIN x_c c USING (customer_id) WHERE is_delivered GROUP BY 1
""",
)(lambda s, sf: cm.logistics_by_state(Commerce(s, sf).placed, Commerce(s, sf).customers))

register(
    "percentile_exact",
    "d: order_date | f: median_delivery_days p95_delivery_days",
    "SELECT * FROM x_logday",
)(
    lambda s, sf: cm.group_percentiles(
        Commerce(s, sf).orders.where("is_delivered").withColumn("order_date", F.to_date("purchased_at")),
        ["order_date"], "days_to_deliver", {"median_delivery_days": 0.5, "p95_delivery_days": 0.95},
    )
)


@register(
    "agg_conditional_sum",
    "s: state | f2: delivered_value other_value",
    "SELECT c.state, sum(CASE WHEN is_delivered THEN total_order_value ELSE 0 END) AS delivered_value, "
    "sum(CASE WHEN is_delivered THEN 0 ELSE total_order_value END) AS other_value "
    "FROM x_fact JOIN x_c c USING (customer_id) GROUP BY 1",
)
def _conditional_sum(s, sf):
    m = Commerce(s, sf)
    value, done = F.col("total_order_value"), F.col("is_delivered")
    return (
        m.fact.join(m.customers.select("customer_id", "state"), "customer_id").groupBy("state")
        .agg(
            F.sum(F.when(done, value).otherwise(0)).alias("delivered_value"),
            F.sum(F.when(done, 0).otherwise(value)).alias("other_value"),
        )
    )


@register(
    "agg_filter",
    "s: order_status | f: quick_approval_pct",
    "SELECT order_status, 100.0 * count(*) FILTER (hours_to_approve <= 12) / count(*) AS quick_approval_pct "
    "FROM x_o GROUP BY 1",
)
def _agg_filter(s, sf):
    quick = ratio(F.count_if(F.col("hours_to_approve") <= 12) * 100, F.count("*"))
    return Commerce(s, sf).orders.groupBy("order_status").agg(quick.alias("quick_approval_pct"))


_RFM_SQL = f"""
SELECT *, recency_score + frequency_score + monetary_score AS rfm_total,
       concat(recency_score, frequency_score, monetary_score) AS rfm_code,
       {segment_case(fv.RFM_SEGMENTS, fv.RFM_REMAINDER, 'recency_score', 'frequency_score', 'monetary_score')} AS rfm_segment,
       CASE WHEN customer_lifetime_days > 0 THEN round(CAST(total_spend AS DOUBLE) / customer_lifetime_days * 365, 2)
            ELSE CAST(total_spend AS DOUBLE) END AS estimated_annual_value,
       last_order_at < (SELECT max(last_order_at) FROM x_metrics) - INTERVAL 90 DAY AS is_churned
FROM (SELECT *, ntile(5) OVER (ORDER BY last_order_at DESC, customer_unique_id) AS recency_score,
             ntile(5) OVER (ORDER BY order_count, customer_unique_id) AS frequency_score,
             ntile(5) OVER (ORDER BY total_spend, customer_unique_id) AS monetary_score
      FROM x_tiers WHERE order_count > 0)
"""
_RFM = (
    "i: customer_unique_id recency_score frequency_score monetary_score rfm_total | s: rfm_code rfm_segment "
    "| f2: estimated_annual_value | b: is_churned"
)
register("mart_customers", _TIERS + " | " + _RFM.split("customer_unique_id", 1)[0].strip() + _RFM.split("customer_unique_id", 1)[1], _RFM_SQL)(
    lambda s, sf: cm.mart_customers(Commerce(s, sf).dim_customers)
)
register("rfm_scores", _RFM, _RFM_SQL)(lambda s, sf: cm.mart_customers(Commerce(s, sf).dim_customers))


@register(
    "rfm_scores_large",
    _RFM,
    _RFM_SQL,
)
def _rfm_large(s, sf):
    """The boundary-row path used beyond the single-task bound, forced here at any size."""
    return cm.mart_customers(cm.dim_customers(Commerce(s, sf).metrics))


# --- dashboard ----------------------------------------------------------------------------


def _raw(s, sf):
    return ad.raw_orders(s, sf), ad.raw_order_items(s, sf), ad.raw_reviews(s, sf)


register(
    "kpis",
    "i: total_orders | f2: total_revenue | i: total_customers | f2: avg_order_value | f1: avg_delivery_days "
    "| f2: avg_review_score | f1: on_time_delivery_pct",
    f"""
SELECT count(DISTINCT o.order_id) AS total_orders, coalesce(sum(i.price + i.freight_value), 0) AS total_revenue,
       count(DISTINCT o.customer_id) AS total_customers,
       CAST(sum(i.price + i.freight_value) AS DOUBLE) / count(i.price) AS avg_order_value,
       avg(date_diff('microsecond', o.bought, o.arrived) / 86400e6) AS avg_delivery_days,
       avg(r.review_score) AS avg_review_score,
       (SELECT 100.0 * count(*) FILTER (arrived <= promised) / count(*) FROM x_ro
        WHERE order_status = 'delivered' AND arrived IS NOT NULL) AS on_time_delivery_pct
FROM x_ro o LEFT JOIN x_ri i ON i.order_id = o.order_id LEFT JOIN x_rev r ON r.order_id = o.order_id
WHERE o.order_status = 'delivered'
""",
)(lambda s, sf: db.kpis(*_raw(s, sf)))

_TREND_SQL = """
SELECT * FROM (
  SELECT CAST(date_trunc('{unit}', o.bought) AS DATE) AS period, sum(i.price + i.freight_value) AS revenue,
         count(DISTINCT o.order_id) AS order_count
  FROM x_ro o JOIN x_ri i USING (order_id) WHERE o.order_status <> 'canceled' {where}
  GROUP BY 1 ORDER BY 1 DESC {limit}) ORDER BY period
"""
_TREND = "d: period | f2: revenue | i: order_count"
register("revenue_trends", _TREND, _TREND_SQL.format(unit="month", where="", limit="LIMIT 60"))(
    lambda s, sf: db.revenue_trends(*_raw(s, sf)[:2], limit=60)
)
register("revenue_trends_weekly", _TREND, _TREND_SQL.format(unit="week", where="", limit="LIMIT 60"))(
    lambda s, sf: db.revenue_trends(*_raw(s, sf)[:2], granularity="weekly", limit=60)
)
register(
    "date_range_filter", _TREND,
    _TREND_SQL.format(unit="day", where="AND o.bought >= TIMESTAMP '1996-01-01' AND o.bought <= TIMESTAMP '1996-12-31'", limit=""),
)(
    lambda s, sf: db.revenue_trends(
        *_raw(s, sf)[:2], granularity="daily", start="1996-01-01", end="1996-12-31"
    )
)

_TOP = "s: product_category | f2: revenue | i: order_count | f2: avg_review_score"
_TOP_SQL = """
SELECT coalesce(p.category_pt, 'unknown') AS product_category, sum(i.price + i.freight_value) AS revenue,
       count(DISTINCT i.order_id) AS order_count, avg(r.review_score) AS avg_review_score
FROM x_ri i JOIN x_ro o USING (order_id) JOIN x_p p USING (product_id) LEFT JOIN x_rev r ON r.order_id = o.order_id
WHERE o.order_status <> 'canceled' GROUP BY 1 ORDER BY revenue DESC LIMIT {n}
"""


def _top(s, sf, n):
    orders, items, reviews = _raw(s, sf)
    return db.top_products(orders, items, ad.raw_products(s, sf), reviews, limit=n)


register("top_products", _TOP, _TOP_SQL.format(n=20))(lambda s, sf: _top(s, sf, 20))
register("top_k", _TOP, _TOP_SQL.format(n=3))(lambda s, sf: _top(s, sf, 3))

_SEGMENT_SQL = f"""
SELECT segment, count(*) AS customer_count, CAST(sum(money) AS DOUBLE) / count(*) AS avg_monetary,
       100.0 * count(*) / sum(count(*)) OVER () AS pct_of_total
FROM (SELECT *, {segment_case(fv.RFM_DASHBOARD_SEGMENTS, fv.RFM_DASHBOARD_REMAINDER, 'r', 'f', 'm')} AS segment
      FROM (SELECT *, ntile(5) OVER (ORDER BY newest DESC, customer_id) AS r, ntile(5) OVER (ORDER BY n, customer_id) AS f,
                   ntile(5) OVER (ORDER BY money, customer_id) AS m
            FROM (SELECT customer_id, max(bought) AS newest, count(DISTINCT order_id) AS n,
                         sum(price + freight_value) AS money
                  FROM x_ro JOIN x_ri USING (order_id) WHERE order_status = 'delivered' GROUP BY 1)))
GROUP BY 1
"""
register("rfm_segments_kpi", "s: segment | i: customer_count | f2: avg_monetary | f1: pct_of_total", _SEGMENT_SQL)(
    lambda s, sf: db.customer_segments(*_raw(s, sf)[:2])
)

register(
    "delivery_performance",
    "f1: avg_delivery_days on_time_pct late_pct | f2: avg_freight_value | i: total_delivered",
    """
SELECT avg(date_diff('microsecond', bought, arrived) / 86400e6) AS avg_delivery_days,
       100.0 * count(*) FILTER (arrived <= promised) / count(*) AS on_time_pct,
       100.0 * count(*) FILTER (arrived > promised) / count(*) AS late_pct, count(*) AS total_delivered,
       (SELECT CAST(sum(freight_value) AS DOUBLE) / count(*) FROM x_ri JOIN x_ro USING (order_id)
        WHERE order_status = 'delivered') AS avg_freight_value
FROM x_ro WHERE order_status = 'delivered' AND arrived IS NOT NULL
""",
)(lambda s, sf: db.delivery_performance(*_raw(s, sf)[:2]))

_STATUS_SQL = (
    "SELECT order_status AS status, count(*) AS count, 100.0 * count(*) / sum(count(*)) OVER () AS pct FROM x_ro GROUP BY 1"
)
register("order_status_distribution", "s: status | i: count | f1: pct", _STATUS_SQL)(
    lambda s, sf: db.order_status_distribution(ad.raw_orders(s, sf))
)
register("percent_of_total", "s: status | f1: pct", _STATUS_SQL)(
    lambda s, sf: db.order_status_distribution(ad.raw_orders(s, sf))
)


@register(
    "order_by",
    "s: state | i: total_deliveries",
    "SELECT c.state, count(*) AS total_deliveries FROM x_fact JOIN x_c c USING (customer_id) WHERE is_delivered "
    "GROUP BY 1 ORDER BY 2 DESC, 1",
)
def _order_by(s, sf):
    m = Commerce(s, sf)
    return (
        m.orders.where("is_delivered").join(m.customers, "customer_id").groupBy("state")
        .agg(F.count("*").alias("total_deliveries")).orderBy(F.desc("total_deliveries"), "state")
    )


@register(
    "predicates",
    "i: order_id customer_id | s: order_status | f: days_to_deliver",
    "SELECT * FROM x_o WHERE delivered_at IS NOT NULL AND days_to_deliver BETWEEN 3 AND 20 AND order_status IN ('delivered', 'shipped') "
    "AND order_status NOT IN ('canceled') AND order_status LIKE 'del%' AND customer_id <> 7 AND (is_delivered OR is_canceled)",
)
def _predicates(s, sf):
    status = F.col("order_status")
    return Commerce(s, sf).orders.where(
        F.col("delivered_at").isNotNull()
        & F.col("days_to_deliver").between(3, 20)
        & status.isin("delivered", "shipped")
        & ~status.isin("canceled")
        & status.like("del%")
        & (F.col("customer_id") != 7)
        & (F.col("is_delivered") | F.col("is_canceled"))
    )
