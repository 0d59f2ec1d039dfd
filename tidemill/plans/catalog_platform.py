"""Registered source, sink, quality, incremental and streaming queries with their SQL.

Queries that write do so under the shared folder and return what a reader sees afterwards.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill import schemas
from tidemill.operators import incremental as inc
from tidemill.operators import quality as dq
from tidemill.plans import adapters as ad
from tidemill.plans import commerce as cm
from tidemill.plans.commerce import Commerce
from tidemill.plans.guard import capped_query
from tidemill.plans.macro import Macro
from tidemill.plans.market import Market
from tidemill.plans.oracle_tables import sql_list
from tidemill.plans.registry import register
from tidemill.session import scratch_path
from tidemill.sources import sinks
from tidemill.sources import tables as tb
from tidemill.sources.keyed import KeyedTable
from tidemill.streaming import bars as sbars
from tidemill.streaming import ingest

# --- CSV, validation, landing ---------------------------------------------------------------


def _land_csv(s, sf) -> str:
    """Reviews and orders as CSV files with dirty scores, blanks and missing keys."""
    root = scratch_path(s, "csv")
    key = F.col("review_id")
    score = (
        F.when(key % 11 == 0, F.lit("abc")).when(key % 13 == 0, F.lit("")).when(key % 17 == 0, F.lit("6"))
        .otherwise(F.col("review_score").cast("string"))
    )
    shown = ad.raw_reviews(s, sf).select(
        key.cast("string").alias("review_id"),
        F.when(key % 19 != 0, F.col("order_id").cast("string")).alias("order_id"),
        score.alias("review_score"),
        "review_comment_title",
        F.concat(F.lit('said "'), F.lit('ok", thanks')).alias("review_comment_message"),
        F.date_format("review_creation_date", "yyyy-MM-dd HH:mm:ss").alias("review_creation_date"),
        F.when(key % 23 == 0, F.lit("soon")).otherwise(F.date_format("review_answer_timestamp", "yyyy-MM-dd HH:mm:ss"))
        .alias("review_answer_timestamp"),
    )
    keep_spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    shown.write.options(header=True, escape='"', **keep_spaces).csv(f"{root}/reviews.csv")
    return root


_DIRTY = """
SELECT review_id, order_id AS o, review_score AS sc, created_at, answered_at,
       CASE WHEN review_id % 11 = 0 THEN 'abc' WHEN review_id % 13 = 0 THEN NULL WHEN review_id % 17 = 0 THEN '6' ELSE CAST(review_score AS VARCHAR) END AS shown,
       CASE WHEN review_id % 19 <> 0 THEN CAST(order_id AS VARCHAR) END AS order_id, review_id % 23 <> 0 AS dated
FROM x_rev
"""


@register(
    "read_csv_table",
    "s: review_id order_id review_score review_comment_message review_creation_date",
    f"SELECT review_id, order_id, shown AS review_score, 'said \"ok\", thanks' AS review_comment_message, "
    f"strftime(created_at, '%Y-%m-%d %H:%M:%S') AS review_creation_date FROM ({_DIRTY})",
)
def _read_csv(s, sf):
    return tb.blanks_to_null(tb.read_csv_table(s, _land_csv(s, sf), "reviews"))


def _tagged(s, sf) -> DataFrame:
    return tb.tag_rows(tb.read_csv_table(s, _land_csv(s, sf), "reviews"), schemas.COMMERCE["reviews"], tb.SCORE_RANGE)


_OK = "order_id IS NOT NULL AND TRY_CAST(shown AS INTEGER) BETWEEN 1 AND 5 AND dated"
register(
    "validate_rows",
    "s: review_id order_id | i: review_score | t: review_creation_date review_answer_timestamp",
    f"SELECT review_id, order_id, shown AS review_score, created_at AS review_creation_date, answered_at AS review_answer_timestamp "
    f"FROM ({_DIRTY}) WHERE {_OK}",
)(lambda s, sf: tb.valid_rows(_tagged(s, sf)))
register(
    "validate_errors",
    "s: error | i: rows",
    f"""
SELECT CASE WHEN order_id IS NULL THEN 'order_id: missing' WHEN shown IS NULL THEN 'review_score: missing'
            WHEN shown = 'abc' THEN 'review_score: not a int' WHEN NOT dated THEN 'review_answer_timestamp: not a timestamp'
            ELSE 'review_score: must be 1-5' END AS error, count(*) AS rows
FROM ({_DIRTY}) WHERE ({_OK}) IS NOT TRUE GROUP BY 1
""",
)(lambda s, sf: tb.error_rows(_tagged(s, sf)).groupBy("error").agg(F.count("*").alias("rows")))
register(
    "ingest_report",
    "s: table_name | i: raw_count valid_count error_count",
    f"SELECT 'reviews' AS table_name, count(*) AS raw_count, count(*) FILTER ({_OK}) AS valid_count, "
    f"count(*) - count(*) FILTER ({_OK}) AS error_count FROM ({_DIRTY})",
)(lambda s, sf: tb.ingest_report({"reviews": _tagged(s, sf)}))

_BRONZE = ["review_id", "order_id", "review_score", "review_comment_title", "not_landed"]
register(
    "load_bronze",
    "s: review_id order_id review_score review_comment_title not_landed | b: has_source",
    f"SELECT d.review_id, d.order_id, shown AS review_score, CASE WHEN o % 3 <> 0 THEN ' fine ' END AS review_comment_title, "
    f"NULL AS not_landed, TRUE AS has_source FROM ({_DIRTY}) d",
)(
    lambda s, sf: tb.load_bronze(
        tb.read_csv_table(s, _land_csv(s, sf), "reviews").select("*", "_metadata"), _BRONZE
    ).withColumn("has_source", F.contains("source_file", F.lit("reviews.csv")))
)


def _landed_orders(s, sf) -> str:
    path = tb.lake_path(scratch_path(s, "lake"), "bronze", "commerce", "orders")
    orders = ad.raw_orders(s, sf).select("order_id", "customer_id", "order_status")
    tb.write_partition(orders.where("order_status = 'created'"), path, "2024-01-01")
    tb.write_partition(orders.where("order_status = 'canceled'"), path, "2024-01-02")
    tb.write_partition(orders.where("order_status = 'delivered'"), path, "2024-01-02")
    return path


register(
    "write_partition",
    "i: order_id customer_id | s: order_status | d: ingest_date",
    "SELECT order_id, customer_id, order_status, CASE order_status WHEN 'created' THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END AS ingest_date "
    "FROM x_ro WHERE order_status <> 'canceled'",
)(lambda s, sf: s.read.parquet(_landed_orders(s, sf)))
register(
    "read_latest_partition",
    "i: order_id customer_id | s: order_status | d: ingest_date",
    "SELECT order_id, customer_id, order_status, DATE '2024-01-02' AS ingest_date FROM x_ro WHERE order_status = 'delivered'",
)(lambda s, sf: tb.read_latest_partition(s, _landed_orders(s, sf))[1])

# --- other sources and sinks ----------------------------------------------------------------

_NAMES = ["customer", "lineitem", "nation", "orders", "part", "region", "supplier"]


def _frames(s, sf) -> dict[str, DataFrame]:
    return tb.read_many_tables({n: lambda n=n: ad.table(s, sf, n) for n in [*_NAMES, "no_such_table"]})[0]


_COUNTS = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in _NAMES)
register("read_many_tables", "s: table_name | i: row_count", _COUNTS)(lambda s, sf: tb.table_counts(_frames(s, sf)))
register(
    "source_row_counts",
    "s: source_id table_name | i: row_count total_rows",
    f"SELECT *, sum(row_count) OVER (PARTITION BY source_id) AS total_rows FROM (SELECT *, CASE WHEN table_name[1] IN ('c', 'o', 'l') "
    f"THEN 'shop' ELSE 'catalog' END AS source_id FROM ({_COUNTS}))",
)(
    lambda s, sf: tb.source_row_counts(
        {("shop_" if n[0] in "col" else "catalog_") + n: f for n, f in _frames(s, sf).items()},
        {"shop": "shop_", "catalog": "catalog_"},
    ).withColumn("table_name", F.regexp_replace("table_name", "^(shop|catalog)_", ""))
)


@register(
    "profile_source",
    "s: table_name | i: columns row_count",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, (SELECT count(*) FROM (DESCRIBE {n})) AS columns, count(*) AS row_count FROM {n}" for n in _NAMES
    ),
)
def _profile(s, sf):
    for n, f in _frames(s, sf).items():
        f.createOrReplaceTempView(f"profiled_{n}")
    seen = tb.profile_source(s).where(F.col("table_name").startswith("profiled_"))
    return seen.groupBy(F.regexp_replace("table_name", "^profiled_", "").alias("table_name")).agg(
        F.count("*").alias("columns"), F.max("row_count").alias("row_count")
    )


register(
    "read_parquet_glob",
    "i: o_orderkey is_imputed | s: data_source",
    "SELECT o_orderkey, 0 AS is_imputed, 'archive' AS data_source FROM orders",
)(lambda s, sf: tb.read_parquet_glob(s, f"{sf}/orders*.parquet", data_source="archive", is_imputed=0))


@register(
    "export_partitioned",
    "s: yyyymm | i: rows",
    "SELECT strftime(o_orderdate, '%Y%m') AS yyyymm, count(*) AS rows FROM orders GROUP BY 1",
)
def _export(s, sf):
    path = scratch_path(s, "gold")
    sinks.export_partitioned(ad.table(s, sf, "orders"), path, "o_orderdate")
    return s.read.parquet(path).groupBy("yyyymm").agg(F.count("*").alias("rows"))


@register(
    "export_marts",
    "s: mart | d: ingest_date | i: rows",
    "SELECT 'status' AS mart, DATE '2024-05-01' AS ingest_date, count(DISTINCT order_status) AS rows FROM x_ro "
    "UNION ALL SELECT 'daily', DATE '2024-05-01', count(*) FROM x_daily",
)
def _export_marts(s, sf):
    m = Commerce(s, sf)
    status = m.orders.groupBy("order_status").agg(F.count("*").alias("n"))
    paths = sinks.export_marts({"status": status, "daily": cm.daily_sales(m.fact)}, scratch_path(s, "archive"), "2024-05-01")
    parts = [
        s.read.parquet(p).groupBy("ingest_date").agg(F.count("*").alias("rows")).withColumn("mart", F.lit(n))
        for n, p in paths.items()
    ]
    return parts[0].unionByName(parts[1])


@register(
    "replace_table",
    "i: order_id | s: order_status",
    "SELECT order_id, order_status FROM x_ro WHERE order_status <> 'canceled'",
)
def _replace(s, sf):
    path = scratch_path(s, "serving")
    sinks.replace_table(ad.raw_orders(s, sf).select("order_id", "order_status"), path)
    sinks.replace_table(sinks.current_version(s, path).where("order_status <> 'canceled'"), path)
    return sinks.current_version(s, path)


@register(
    "export_csv",
    "i: c_custkey | s: c_name",
    "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 1000",
)
def _export_csv(s, sf):
    path = scratch_path(s, "head")
    sinks.export_head(ad.table(s, sf, "customer").select("c_custkey", "c_name"), path, 1000, order=["c_custkey"])
    return s.read.csv(path, header=True, schema="c_custkey bigint, c_name string")


@register(
    "capped_query",
    "s: o_orderstatus | i: orders",
    "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1",
)
def _capped(s, sf):
    ad.table(s, sf, "orders").createOrReplaceTempView("capped_orders")
    return capped_query(s, "SELECT o_orderstatus, count(*) AS orders FROM capped_orders GROUP BY 1;", 1000).rows


# --- quality --------------------------------------------------------------------------------

register(
    "fk_orphans",
    "i: order_id item_seq product_id seller_id",
    "SELECT * FROM x_ri WHERE order_id NOT IN (SELECT order_id FROM x_ro WHERE order_status = 'delivered')",
)(
    lambda s, sf: dq.fk_orphans(
        Commerce(s, sf).items, "order_id", ad.raw_orders(s, sf).where("order_status = 'delivered'"), "order_id"
    )
)
register(
    "value_set_difference",
    "s: p_type",
    "SELECT DISTINCT p_type FROM part WHERE p_type NOT IN ('PROMO', 'SMALL')",
)(lambda s, sf: dq.value_set_difference(ad.table(s, sf, "part"), "p_type", ["PROMO", "SMALL"]))

_PLACED = "SELECT count(*) FROM x_ro WHERE order_status <> 'canceled'"
register(
    "check_row_count_match",
    "s: check_name | b: passed | f: observed",
    f"SELECT 'row_count:orders' AS check_name, observed < 5 AS passed, observed FROM (SELECT 100.0 * abs(count(*) - ({_PLACED})) / count(*) AS observed FROM x_ro)",
)(
    lambda s, sf: dq.check_row_count_match(
        "orders", ad.raw_orders(s, sf), ad.raw_orders(s, sf).where("order_status <> 'canceled'")
    ).withColumnRenamed("check", "check_name")
)


def _named(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("check", "check_name")


def _landed(s, sf) -> dict[str, DataFrame]:
    """The landed commerce tables; payment types and states come from the given data."""
    return {
        "orders": ad.raw_orders(s, sf),
        "order_items": ad.raw_order_items(s, sf),
        "customers": ad.raw_customers(s, sf),
        "products": ad.raw_products(s, sf),
        "sellers": ad.raw_sellers(s, sf),
        "payments": ad.raw_payments(s, sf),
        "reviews": ad.raw_reviews(s, sf),
        "geolocation": ad.raw_geolocation(s, sf),
    }


_CHK = "s: check_name | b: passed | f: observed"


def _checks_sql(rows: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, o = 0 AS passed, o AS observed FROM (SELECT CAST(({q}) AS DOUBLE) AS o)" for n, q in rows
    )


_NULLS = [
    ("not_null:reviews.review_id", "SELECT count(*) - count(review_id) FROM x_rev"),
    ("not_null:reviews.review_comment_message", "SELECT count(*) FILTER (order_id % 4 = 0) FROM x_rev"),
]
register("check_not_null", _CHK, _checks_sql(_NULLS))(
    lambda s, sf: _named(dq.check_not_null("reviews", ad.raw_reviews(s, sf), ["review_id", "review_comment_message"]))
)
_FK = [("fk:order_items.product_id->products.product_id", "SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)")]
register("check_fk", _CHK, _checks_sql(_FK))(
    lambda s, sf: _named(
        dq.check_fk(
            "order_items", ad.raw_order_items(s, sf), "product_id", "products",
            ad.raw_products(s, sf).where("product_length_cm > 10"), "product_id",
        )
    )
)
_RANGE = [
    ("range:order_items.price", "SELECT count(*) FROM x_ri WHERE price < 2000 OR price > 90000"),
    ("range:order_items.freight_value", "SELECT count(*) FROM x_ri WHERE freight_value < 0"),
]
register("check_range", _CHK, _checks_sql(_RANGE))(
    lambda s, sf: _named(
        dq.check_range("order_items", ad.raw_order_items(s, sf), {"price": (2000, 90000), "freight_value": (0, None)})
    )
)
_SET = [("enum:orders.order_status", f"SELECT count(DISTINCT order_status) FROM x_ro WHERE order_status NOT IN ({sql_list(fv.ORDER_STATUSES[:2])})")]
register("check_allowed", _CHK, _checks_sql(_SET))(
    lambda s, sf: _named(dq.check_allowed("orders", ad.raw_orders(s, sf), "order_status", fv.ORDER_STATUSES[:2]))
)

_REPORT = (
    [(f"not_null:{t}.{c}", "SELECT 0") for t, cols in fv.REQUIRED_COLUMNS.items() if t != "category_translation" for c in cols]
    + [(f"fk:{a}.{b}->{c}.{d}", "SELECT 0") for a, b, c, d in fv.FOREIGN_KEYS]
    + [
        ("range:reviews.review_score", "SELECT count(*) FROM x_rev WHERE review_score NOT BETWEEN 1 AND 5"),
        ("range:order_items.price", "SELECT count(*) FROM x_ri WHERE price < 0"),
        ("range:order_items.freight_value", "SELECT count(*) FROM x_ri WHERE freight_value < 0"),
        ("range:payments.payment_value", "SELECT count(*) FROM x_pay WHERE payment_value < 0"),
        ("enum:orders.order_status", f"SELECT count(DISTINCT order_status) FROM x_ro WHERE order_status NOT IN ({sql_list(fv.ORDER_STATUSES)})"),
        ("enum:payments.payment_type", "SELECT count(DISTINCT payment_type) FROM x_pay"),
        ("enum:customers.customer_state", "SELECT count(DISTINCT state) FROM x_c"),
        ("enum:sellers.seller_state", "SELECT count(DISTINCT state) FROM x_s"),
    ]
)
register(
    "quality_report",
    _CHK + " | f: pass_ratio",
    f"SELECT *, avg(CAST(passed AS INTEGER)) OVER () AS pass_ratio FROM ({_checks_sql(_REPORT)})",
)(lambda s, sf: _named(dq.quality_report(dq.commerce_checks(_landed(s, sf)))))

_SUITE = [
    {"type": "row_count_between", "min_value": 10},
    {"type": "column_exists", "column": "order_status"},
    {"type": "column_exists", "column": "nothing"},
    {"type": "not_null", "column": "delivered_at"},
    {"type": "unique", "column": "order_id"},
    {"type": "unique", "column": "customer_id"},
    {"type": "in_set", "column": "order_status", "value_set": ["delivered", "created"]},
    {"type": "between", "column": "days_to_deliver", "min_value": 3, "max_value": 25},
    {"type": "unique_combination", "columns": ["customer_id", "purchased_at"]},
    {"type": "median_near", "column": "order_id"},
]
_SUITE_SQL = _checks_sql(
    [
        ("4:not_null:delivered_at", "SELECT count(*) - count(delivered_at) FROM x_o"),
        ("5:unique:order_id", "SELECT count(order_id) - count(DISTINCT order_id) FROM x_o"),
        ("6:unique:customer_id", "SELECT count(customer_id) - count(DISTINCT customer_id) FROM x_o"),
        ("7:in_set:order_status", "SELECT count(*) FROM x_o WHERE order_status NOT IN ('delivered', 'created')"),
        ("8:between:days_to_deliver", "SELECT count(*) FROM x_o WHERE days_to_deliver < 3 OR days_to_deliver > 25"),
        ("9:unique_combination", "SELECT count(*) - count(DISTINCT (customer_id, purchased_at)) FROM x_o"),
        ("10:median_near:order_id", "SELECT 0"),
    ]
) + (
    " UNION ALL SELECT '1:row_count_between', count(*) >= 10, count(*) FROM x_o UNION ALL SELECT '2:column_exists:order_status', TRUE, 1 "
    "UNION ALL SELECT '3:column_exists:nothing', FALSE, 0"
)
register("expect_suite", _CHK, _SUITE_SQL)(lambda s, sf: _named(dq.expect_suite(Commerce(s, sf).orders, _SUITE)))
register(
    "suite_summary",
    "s: suite | i: total passed failed | b: success",
    f"SELECT 'orders' AS suite, count(*) AS total, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed, "
    f"bool_and(passed) AS success FROM ({_SUITE_SQL})",
)(lambda s, sf: dq.suite_summary(dq.expect_suite(Commerce(s, sf).orders, _SUITE), "orders"))

_REGIMES = ["goldilocks", "overheating", "stagflation", "recession", "recovery", "transition"]


@register(
    "dbt_tests",
    _CHK,
    _checks_sql(
        [
            ("1:not_null:observation_date", "SELECT 0"),
            ("2:unique:observation_date", "SELECT 0"),
            ("3:in_set:economic_regime", f"SELECT count(*) FROM x_econ WHERE economic_regime NOT IN ({sql_list(_REGIMES)})"),
            ("4:in_set:monetary_policy_stance", "SELECT count(*) FROM x_econ WHERE monetary_policy_stance NOT IN ('tight', 'loose')"),
            ("5:unique_combination", "SELECT count(*) - count(DISTINCT (observation_year, observation_quarter)) FROM x_econ"),
        ]
    ),
)
def _model_tests(s, sf):
    return _named(
        dq.expect_suite(
            Macro(s, sf).indicators,
            [
                {"type": "not_null", "column": "observation_date"},
                {"type": "unique", "column": "observation_date"},
                {"type": "in_set", "column": "economic_regime", "value_set": _REGIMES},
                {"type": "in_set", "column": "monetary_policy_stance", "value_set": ["tight", "loose"]},
                {"type": "unique_combination", "columns": ["observation_year", "observation_quarter"]},
            ],
        )
    )


register(
    "test_freshness",
    "s: model_name | t: last_update | f: hours_since_update",
    "SELECT 'events' AS model_name, max(ts) AS last_update, (epoch_us(TIMESTAMP '2024-02-05') - epoch_us(max(ts))) / 3600e6 AS hours_since_update FROM events",
)(lambda s, sf: dq.freshness_test(ad.table(s, sf, "events"), "ts", F.lit("2024-02-05 00:00:00"), 24, "events"))
register(
    "test_min_rows",
    "s: model_name | i: row_count",
    "SELECT 'region' AS model_name, count(*) AS row_count FROM region HAVING count(*) < 100",
)(lambda s, sf: dq.min_rows_test(ad.table(s, sf, "region"), 100, "region"))
register(
    "test_null_pct",
    "s: model_name column_name | i: null_rows total_rows | f: null_percentage",
    "SELECT 'orders' AS model_name, 'delivered_at' AS column_name, count(*) - count(delivered_at) AS null_rows, count(*) AS total_rows, "
    "100.0 * (count(*) - count(delivered_at)) / count(*) AS null_percentage FROM x_o",
)(lambda s, sf: dq.null_pct_test(Commerce(s, sf).orders, ["order_id", "delivered_at"], 10, "orders"))
register(
    "mart_health",
    "s: mart status | i: row_count",
    "SELECT 'orders' AS mart, 'ok' AS status, count(*) AS row_count FROM orders UNION ALL "
    "SELECT 'nobody', 'empty', 0 UNION ALL SELECT 'lost', 'error', 0",
)(
    lambda s, sf: dq.mart_health(
        {"orders": ad.table(s, sf, "orders"), "nobody": ad.table(s, sf, "customer").where("c_custkey < 0")}, {"lost": "no such path"}
    )
)

# --- incremental ----------------------------------------------------------------------------


def _old_and_all(s, sf) -> tuple[DataFrame, DataFrame]:
    trades = Market(s, sf, intraday=True).trades
    return trades.where("trade_id % 10 < 7 AND trade_timestamp < '2024-01-20'"), trades


_TRADE_KEYS = "i: trade_id | s: symbol | t: ingested_at"
_MARK = "(SELECT max(ingested_at) FROM x_est WHERE trade_id % 10 < 7 AND trade_time < TIMESTAMP '2024-01-20')"
register("incremental_filter", _TRADE_KEYS, f"SELECT * FROM x_est WHERE ingested_at > {_MARK}")(
    lambda s, sf: inc.incremental_filter(_old_and_all(s, sf)[1], _old_and_all(s, sf)[0])
)
register("incremental_lookback", _TRADE_KEYS, f"SELECT * FROM x_est WHERE ingested_at > {_MARK} - INTERVAL 6 HOUR")(
    lambda s, sf: inc.incremental_lookback(_old_and_all(s, sf)[1], _old_and_all(s, sf)[0], hours=6)
)


@register(
    "merge_by_key",
    "i: trade_id | s: symbol note | e: price",
    "SELECT trade_id, symbol, CASE WHEN trade_time >= TIMESTAMP '2024-01-15' THEN 'updated' END AS note, "
    "CASE WHEN trade_time >= TIMESTAMP '2024-01-15' THEN CAST(price AS DOUBLE) * 2 ELSE CAST(price AS DOUBLE) END AS price FROM x_est",
)
def _merge(s, sf):
    """Older rows, and a batch that repeats and changes rows; the batch also brings a new column."""
    trades = Market(s, sf, intraday=True).trades.select("trade_id", "symbol", "price", "trade_timestamp")
    target = trades.where("trade_timestamp < '2024-01-20'")
    batch = trades.where("trade_timestamp >= '2024-01-15'")
    stale = batch.withColumns({"v": F.lit(1), "note": F.lit("stale")})
    fresh = batch.withColumns({"v": F.lit(2), "note": F.lit("updated"), "price": (F.col("price") * 2).cast("decimal(18,8)")})
    table = KeyedTable(s, scratch_path(s, "merged"), ["trade_id"])
    table.merge(target)
    # The batch's own versions only decide between its rows; the stored rows have none.
    table.merge(inc.latest_per_key(stale.unionByName(fresh), ["trade_id"], "v").drop("v"))
    return table.read()


@register(
    "scd2_snapshot",
    "s: coin_id | e: current_price_usd | t: valid_from valid_to | b: is_current",
    """
WITH v AS (SELECT coin_id, current_price_usd, last_updated_at AS t, CASE WHEN price_date < DATE '1997-01-01' THEN 1 WHEN price_date < DATE '1999-01-01' THEN 2 ELSE 3 END AS batch
           FROM x_coinstg),
     b AS (SELECT coin_id, batch, max(t) AS t, arg_max(current_price_usd, t) AS current_price_usd FROM v
           WHERE NOT (batch = 2 AND coin_id = 'dxy') AND NOT (batch = 3 AND coin_id = 'xau') GROUP BY 1, 2)
SELECT coin_id, current_price_usd, t AS valid_from,
       CASE WHEN coin_id = 'dxy' AND batch = 1 THEN TIMESTAMP '1999-01-01' WHEN coin_id = 'xau' AND batch = 2 THEN TIMESTAMP '2002-01-01'
            ELSE lead(t) OVER (PARTITION BY coin_id ORDER BY batch) END AS valid_to, valid_to IS NULL AS is_current
FROM b
""",
)
def _scd2(s, sf):
    """Three source states: one coin is gone from the second and returns, one is gone from the third."""
    coins = Market(s, sf).coins.select("coin_id", "current_price_usd", "last_updated_at", "price_date")
    day, key = F.col("price_date"), F.col("coin_id")
    batches = [
        (coins.where(day < "1997-01-01"), "1997-01-01"),
        (coins.where((day >= "1997-01-01") & (day < "1999-01-01") & (key != "dxy")), "1999-01-01"),
        (coins.where((day >= "1999-01-01") & (key != "xau")), "2002-01-01"),
    ]
    table = KeyedTable(s, scratch_path(s, "history"), ["coin_id"], buckets=16)
    for rows, as_of in batches:
        inc.scd2_apply(table, rows.drop("price_date"), "last_updated_at", F.lit(as_of).cast("timestamp"))
    return table.read()


@register(
    "checkpoint_store",
    "s: source_name table_name status | i: records_processed | t: checkpoint_value",
    "SELECT 'exchange' AS source_name, t AS table_name, CASE WHEN t = 'late' THEN 'failed' ELSE 'success' END AS status, "
    "CASE WHEN t = 'late' THEN 0 ELSE n END AS records_processed, m AS checkpoint_value "
    "FROM (SELECT 'trades' AS t, count(*) AS n, max(ingested_at) AS m FROM x_est UNION ALL SELECT 'late', 0, TIMESTAMP '2024-02-01')",
)
def _checkpoints(s, sf):
    store = inc.CheckpointStore(s, scratch_path(s, "marks"))
    top = Market(s, sf, intraday=True).trades.agg(F.count("*").alias("n"), F.max("ingested_at").cast("timestamp_ntz").alias("t")).first()
    early = datetime(2024, 1, 1)
    store.save("exchange", "trades", "ingested_at", early, 1, now=early)
    store.save("exchange", "trades", "ingested_at", top["t"], top["n"], now=datetime(2024, 2, 2))
    store.save("exchange", "late", "ingested_at", early, 5, now=early)
    store.save("exchange", "late", "ingested_at", datetime(2024, 2, 1), 0, "failed", "timeout", now=datetime(2024, 2, 2))
    return store.all()


@register(
    "incremental_load",
    _TRADE_KEYS,
    "SELECT * FROM x_est WHERE ingested_at >= TIMESTAMP '2024-01-15'",
)
def _incremental_load(s, sf):
    """Two runs: seven days up to the 22nd, then from the mark on; read back newest per key."""
    trades = Market(s, sf, intraday=True).trades
    store, path = inc.CheckpointStore(s, scratch_path(s, "marks")), scratch_path(s, "loaded")
    for now in (datetime(2024, 1, 22), datetime(2024, 2, 1)):
        inc.incremental_load(
            store, "exchange", "trades",
            lambda start, now=now: trades.where((F.col("ingested_at") >= inc.at(start)) & (F.col("ingested_at") < inc.at(now))),
            lambda batch: batch.write.mode("append").parquet(path),
            now=now,
        )
    return inc.latest_per_key(s.read.parquet(path), ["trade_id"], "ingested_at")


@register(
    "run_log",
    "s: source_schema source_table | d: run_date | i: row_count | s: status",
    "SELECT * FROM x_log",
)
def _run_log(s, sf):
    """Runs written to a log and read back."""
    path = scratch_path(s, "runs")
    ad.run_log(s, sf).write.mode("append").parquet(path)
    return s.read.parquet(path)


register(
    "run_once_per_date",
    "s: source_schema source_table | d: run_date",
    "SELECT a.source_schema, a.source_table, a.run_date FROM x_log a WHERE status <> 'success'",
)(lambda s, sf: inc.not_yet_done(ad.run_log(s, sf).select("source_schema", "source_table", "run_date"), ad.run_log(s, sf)))
register(
    "latest_runs",
    "s: source_schema source_table | d: run_date | i: row_count",
    "SELECT source_schema, source_table, max(run_date) AS run_date, arg_max(row_count, run_date) AS row_count FROM x_log GROUP BY 1, 2",
)(lambda s, sf: inc.latest_runs(ad.run_log(s, sf)))
register(
    "checkpoint_totals",
    "s: source_schema source_table | i: total_rows",
    "SELECT source_schema, source_table, sum(row_count) AS total_rows FROM x_log GROUP BY 1, 2",
)(lambda s, sf: inc.checkpoint_totals(ad.run_log(s, sf)))
register(
    "source_health",
    "s: source_schema status | i: total_rows",
    "SELECT source_schema, 'healthy' AS status, sum(row_count) AS total_rows FROM x_log GROUP BY 1 UNION ALL SELECT 'crm', 'unknown', 0",
)(lambda s, sf: inc.source_health(ad.run_log(s, sf), ["shop", "erp", "crm"]))

# --- streaming ------------------------------------------------------------------------------


def _event_stream(s, sf) -> DataFrame:
    """The events table as a file stream (a glob, as a stream cannot start from a single file)."""
    schema = ad.table(s, sf, "events").schema
    return s.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")


def _message_files(s, df: DataFrame, files: int = 4) -> str:
    """Messages as text files, one JSON object per line."""
    path = scratch_path(s, "topic")
    df.repartition(files).write.text(path)
    return path


def _run_topic(s, messages: DataFrame, topic: str) -> DataFrame:
    out = scratch_path(s, topic)
    stream = ingest.read_message_files(s, _message_files(s, messages), files_per_trigger=2)
    ingest.ingest_topic(stream, topic, out, scratch_path(s, "progress")).awaitTermination()
    return s.read.parquet(out)


@register(
    "stream_trades",
    "i: trade_id | s: symbol | e: price quantity | t: trade_time | b: is_buyer_maker",
    "SELECT event_id AS trade_id, upper(event_type) AS symbol, CASE WHEN event_id % 7 <> 0 THEN value END AS price, "
    "CAST(json_extract(props, '$.k') AS DOUBLE) AS quantity, date_trunc('milliseconds', ts) AS trade_time, user_id % 2 = 1 AS is_buyer_maker FROM events",
)
def _stream_trades(s, sf):
    key, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    message = F.struct(
        key.alias("trade_id"), F.upper("event_type").alias("symbol"),
        F.when(key % 7 == 0, F.lit(".")).otherwise(F.col("value").cast("decimal(18,2)").cast("string")).alias("price"),
        F.get_json_object("props", "$.k").alias("quantity"), F.unix_millis(ts).alias("trade_time"),
        (F.col("user_id") % 2).alias("is_buyer_maker"), F.lit("").alias("raw_data"),
    )
    return _run_topic(s, ad.table(s, sf, "events").select(F.to_json(message).alias("value")), "trades")


@register(
    "stream_prices",
    "s: coin_id vs_currency | i: timestamp_ms | e: price market_cap total_volume",
    "SELECT coin_id, 'usd' AS vs_currency, epoch_ms(last_updated_at) AS timestamp_ms, current_price_usd AS price, market_cap_usd AS market_cap, "
    "volume_24h_usd AS total_volume FROM x_coinstg",
)
def _stream_prices(s, sf):
    message = F.struct(
        "coin_id", F.lit("usd").alias("vs_currency"), F.unix_millis("last_updated_at").alias("timestamp_ms"),
        F.col("current_price_usd").cast("string").alias("price"), F.col("market_cap_usd").cast("string").alias("market_cap"),
        F.col("volume_24h_usd").cast("string").alias("total_volume"),
    )
    return _run_topic(s, Market(s, sf).coins.select(F.to_json(message).alias("value")), "prices")


@register(
    "stream_fear_greed",
    "d: value_date | i: value timestamp_unix | s: classification",
    "SELECT value_date, value, classification, CAST(epoch(value_date) AS BIGINT) AS timestamp_unix FROM x_feel",
)
def _stream_sentiment(s, sf):
    from tidemill.functions import labels

    day = F.col("value_date")
    message = F.struct(
        day.cast("string").alias("value_date"), "value", labels.sentiment_class(F.col("value")).alias("classification"),
        F.unix_seconds(day.cast("timestamp")).alias("timestamp_unix"),
    )
    return _run_topic(s, Market(s, sf).sentiment.select(F.to_json(message).alias("value")), "sentiment")


@register(
    "stream_fred",
    "s: series_id | d: observation_date | e: value",
    "SELECT series_id, date AS observation_date, CASE WHEN month(date) <> 6 THEN value END AS value FROM x_series",
)
def _stream_series(s, sf):
    shown = F.when(F.col("observation_month") == 6, F.lit(".")).otherwise(F.col("value").cast("string"))
    message = F.struct("series_id", F.col("observation_date").cast("string").alias("observation_date"), shown.alias("value"))
    return _run_topic(s, Macro(s, sf).series.select(F.to_json(message).alias("value")), "series")


def _stream_of_trades(s, sf) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return _event_stream(s, sf).select(
        F.col("event_id").alias("trade_id"), F.upper("event_type").alias("symbol"), F.col("value").cast("decimal(18,8)").alias("price"),
        F.get_json_object("props", "$.k").cast("decimal(18,8)").alias("quantity"), ts.alias("trade_time"),
    )


@register(
    "stream_hourly_bars",
    "s: symbol | t: price_hour | e: open_price high_price low_price close_price volume_usd | i: trades_count",
    """
SELECT symbol, date_trunc('hour', trade_time) AS price_hour, arg_min(price, (trade_time, trade_id)) AS open_price, max(price) AS high_price,
       min(price) AS low_price, arg_max(price, (trade_time, trade_id)) AS close_price, sum(price * CAST(quantity AS DECIMAL(8,0))) AS volume_usd,
       count(*) AS trades_count
FROM x_et GROUP BY 1, 2 HAVING date_trunc('hour', min(trade_time)) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR
""",
)
def _stream_bars(s, sf):
    """Closed hours only: an hour is written once the watermark has passed its end."""
    out = scratch_path(s, "bars")
    ingest.append_to(sbars.hourly_bars(_stream_of_trades(s, sf)), out, scratch_path(s, "progress")).awaitTermination()
    return s.read.parquet(out)


@register(
    "stream_dedupe",
    "i: trade_id | s: symbol | t: trade_time",
    "SELECT trade_id, symbol, trade_time FROM x_et",
)
def _stream_dedupe(s, sf):
    """Every trade arrives twice."""
    out = scratch_path(s, "unique")
    doubled = _stream_of_trades(s, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    ingest.append_to(sbars.unique_trades(doubled), out, scratch_path(s, "progress")).awaitTermination()
    return s.read.parquet(out)


@register(
    "stream_upsert",
    "s: coin_id | e: price | i: timestamp_ms",
    "SELECT coin_id, arg_max(current_price_usd, last_updated_at) AS price, epoch_ms(max(last_updated_at)) AS timestamp_ms FROM x_coinstg GROUP BY 1",
)
def _stream_upsert(s, sf):
    message = F.struct(
        "coin_id", F.unix_millis("last_updated_at").alias("timestamp_ms"), F.col("current_price_usd").cast("string").alias("price")
    )
    topic = _message_files(s, Market(s, sf).coins.select(F.to_json(message).alias("value")))
    path = scratch_path(s, "versions")
    stream = ingest.parse_prices(ingest.read_message_files(s, topic, files_per_trigger=1))
    ingest.upsert_stream(stream, path, scratch_path(s, "progress")).awaitTermination()
    ingest.merge_batches(s, path, ["coin_id"], "timestamp_ms")
    return ingest.read_versioned(s, path, ["coin_id"], "timestamp_ms")


@register(
    "stream_file_ingest",
    "s: coin_id | d: price_date | i: timestamp_ms",
    "SELECT coin_id, price_date, epoch_ms(CAST(price_date AS TIMESTAMP)) AS timestamp_ms FROM x_coinstg",
)
def _stream_files(s, sf):
    landed, out = scratch_path(s, "price-files"), scratch_path(s, "prices")
    prices = Market(s, sf).coins.select("coin_id", "price_date", "current_price_usd")
    prices.repartition(3).write.parquet(landed)
    ingest.append_to(ingest.ingest_price_files(s, landed, prices.schema), out, scratch_path(s, "progress")).awaitTermination()
    return s.read.parquet(out)


register(
    "retention",
    "i: event_id | t: ts",
    "SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 10 DAY",
)(lambda s, sf: sinks.retain(ad.table(s, sf, "events"), "ts", 10))
