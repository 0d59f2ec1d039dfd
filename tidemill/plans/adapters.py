"""Domain tables derived from the given Parquet tables.

Every frame here is a lazy projection or aggregation of whole given tables, with the landed
column names the staging functions expect.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill import fixed_values as fv

MARKET_SYMBOLS = ["BTCUSDT", "ETHUSDT", "SPXUSDT", "XAUUSDT", "DXYUSDT"]
COIN_IDS = ["bitcoin", "ethereum", "spx", "xau", "dxy"]
COUNTRY_CODES = [
    "USA", "CHN", "JPN", "DEU", "GBR", "FRA", "IND", "ITA", "BRA", "CAN", "KOR", "AUS", "MEX",
    "ESP", "IDN", "NLD", "SAU", "TUR", "CHE", "ARG", "SWE", "POL", "BEL", "THA", "ZAF",
]
# Category in the landed tables -> display name; PROMO stays untranslated on purpose.
CATEGORY_NAMES = {
    "STANDARD": "standard_goods",
    "ECONOMY": "economy_goods",
    "MEDIUM": "medium_goods",
    "LARGE": "large_goods",
    "SMALL": "small_goods",
}
# Scale of each series: value = (monthly mean order total - shift) / scale.
SERIES_SCALES = {
    "GDP": (0, 10), "GDPC1": (0, 12), "GDPPOT": (0, 11), "CPIAUCSL": (0, 1000),
    "CPILFESL": (0, 1100), "PCEPI": (0, 2000), "UNRATE": (0, 50000), "PAYEMS": (0, 2),
    "CIVPART": (0, 4000), "FEDFUNDS": (200000, 20000), "DGS10": (180000, 20000),
    "DGS2": (190000, 20000), "T10Y2Y": (250000, 50000), "M2SL": (0, 15), "M1SL": (0, 20),
    "BOGMBASE": (0, 40),
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table, as it lies."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    """The entry of a short fixed list at a zero-based index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(12,2)")


def raw_orders(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    bought = F.col("o_orderdate").cast("timestamp")
    key = F.col("o_orderkey")
    return o.select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "created")
        .otherwise("canceled")
        .alias("order_status"),
        bought.alias("order_purchase_timestamp"),
        (bought + F.make_dt_interval(hours=(key % 24).cast("int"))).alias("order_approved_at"),
        F.when(
            F.col("o_orderstatus") == "F", bought + F.expr("interval 1 day")
        ).alias("order_delivered_carrier_date"),
        F.when(
            F.col("o_orderstatus") == "F",
            bought + F.make_dt_interval(days=(2 + key % 29).cast("int"), hours=(key % 7).cast("int")),
        ).alias("order_delivered_customer_date"),
        (bought + F.expr("interval 20 days")).alias("order_estimated_delivery_date"),
    )


def raw_order_items(spark, sf) -> DataFrame:
    price = _money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    freight = _money("l_extendedprice") * F.col("l_tax").cast("decimal(4,2)")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").cast("timestamp").alias("shipping_limit_date"),
        price.cast("decimal(10,2)").alias("price"),
        freight.cast("decimal(10,2)").alias("freight_value"),
    )


def raw_customers(spark, sf) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_custkey").alias("customer_unique_id"),
            (F.col("c_custkey") % 997).cast("string").alias("customer_zip_code_prefix"),
            F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" town ")).alias("customer_city"),
            F.lower("n_name").alias("customer_state"),
        )
    )


def raw_sellers(spark, sf) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("seller_id"),
            (F.col("s_suppkey") % 1009).cast("string").alias("seller_zip_code_prefix"),
            F.concat(F.lit("port "), F.lower("n_name")).alias("seller_city"),
            F.lower("n_name").alias("seller_state"),
        )
    )


def raw_geolocation(spark, sf) -> DataFrame:
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            (F.col("c_custkey") % 997).cast("string").alias("geolocation_zip_code_prefix"),
            (F.col("c_custkey") % 180 - 90).cast("decimal(15,10)").alias("geolocation_lat"),
            (F.col("c_custkey") % 360 - 180).cast("decimal(15,10)").alias("geolocation_lng"),
            F.lower("c_mktsegment").alias("geolocation_city"),
            F.lower("n_name").alias("geolocation_state"),
        )
    )


def region_of_state(spark, sf) -> DataFrame:
    """state -> region, from the nation and region tables (bounded by their size)."""
    nation = table(spark, sf, "nation").select("n_name", "n_regionkey")
    region = table(spark, sf, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.lower("n_name").alias("state"), F.col("r_name").alias("region")
    )


def raw_products(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        (F.col("p_size") * 3).alias("product_description_lenght"),
        (F.col("p_size") % 5).alias("product_photos_qty"),
        (F.col("p_size") * 100).alias("product_weight_g"),
        F.col("p_size").alias("product_length_cm"),
        (F.col("p_size") + 1).alias("product_height_cm"),
        (F.col("p_size") + 2).alias("product_width_cm"),
    )


def raw_translation(spark, sf) -> DataFrame:
    """Category names present in the part table, with their display name where there is one."""
    known = F.create_map(*[F.lit(x) for pair in CATEGORY_NAMES.items() for x in pair])
    return (
        table(spark, sf, "part")
        .select(F.col("p_type").alias("product_category_name"))
        .distinct()
        .select("product_category_name", known[F.col("product_category_name")].alias("product_category_name_english"))
        .where(F.col("product_category_name_english").isNotNull())
    )


def raw_payments(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("payment_type"),
        (1 + F.col("o_custkey") % 12).cast("int").alias("payment_installments"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("payment_value"),
    )


def raw_reviews(spark, sf) -> DataFrame:
    """Synthetic scores: one review per order, two for every tenth order, none for every seventh."""
    key = F.col("o_orderkey")
    created = F.col("o_orderdate").cast("timestamp") + F.expr("interval 25 days")
    copies = F.when(key % 7 == 0, 0).when(key % 10 == 0, 2).otherwise(1)
    return (
        table(spark, sf, "orders")
        .select("o_orderkey", "o_orderdate", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("copy"), copies.alias("n"))
        .where(F.col("copy") <= F.col("n"))
        .select(
            (key * 2 + F.col("copy")).alias("review_id"),
            key.alias("order_id"),
            (1 + (key + F.col("copy")) % 5).cast("int").alias("review_score"),
            F.when(key % 3 == 0, "  ").otherwise(" fine ").alias("review_comment_title"),
            F.when(key % 4 == 0, F.lit(None)).when(key % 4 == 1, "   ").otherwise(" arrived ")
            .alias("review_comment_message"),
            created.alias("review_creation_date"),
            (created + F.make_dt_interval(hours=(key % 100).cast("int"))).alias("review_answer_timestamp"),
        )
    )


# --- market ---------------------------------------------------------------------------


def event_trades(spark, sf) -> DataFrame:
    """Intraday trades: one per event."""
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("trade_id"),
        F.upper("event_type").alias("symbol"),
        F.col("value").cast("decimal(18,8)").alias("price"),
        F.get_json_object("props", "$.k").cast("decimal(18,8)").alias("quantity"),
        ts.alias("trade_time"),
        (F.col("user_id") % 2 == 1).alias("is_buyer_maker"),
        (ts + F.expr("interval 5 seconds")).alias("ingested_at"),
    )


def market_trades(spark, sf) -> DataFrame:
    """Years of trades: one per line item, five symbols, price = unit price."""
    ts = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(
        hours=(F.col("l_orderkey") % 24).cast("int"), mins=(F.col("l_partkey") % 60).cast("int")
    )
    return table(spark, sf, "lineitem").select(
        (
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000_000
            + F.col("l_partkey") * 10_000
            + F.col("l_suppkey")
        ).alias("trade_id"),
        _pick(MARKET_SYMBOLS, F.col("l_suppkey") % 5).alias("symbol"),
        F.col("l_extendedprice").cast("decimal(18,8)").alias("price"),
        F.col("l_quantity").cast("decimal(18,8)").alias("quantity"),
        ts.alias("trade_time"),
        (F.col("l_returnflag") == "R").alias("is_buyer_maker"),
        (ts + F.expr("interval 5 seconds")).alias("ingested_at"),
    )


def coin_prices(spark, sf) -> DataFrame:
    """One market snapshot per coin and day."""
    o = table(spark, sf, "orders")
    slot = F.col("o_custkey") % 5
    day = F.col("o_orderdate").cast("timestamp")
    hundredth = F.lit(Decimal("0.01"))
    pct = (F.sum("o_orderkey") % 2001 - 1000).cast("decimal(10,4)") * hundredth
    return (
        o.groupBy(slot.alias("slot"), day.alias("last_updated"))
        .agg(
            F.max(_money("o_totalprice")).alias("current_price"),
            (F.sum(_money("o_totalprice")) * 10).alias("market_cap"),
            F.sum(_money("o_totalprice")).alias("total_volume"),
            pct.cast("decimal(10,4)").alias("price_change_percentage_24h"),
        )
        .select(
            _pick(COIN_IDS, F.col("slot")).alias("coin_id"),
            F.lower(F.regexp_replace(_pick(MARKET_SYMBOLS, F.col("slot")), "USDT$", "")).alias("symbol"),
            F.initcap(_pick(COIN_IDS, F.col("slot"))).alias("name"),
            "current_price",
            "market_cap",
            "total_volume",
            (F.col("current_price") * F.col("price_change_percentage_24h") * hundredth)
            .cast("decimal(18,4)").alias("price_change_24h"),
            "price_change_percentage_24h",
            "last_updated",
            (F.col("last_updated") + F.expr("interval 1 hour")).alias("ingested_at"),
        )
    )


def sentiment_index(spark, sf) -> DataFrame:
    """Daily index 0..100."""
    return (
        table(spark, sf, "orders")
        .groupBy(F.to_date("o_orderdate").alias("value_date"))
        .agg((F.sum("o_orderkey") % 101).cast("int").alias("value"))
    )


def chain_stats(spark, sf) -> DataFrame:
    """Daily network figures; amounts in satoshi where the landed field uses them."""
    return (
        table(spark, sf, "orders")
        .groupBy(F.to_date("o_orderdate").alias("stat_date"))
        .agg(
            (F.sum("o_custkey") % 100000 + 1000).cast("double").alias("hash_rate"),
            (F.count("*") * 1000000).cast("double").alias("difficulty"),
            (F.max("o_orderkey") * 100000000).alias("totalbc"),
            F.count("*").alias("n_blocks_total"),
            (F.count("*") * 1000 + 1).alias("n_tx"),
            (F.sum("o_custkey") * 1000000).alias("total_btc_sent"),
            (F.sum("o_custkey") * 500000).alias("estimated_btc_sent"),
            F.sum(_money("o_totalprice")).cast("decimal(20,2)").alias("miners_revenue_usd"),
            F.max(_money("o_totalprice")).cast("decimal(20,2)").alias("market_price_usd"),
            F.min("o_orderkey").alias("mempool_bytes"),
            F.max("o_custkey").alias("block_height"),
            (F.count("*") * 50 + 25).cast("double").alias("btc_mined_daily"),
        )
    )


# --- macro ----------------------------------------------------------------------------


def macro_series(spark, sf) -> DataFrame:
    """Long series: sixteen monthly series, each the scaled mean of a sixteenth of the orders."""
    codes = list(SERIES_SCALES)
    shift = F.create_map(*[F.lit(x) for k in codes for x in (k, SERIES_SCALES[k][0])])
    scale = F.create_map(*[F.lit(x) for k in codes for x in (k, SERIES_SCALES[k][1])])
    cents = F.sum(_money("o_totalprice") * 100).cast("bigint")
    return (
        table(spark, sf, "orders")
        .groupBy(
            _pick(codes, F.col("o_custkey") % len(codes)).alias("series_id"),
            F.trunc("o_orderdate", "month").alias("date"),
        )
        .agg(cents.alias("cents"), F.count("*").alias("n"))
        .withColumns({"shift": shift[F.col("series_id")], "scale": scale[F.col("series_id")]})
        .select(
            "series_id",
            "date",
            # Whole ten-thousandths, so that every engine gets the same digits.
            (F.expr("((cents - shift * 100 * n) * 100) div (n * scale)").cast("decimal(20,0)") * F.lit(Decimal("0.0001")))
            .cast("decimal(20,4)").alias("value"),
            F.concat(F.col("series_id"), F.lit(" title")).alias("series_title"),
            F.lit("index").alias("series_units"),
            F.lit("monthly").alias("series_frequency"),
            (F.col("date").cast("timestamp") + F.expr("interval 1 day")).alias("ingested_at"),
        )
    )


def series_metadata(spark, sf) -> DataFrame:
    return (
        macro_series(spark, sf)
        .groupBy("series_id")
        .agg(
            F.max("series_title").alias("title"),
            F.max("series_frequency").alias("frequency"),
            F.max("series_units").alias("units"),
            F.min("date").alias("observation_start"),
            F.max("date").alias("observation_end"),
        )
    )


def country_indicators(spark, sf) -> DataFrame:
    """Yearly country figures from the orders of each nation's customers."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    yearly = (
        table(spark, sf, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.year("o_orderdate").alias("year"))
        .agg(
            F.sum(_money("o_totalprice")).cast("double").alias("NY.GDP.MKTP.CD"),
            F.count("*").cast("double").alias("SP.POP.TOTL"),
            (F.sum("o_custkey") % 1000).cast("double").alias("FP.CPI.TOTL.ZG"),
            (F.sum("o_orderkey") % 200).cast("double").alias("SL.UEM.TOTL.ZS"),
            (F.sum("o_orderkey") % 150).cast("double").alias("NE.TRD.GNFS.ZS"),
        )
    )
    codes = ["NY.GDP.MKTP.CD", "SP.POP.TOTL", "FP.CPI.TOTL.ZG", "SL.UEM.TOTL.ZS", "NE.TRD.GNFS.ZS"]
    return (
        yearly.unpivot(["c_nationkey", "year"], [F.col(f"`{c}`") for c in codes], "indicator_code", "value")
        .select(
            _pick(COUNTRY_CODES, F.col("c_nationkey")).alias("country_code"),
            F.concat(F.lit("Country "), F.col("c_nationkey")).alias("country_name"),
            "indicator_code",
            F.concat(F.lit("name of "), F.col("indicator_code")).alias("indicator_name"),
            "year",
            F.col("value").cast("decimal(20,4)").alias("value"),
            F.to_timestamp(F.lit("2002-01-01")).alias("ingested_at"),
        )
    )


def treasury_yields(spark, sf) -> DataFrame:
    """Daily curve: eleven tenors in percent."""
    daily = (
        table(spark, sf, "orders")
        .groupBy(F.to_date("o_orderdate").alias("record_date"))
        .agg(F.sum("o_custkey").alias("s"), F.count("*").alias("n"))
    )
    return daily.select(
        "record_date",
        *[
            (((F.col("s") + 37 * j * F.col("n")) % 600).cast("decimal(10,4)") / 100)
            .cast("decimal(10,4)").alias(f"yield_{t}")
            for j, t in enumerate(fv.YIELD_TENORS)
        ],
    )


def treasury_debt(spark, sf) -> DataFrame:
    """Daily debt levels as landed: amounts are strings."""
    return (
        table(spark, sf, "orders")
        .groupBy(F.to_date("o_orderdate").alias("record_date"))
        .agg(
            F.sum(_money("o_totalprice")).cast("string").alias("tot_pub_debt_out_amt"),
            F.sum(F.when(F.col("o_orderstatus") == "O", _money("o_totalprice"))).cast("string")
            .alias("intragov_hold_amt"),
            F.sum(F.when(F.col("o_orderstatus") != "O", _money("o_totalprice"))).cast("string")
            .alias("debt_held_public_amt"),
        )
    )


def treasury_rates(spark, sf) -> DataFrame:
    """Average interest rates by security, monthly."""
    kind = F.col("o_custkey") % 3
    return (
        table(spark, sf, "orders")
        .groupBy(
            F.last_day("o_orderdate").alias("record_date"),
            _pick(fv.SECURITY_TYPES, kind).alias("security_type"),
            F.concat(
                _pick(["2-Year", "5-Year", "10-Year", "30-Year"], F.col("o_orderkey") % 4),
                F.lit(" "),
                _pick(fv.SECURITY_TYPES, kind),
            ).alias("security_desc"),
        )
        .agg(((F.sum("o_custkey") % 900).cast("decimal(10,4)") / 100).cast("decimal(10,4)").alias("avg_interest_rate"))
    )


def policy_events(spark, sf) -> DataFrame:
    """Dated events: the first order of each status and month."""
    return (
        table(spark, sf, "orders")
        .groupBy(F.trunc("o_orderdate", "month").alias("m"), "o_orderstatus")
        .agg(F.min(F.to_date("o_orderdate")).alias("event_date"))
        .select(
            "event_date",
            F.concat(F.lit("event_"), F.lower("o_orderstatus"), F.lit("_"), F.date_format("m", "yyyyMM"))
            .alias("event_type"),
        )
    )


def run_log(spark, sf) -> DataFrame:
    """Ingestion runs: one per nation table part and month, with row counts."""
    return (
        table(spark, sf, "orders")
        .groupBy(
            _pick(["shop", "erp"], F.col("o_custkey") % 2).alias("source_schema"),
            F.lower(F.regexp_replace("o_orderpriority", "[^A-Za-z]", "")).alias("source_table"),
            F.trunc("o_orderdate", "month").alias("run_date"),
        )
        .agg(
            F.count("*").cast("int").alias("row_count"),
            F.max(F.col("o_orderdate").cast("timestamp")).alias("finished_at"),
            F.when(F.sum("o_orderkey") % 4 == 0, "failed").otherwise("success").alias("status"),
        )
    )
