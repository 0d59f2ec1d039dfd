"""Declared schemas of the landed tables, messages and pages."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "money": T.DecimalType(10, 2),
    "degrees": T.DecimalType(15, 10),
}


def record(required: dict | None = None, **optional) -> T.StructType:
    """Required fields first, then optional ones; a kind is a name above or a Spark type."""
    fields = [(n, k, False) for n, k in (required or {}).items()] + [(n, k, True) for n, k in optional.items()]
    return T.StructType([T.StructField(n, _KINDS.get(k, k) if isinstance(k, str) else k, null) for n, k, null in fields])


def texts(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, "string")


# Landed commerce tables.
COMMERCE = {
    "orders": record(
        {**texts("order_id", "customer_id", "order_status"), "order_purchase_timestamp": "timestamp"},
        order_approved_at="timestamp",
        order_delivered_carrier_date="timestamp",
        order_delivered_customer_date="timestamp",
        order_estimated_delivery_date="timestamp",
    ),
    "order_items": record(
        {
            "order_id": "string", "order_item_id": "int", "product_id": "string", "seller_id": "string",
            "shipping_limit_date": "timestamp", "price": "money", "freight_value": "money",
        }
    ),
    "customers": record(
        texts("customer_id", "customer_unique_id"),
        **texts("customer_zip_code_prefix", "customer_city", "customer_state"),
    ),
    "products": record(
        texts("product_id"),
        product_category_name="string",
        **dict.fromkeys(
            [
                "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
                "product_length_cm", "product_height_cm", "product_width_cm",
            ],
            "int",
        ),
    ),
    "sellers": record(texts("seller_id"), **texts("seller_zip_code_prefix", "seller_city", "seller_state")),
    "payments": record(
        {"order_id": "string", "payment_sequential": "int", "payment_type": "string"},
        payment_installments="int",
        payment_value="money",
    ),
    "reviews": record(
        {"review_id": "string", "order_id": "string", "review_score": "int"},
        review_comment_title="string",
        review_comment_message="string",
        review_creation_date="timestamp",
        review_answer_timestamp="timestamp",
    ),
    "geolocation": record(
        {
            "geolocation_zip_code_prefix": "string", "geolocation_lat": "degrees", "geolocation_lng": "degrees",
            "geolocation_city": "string", "geolocation_state": "string",
        }
    ),
    "category_translation": record(texts("product_category_name", "product_category_name_english")),
}

# Exchange messages: numbers arrive as text, times as epoch milliseconds.
TRADE_EVENT = record(
    e="string", E="bigint", s="string", t="bigint", p="string", q="string", b="bigint", a="bigint", T="bigint", m="boolean"
)
KLINE_EVENT = record(
    e="string", E="bigint", s="string",
    k=record(
        i="string", t="bigint", T="bigint", o="string", h="string", l="string", c="string", v="string", q="string",
        n="bigint", x="boolean",
    ),
)
TICKER_EVENT = record(
    e="string", E="bigint", s="string", **texts("p", "P", "w", "x", "c", "Q", "b", "B", "a", "A", "o", "h", "l", "v", "q"),
    O="bigint", C="bigint", n="bigint",
)

# Stream topics, one JSON object per message.
TOPICS = {
    "trades": record(
        trade_id="bigint", symbol="string", price="string", quantity="string", trade_time="bigint",
        is_buyer_maker="int", raw_data="string",
    ),
    "prices": record(
        coin_id="string", vs_currency="string", timestamp_ms="bigint", price="string", market_cap="string",
        total_volume="string",
    ),
    "sentiment": record(value_date="string", value="int", classification="string", timestamp_unix="bigint"),
    "series": record(series_id="string", observation_date="string", value="string"),
}

# Landed API pages, as DDL.
PRICE_ARRAYS = (
    "coin_id string, prices array<array<double>>, total_volumes array<array<double>>, market_caps array<array<double>>"
)
OBSERVATION_PAGE = "series_id string, observations array<struct<date: string, value: string>>"
COUNTRY_ITEM = (
    "struct<country: struct<id: string, value: string>, indicator: struct<id: string, value: string>, date: string, "
    "value: double, decimal: int>"
)
LABOR_PAGE = (
    "seriesID string, data array<struct<year: string, period: string, periodName: string, value: string, "
    "calculations: struct<pct_changes: map<string, string>>>>"
)
ACCOUNTS_PAGE = (
    "Data array<struct<TableName: string, SeriesCode: string, LineNumber: string, LineDescription: string, "
    "TimePeriod: string, DataValue: string, NoteRef: string>>"
)
CHART_PAGE = "name string, values array<struct<x: bigint, y: double>>"
HISTORY_PAGE = (
    "symbol string, Data struct<Data: array<struct<time: bigint, open: double, high: double, low: double, "
    "close: double, volumefrom: double, volumeto: double>>>"
)

RUN_LOG = record(
    started_at="timestamp", finished_at="timestamp", source_schema="string", source_table="string", run_date="date",
    row_count="bigint", parquet_size="bigint", path="string", status="string", error_message="string",
)
CHECKPOINT = record(
    source_name="string", table_name="string", checkpoint_column="string", checkpoint_value="timestamp",
    records_processed="bigint", status="string", error_message="string", updated_at="timestamp",
)
