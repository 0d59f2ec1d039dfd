"""Landed JSON payloads and nested pages to flat, typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill import schemas
from tidemill.functions.scalars import epoch_to_timestamp


# A message that does not parse keeps its text in this field; such messages are dropped.
CORRUPT = "_corrupt"
KEEP_CORRUPT = {"columnNameOfCorruptRecord": CORRUPT}


def number_or_zero(c: Column) -> Column:
    """A missing number counts as zero; text that is no number becomes NULL."""
    return F.when(c.isNull(), F.lit(0.0)).otherwise(c.try_cast("double"))


class _Message:
    """A parsed JSON event whose field names may differ only in case ("p" and "P").

    Column names are matched without case, so the parsed struct is given positional names and
    fields are addressed through this class.
    """

    def __init__(self, df: DataFrame, value: str, schema: T.StructType):
        self.schema = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
        parsed = F.from_json(F.col(value), self.schema, KEEP_CORRUPT).cast(self._positional(self.schema))
        self.rows = df.select("*", parsed.alias("_m")).where(F.col("_m").isNotNull() & self[CORRUPT].isNull())

    def _positional(self, schema: T.StructType) -> T.StructType:
        return T.StructType(
            [
                T.StructField(f"f{i}", self._positional(f.dataType) if isinstance(f.dataType, T.StructType) else f.dataType)
                for i, f in enumerate(schema)
            ]
        )

    def __getitem__(self, path: str) -> Column:
        schema, at = self.schema, "_m"
        for name in path.split("."):
            at += f".f{schema.fieldNames().index(name)}"
            schema = schema[name].dataType
        return F.col(at)

    def named(self, fields: dict[str, str]) -> list[Column]:
        return [self[path].alias(name) for name, path in fields.items()]

    def numbers(self, fields: dict[str, str]) -> list[Column]:
        return [number_or_zero(self[path]).alias(name) for name, path in fields.items()]

    def moments(self, fields: dict[str, str]) -> list[Column]:
        return [epoch_to_timestamp(self[path]).alias(name) for name, path in fields.items()]


def parse_trade_json(df: DataFrame, value: str = "value") -> DataFrame:
    m = _Message(df, value, schemas.TRADE_EVENT)
    return m.rows.select(
        *m.named({"event_type": "e", "symbol": "s", "trade_id": "t", "buyer_order_id": "b", "seller_order_id": "a"}),
        *m.named({"is_buyer_maker": "m"}),
        *m.moments({"event_time": "E", "trade_time": "T"}),
        *m.numbers({"price": "p", "quantity": "q"}),
    )


def parse_kline_json(df: DataFrame, value: str = "value") -> DataFrame:
    m = _Message(df, value, schemas.KLINE_EVENT)
    prices = {"open": "k.o", "high": "k.h", "low": "k.l", "close": "k.c", "volume": "k.v", "quote_volume": "k.q"}
    return m.rows.select(
        *m.named({"event_type": "e", "symbol": "s", "interval": "k.i", "trades_count": "k.n", "is_closed": "k.x"}),
        *m.moments({"event_time": "E", "open_time": "k.t", "close_time": "k.T"}),
        *m.numbers(prices),
    )


def parse_ticker_json(df: DataFrame, value: str = "value") -> DataFrame:
    m = _Message(df, value, schemas.TICKER_EVENT)
    numbers = {
        "price_change": "p", "price_change_percent": "P", "weighted_avg_price": "w", "prev_close_price": "x",
        "last_price": "c", "last_quantity": "Q", "bid_price": "b", "bid_quantity": "B", "ask_price": "a",
        "ask_quantity": "A", "open_price": "o", "high_price": "h", "low_price": "l", "volume": "v",
        "quote_volume": "q",
    }
    return m.rows.select(
        *m.named({"event_type": "e", "symbol": "s", "trades_count": "n"}),
        *m.moments({"event_time": "E", "open_time": "O", "close_time": "C"}),
        *m.numbers(numbers),
    )


def route_envelope(df: DataFrame, value: str = "value") -> DataFrame:
    """Unwrap {stream, data} messages; a bare event is its own payload, named by its type."""
    m = F.from_json(value, f"stream string, data string, e string, {CORRUPT} string", KEEP_CORRUPT)
    wrapped = m["stream"].isNotNull() & m["data"].isNotNull()
    return df.where(m.isNotNull() & m[CORRUPT].isNull()).select(
        F.when(wrapped, m["stream"]).otherwise(F.coalesce(m["e"], F.lit("unknown"))).alias("stream"),
        F.when(wrapped, m["data"]).otherwise(F.col(value)).alias("payload"),
    )


def of_stream(routed: DataFrame, kind: str) -> DataFrame:
    """Messages whose stream name contains the wanted kind."""
    return routed.where(F.contains("stream", F.lit(kind)))


# --- pages --------------------------------------------------------------------------------


def zip_price_arrays(pages: DataFrame) -> DataFrame:
    """One row per price point; a shorter volume or cap list gives NULL."""
    point = pages.select("*", F.posexplode("prices").alias("_i", "_p"))
    return point.select(
        "coin_id",
        F.get("_p", F.lit(0)).cast("bigint").alias("timestamp_ms"),
        epoch_to_timestamp(F.get("_p", F.lit(0))).alias("date"),
        F.get("_p", F.lit(1)).alias("price"),
        F.get(F.get("total_volumes", F.col("_i")), F.lit(1)).alias("volume"),
        F.get(F.get("market_caps", F.col("_i")), F.lit(1)).alias("market_cap"),
    )


def explode_observations(pages: DataFrame) -> DataFrame:
    """Dated values of a series page without missing ones ('.', blank or NULL)."""
    rows = pages.select("series_id", F.explode("observations").alias("o"))
    return rows.where(F.col("o.value").isNotNull() & ~F.col("o.value").isin(".", "")).select(
        "series_id", F.to_date("o.date").alias("date"), F.col("o.value").try_cast("double").alias("value")
    )


def flatten_countries(pages: DataFrame, value: str = "value", zero_is_missing: bool = True) -> DataFrame:
    """[meta, rows] pages as text. By default a value of zero becomes NULL; missing rows drop."""
    rows = pages.select(F.explode(F.from_json(F.get_json_object(value, "$[1]"), f"array<{schemas.COUNTRY_ITEM}>")).alias("r"))
    v = F.col("r.value")
    return rows.where(v.isNotNull()).select(
        F.col("r.country.id").alias("country_id"),
        F.col("r.country.value").alias("country_name"),
        F.col("r.indicator.id").alias("indicator_id"),
        F.col("r.indicator.value").alias("indicator_name"),
        F.col("r.date").try_cast("int").alias("year"),
        (F.when(v != 0, v) if zero_is_missing else v).alias("value"),
        F.col("r.decimal").alias("decimal"),
    )


def flatten_labor(pages: DataFrame) -> DataFrame:
    """Labor series pages with optional percent changes over 1, 3, 6 and 12 months."""
    rows = pages.select(F.col("seriesID").alias("series_id"), F.explode("data").alias("d"))
    changes = F.col("d.calculations.pct_changes")
    return rows.select(
        "series_id",
        F.col("d.year").cast("int").alias("year"),
        F.col("d.period").alias("period"),
        F.col("d.periodName").alias("period_name"),
        F.col("d.value").try_cast("double").alias("value"),
        *[changes[str(m)].try_cast("double").alias(f"pct_change_{m}m") for m in (1, 3, 6, 12)],
    )


def flatten_accounts(pages: DataFrame) -> DataFrame:
    """National accounts rows; thousands separators removed."""
    rows = pages.select(F.explode("Data").alias("d"))
    return rows.select(
        F.col("d.TableName").alias("table_name"),
        F.col("d.SeriesCode").alias("series_code"),
        F.col("d.LineNumber").alias("line_number"),
        F.col("d.LineDescription").alias("line_description"),
        F.col("d.TimePeriod").alias("time_period"),
        F.regexp_replace("d.DataValue", ",", "").try_cast("double").alias("value"),
        F.col("d.NoteRef").alias("note_ref"),
    )


def flatten_chart(pages: DataFrame) -> DataFrame:
    rows = pages.select("name", F.explode("values").alias("v"))
    return rows.select("name", F.col("v.x").alias("timestamp"), epoch_to_timestamp(F.col("v.x")).alias("datetime"), F.col("v.y").alias("value"))


def flatten_history(pages: DataFrame) -> DataFrame:
    """Open-high-low-close history pages."""
    rows = pages.select("symbol", F.explode("Data.Data").alias("d"))
    return rows.select(
        "symbol",
        F.col("d.time").alias("timestamp"),
        epoch_to_timestamp(F.col("d.time")).alias("datetime"),
        *[F.col(f"d.{c}").alias(c) for c in ("open", "high", "low", "close")],
        F.col("d.volumefrom").alias("volume_from"),
        F.col("d.volumeto").alias("volume_to"),
    )
