"""Registered scalar and nested-data queries with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.functions import labels, nested
from tidemill.functions import scalars as sc
from tidemill.plans import adapters as ad
from tidemill.plans.commerce import Commerce
from tidemill.plans.macro import Macro, cast_debt_amounts, headline_gdp
from tidemill.plans.market import Market
from tidemill.plans.oracle_tables import sql_list
from tidemill.plans.registry import register
from tidemill.session import scratch_path

# --- text and conditionals ------------------------------------------------------------------


@register(
    "fn_text",
    "i: c_custkey | s: trimmed lowered uppered titled padded joined filled nulled | b: starts | s: region",
    """
SELECT c_custkey, trim('  ' || c_name || ' ') AS trimmed, lower(c_name) AS lowered, upper(c_name) AS uppered,
       upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS titled, lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS padded,
       c_name || '-' || c_mktsegment AS joined, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS filled,
       nullif(c_mktsegment, 'BUILDING') AS nulled, c_name LIKE 'Customer#00000%' AS starts,
       CASE c_nationkey % 4 WHEN 0 THEN 'Sudeste' WHEN 1 THEN 'Sul' WHEN 2 THEN 'Norte' ELSE 'Desconhecido' END AS region
FROM customer
""",
)
def _text(s, sf):
    state = F.element_at(F.array(*[F.lit(x) for x in ("SP", "RS", "AC", "??")]), F.col("c_nationkey") % 4 + 1)
    segment = F.col("c_mktsegment")
    return ad.table(s, sf, "customer").select(
        "c_custkey",
        F.trim(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("trimmed"),
        F.lower("c_name").alias("lowered"),
        F.upper("c_name").alias("uppered"),
        sc.title_case(segment).alias("titled"),
        sc.zip_code(F.col("c_custkey")).alias("padded"),
        F.concat_ws("-", "c_name", segment).alias("joined"),
        F.coalesce(F.nullif(segment, F.lit("BUILDING")), F.lit("none")).alias("filled"),
        F.nullif(segment, F.lit("BUILDING")).alias("nulled"),
        F.col("c_name").like("Customer#00000%").alias("starts"),
        labels.state_region(state).alias("region"),
    )


@register(
    "fn_title_case",
    "i: p_partkey | s: plain every_word",
    """
SELECT p_partkey, upper(split_part(p_name, ' ', 1)[1]) || split_part(p_name, ' ', 1)[2:] || '-' || split_part(p_name, ' ', 2) AS plain,
       upper(split_part(p_name, ' ', 1)[1]) || split_part(p_name, ' ', 1)[2:] || '-' || upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] AS every_word
FROM part
""",
)
def _title(s, sf):
    dashed = F.regexp_replace("p_name", " ", "-")
    return ad.table(s, sf, "part").select(
        "p_partkey", sc.title_case(dashed).alias("plain"), sc.title_case(dashed, after_punctuation=True).alias("every_word")
    )


@register(
    "fn_dates",
    "i: event_id | d: day | i: y q m h wk isodow dow | d: day_start week_start month_start | s: ym yq month_name day_name yyyymm "
    "| t: earlier | e: age_days age_hours",
    """
SELECT event_id, CAST(ts AS DATE) AS day, year(ts) AS y, quarter(ts) AS q, month(ts) AS m, hour(ts) AS h, weekofyear(ts) AS wk,
       isodow(ts) AS isodow, dayofweek(ts) + 1 AS dow, date_trunc('day', ts) AS day_start, date_trunc('week', ts) AS week_start,
       date_trunc('month', ts) AS month_start, strftime(ts, '%Y-%m') AS ym, year(ts) || '-' || quarter(ts) AS yq,
       monthname(ts) AS month_name, dayname(ts) AS day_name, strftime(ts, '%Y%m') AS yyyymm, ts - INTERVAL 90 DAY AS earlier,
       CAST(epoch_us(TIMESTAMP '2024-03-01') - epoch_us(ts) AS DOUBLE) / 86400e6 AS age_days,
       CAST(epoch_us(TIMESTAMP '2024-03-01') - epoch_us(ts) AS DOUBLE) / 3600e6 AS age_hours
FROM events
""",
)
def _dates(s, sf):
    ts = F.col("ts").cast("timestamp")
    later = F.lit("2024-03-01").cast("timestamp")
    return ad.table(s, sf, "events").select(
        "event_id",
        F.to_date(ts).alias("day"),
        F.year(ts).alias("y"), F.quarter(ts).alias("q"), F.month(ts).alias("m"), F.hour(ts).alias("h"),
        F.weekofyear(ts).alias("wk"),
        F.extract(F.lit("DAYOFWEEK_ISO"), ts).alias("isodow"),
        F.dayofweek(ts).alias("dow"),
        *[F.to_date(F.date_trunc(u, ts)).alias(f"{u}_start") for u in ("day", "week", "month")],
        F.date_format(ts, "yyyy-MM").alias("ym"),
        F.date_format(ts, "yyyy-q").alias("yq"),
        F.date_format(ts, "MMMM").alias("month_name"),
        F.date_format(ts, "EEEE").alias("day_name"),
        sc.month_key(ts).alias("yyyymm"),
        (ts - F.expr("interval 90 days")).alias("earlier"),
        sc.days_between(later, ts).alias("age_days"),
        sc.hours_between(later, ts).alias("age_hours"),
    )


@register(
    "fn_numbers",
    "i: l_orderkey l_linenumber l_partkey l_suppkey | f2: half_up | e: magnitude divided guarded dollars | s: key",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(12,1)) AS half_up,
       abs(l_discount - 0.05) AS magnitude,
       CASE WHEN l_tax = 0 THEN 0 ELSE l_quantity / l_tax END AS divided, l_quantity / nullif(l_tax, 0) AS guarded,
       CAST(CAST(l_partkey AS DECIMAL(30,2)) / 100 AS DOUBLE) AS dollars,
       md5(l_orderkey || '|' || coalesce(nullif(l_returnflag, 'R'), '') || '|' || l_linestatus) AS key
FROM lineitem
""",
)
def _numbers(s, sf):
    tax, quantity = F.col("l_tax"), F.col("l_quantity")
    return ad.table(s, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(F.col("l_extendedprice").cast("decimal(12,2)"), 1).alias("half_up"),
        F.abs(F.col("l_discount") - 0.05).alias("magnitude"),
        sc.safe_divide(quantity, tax).alias("divided"),
        sc.ratio(quantity, tax).alias("guarded"),
        sc.cents_to_units(F.col("l_partkey")).alias("dollars"),
        sc.surrogate_key(F.col("l_orderkey"), F.nullif("l_returnflag", F.lit("R")), F.col("l_linestatus")).alias("key"),
    )


@register(
    "safe_divide",
    "i: o_orderkey | e: share",
    "SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_totalprice / (o_custkey % 3) END AS share FROM orders",
)
def _safe_divide(s, sf):
    return ad.table(s, sf, "orders").select(
        "o_orderkey", sc.safe_divide(F.col("o_totalprice"), F.col("o_custkey") % 3).alias("share")
    )


@register(
    "to_decimal_or_null",
    "i: o_orderkey | e: value",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS value FROM orders",
)
def _decimal(s, sf):
    key = F.col("o_orderkey")
    text = F.when(key % 3 == 0, ".").when(key % 3 == 1, F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    return ad.table(s, sf, "orders").select(key, sc.decimal_or_null(text).alias("value"))


# Text forms of a date, in turn; the last one fits no accepted format.
_SHOWN = [
    "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy/MM/dd", "dd-MM-yyyy", "dd/MM/yyyy", "MM/dd/yyyy", "yyyyMMdd",
]
_SHOWN_SQL = ["%Y-%m-%d", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S.%f", "%Y/%m/%d", "%d-%m-%Y", "%d/%m/%Y", "%m/%d/%Y", "%Y%m%d"]


@register(
    "parse_any_date",
    "i: o_orderkey | t: parsed",
    f"""
SELECT o_orderkey, try_strptime(shown, [{sql_list(_SHOWN_SQL[:-1])}]) AS parsed
FROM (SELECT o_orderkey, CASE o_orderkey % {len(_SHOWN)} {' '.join(f"WHEN {i} THEN strftime(o_orderdate, '{f}')" for i, f in enumerate(_SHOWN_SQL))} END AS shown FROM orders)
""",
)
def _parse_dates(s, sf):
    day = F.col("o_orderdate").cast("timestamp")
    shown = F.element_at(F.array(*[F.date_format(day, f) for f in _SHOWN]), (F.col("o_orderkey") % len(_SHOWN) + 1).cast("int"))
    return ad.table(s, sf, "orders").select("o_orderkey", sc.parse_any_date(shown).alias("parsed"))


@register(
    "epoch_autodetect",
    "i: event_id | t: moment | i: back_seconds back_millis",
    """
SELECT event_id, m AS moment, epoch_ms(m) // 1000 AS back_seconds, epoch_ms(m) AS back_millis
FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN date_trunc('milliseconds', ts) ELSE date_trunc('second', ts) END AS m FROM events)
""",
)
def _epoch(s, sf):
    ts = F.col("ts").cast("timestamp")
    number = F.when(F.col("event_id") % 2 == 0, F.unix_millis(ts)).otherwise(F.unix_seconds(ts))
    moment = sc.epoch_to_timestamp(number)
    return ad.table(s, sf, "events").select(
        "event_id", moment.alias("moment"), sc.timestamp_to_epoch(moment).alias("back_seconds"),
        sc.timestamp_to_epoch(moment, milliseconds=True).alias("back_millis"),
    )


@register(
    "satoshi_scaling",
    "i: o_orderkey | e: btc",
    "SELECT o_orderkey, CAST(o_orderkey * 12345 AS DOUBLE) / 1e8 AS btc FROM orders",
)
def _satoshi(s, sf):
    return ad.table(s, sf, "orders").select("o_orderkey", sc.satoshi_to_btc(F.col("o_orderkey") * 12345).alias("btc"))


@register(
    "sentiment_normalize",
    "d: value_date | e: sentiment_score",
    "SELECT value_date, CAST(value - 50 AS DOUBLE) / 50 AS sentiment_score FROM x_sent",
)
def _normalize(s, sf):
    return Market(s, sf).sentiment.withColumn("sentiment_score", labels.sentiment_score(F.col("value")))


@register(
    "date_spine",
    "d: date_month | i: orders",
    """
SELECT CAST(d AS DATE) AS date_month, count(o_orderkey) AS orders
FROM (SELECT unnest(generate_series(DATE '1994-01-01', DATE '2002-12-01', INTERVAL 1 MONTH)) AS d)
LEFT JOIN orders ON date_trunc('month', o_orderdate) = d GROUP BY 1
""",
)
def _spine(s, sf):
    months = ad.table(s, sf, "orders").groupBy(F.trunc("o_orderdate", "month").alias("date_month")).agg(F.count("*").alias("n"))
    spine = sc.date_spine(s, "1994-01-01", "2002-12-01", "month")
    return spine.join(months, "date_month", "left").select("date_month", F.coalesce("n", F.lit(0)).alias("orders"))


# --- nested helpers -------------------------------------------------------------------------


def _packed_events(s, sf) -> DataFrame:
    return ad.table(s, sf, "events").select(
        F.struct("event_id", F.struct("user_id", F.struct("event_type", "value").alias("what")).alias("who")).alias("e"),
        F.when(F.col("event_id") % 4 != 0, F.from_json("props", "k int")).alias("props"),
    )


@register(
    "flatten_struct",
    "i: e_event_id e_who_user_id | s: e_who_what_event_type | e: e_who_what_value | i: props_k",
    "SELECT event_id AS e_event_id, user_id AS e_who_user_id, event_type AS e_who_what_event_type, value AS e_who_what_value, "
    "CASE WHEN event_id % 4 <> 0 THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS props_k FROM events",
)
def _flatten(s, sf):
    return sc.flatten_struct(_packed_events(s, sf))


@register(
    "nested_get",
    "i: event_id k",
    "SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN CAST(json_extract(props, '$.k') AS INTEGER) ELSE -1 END AS k FROM events",
)
def _nested_get(s, sf):
    return _packed_events(s, sf).select("e.event_id", sc.nested_get("props.k", -1).alias("k"))


@register(
    "required_fields",
    "b: complete | i: rows",
    "SELECT event_id % 4 <> 0 AS complete, count(*) AS rows FROM events GROUP BY 1",
)
def _required(s, sf):
    return _packed_events(s, sf).groupBy(sc.has_fields("e", "props").alias("complete")).agg(F.count("*").alias("rows"))


# --- messages -------------------------------------------------------------------------------


def trade_messages(s, sf) -> DataFrame:
    """Events as exchange trade messages; every ninth has no price, every 50th is broken."""
    key, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    text = F.to_json(
        F.struct(
            F.lit("trade").alias("e"), F.unix_millis(ts).alias("E"), F.upper("event_type").alias("s"), key.alias("t"),
            F.when(key % 9 != 0, F.col("value").cast("decimal(18,8)").cast("string")).alias("p"),
            F.get_json_object("props", "$.k").alias("q"), F.col("user_id").alias("b"), (F.col("user_id") + 1).alias("a"),
            F.unix_millis(ts).alias("T"), (F.col("user_id") % 2 == 1).alias("m"),
        )
    )
    cut = F.col("text").substr(F.lit(1), F.length("text") - 1)
    messages = ad.table(s, sf, "events").select(key.alias("n"), text.alias("text"))
    return messages.select(F.when(F.col("n") % 50 == 0, cut).otherwise(F.col("text")).alias("value"), "n")


_TRADE_MSG = "s: event_type symbol | i: trade_id buyer_order_id seller_order_id | t: event_time trade_time | e: price quantity | b: is_buyer_maker"
_TRADE_MSG_SQL = """
SELECT 'trade' AS event_type, upper(event_type) AS symbol, event_id AS trade_id, user_id AS buyer_order_id, user_id + 1 AS seller_order_id,
       date_trunc('milliseconds', ts) AS event_time, date_trunc('milliseconds', ts) AS trade_time,
       CASE WHEN event_id % 9 = 0 THEN 0 ELSE value END AS price, CAST(json_extract(props, '$.k') AS DOUBLE) AS quantity,
       user_id % 2 = 1 AS is_buyer_maker
FROM events WHERE {}
"""
register("parse_trade_json", _TRADE_MSG, _TRADE_MSG_SQL.format("event_id % 50 <> 0"))(
    lambda s, sf: nested.parse_trade_json(trade_messages(s, sf))
)


@register("route_envelope", _TRADE_MSG, _TRADE_MSG_SQL.format("event_id % 50 <> 0 AND event_id % 3 <> 2"))
def _route(s, sf):
    """A third wrapped, a third bare, a third wrapped in another stream's envelope."""
    n = F.col("n") % 3
    wrapped = F.concat(F.lit('{"stream":"x@trade","data":'), "value", F.lit("}"))
    other = F.concat(F.lit('{"stream":"x@depth","data":'), "value", F.lit("}"))
    mixed = trade_messages(s, sf).select(F.when(n == 0, wrapped).when(n == 1, F.col("value")).otherwise(other).alias("value"))
    return nested.parse_trade_json(nested.of_stream(nested.route_envelope(mixed), "trade"), "payload")


@register(
    "parse_kline_json",
    "s: symbol interval | t: open_time close_time | e: open high low close volume quote_volume | i: trades_count | b: is_closed",
    """
SELECT symbol, '1d' AS interval, CAST(trade_date AS TIMESTAMP) AS open_time, CAST(trade_date AS TIMESTAMP) + INTERVAL 86399999 MILLISECOND AS close_time,
       open_price AS open, high_price AS high, low_price AS low, close_price AS close, total_volume AS volume, total_value_usd AS quote_volume,
       trade_count AS trades_count, TRUE AS is_closed
FROM x_ebar
""",
)
def _klines(s, sf):
    start = F.unix_millis(F.col("trade_date").cast("timestamp"))
    bars = Market(s, sf, intraday=True).bars
    text = {"o": "open_price", "h": "high_price", "l": "low_price", "c": "close_price", "v": "total_volume", "q": "total_value_usd"}
    k = F.struct(
        F.lit("1d").alias("i"), start.alias("t"), (start + 86_399_999).alias("T"),
        *[F.col(c).cast("string").alias(n) for n, c in text.items()],
        F.col("trade_count").alias("n"), F.lit(True).alias("x"),
    )
    return nested.parse_kline_json(
        bars.select(F.to_json(F.struct(F.lit("kline").alias("e"), start.alias("E"), F.col("symbol").alias("s"), k.alias("k"))).alias("value"))
    )


@register(
    "parse_ticker_json",
    "s: event_type symbol | t: event_time open_time close_time | e: price_change price_change_percent weighted_avg_price "
    "last_price high_price low_price volume quote_volume bid_price | i: trades_count",
    """
SELECT '24hrTicker' AS event_type, symbol, CAST(trade_date AS TIMESTAMP) AS event_time, CAST(trade_date AS TIMESTAMP) AS open_time,
       CAST(trade_date AS TIMESTAMP) + INTERVAL 1 DAY AS close_time, price_change, price_change_percentage AS price_change_percent,
       avg_price AS weighted_avg_price, close_price AS last_price, high_price, low_price, total_volume AS volume,
       total_value_usd AS quote_volume, 0 AS bid_price, trade_count AS trades_count
FROM x_ebar
""",
)
def _tickers(s, sf):
    start = F.unix_millis(F.col("trade_date").cast("timestamp"))
    text = {
        "p": "price_change", "P": "price_change_percentage", "w": "avg_price", "c": "close_price", "h": "high_price",
        "l": "low_price", "v": "total_volume", "q": "total_value_usd",
    }
    message = F.struct(
        F.lit("24hrTicker").alias("e"), start.alias("E"), F.col("symbol").alias("s"),
        *[F.col(c).cast("string").alias(n) for n, c in text.items()],
        start.alias("O"), (start + 86_400_000).alias("C"), F.col("trade_count").alias("n"),
    )
    return nested.parse_ticker_json(Market(s, sf, intraday=True).bars.select(F.to_json(message).alias("value")))


# --- landed pages ---------------------------------------------------------------------------


def land_json(df: DataFrame, schema) -> DataFrame:
    """Write pages as JSON lines to the shared folder and read them back with a fixed schema."""
    path = scratch_path(df.sparkSession, "pages")
    df.write.json(path)
    return df.sparkSession.read.schema(schema).json(path)


@register(
    "zip_price_arrays",
    "s: coin_id | t: date | e: price volume market_cap",
    """
SELECT coin_id, last_updated_at AS date, current_price_usd AS price,
       CASE WHEN n <= c - 1 THEN volume_24h_usd END AS volume, CASE WHEN n <= c - 2 THEN market_cap_usd END AS market_cap
FROM (SELECT *, row_number() OVER (PARTITION BY coin_id, year(price_date) ORDER BY price_date) AS n,
             count(*) OVER (PARTITION BY coin_id, year(price_date)) AS c FROM x_coinstg)
""",
)
def _zip(s, sf):
    """Pages of one coin and year whose volume list is one and cap list two entries short."""
    at = F.unix_seconds("last_updated_at").cast("double")
    days = F.sort_array(F.collect_list(F.struct(at.alias("t"), F.col("current_price_usd").cast("double").alias("p"), F.col("volume_24h_usd").cast("double").alias("v"), F.col("market_cap_usd").cast("double").alias("m"))))
    pages = Market(s, sf).coins.groupBy("coin_id", F.year("price_date").alias("y")).agg(days.alias("d"))

    def pairs(field: str, short: int):
        cut = F.slice("d", 1, F.greatest(F.size("d") - short, F.lit(0)))
        return F.transform(cut, lambda x: F.array(x["t"], x[field]))

    landed = pages.select("coin_id", pairs("p", 0).alias("prices"), pairs("v", 1).alias("total_volumes"), pairs("m", 2).alias("market_caps"))
    return nested.zip_price_arrays(land_json(landed, schemas.PRICE_ARRAYS))


@register(
    "explode_observations",
    "s: series_id | d: date | e: value",
    "SELECT series_id, date, value FROM x_series WHERE month(date) <> 6",
)
def _observations(s, sf):
    shown = F.when(F.month("observation_date") == 6, ".").otherwise(F.col("value").cast("string"))
    row = F.struct(F.col("observation_date").cast("string").alias("date"), shown.alias("value"))
    pages = Macro(s, sf).series.groupBy("series_id", "observation_year").agg(F.collect_list(row).alias("observations"))
    return nested.explode_observations(land_json(pages, schemas.OBSERVATION_PAGE))


@register(
    "flatten_worldbank",
    "s: country_id country_name indicator_id indicator_name | i: year | e: value",
    "SELECT country_code AS country_id, country_name, indicator_code AS indicator_id, indicator_name, year, nullif(value, 0) AS value FROM x_wb",
)
def _worldbank(s, sf):
    item = F.struct(
        F.struct(F.col("country_code").alias("id"), F.col("country_name").alias("value")).alias("country"),
        F.struct(F.col("indicator_code").alias("id"), F.col("indicator_name").alias("value")).alias("indicator"),
        F.col("year").cast("string").alias("date"), F.col("value").cast("double").alias("value"), F.lit(0).alias("decimal"),
    )
    pages = Macro(s, sf).countries.groupBy("country_code").agg(F.to_json(F.collect_list(item)).alias("rows"))
    path = scratch_path(s, "pages")
    pages.select(F.concat(F.lit('[{"page":1},'), "rows", F.lit("]")).alias("value")).write.text(path)
    return nested.flatten_countries(s.read.text(path))


@register(
    "flatten_bls",
    "s: series_id | i: year | s: period period_name | e: value pct_change_1m pct_change_3m pct_change_6m pct_change_12m",
    """
SELECT series_id, year(date) AS year, 'M' || lpad(CAST(month(date) AS VARCHAR), 2, '0') AS period, monthname(date) AS period_name, value,
       CASE WHEN month(date) > 6 THEN month(date) * 0.5 END AS pct_change_1m, NULL AS pct_change_3m, NULL AS pct_change_6m,
       CASE WHEN month(date) > 6 THEN month(date) * 1.5 END AS pct_change_12m
FROM x_series
""",
)
def _labor(s, sf):
    m = F.col("observation_month")
    changes = F.when(m > 6, F.struct(F.create_map(F.lit("1"), (m * 0.5).cast("string"), F.lit("12"), (m * 1.5).cast("string")).alias("pct_changes")))
    row = F.struct(
        F.col("observation_year").cast("string").alias("year"), F.date_format("observation_date", "'M'MM").alias("period"),
        F.date_format("observation_date", "MMMM").alias("periodName"), F.col("value").cast("string").alias("value"), changes.alias("calculations"),
    )
    pages = Macro(s, sf).series.groupBy(F.col("series_id").alias("seriesID"), "observation_year").agg(F.collect_list(row).alias("data"))
    return nested.flatten_labor(land_json(pages, schemas.LABOR_PAGE))


def _accounts(s, sf) -> DataFrame:
    o = ad.table(s, sf, "orders")
    lines = o.groupBy(
        F.concat(F.year("o_orderdate"), F.lit("Q"), F.quarter("o_orderdate")).alias("TimePeriod"),
        F.substring("o_orderpriority", 1, 1).alias("LineNumber"),
    ).agg(F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("total"))
    row = F.struct(
        F.lit("T10101").alias("TableName"), F.concat(F.lit("S"), "LineNumber").alias("SeriesCode"), "LineNumber",
        F.concat(F.lit("line "), "LineNumber").alias("LineDescription"), "TimePeriod",
        F.format_number(F.col("total"), 2).alias("DataValue"), F.lit("n").alias("NoteRef"),
    )
    pages = lines.groupBy("TimePeriod").agg(F.collect_list(row).alias("Data"))
    return nested.flatten_accounts(land_json(pages.select("Data"), schemas.ACCOUNTS_PAGE))


_ACCOUNTS = "s: table_name series_code line_number line_description time_period | e: value"
_ACCOUNTS_SQL = """
SELECT 'T10101' AS table_name, 'S' || n AS series_code, n AS line_number, 'line ' || n AS line_description, p AS time_period, v AS value
FROM (SELECT o_orderpriority[1] AS n, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS p,
             sum(CAST(o_totalprice AS DECIMAL(12,2))) AS v FROM orders GROUP BY 1, 2)
"""
register("flatten_bea", _ACCOUNTS, _ACCOUNTS_SQL)(_accounts)
register("headline_gdp", _ACCOUNTS, _ACCOUNTS_SQL + " WHERE n = '1' ORDER BY p DESC LIMIT 1")(
    lambda s, sf: headline_gdp(_accounts(s, sf))
)


@register(
    "read_api_landing",
    "s: symbol | t: datetime | e: open high low close volume_from volume_to",
    "SELECT symbol, CAST(trade_date AS TIMESTAMP) AS datetime, open_price AS open, high_price AS high, low_price AS low, "
    "close_price AS close, total_volume AS volume_from, total_value_usd AS volume_to FROM x_bar",
)
def _history(s, sf):
    row = F.struct(
        F.unix_seconds(F.col("trade_date").cast("timestamp")).alias("time"),
        *[F.col(f"{c}_price").alias(c) for c in ("open", "high", "low", "close")],
        F.col("total_volume").alias("volumefrom"), F.col("total_value_usd").alias("volumeto"),
    )
    pages = Market(s, sf).bars.groupBy("symbol", F.trunc("trade_date", "month").alias("m")).agg(
        F.struct(F.collect_list(row).alias("Data")).alias("Data")
    )
    return nested.flatten_history(land_json(pages.select("symbol", "Data"), schemas.HISTORY_PAGE))


@register(
    "flatten_chart",
    "s: name | t: datetime | e: value",
    "SELECT 'hash_rate' AS name, CAST(stat_date AS TIMESTAMP) AS datetime, hash_rate AS value FROM x_chain",
)
def _chart(s, sf):
    point = F.struct(F.unix_seconds(F.col("stat_date").cast("timestamp")).alias("x"), F.col("hash_rate").alias("y"))
    pages = Market(s, sf).chain.groupBy(F.trunc("stat_date", "year").alias("y")).agg(F.collect_list(point).alias("values"))
    return nested.flatten_chart(land_json(pages.select(F.lit("hash_rate").alias("name"), "values"), schemas.CHART_PAGE))


@register(
    "landed_debt_pages",
    "d: record_date | e: tot_pub_debt_out_amt debt_held_public_amt",
    "SELECT record_date, total AS tot_pub_debt_out_amt, held AS debt_held_public_amt FROM x_debt",
)
def _debt_pages(s, sf):
    schema = "record_date date, tot_pub_debt_out_amt string, intragov_hold_amt string, debt_held_public_amt string"
    return cast_debt_amounts(land_json(Macro(s, sf).debt, schema))


@register(
    "rows_to_json",
    "s: source_table source_row_id | i: customer",
    "SELECT 'orders' AS source_table, CAST(o_orderkey AS VARCHAR) AS source_row_id, o_custkey AS customer FROM orders",
)
def _rows_to_json(s, sf):
    from tidemill.sources.tables import rows_to_json

    landed = rows_to_json(ad.table(s, sf, "orders").withColumnRenamed("o_orderkey", "orders_id"), "orders")
    return landed.withColumn("customer", F.get_json_object("record_data", "$.o_custkey").cast("bigint"))


@register(
    "json_to_rows",
    "i: orders_id o_custkey | s: o_orderstatus | e: o_totalprice",
    "SELECT o_orderkey AS orders_id, o_custkey, o_orderstatus, o_totalprice FROM orders",
)
def _json_to_rows(s, sf):
    from tidemill.sources.tables import json_to_rows, rows_to_json

    landed = rows_to_json(ad.table(s, sf, "orders").withColumnRenamed("o_orderkey", "orders_id"), "orders")
    return json_to_rows(landed, "orders_id bigint, o_custkey bigint, o_orderstatus string, o_totalprice double")


@register(
    "review_comment_cleanup",
    "i: review_id | s: comment_title comment_message | b: has_comment",
    "SELECT * FROM x_rev",
)
def _comments(s, sf):
    return Commerce(s, sf).reviews
