"""Registered market queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.operators import blocked
from tidemill.operators.ranking import latest_per_key
from tidemill.plans import adapters as ad
from tidemill.plans import market as mk
from tidemill.plans.market import Market
from tidemill.plans.oracle_tables import TABLES, case_of
from tidemill.plans.registry import register

_TRADES = (
    "i: trade_id | s: symbol | e: price quantity trade_value_usd | b: is_buyer_maker | s: trade_side "
    "| t: trade_timestamp | d: trade_date | i: trade_hour trade_day_of_week"
)
register("stg_trades", _TRADES, "SELECT *, trade_time AS trade_timestamp FROM x_est")(
    lambda s, sf: Market(s, sf, intraday=True).trades
)
register("stg_trades_market", _TRADES, "SELECT *, trade_time AS trade_timestamp FROM x_mst")(
    lambda s, sf: Market(s, sf).trades
)

TABLES["x_coinstg"] = """
SELECT coin_id, symbol, name, current_price AS current_price_usd, market_cap AS market_cap_usd,
       total_volume AS volume_24h_usd, price_change_24h AS price_change_24h_usd, pct AS price_change_percentage_24h,
       last_updated AS last_updated_at, CAST(last_updated AS DATE) AS price_date,
       CAST(total_volume AS DOUBLE) / CAST(market_cap AS DOUBLE) AS volume_to_market_cap_ratio,
       CASE WHEN pct > 0 THEN 'up' WHEN pct < 0 THEN 'down' ELSE 'flat' END AS price_trend_24h
FROM x_coin WHERE current_price > 0 AND market_cap > 0
"""
register(
    "stg_coin_prices",
    "s: coin_id symbol name | f2: current_price_usd market_cap_usd volume_24h_usd | f4: price_change_24h_usd "
    "price_change_percentage_24h | t: last_updated_at | d: price_date | f: volume_to_market_cap_ratio | s: price_trend_24h",
    "SELECT * FROM x_coinstg",
)(lambda s, sf: Market(s, sf).coins)

_BAR = (
    "s: symbol | d: trade_date | e: open_price high_price low_price close_price avg_price total_volume total_value_usd "
    "| i: trade_count | e: buy_volume_usd sell_volume_usd | t: first_trade_at last_trade_at | e: price_change "
    "| f: price_change_percentage | e: price_range | f: volatility_percentage buy_sell_pressure | e: avg_trade_size_usd"
)
register("daily_ohlcv", _BAR, "SELECT * FROM x_bar")(lambda s, sf: Market(s, sf).bars)
register("daily_ohlcv_intraday", _BAR, "SELECT * FROM x_ebar")(lambda s, sf: Market(s, sf, intraday=True).bars)
register(
    "win_first_last", "s: symbol | d: trade_date | e: open_price close_price", "SELECT * FROM x_bar"
)(lambda s, sf: Market(s, sf).bars)

# --- one symbol over many tasks ---------------------------------------------------------

TABLES["x_hour"] = """
SELECT symbol, date_trunc('hour', trade_time) AS price_hour, CAST(arg_max(price, (trade_time, trade_id)) AS DOUBLE) AS close_price
FROM x_est GROUP BY 1, 2
"""


@register(
    "hourly_averages",
    "s: symbol | t: price_hour | f6: sma_24h sma_168h volatility_24h change_24h",
    """
SELECT symbol, price_hour, CASE WHEN count(*) OVER d = 24 THEN avg(close_price) OVER d END AS sma_24h,
       CASE WHEN count(*) OVER w = 168 THEN avg(close_price) OVER w END AS sma_168h, stddev_samp(close_price) OVER d AS volatility_24h,
       close_price - lag(close_price, 24) OVER (PARTITION BY symbol ORDER BY price_hour) AS change_24h
FROM x_hour WINDOW d AS (PARTITION BY symbol ORDER BY price_hour ROWS 23 PRECEDING),
                   w AS (PARTITION BY symbol ORDER BY price_hour ROWS 167 PRECEDING)
""",
)
def _hourly_averages(s, sf):
    bars = mk.hourly_ohlcv(Market(s, sf, intraday=True).trades).select("symbol", "price_hour", "close_price")
    close = F.col("close_price")

    def made(window):
        day, week = window.rowsBetween(-23, 0), window.rowsBetween(-167, 0)
        return {
            "sma_24h": F.when(F.count("*").over(day) == 24, F.avg(close).over(day)),
            "sma_168h": F.when(F.count("*").over(week) == 168, F.avg(close).over(week)),
            "volatility_24h": F.stddev_samp(close).over(day),
            "change_24h": close - F.lag(close, 24).over(window),
        }

    return blocked.sliding(bars, ["symbol"], ["price_hour"], 167, made)


@register(
    "running_volume",
    "i: trade_id | s: symbol | e: running_quantity running_value | i: trade_number",
    """
SELECT trade_id, symbol, CAST(sum(quantity) OVER w AS DOUBLE) AS running_quantity, CAST(sum(trade_value_usd) OVER w AS DOUBLE) AS running_value,
       count(*) OVER w AS trade_number
FROM x_est WINDOW w AS (PARTITION BY symbol ORDER BY trade_time, trade_id ROWS UNBOUNDED PRECEDING)
""",
)
def _running_volume(s, sf):
    order = ["trade_timestamp", "trade_id"]
    parts = blocked.dealt(Market(s, sf, intraday=True).trades, ["symbol"], *order)
    sums = {"running_quantity": F.col("quantity"), "running_value": F.col("trade_value_usd"), "trade_number": F.lit(1).cast("long")}
    return blocked.running_sums(parts, ["symbol"], order, sums)


@register(
    "side_streaks",
    "i: trade_id | s: symbol trade_side | i: streak",
    """
SELECT trade_id, symbol, trade_side, row_number() OVER (PARTITION BY symbol, run ORDER BY trade_time, trade_id) AS streak
FROM (SELECT *, sum(CASE WHEN trade_side IS DISTINCT FROM side_before THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY trade_time, trade_id) AS run
      FROM (SELECT *, lag(trade_side) OVER (PARTITION BY symbol ORDER BY trade_time, trade_id) AS side_before FROM x_est))
""",
)
def _side_streaks(s, sf):
    trades = Market(s, sf, intraday=True).trades.select("trade_id", "symbol", "trade_timestamp", "trade_side")
    return blocked.streaks(trades, ["symbol"], ["trade_timestamp", "trade_id"], "trade_side")


@register(
    "sell_asof_buy",
    "i: trade_id | s: symbol | e: price buy_price",
    """
WITH buys AS (SELECT symbol, trade_time, max(price) AS buy_price FROM x_est WHERE trade_side = 'buy' GROUP BY 1, 2)
SELECT s.trade_id, s.symbol, CAST(s.price AS DOUBLE) AS price, CAST(b.buy_price AS DOUBLE) AS buy_price
FROM (SELECT * FROM x_est WHERE trade_side = 'sell') s ASOF LEFT JOIN buys b ON s.symbol = b.symbol AND s.trade_time >= b.trade_time
""",
)
def _sell_asof_buy(s, sf):
    """Each sale with the price of the last purchase of its symbol, at the grain of trades."""
    trades = Market(s, sf, intraday=True).trades
    sells = trades.where("trade_side = 'sell'").select("trade_id", "symbol", "price", "trade_timestamp")
    buys = trades.where("trade_side = 'buy'").select("symbol", "trade_timestamp", F.col("price").alias("buy_price"))
    return blocked.asof_join(sells, buys, ["symbol"], "trade_timestamp", ["buy_price"])


register(
    "hourly_ohlcv",
    "s: symbol | t: price_hour | e: open_price high_price low_price close_price volume_usd | i: trades_count "
    "| e: vwap | f: hourly_return_pct",
    """
SELECT *, (close_price / lag(close_price) OVER (PARTITION BY symbol ORDER BY price_hour) - 1) * 100 AS hourly_return_pct
FROM (SELECT symbol, date_trunc('hour', trade_time) AS price_hour,
             CAST(arg_min(price, (trade_time, trade_id)) AS DOUBLE) AS open_price, CAST(max(price) AS DOUBLE) AS high_price,
             CAST(min(price) AS DOUBLE) AS low_price, CAST(arg_max(price, (trade_time, trade_id)) AS DOUBLE) AS close_price,
             CAST(sum(trade_value_usd) AS DOUBLE) AS volume_usd, count(*) AS trades_count,
             CAST(sum(trade_value_usd) AS DOUBLE) / CAST(sum(quantity) AS DOUBLE) AS vwap
      FROM x_est GROUP BY 1, 2)
""",
)(lambda s, sf: mk.hourly_ohlcv(Market(s, sf, intraday=True).trades))

TABLES["x_ret"] = """
SELECT *, (close_price / lag(close_price) OVER (PARTITION BY symbol ORDER BY trade_date) - 1) * 100 AS daily_return_pct,
       (high_price - low_price) / close_price * 100 AS daily_range_pct
FROM x_bar
"""
_PERIOD = (
    "s: symbol | d: period_start period_end | e: open_price high_price low_price close_price | f2: total_volume_usd "
    "| f6: avg_daily_volume | i: trading_days | f: return_pct | f6: volatility"
)
_PERIOD_SQL = """
SELECT *, {end} AS period_end, (close_price - open_price) / open_price * 100 AS return_pct
FROM (SELECT symbol, CAST(date_trunc('{unit}', trade_date) AS DATE) AS period_start, arg_min(open_price, trade_date) AS open_price,
             max(high_price) AS high_price, min(low_price) AS low_price, arg_max(close_price, trade_date) AS close_price,
             sum(total_value_usd) AS total_volume_usd, avg(total_value_usd) AS avg_daily_volume, count(*) AS trading_days,
             stddev_samp(daily_return_pct) AS volatility
      FROM x_ret GROUP BY 1, 2)
"""
register("weekly_ohlcv", _PERIOD, _PERIOD_SQL.format(unit="week", end="period_start + 6"))(
    lambda s, sf: mk.period_ohlcv(Market(s, sf).bars, "week")
)
register("monthly_ohlcv", _PERIOD, _PERIOD_SQL.format(unit="month", end="last_day(period_start)"))(
    lambda s, sf: mk.period_ohlcv(Market(s, sf).bars, "month")
)

TABLES["x_ana"] = """
SELECT *,
       CASE WHEN close_price > ma_7d AND ma_7d > ma_30d THEN 'bullish'
            WHEN close_price < ma_7d AND ma_7d < ma_30d THEN 'bearish' ELSE 'neutral' END AS trend_signal,
       CASE WHEN total_value_usd > 1.5 * avg_volume_7d THEN 'high_volume'
            WHEN total_value_usd < 0.5 * avg_volume_7d THEN 'low_volume' ELSE 'normal_volume' END AS volume_signal,
       CASE WHEN volatility_percentage > 5 THEN 'high_volatility'
            WHEN volatility_percentage < 2 THEN 'low_volatility' ELSE 'normal_volatility' END AS volatility_signal
FROM (SELECT b.*, k.market_cap_usd, k.volume_24h_usd AS market_volume_24h, k.volume_to_market_cap_ratio,
             avg(close_price) OVER w7 AS ma_7d, avg(close_price) OVER (PARTITION BY b.symbol ORDER BY trade_date ROWS 29 PRECEDING) AS ma_30d,
             stddev_samp(close_price) OVER w7 AS volatility_7d, avg(total_value_usd) OVER w7 AS avg_volume_7d
      FROM x_bar b LEFT JOIN x_coinstg k ON b.symbol = upper(k.symbol) || 'USDT' AND b.trade_date = k.price_date
      WINDOW w7 AS (PARTITION BY b.symbol ORDER BY trade_date ROWS 6 PRECEDING))
"""
register(
    "crypto_daily_analytics",
    "s: symbol | d: trade_date | e: close_price total_value_usd | f2: market_cap_usd market_volume_24h "
    "| f: volume_to_market_cap_ratio | f6: ma_7d ma_30d volatility_7d avg_volume_7d | s: trend_signal volume_signal volatility_signal",
    "SELECT * FROM x_ana",
)(lambda s, sf: Market(s, sf).analytics)
for _n in ("trend_signal", "volume_signal", "volatility_signal"):
    register(_n, f"s: symbol | d: trade_date | s: {_n}", "SELECT * FROM x_ana")(lambda s, sf: Market(s, sf).analytics)
register(
    "join_computed_key", "s: symbol | d: trade_date | f2: market_cap_usd market_volume_24h", "SELECT * FROM x_ana"
)(lambda s, sf: mk.enrich_with_market(Market(s, sf).bars, Market(s, sf).coins))

register("daily_returns", "s: symbol | d: trade_date | f: daily_return_pct daily_range_pct", "SELECT * FROM x_ret")(
    lambda s, sf: mk.daily_returns(Market(s, sf).bars)
)
TABLES["x_sma"] = (
    "SELECT *, sma_50d - sma_200d AS gap FROM (SELECT symbol, trade_date, close_price, "
    + ", ".join(
        f"CASE WHEN count(*) OVER w{n} = {n} THEN avg(close_price) OVER w{n} END AS sma_{n}d" for n in (7, 30, 50, 200)
    )
    + " FROM x_bar WINDOW "
    + ", ".join(f"w{n} AS (PARTITION BY symbol ORDER BY trade_date ROWS {n - 1} PRECEDING)" for n in (7, 30, 50, 200))
    + ")"
)
register(
    "sma_set",
    "s: symbol | d: trade_date | f6: sma_7d sma_30d sma_50d sma_200d | b: is_above_sma_50 is_above_sma_200",
    "SELECT *, close_price > sma_50d AS is_above_sma_50, close_price > sma_200d AS is_above_sma_200 FROM x_sma",
)(lambda s, sf: mk.sma_set(Market(s, sf).bars))
register(
    "golden_death_cross",
    "s: symbol | d: trade_date | b: golden_cross_signal death_cross_signal",
    "SELECT symbol, trade_date, coalesce(gap > 0 AND lag(gap) OVER w <= 0, FALSE) AS golden_cross_signal, "
    "coalesce(gap < 0 AND lag(gap) OVER w >= 0, FALSE) AS death_cross_signal FROM x_sma "
    "WINDOW w AS (PARTITION BY symbol ORDER BY trade_date)",
)(lambda s, sf: mk.crosses(mk.sma_set(Market(s, sf).bars)))
register(
    "rolling_volatility",
    "s: symbol | d: trade_date | f6: volatility_7d volatility_30d",
    "SELECT symbol, trade_date, stddev_samp(daily_return_pct) OVER (PARTITION BY symbol ORDER BY trade_date ROWS 6 PRECEDING) "
    "AS volatility_7d, stddev_samp(daily_return_pct) OVER (PARTITION BY symbol ORDER BY trade_date ROWS 29 PRECEDING) "
    "AS volatility_30d FROM x_ret",
)(lambda s, sf: mk.rolling_volatility(mk.daily_returns(Market(s, sf).bars)))
register(
    "rsi_14",
    "s: symbol | d: trade_date | f6: rsi_14d",
    """
SELECT symbol, trade_date, CASE WHEN n = 14 THEN CASE WHEN dn = 0 THEN 100 ELSE 100 - 100 / (1 + up / dn) END END AS rsi_14d
FROM (SELECT symbol, trade_date, count(d) OVER w AS n, avg(CASE WHEN d > 0 THEN d WHEN d IS NOT NULL THEN 0 END) OVER w AS up,
             avg(CASE WHEN d < 0 THEN -d WHEN d IS NOT NULL THEN 0 END) OVER w AS dn
      FROM (SELECT *, close_price - lag(close_price) OVER (PARTITION BY symbol ORDER BY trade_date) AS d FROM x_bar)
      WINDOW w AS (PARTITION BY symbol ORDER BY trade_date ROWS 13 PRECEDING))
""",
)(lambda s, sf: mk.rsi(Market(s, sf).bars))
register(
    "volume_spike",
    "s: symbol | d: trade_date | f6: volume_sma_20d | b: is_high_volume",
    "SELECT symbol, trade_date, avg(total_value_usd) OVER w AS volume_sma_20d, total_value_usd > 2 * avg(total_value_usd) OVER w "
    "AS is_high_volume FROM x_bar WINDOW w AS (PARTITION BY symbol ORDER BY trade_date ROWS 19 PRECEDING)",
)(lambda s, sf: mk.volume_spikes(Market(s, sf).bars))
register(
    "ema",
    "s: symbol | t: price_hour | f6: ema_12h ema_24h",
    """
WITH RECURSIVE h AS MATERIALIZED (SELECT symbol, date_trunc('hour', trade_time) AS t,
         CAST(arg_max(price, (trade_time, trade_id)) AS DOUBLE) AS c,
         row_number() OVER (PARTITION BY symbol ORDER BY date_trunc('hour', trade_time)) AS n
  FROM x_est GROUP BY 1, 2),
e AS (SELECT symbol, t, n, c AS a, c AS b FROM h WHERE n = 1
      UNION ALL SELECT h.symbol, h.t, h.n, h.c * 2 / 13 + e.a * 11 / 13, h.c * 2 / 25 + e.b * 23 / 25
      FROM e JOIN h ON h.symbol = e.symbol AND h.n = e.n + 1)
SELECT symbol, t AS price_hour, a AS ema_12h, b AS ema_24h FROM e
""",
)(lambda s, sf: mk.gold_hourly(Market(s, sf, intraday=True).trades))

register(
    "market_breadth",
    "d: market_date | f2: total_market_cap_usd total_volume_24h_usd | f: btc_dominance_pct eth_dominance_pct "
    "| i: coins_gainers coins_losers | f: advance_decline_ratio | s: top_gainer_id | f4: top_gainer_pct "
    "| s: top_loser_id | f4: top_loser_pct",
    """
SELECT price_date AS market_date, sum(market_cap_usd) AS total_market_cap_usd, sum(volume_24h_usd) AS total_volume_24h_usd,
       CAST(sum(market_cap_usd) FILTER (coin_id = 'bitcoin') AS DOUBLE) / CAST(sum(market_cap_usd) AS DOUBLE) * 100 AS btc_dominance_pct,
       CAST(sum(market_cap_usd) FILTER (coin_id = 'ethereum') AS DOUBLE) / CAST(sum(market_cap_usd) AS DOUBLE) * 100 AS eth_dominance_pct,
       count(*) FILTER (price_change_percentage_24h > 0) AS coins_gainers,
       count(*) FILTER (price_change_percentage_24h < 0) AS coins_losers,
       CAST(coins_gainers AS DOUBLE) / nullif(coins_losers, 0) AS advance_decline_ratio,
       arg_min(coin_id, (-price_change_percentage_24h, coin_id)) AS top_gainer_id, max(price_change_percentage_24h) AS top_gainer_pct,
       arg_min(coin_id, (price_change_percentage_24h, coin_id)) AS top_loser_id, min(price_change_percentage_24h) AS top_loser_pct
FROM x_coinstg GROUP BY 1
""",
)(lambda s, sf: mk.market_breadth(Market(s, sf).coins))
register(
    "top_coins",
    "s: coin_id | d: price_date | f2: market_cap_usd",
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY price_date DESC) AS age FROM x_coinstg) "
    "WHERE age = 1 ORDER BY market_cap_usd DESC, coin_id LIMIT 3",
)(lambda s, sf: mk.top_coins(Market(s, sf).coins, 3))
register(
    "price_history",
    "s: coin_id | d: date | f2: price volume market_cap",
    "SELECT coin_id, price_date AS date, current_price_usd AS price, volume_24h_usd AS volume, market_cap_usd AS market_cap "
    "FROM x_coinstg WHERE coin_id = 'bitcoin' AND price_date > (SELECT max(price_date) - 90 FROM x_coinstg WHERE coin_id = 'bitcoin')",
)(lambda s, sf: mk.price_history(Market(s, sf).coins, "bitcoin", 90))


@register(
    "ohlc_history",
    "s: symbol | t: timestamp | e: open high low close",
    "SELECT symbol, CAST(trade_date AS TIMESTAMP) AS timestamp, open_price AS open, high_price AS high, low_price AS low, "
    "close_price AS close FROM x_bar",
)
def _ohlc_history(s, sf):
    """Bars packed per symbol and month into arrays, as the landed pages hold them, then unpacked."""
    bars = Market(s, sf).bars
    row = F.array(
        F.unix_millis(F.col("trade_date").cast("timestamp")).cast("double"),
        "open_price", "high_price", "low_price", "close_price",
    )
    pages = bars.groupBy("symbol", F.trunc("trade_date", "month").alias("page")).agg(F.collect_list(row).alias("ohlc"))
    return mk.ohlc_history(pages)


@register(
    "dedupe_latest",
    "s: coin_id | t: last_updated_at | f2: current_price_usd",
    "SELECT coin_id, max(last_updated_at) AS last_updated_at, arg_max(current_price_usd, last_updated_at) AS current_price_usd "
    "FROM x_coinstg GROUP BY 1",
)
def _dedupe(s, sf):
    return latest_per_key(Market(s, sf).coins, ["coin_id"], "last_updated_at")


# --- sentiment, chain, returns --------------------------------------------------------------

_CLASS = case_of([("value <= 24", "Extreme Fear"), ("value <= 49", "Fear"), ("value = 50", "Neutral"), ("value <= 74", "Greed")], "Extreme Greed")
_SIGNAL = case_of(
    [("value <= 20", "Strong Buy Signal"), ("value <= 35", "Buy Signal"), ("value <= 65", "Hold"), ("value <= 80", "Sell Signal")],
    "Strong Sell Signal",
)
TABLES["x_feel"] = f"""
SELECT value_date, value, {_CLASS} AS classification, {_SIGNAL} AS trading_signal, (value - 50) / 50.0 AS sentiment_score
FROM x_sent
"""
register(
    "sentiment_features",
    "d: value_date | i: value | s: classification trading_signal | f: sentiment_score ma_7d ma_30d sentiment_change_1d "
    "sentiment_change_7d | b: is_extreme_fear is_extreme_greed | s: contrarian_signal",
    """
SELECT *, avg(value) OVER (ORDER BY value_date ROWS 6 PRECEDING) AS ma_7d, avg(value) OVER (ORDER BY value_date ROWS 29 PRECEDING) AS ma_30d,
       CAST(sentiment_score - lag(sentiment_score) OVER w AS DOUBLE) AS sentiment_change_1d,
       CAST(sentiment_score - lag(sentiment_score, 7) OVER w AS DOUBLE) AS sentiment_change_7d,
       value < 20 AS is_extreme_fear, value > 80 AS is_extreme_greed,
       CASE WHEN value < 20 THEN 'buy' WHEN value > 80 THEN 'sell' ELSE 'hold' END AS contrarian_signal
FROM x_feel WINDOW w AS (ORDER BY value_date)
""",
)(lambda s, sf: mk.sentiment_features(Market(s, sf).sentiment))
register("classify_sentiment", "d: value_date | i: value | s: classification", "SELECT * FROM x_feel")(
    lambda s, sf: mk.sentiment_features(Market(s, sf).sentiment)
)
register("sentiment_signal", "d: value_date | i: value | s: trading_signal", "SELECT * FROM x_feel")(
    lambda s, sf: mk.sentiment_features(Market(s, sf).sentiment)
)
register(
    "sentiment_summary",
    "i: current_value | s: current_classification trading_signal | f1: avg_7d avg_30d | s: trend_7d | i: min_30d max_30d | d: last_update",
    f"""
SELECT arg_max(value, value_date) AS current_value, arg_max(classification, value_date) AS current_classification,
       arg_max(trading_signal, value_date) AS trading_signal, avg(value) FILTER (n <= 7) AS avg_7d, avg(value) AS avg_30d,
       CASE WHEN avg(value) FILTER (n <= 3) > avg(value) FILTER (n IN (5, 6, 7)) THEN 'improving' ELSE 'declining' END AS trend_7d,
       min(value) AS min_30d, max(value) AS max_30d, max(value_date) AS last_update
FROM (SELECT *, row_number() OVER (ORDER BY value_date DESC) AS n FROM x_feel) WHERE n <= 30
""",
)(lambda s, sf: mk.sentiment_summary(Market(s, sf).sentiment))
register(
    "sentiment_history",
    "d: date | i: value | s: classification | f: sentiment_score",
    "SELECT value_date AS date, * FROM x_feel ORDER BY value_date DESC LIMIT 30",
)(lambda s, sf: mk.sentiment_history(Market(s, sf).sentiment))
register(
    "extreme_sentiment",
    "d: value_date | i: value | s: event | i: event_count",
    "SELECT value_date, value, CASE WHEN value <= 20 THEN 'extreme_fear' ELSE 'extreme_greed' END AS event, "
    "count(*) OVER (PARTITION BY value <= 20) AS event_count FROM x_feel WHERE value <= 20 OR value >= 80",
)(lambda s, sf: mk.extreme_sentiment(Market(s, sf).sentiment))

register(
    "network_summary",
    "d: stat_date | e: price_usd | f4: market_cap_usd | e: hash_rate difficulty total_btc | i: block_height transactions_24h "
    "| e: btc_sent_24h | f2: miners_revenue_24h | i: n_blocks_mined_24h mempool_size | e: estimated_transaction_volume",
    """
SELECT *, top_price AS price_usd, price_usd * CAST(totalbc AS DOUBLE) / 1e8 AS market_cap_usd,
       CAST(totalbc AS DOUBLE) / 1e8 AS total_btc, n_tx AS transactions_24h, CAST(sats * 1000000 AS DOUBLE) / 1e8 AS btc_sent_24h,
       rev_float AS miners_revenue_24h, n_blocks_total AS n_blocks_mined_24h, mempool_bytes AS mempool_size,
       CAST(sats * 500000 AS DOUBLE) / 1e8 AS estimated_transaction_volume
FROM x_chain
""",
)(lambda s, sf: mk.network_summary(Market(s, sf).chain))
register(
    "onchain_metrics",
    "d: metric_date | e: hash_rate_eh | f: hash_rate_change_pct | e: total_btc daily_issuance | f6: issuance_rate_pct "
    "| f: hash_price | f6: stock_to_flow | f2: s2f_model_price",
    """
WITH b AS (SELECT stat_date AS metric_date, hash_rate AS hash_rate_eh, (hash_rate / lag(hash_rate) OVER (ORDER BY stat_date) - 1) * 100 AS hash_rate_change_pct,
                  CAST(totalbc AS DOUBLE) / 1e8 AS total_btc, btc_mined_daily AS daily_issuance,
                  btc_mined_daily * 365 / nullif(CAST(totalbc AS DOUBLE) / 1e8, 0) * 100 AS issuance_rate_pct,
                  rev_float / (hash_rate * 1e6) AS hash_price, CAST(totalbc AS DOUBLE) / 1e8 / (btc_mined_daily * 365) AS stock_to_flow,
                  top_price * (CAST(totalbc AS DOUBLE) / 1e8) AS cap
           FROM x_chain),
f AS (SELECT regr_slope(ln(cap), ln(stock_to_flow)) AS k, regr_intercept(ln(cap), ln(stock_to_flow)) AS a FROM b WHERE stock_to_flow > 0 AND cap > 0)
SELECT b.*, exp(a + k * ln(nullif(stock_to_flow, 0))) / nullif(total_btc, 0) AS s2f_model_price FROM b, f
""",
)(lambda s, sf: mk.onchain_metrics(Market(s, sf).chain))

TABLES["x_close"] = (
    "SELECT "
    + case_of([(f"symbol = '{a}'", b) for a, b in zip(ad.MARKET_SYMBOLS, ["btc", "eth", "sp500", "gold", "dxy"])], None)
    + " AS asset, trade_date AS date, close_price AS price FROM x_bar"
)
for _p, _d in fv.PERIOD_DAYS.items():
    register(
        "asset_returns" if _p == "1y" else f"asset_returns_{_p}",
        "s: asset | f2: return_pct",
        "SELECT asset, (arg_max(price, date) - arg_min(price, date)) / arg_min(price, date) * 100 AS return_pct FROM x_close "
        f"WHERE date >= (SELECT max(date) FROM x_close) - {_d} GROUP BY 1",
    )(lambda s, sf, _p=_p: mk.asset_returns(Market(s, sf).closes, _p))
