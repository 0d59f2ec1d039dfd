"""Trades, coin prices, bars, indicators, sentiment and chain figures.

Raw trades are reduced to one row per symbol and day (or hour) with map-side combine, so a
symbol that holds most trades costs no more than another. All windows run on those bars.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions import labels
from tidemill.functions.scalars import pct_change, ratio, satoshi_to_btc, time_key
from tidemill.operators.ranking import latest_per_key
from tidemill.operators.timeseries import dated, ema, full_moving_avg, last_rows, moving_avg
from tidemill.plans import adapters
from tidemill.session import materialize

PRICE = "decimal(18,8)"


def stg_trades(raw: DataFrame) -> DataFrame:
    """Typed trades with side and calendar fields; only priced, sized and dated rows stay."""
    price, size = F.col("price"), F.col("quantity")
    ts = F.col("trade_time").cast("timestamp")
    return raw.where(F.col("trade_time").isNotNull() & (price > 0) & (size > 0)).select(
        "trade_id",
        "symbol",
        price.cast(PRICE).alias("price"),
        size.cast(PRICE).alias("quantity"),
        (price.cast("decimal(28,10)") * size.cast(PRICE)).cast(PRICE).alias("trade_value_usd"),
        "is_buyer_maker",
        F.when(F.col("is_buyer_maker"), "sell").otherwise("buy").alias("trade_side"),
        ts.alias("trade_timestamp"),
        F.to_date(ts).alias("trade_date"),
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
        F.hour(ts).alias("trade_hour"),
        F.dayofweek(ts).alias("trade_day_of_week"),
        F.lit(True).alias("is_valid_trade"),
    )


def stg_coin_prices(raw: DataFrame) -> DataFrame:
    cap, volume = F.col("market_cap").cast("decimal(20,2)"), F.col("total_volume").cast("decimal(20,2)")
    pct = F.col("price_change_percentage_24h").cast("decimal(10,4)")
    seen = F.col("last_updated").cast("timestamp")
    valid = (F.col("current_price") > 0) & (F.col("market_cap") > 0)
    return raw.where(F.col("last_updated").isNotNull() & F.col("coin_id").isNotNull() & valid).select(
        "coin_id",
        "symbol",
        "name",
        F.col("current_price").cast(PRICE).alias("current_price_usd"),
        cap.alias("market_cap_usd"),
        volume.alias("volume_24h_usd"),
        F.col("price_change_24h").cast(PRICE).alias("price_change_24h_usd"),
        pct.alias("price_change_percentage_24h"),
        seen.alias("last_updated_at"),
        F.to_date(seen).alias("price_date"),
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
        ratio(volume, cap).alias("volume_to_market_cap_ratio"),
        labels.first_match([(pct > 0, "up"), (pct < 0, "down")], "flat").alias("price_trend_24h"),
        F.lit(True).alias("is_valid_price"),
    )


# --- bars -------------------------------------------------------------------------------


def bar_aggregates(price: str, ts: str, tie: str) -> dict[str, Column]:
    """Open, high, low, close: first and last by time, ties by a unique column."""
    moment = time_key(ts, tie)
    return {
        "open_price": F.min_by(price, moment),
        "high_price": F.max(price),
        "low_price": F.min(price),
        "close_price": F.max_by(price, moment),
    }


def daily_ohlcv(trades: DataFrame) -> DataFrame:
    value = F.col("trade_value_usd")
    zero = F.lit(0).cast(PRICE)
    bars = trades.groupBy("symbol", "trade_date").agg(
        *[c.cast("double").alias(n) for n, c in bar_aggregates("price", "trade_timestamp", "trade_id").items()],
        ratio(F.sum("price"), F.count("*")).alias("avg_price"),
        F.sum("quantity").cast("double").alias("total_volume"),
        F.sum(value).cast("double").alias("total_value_usd"),
        F.count("*").alias("trade_count"),
        *[
            F.sum(F.when(F.col("trade_side") == side, value).otherwise(zero)).cast("double").alias(f"{side}_volume_usd")
            for side in ("buy", "sell")
        ],
        F.min("trade_timestamp").alias("first_trade_at"),
        F.max("trade_timestamp").alias("last_trade_at"),
    )
    both = F.col("buy_volume_usd") + F.col("sell_volume_usd")
    spread = F.col("high_price") - F.col("low_price")
    return bars.withColumns(
        {
            "price_change": F.col("close_price") - F.col("open_price"),
            "price_change_percentage": pct_change(F.col("close_price"), F.col("open_price")),
            "price_range": spread,
            "volatility_percentage": F.when(F.col("avg_price") > 0, spread / F.col("avg_price") * 100),
            "buy_sell_pressure": F.when(
                both > 0, (F.col("buy_volume_usd") - F.col("sell_volume_usd")) / both
            ).otherwise(0.0),
            "avg_trade_size_usd": ratio(F.col("total_value_usd"), F.col("trade_count")),
        }
    )


def hourly_ohlcv(trades: DataFrame) -> DataFrame:
    """Hourly bars per symbol with volume-weighted price and return over the previous bar."""
    bars = trades.groupBy("symbol", F.date_trunc("hour", "trade_timestamp").alias("price_hour")).agg(
        *[c.cast("double").alias(n) for n, c in bar_aggregates("price", "trade_timestamp", "trade_id").items()],
        F.sum("trade_value_usd").cast("double").alias("volume_usd"),
        F.count("*").alias("trades_count"),
        ratio(F.sum("trade_value_usd"), F.sum("quantity")).alias("vwap"),
    )
    before = F.lag("close_price").over(dated("price_hour", "symbol"))
    return bars.withColumn("hourly_return_pct", (ratio(F.col("close_price"), before) - 1) * 100)


def period_ohlcv(daily: DataFrame, unit: str) -> DataFrame:
    """Weekly or monthly bars from daily bars; volatility is that of daily returns."""
    period = F.to_date(F.date_trunc(unit, "trade_date"))
    returned = daily_returns(daily)
    bars = returned.groupBy("symbol", period.alias("period_start")).agg(
        F.min_by("open_price", "trade_date").alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", "trade_date").alias("close_price"),
        F.sum("total_value_usd").alias("total_volume_usd"),
        F.avg("total_value_usd").alias("avg_daily_volume"),
        F.count("*").alias("trading_days"),
        F.stddev_samp("daily_return_pct").alias("volatility"),
    )
    return bars.withColumns(
        {
            "period_end": F.to_date(F.last_day("period_start")) if unit == "month" else F.date_add("period_start", 6),
            "return_pct": pct_change(F.col("close_price"), F.col("open_price")),
        }
    )


# --- daily analytics ----------------------------------------------------------------------


def enrich_with_market(bars: DataFrame, coins: DataFrame, upper: bool = True) -> DataFrame:
    """Attach market figures by pair symbol (coin symbol + quote currency) and date."""
    code = F.upper("symbol") if upper else F.col("symbol")
    market = coins.select(
        F.concat(code, F.lit("USDT")).alias("symbol"),
        F.col("price_date").alias("trade_date"),
        "market_cap_usd",
        F.col("volume_24h_usd").alias("market_volume_24h"),
        "volume_to_market_cap_ratio",
    )
    return bars.join(market, ["symbol", "trade_date"], "left")


def daily_analytics(bars: DataFrame, coins: DataFrame, upper: bool = True) -> DataFrame:
    close, value = F.col("close_price"), F.col("total_value_usd")
    at = ("trade_date", "symbol")
    with_windows = enrich_with_market(bars, coins, upper).withColumns(
        {
            "ma_7d": moving_avg(close, 7, *at),
            "ma_30d": moving_avg(close, 30, *at),
            "volatility_7d": F.stddev_samp(close).over(last_rows(7, *at)),
            "avg_volume_7d": moving_avg(value, 7, *at),
        }
    )
    return with_windows.withColumns(
        {
            "trend_signal": labels.trend_signal(close, F.col("ma_7d"), F.col("ma_30d")),
            "volume_signal": labels.volume_signal(value, F.col("avg_volume_7d")),
            "volatility_signal": labels.volatility_signal(F.col("volatility_percentage")),
        }
    )


def daily_returns(bars: DataFrame) -> DataFrame:
    before = F.lag("close_price").over(dated("trade_date", "symbol"))
    return bars.withColumns(
        {
            "daily_return_pct": (ratio(F.col("close_price"), before) - 1) * 100,
            "daily_range_pct": ratio(F.col("high_price") - F.col("low_price"), F.col("close_price")) * 100,
        }
    )


def rsi(bars: DataFrame, periods: int = 14, out: str = "rsi_14d") -> DataFrame:
    """Simple-average relative strength; NULL until `periods` changes exist, 100 without losses."""
    at = ("trade_date", "symbol")
    change = F.col("close_price") - F.lag("close_price").over(dated(*at))
    frame = last_rows(periods, *at)
    moved = bars.withColumn("_change", change)
    gain = F.avg(F.greatest("_change", F.lit(0.0))).over(frame)
    loss = F.avg(F.greatest(-F.col("_change"), F.lit(0.0))).over(frame)
    known = F.count("_change").over(frame)
    value = F.when(loss == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + gain / F.when(loss != 0, loss)))
    return moved.withColumn(out, F.when(known == periods, value)).drop("_change")


def sma_set(bars: DataFrame, spans: tuple[int, ...] = (7, 30, 50, 200)) -> DataFrame:
    """Moving averages of the close (NULL until the window is full) and above-average flags."""
    at = ("trade_date", "symbol")
    close = F.col("close_price")
    out = bars.withColumns({f"sma_{n}d": full_moving_avg(close, n, *at) for n in spans})
    return out.withColumns({f"is_above_sma_{n}": close > F.col(f"sma_{n}d") for n in spans if n >= 50})


def crosses(bars: DataFrame) -> DataFrame:
    """Days on which the 50-day average crosses the 200-day one; both windows must be full."""
    side = F.signum(F.col("sma_50d") - F.col("sma_200d"))
    before = F.lag("_side").over(dated("trade_date", "symbol"))
    return (
        bars.withColumn("_side", side)
        .withColumn("golden_cross_signal", F.coalesce((F.col("_side") > 0) & (before <= 0), F.lit(False)))
        .withColumn("death_cross_signal", F.coalesce((F.col("_side") < 0) & (before >= 0), F.lit(False)))
        .drop("_side")
    )


def rolling_volatility(bars: DataFrame) -> DataFrame:
    r = F.col("daily_return_pct")
    return bars.withColumns(
        {f"volatility_{n}d": F.stddev_samp(r).over(last_rows(n, "trade_date", "symbol")) for n in (7, 30)}
    )


def volume_spikes(bars: DataFrame) -> DataFrame:
    usual = moving_avg(F.col("total_value_usd"), 20, "trade_date", "symbol")
    return bars.withColumn("volume_sma_20d", usual).withColumn(
        "is_high_volume", F.col("total_value_usd") > 2 * F.col("volume_sma_20d")
    )


def gold_daily(bars: DataFrame) -> DataFrame:
    """All daily indicators; every window shares one sort by symbol and date."""
    return crosses(sma_set(rsi(volume_spikes(rolling_volatility(daily_returns(bars))))))


def gold_hourly(trades: DataFrame) -> DataFrame:
    return ema(hourly_ohlcv(trades), ["symbol"], "price_hour", "close_price", {"ema_12h": 12, "ema_24h": 24})


def market_breadth(coins: DataFrame) -> DataFrame:
    """Whole-market totals per day: dominance, gainers and losers, leaders (ties by name)."""
    cap, pct = F.col("market_cap_usd"), F.col("price_change_percentage_24h")
    total = F.sum(cap)

    def dominance(coin: str) -> Column:
        return ratio(F.sum(F.when(F.col("coin_id") == coin, cap)), total) * 100

    gain, lose = F.count_if(pct > 0), F.count_if(pct < 0)
    day = coins.groupBy(F.col("price_date").alias("market_date")).agg(
        total.alias("total_market_cap_usd"),
        F.sum("volume_24h_usd").alias("total_volume_24h_usd"),
        dominance("bitcoin").alias("btc_dominance_pct"),
        dominance("ethereum").alias("eth_dominance_pct"),
        gain.alias("coins_gainers"),
        lose.alias("coins_losers"),
        ratio(gain, lose).alias("advance_decline_ratio"),
        F.min(F.struct((-pct).alias("p"), "coin_id")).alias("_up"),
        F.min(F.struct(pct.alias("p"), "coin_id")).alias("_down"),
    )
    return day.withColumns(
        {
            "top_gainer_id": F.col("_up.coin_id"),
            "top_gainer_pct": -F.col("_up.p"),
            "top_loser_id": F.col("_down.coin_id"),
            "top_loser_pct": F.col("_down.p"),
        }
    ).drop("_up", "_down")


def latest_day(df: DataFrame, date: str) -> DataFrame:
    return df.where(F.col(date) == df.agg(F.max(date)).scalar())


def top_coins(coins: DataFrame, n: int = 100) -> DataFrame:
    """Largest coins by market cap, each by its newest row."""
    return latest_per_key(coins, ["coin_id"], "price_date").orderBy(F.desc("market_cap_usd"), "coin_id").limit(n)


def price_history(coins: DataFrame, coin_id: str, days: int = 30) -> DataFrame:
    """Price, volume and cap of one coin over its last days, rows with a date only."""
    one = coins.where((F.col("coin_id") == coin_id) & F.col("price_date").isNotNull())
    newest = one.agg(F.max("price_date")).scalar()
    return one.where(F.col("price_date") > F.date_sub(newest, days)).select(
        "coin_id",
        F.col("price_date").alias("date"),
        F.col("current_price_usd").alias("price"),
        F.col("volume_24h_usd").alias("volume"),
        F.col("market_cap_usd").alias("market_cap"),
    )


def ohlc_history(pages: DataFrame, arrays: str = "ohlc") -> DataFrame:
    """[ts, open, high, low, close] arrays to named columns."""
    bar = pages.select("*", F.explode(arrays).alias("_b")).drop(arrays)
    names = ["open", "high", "low", "close"]
    return bar.select(
        *[c for c in bar.columns if c != "_b"],
        F.timestamp_millis(F.get("_b", F.lit(0)).cast("bigint")).alias("timestamp"),
        *[F.get("_b", F.lit(i)).alias(n) for i, n in enumerate(names, start=1)],
    )


# --- sentiment ----------------------------------------------------------------------------


def sentiment_features(index: DataFrame) -> DataFrame:
    """Classes, score, means, changes and a contrarian signal per day."""
    v = F.col("value")
    w = dated("value_date")
    score = labels.sentiment_score(v)
    return index.withColumns(
        {
            "classification": labels.sentiment_class(v),
            "trading_signal": labels.sentiment_signal(v),
            "sentiment_score": score,
            "ma_7d": moving_avg(v, 7, "value_date"),
            "ma_30d": moving_avg(v, 30, "value_date"),
            "sentiment_change_1d": score - F.lag(score, 1).over(w),
            "sentiment_change_7d": score - F.lag(score, 7).over(w),
            "is_extreme_fear": v < 20,
            "is_extreme_greed": v > 80,
            "contrarian_signal": labels.first_match([(v < 20, "buy"), (v > 80, "sell")], "hold"),
        }
    )


def sentiment_summary(index: DataFrame) -> DataFrame:
    """One row over the newest 30 days: value, class, means, range and a 7-day trend."""
    newest = index.orderBy(F.desc("value_date")).limit(30)
    ranked = newest.withColumn("_n", F.row_number().over(W.orderBy(F.desc("value_date"))))
    v, n = F.col("value"), F.col("_n")

    def mean_of(first: int, last: int) -> Column:
        return F.avg(F.when(n.between(first, last), v))

    trend = F.when(F.count("*") >= 7, F.when(mean_of(1, 3) > mean_of(5, 7), "improving").otherwise("declining"))
    one = ranked.agg(
        F.max(F.when(n == 1, v)).alias("current_value"),
        F.max("value_date").alias("last_update"),
        F.round(mean_of(1, 7), 1).alias("avg_7d"),
        F.round(F.avg(v), 1).alias("avg_30d"),
        F.coalesce(trend, F.lit("unknown")).alias("trend_7d"),
        F.min(v).alias("min_30d"),
        F.max(v).alias("max_30d"),
    )
    return one.withColumns(
        {
            "current_classification": labels.sentiment_class(F.col("current_value")),
            "trading_signal": labels.sentiment_signal(F.col("current_value")),
        }
    )


def sentiment_history(index: DataFrame, days: int = 30) -> DataFrame:
    newest = index.where(F.col("value_date").isNotNull()).orderBy(F.desc("value_date")).limit(days)
    return newest.select(
        F.col("value_date").alias("date"),
        "value",
        labels.sentiment_class(F.col("value")).alias("classification"),
        labels.sentiment_score(F.col("value")).alias("sentiment_score"),
    )


def extreme_sentiment(index: DataFrame, fear: int = 20, greed: int = 80) -> DataFrame:
    """Days at or beyond the two thresholds, with the number of days on each side."""
    kind = F.when(F.col("value") <= fear, "extreme_fear").when(F.col("value") >= greed, "extreme_greed")
    found = index.withColumn("event", kind).where(F.col("event").isNotNull())
    return found.withColumn("event_count", F.count("*").over(W.partitionBy("event")))


# --- chain --------------------------------------------------------------------------------


def network_summary(stats: DataFrame) -> DataFrame:
    """Network figures with satoshi amounts in BTC."""
    return stats.select(
        "stat_date",
        F.col("market_price_usd").alias("price_usd"),
        (F.col("market_price_usd").cast("double") * F.col("totalbc").cast("double") / F.lit(1e8)).alias("market_cap_usd"),
        "hash_rate",
        "difficulty",
        satoshi_to_btc(F.col("totalbc")).alias("total_btc"),
        "block_height",
        F.col("n_tx").alias("transactions_24h"),
        satoshi_to_btc(F.col("total_btc_sent")).alias("btc_sent_24h"),
        F.col("miners_revenue_usd").alias("miners_revenue_24h"),
        F.col("n_blocks_total").alias("n_blocks_mined_24h"),
        F.col("mempool_bytes").alias("mempool_size"),
        satoshi_to_btc(F.col("estimated_btc_sent")).alias("estimated_transaction_volume"),
    )


def onchain_metrics(stats: DataFrame) -> DataFrame:
    """Issuance, stock-to-flow with a log-log price model fitted on the data, and hash price."""
    total = satoshi_to_btc(F.col("totalbc"))
    mined = F.col("btc_mined_daily")
    before = F.lag("hash_rate").over(dated("stat_date"))
    base = stats.select(
        F.col("stat_date").alias("metric_date"),
        F.col("hash_rate").alias("hash_rate_eh"),
        ((ratio(F.col("hash_rate"), before) - 1) * 100).alias("hash_rate_change_pct"),
        total.alias("total_btc"),
        mined.alias("daily_issuance"),
        (ratio(mined * 365, total) * 100).alias("issuance_rate_pct"),
        ratio(F.col("miners_revenue_usd"), F.col("hash_rate") * 1e6).alias("hash_price"),
        ratio(total, mined * 365).alias("stock_to_flow"),
        (F.col("market_price_usd").cast("double") * total).alias("_cap"),
    )
    x, y = F.ln("stock_to_flow"), F.ln(F.when(F.col("_cap") > 0, F.col("_cap")))
    fit = base.where(F.col("stock_to_flow") > 0)
    slope, start = fit.agg(F.regr_slope(y, x)).scalar(), fit.agg(F.regr_intercept(y, x)).scalar()
    price = F.exp(start + slope * F.ln(F.when(F.col("stock_to_flow") > 0, F.col("stock_to_flow")))) / F.when(F.col("total_btc") > 0, F.col("total_btc"))
    return base.withColumn("s2f_model_price", price).drop("_cap")


# --- returns ------------------------------------------------------------------------------


def asset_returns(closes: DataFrame, period: str) -> DataFrame:
    """Change in percent from the first to the last close within a look-back period, per asset.

    `closes` has asset, date, price. The period ends on the newest date of the table.
    """
    end = closes.agg(F.max("date")).scalar()
    inside = closes.where(F.col("date") >= F.date_sub(end, fv.PERIOD_DAYS[period]))
    first, last = F.min_by("price", "date"), F.max_by("price", "date")
    return inside.groupBy("asset").agg(F.round(pct_change(last, first), 2).alias("return_pct"))


# --- the model as one object ---------------------------------------------------------------


@dataclass
class Market:
    """Lazy market graph over the given tables; `intraday` reads events instead of line items."""

    spark: SparkSession
    sf: str
    intraday: bool = False

    @cached_property
    def trades(self) -> DataFrame:
        source = adapters.event_trades if self.intraday else adapters.market_trades
        return stg_trades(source(self.spark, self.sf))

    @cached_property
    def coins(self) -> DataFrame:
        return stg_coin_prices(adapters.coin_prices(self.spark, self.sf))

    @cached_property
    def bars(self) -> DataFrame:
        return daily_ohlcv(self.trades)

    @cached_property
    def bar_table(self) -> DataFrame:
        """The daily bars, written once: for plans that read them several times, so that the
        trades are scanned only once."""
        return materialize(self.bars, "daily-bars")

    @cached_property
    def analytics(self) -> DataFrame:
        return daily_analytics(self.bars, self.coins)

    @cached_property
    def closes(self) -> DataFrame:
        names = dict(zip(adapters.MARKET_SYMBOLS, ["btc", "eth", "sp500", "gold", "dxy"]))
        asset = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("symbol")]
        return self.bar_table.select(asset.alias("asset"), F.col("trade_date").alias("date"), F.col("close_price").alias("price"))

    def closes_of(self, *assets: str) -> DataFrame:
        """Closes of some assets only, from their own trades."""
        names = dict(zip(["btc", "eth", "sp500", "gold", "dxy"], adapters.MARKET_SYMBOLS))
        chosen = {a: names[a] for a in assets}
        asset = F.create_map(*[F.lit(x) for a, symbol in chosen.items() for x in (symbol, a)])[F.col("symbol")]
        bars = daily_ohlcv(self.trades.where(F.col("symbol").isin(list(chosen.values()))))
        return bars.select(asset.alias("asset"), F.col("trade_date").alias("date"), F.col("close_price").alias("price"))

    @cached_property
    def sentiment(self) -> DataFrame:
        return adapters.sentiment_index(self.spark, self.sf)

    @cached_property
    def chain(self) -> DataFrame:
        return adapters.chain_stats(self.spark, self.sf)
