"""Joins of market and macro data: daily context, correlations, regimes, events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions import labels
from tidemill.functions.scalars import last_known, pct_change, ratio
from tidemill.operators.blocked import asof_join
from tidemill.operators.timeseries import asof_last_known, dated, fill_calendar, last_rows, moving_avg, safe_corr, streaks
from tidemill.plans.macro import price_changes

MACRO_CONTEXT = [
    "cpi_all_urban", "inflation_rate_yoy", "unemployment_rate", "federal_funds_rate", "treasury_10y_rate",
    "real_interest_rate", "m2_money_supply", "m2_growth_rate_yoy", "gdp_real_chained", "gdp_growth_rate_yoy",
]


def btc_macro(bars: DataFrame, yoy: DataFrame, symbol: str = "BTCUSDT", asof: bool = False) -> DataFrame:
    """Daily bars of one symbol with macro figures and three relation labels.

    By default only days that carry an observation match; asof=True uses the last known figure.
    """
    daily = bars.where(F.col("symbol") == symbol).select(
        F.col("trade_date").alias("date"),
        F.col("symbol").alias("crypto_symbol"),
        *[F.col(f"{c}_price").alias(f"btc_{c}") for c in ("open", "close", "high", "low")],
        F.col("avg_price").alias("btc_avg_price"),
        F.col("total_volume").alias("btc_volume"),
        F.col("total_value_usd").alias("btc_value_usd"),
        F.col("price_change_percentage").alias("btc_price_change_pct"),
        F.col("volatility_percentage").alias("btc_volatility_pct"),
    )
    known = yoy.select(F.col("observation_date").alias("date"), *MACRO_CONTEXT)
    joined = asof_last_known(daily, known, "date", MACRO_CONTEXT) if asof else daily.join(known, "date", "left")
    inflation, change = F.col("inflation_rate_yoy"), F.col("btc_price_change_pct")
    return joined.withColumns(
        {
            "inflation_btc_relationship": labels.inflation_asset_relation(inflation, change),
            "rate_environment": labels.rate_environment(F.col("federal_funds_rate")),
            "money_supply_regime": labels.money_regime(F.col("m2_growth_rate_yoy")),
        }
    )


def rolling_correlations(df: DataFrame, base: str, others: dict[str, str], days: int = 30, date: str = "date") -> DataFrame:
    """Correlation of one column with others over the last rows; NULL where a side is constant."""
    frame = last_rows(days, date)
    return df.withColumns({out: safe_corr(F.col(base), F.col(c), frame) for c, out in others.items()})


def regime_days(df: DataFrame, columns: dict[str, str], date: str = "date") -> DataFrame:
    """Running number of the row within all rows of the same label (not a streak)."""
    return df.withColumns({out: F.row_number().over(dated(date, c)) for c, out in columns.items()})


def crypto_macro_mart(macro: DataFrame, analytics: DataFrame, indicators: DataFrame, symbol: str = "BTCUSDT") -> DataFrame:
    """One row per day: price, trend, macro figures, regimes, impact labels, correlations."""
    regimes = ["economic_regime", "monetary_policy_stance", "labor_market_health", "inflation_trend", "rate_trend"]
    trend = analytics.where(F.col("symbol") == symbol).select(
        F.col("trade_date").alias("date"),
        F.col("ma_7d").alias("btc_ma_7d"),
        F.col("ma_30d").alias("btc_ma_30d"),
        F.col("trend_signal").alias("btc_trend"),
        F.col("volume_signal").alias("btc_volume_signal"),
    )
    labelled = indicators.select(F.col("observation_date").alias("date"), *regimes)
    joined = macro.join(trend, "date", "left").join(labelled, "date", "left")
    change = F.col("btc_price_change_pct")
    inflation, rate, money = (F.col(c) for c in ("inflation_rate_yoy", "federal_funds_rate", "m2_growth_rate_yoy"))
    judged = joined.withColumns(
        {
            "inflation_hedge_status": labels.hedge_status(inflation, change),
            "rate_impact_on_btc": labels.rate_impact(rate, change),
            "money_supply_impact": labels.money_impact(money, change),
            "market_risk_level": labels.risk_level(F.col("economic_regime"), F.col("btc_volatility_pct")),
        }
    )
    correlated = rolling_correlations(
        judged,
        "btc_price_change_pct",
        {
            "inflation_rate_yoy": "btc_inflation_correlation_30d",
            "federal_funds_rate": "btc_rates_correlation_30d",
            "m2_growth_rate_yoy": "btc_m2_correlation_30d",
        },
    )
    return regime_days(
        correlated,
        {"economic_regime": "days_in_economic_regime", "monetary_policy_stance": "days_in_policy_stance"},
    )


# --- asset panels -------------------------------------------------------------------------


def returns_panel(closes: DataFrame, assets: list[str]) -> DataFrame:
    """One row per date with the daily return of each listed asset."""
    before = F.lag("price").over(dated("date", "asset"))
    returned = closes.withColumn("r", (ratio(F.col("price"), before) - 1) * 100)
    return returned.groupBy("date").pivot("asset", assets).agg(F.max("r"))


def correlation_matrix(closes: DataFrame, assets: list[str], lookback_days: int | None = None) -> DataFrame:
    """Pairwise correlation of daily returns of any number of assets over a look-back, on dates both trade.

    The returns of a date are brought together, a row per date, and paired there; pairs are reduced to their moments in
    the same task, so what is shuffled after is a row per pair and task, and the plan does not grow with the assets.
    """
    number = F.create_map(*[x for i, a in enumerate(assets) for x in (F.lit(a), F.lit(i))])[F.col("asset")]
    before = F.lag("price").over(dated("date", "asset"))
    returned = closes.where(F.col("asset").isin(assets)).withColumn("r", (ratio(F.col("price"), before) - 1) * 100)
    if lookback_days:
        returned = returned.where(F.col("date") > F.date_sub(closes.agg(F.max("date")).scalar(), lookback_days))
    returned = returned.groupBy("date", number.alias("i")).agg(F.max("r").alias("r")).where("r IS NOT NULL")
    dates = returned.groupBy("date").agg(F.sort_array(F.collect_list(F.struct("i", "r"))).alias("day"))
    firsts = dates.select(F.posexplode("day").alias("at", "a"), "day")
    others = F.explode(F.slice("day", F.col("at") + 2, F.size("day")))
    found = firsts.select("a", others.alias("b")).groupBy(F.col("a.i").alias("i"), F.col("b.i").alias("j")).agg(
        safe_corr(F.col("a.r"), F.col("b.r")).alias("correlation")
    )
    spark, names = closes.sparkSession, F.array(*[F.lit(a) for a in assets])
    last = F.lit(len(assets) - 1)
    pairs = spark.range(max(0, len(assets) - 1)).select(F.col("id").cast("int").alias("i"), F.explode(F.sequence(F.col("id").cast("int") + 1, last)).alias("j"))
    return pairs.join(found, ["i", "j"], "left").select(
        F.get(names, F.col("i")).alias("asset_a"), F.get(names, F.col("j")).alias("asset_b"), "correlation"
    )


def pair_correlation(closes: DataFrame, a: str, b: str, days: int = 90) -> DataFrame:
    """Correlation of the daily returns of two assets on dates both trade."""
    return correlation_matrix(closes.where(F.col("asset").isin(a, b)), [a, b], days)


def inflation_hedge(
    closes: DataFrame, staged: DataFrame, asset: str = "btc", start_year: int | None = None, end_year: int | None = None
) -> DataFrame:
    """Return of an asset over a span of years less the mean yearly price increase.

    A year not given is the first or last one that both the asset and the price index have. What cannot be
    measured is NULL: the return without closes, the increase below twelve months of the index.
    """
    priced = closes.where(F.col("asset") == asset)
    index = staged.where(F.col("series_id") == "CPIAUCSL")
    priced_year, index_year = F.year("date"), F.col("observation_year")
    first, last = F.lit(start_year), F.lit(end_year)
    if start_year is None:
        first = F.greatest(priced.agg(F.min(priced_year)).scalar(), index.agg(F.min(index_year)).scalar())
    if end_year is None:
        last = F.least(priced.agg(F.max(priced_year)).scalar(), index.agg(F.max(index_year)).scalar())
    held = priced.where(priced_year.between(first, last)).agg(
        pct_change(F.max_by("price", "date"), F.min_by("price", "date")).alias("gain")
    )
    cpi = index.where(index_year.between(first, last)).agg(
        F.when(
            F.count("*") >= 12, pct_change(F.max_by("value", "observation_date"), F.min_by("value", "observation_date"))
        ).alias("inflation")
    )
    gain, inflation = F.col("gain"), cpi.scalar() / (last - first + 1)
    return held.select(
        F.when(first <= last, F.concat_ws("-", first, last)).alias("analysis_period"),
        F.round(gain, 2).alias("btc_return_pct"),
        F.round(inflation, 2).alias("average_inflation_pct"),
        F.round(gain - inflation, 2).alias("btc_real_return_pct"),
        (gain - inflation > 0).alias("is_positive_real_return"),
    )


def inflation_regression(panel: DataFrame, asset: str, inflation: str) -> DataFrame:
    """Slope, fit and hedge score of asset returns on inflation over dated rows with both."""
    y, x = F.col(asset).cast("double"), F.col(inflation).cast("double")
    varies = F.stddev_pop(F.when(y.isNotNull(), x)) > 1e-12
    corr = safe_corr(y, x)
    real = F.avg(y - x)
    return panel.where(y.isNotNull() & x.isNotNull()).agg(
        F.when(varies, F.regr_slope(y, x)).alias("btc_inflation_beta"),
        F.when(varies, F.regr_r2(y, x)).alias("btc_inflation_r_squared"),
        corr.alias("btc_cpi_correlation"),
        real.alias("btc_real_return_pct"),
        (50 * (1 + corr)).alias("hedge_effectiveness_score"),
        ((real > 0) & (corr > 0)).alias("is_effective_hedge"),
    )


def event_impact(events: DataFrame, closes: DataFrame, offsets: dict[str, int]) -> DataFrame:
    """Asset returns after dated events: first close on or after event + offset days against the
    last close before the event. One row per event and asset; without a close before, price and returns are NULL.

    Closes are spread over the calendar once per asset, so every lookup is an equality join on
    (asset, day).
    """
    price = closes.select("asset", "date", "price")
    nearest = fill_calendar(price, "date", "price", ["asset"], "back").select("asset", "day", F.col("price").alias("_p"))
    newest = closes.agg(F.max("date")).scalar()
    oldest = events.agg(F.min("event_date")).scalar()
    # The last close stays known until the last event.
    tail = price.groupBy("asset").agg(F.max_by("price", "date").alias("price")).select(
        "asset", F.greatest(newest, events.agg(F.max("event_date")).scalar()).alias("date"), "price"
    )
    merged = price.unionByName(tail).groupBy("asset", "date").agg(F.max("price").alias("price"))
    known = fill_calendar(merged, "date", "price", ["asset"], "forward").where(F.col("day") >= F.date_sub(oldest, 1))
    assets = closes.agg(F.collect_set("asset")).scalar()  # a short list
    before = known.select("asset", F.date_add("day", 1).alias("event_date"), F.col("price").alias("price_pre"))
    paired = events.withColumn("_assets", assets).withColumn("asset", F.explode("_assets")).drop("_assets")
    out = paired.join(before, ["asset", "event_date"], "left")
    for name, days in offsets.items():
        after = nearest.select("asset", F.date_sub("day", days).alias("event_date"), F.col("_p").alias(f"_{name}"))
        out = out.join(after, ["asset", "event_date"], "left")
    returns = {f"return_{name}_pct": pct_change(F.col(f"_{name}"), F.col("price_pre")) for name in offsets}
    return out.withColumns(returns).drop(*[f"_{name}" for name in offsets])


# --- daily context and regimes --------------------------------------------------------------


def crypto_macro_daily(
    closes: DataFrame, bars: DataFrame, sentiment: DataFrame, macro: DataFrame, coins: DataFrame
) -> DataFrame:
    """One row per day with prices, returns, sentiment, last known macro figures, correlations.

    `macro` is the year-over-year table; its figures are carried forward from their date.
    """
    names = {"btc": "btc_price_usd", "sp500": "sp500_close", "gold": "gold_price_usd", "dxy": "dxy_index"}
    wide = closes.groupBy("date").pivot("asset", list(names)).agg(F.max("price")).withColumnsRenamed(names)
    days = wide.where(F.col("btc_price_usd").isNotNull())
    w = dated("date")

    def daily_return(c: str) -> Column:
        return (ratio(F.col(c), F.lag(c).over(w)) - 1) * 100

    moved = days.withColumns(
        {
            "btc_return_daily_pct": daily_return("btc_price_usd"),
            "sp500_return_daily_pct": daily_return("sp500_close"),
            "gold_return_daily_pct": daily_return("gold_price_usd"),
            "_dxy_return": daily_return("dxy_index"),
        }
    )
    frame = last_rows(30, "date")
    btc = F.col("btc_return_daily_pct")
    rolled = moved.withColumns(
        {
            "btc_volatility_30d": F.stddev_samp(btc).over(frame),
            "btc_sp500_corr_30d": safe_corr(btc, F.col("sp500_return_daily_pct"), frame),
            "btc_gold_corr_30d": safe_corr(btc, F.col("gold_return_daily_pct"), frame),
            "btc_dxy_corr_30d": safe_corr(btc, F.col("_dxy_return"), frame),
        }
    ).drop("_dxy_return")
    volume = bars.where(F.col("symbol") == "BTCUSDT").select(
        F.col("trade_date").alias("date"), F.col("total_value_usd").alias("btc_volume_usd")
    )
    caps = coins.where(F.col("coin_id") == "bitcoin").select(
        F.col("price_date").alias("date"), F.col("market_cap_usd").alias("btc_market_cap_usd")
    )
    mood = sentiment.select(
        F.col("value_date").alias("date"),
        F.col("value").alias("fear_greed_value"),
        labels.sentiment_class(F.col("value")).alias("fear_greed_classification"),
    )
    figures = price_changes(macro).select(
        F.col("observation_date").alias("date"),
        "unemployment_rate",
        F.col("inflation_rate_yoy").alias("cpi_yoy"),
        "core_cpi_yoy",
        F.col("federal_funds_rate").alias("fed_funds_rate"),
        F.col("treasury_10y_rate").alias("treasury_10y"),
        (F.col("treasury_10y_rate") - F.col("treasury_2y_rate")).alias("yield_curve_spread"),
        F.col("m2_money_supply").alias("m2_billions"),
        F.col("m2_growth_rate_yoy").alias("m2_growth_yoy"),
        F.col("gdp_growth_rate_yoy").alias("gdp_growth_yoy"),
    )
    joined = rolled.join(volume, "date", "left").join(caps, "date", "left").join(mood, "date", "left")
    return asof_last_known(joined, figures, "date", [c for c in figures.columns if c != "date"])


def market_regime(daily: DataFrame) -> DataFrame:
    """Policy stance, risk appetite and market mood per day; what is not known is NULL, and so is its label."""
    rate, mood = F.col("fed_funds_rate"), F.col("fear_greed_value")
    return daily.select(
        "date",
        F.when(rate.isNotNull(), labels.fed_stance(rate)).alias("fed_stance"),
        rate,
        F.when(mood.isNotNull(), labels.risk_appetite(mood)).alias("risk_appetite"),
        mood,
        F.when(mood.isNotNull(), labels.crypto_phase(mood)).alias("crypto_phase"),
    )


def inflation_hedge_daily(daily: DataFrame, closes: DataFrame) -> DataFrame:
    """Returns over a year, less inflation, of three assets per day, and how often the first beat inflation.

    A year ago is the last close on or before that day. The score is the share of the last 365 rows with both figures.
    """
    back = closes.select("asset", "date", "price", F.add_months("date", -12).alias("day"))
    then = closes.select("asset", F.col("date").alias("day"), F.col("price").alias("price_before"))
    found = asof_join(back, then, ["asset"], "day", ["price_before"])
    gains = found.groupBy("date").pivot("asset", ["btc", "gold", "sp500"]).agg(F.max(pct_change(F.col("price"), F.col("price_before"))))
    both = daily.join(gains, "date", "left")
    cpi = F.col("cpi_yoy")
    beat = F.when(F.col("btc") > cpi, 1.0).when(F.col("btc") <= cpi, 0.0)
    return both.select(
        "date",
        "btc_price_usd",
        F.col("btc").alias("btc_return_1y_pct"),
        "cpi_yoy",
        "core_cpi_yoy",
        *[(F.col(a) - cpi).alias(f"{a}_real_return_1y_pct") for a in ("btc", "gold", "sp500")],
        (F.col("btc") - F.col("gold")).alias("btc_vs_gold_return"),
        F.avg(beat).over(last_rows(365, "date")).alias("inflation_hedge_score"),
    )


def rate_analysis(daily: DataFrame) -> DataFrame:
    """Returns and rate changes since the last row of the month and the year before, the real ten-year rate, and the slope
    of daily returns on moves of the ten-year rate over 90 rows."""
    month, year = F.trunc("date", "month"), F.year("date")
    last = F.max_by(F.struct(F.col("btc_price_usd").alias("price"), F.col("fed_funds_rate").alias("rate")), "date")
    months = daily.groupBy(F.add_months(month, 1).alias("_month")).agg(last.alias("_m"))
    years = daily.groupBy((year + 1).alias("_year")).agg(F.max_by("btc_price_usd", "date").alias("_y"))
    move = F.col("treasury_10y") - F.lag("treasury_10y").over(dated("date"))
    rows = daily.withColumns({"_month": month, "_year": year, "_move": move})
    rows = rows.join(months, "_month", "left").join(years, "_year", "left")
    frame = last_rows(90, "date")
    x = F.when(F.col("btc_return_daily_pct").isNotNull(), F.col("_move"))
    r = F.when(F.col("_move").isNotNull(), F.col("btc_return_daily_pct"))
    varies = F.var_pop(x).over(frame)
    price, rate = F.col("btc_price_usd"), F.col("fed_funds_rate")
    return rows.select(
        "date",
        price,
        pct_change(price, F.col("_m.price")).alias("btc_return_mtd_pct"),
        pct_change(price, F.col("_y")).alias("btc_return_ytd_pct"),
        rate,
        (rate - F.col("_m.rate")).alias("fed_funds_change_mtd"),
        "treasury_10y",
        (F.col("treasury_10y") - F.col("cpi_yoy")).alias("real_rate_10y"),
        F.when(varies > 1e-12, F.covar_pop(r, x).over(frame) / varies).alias("btc_rate_sensitivity"),
    )


def market_regime_scores(daily: DataFrame) -> DataFrame:
    """Cycle, trend, phase and two scores from 0 to 100 per day."""
    w = dated("date")
    price = F.col("btc_price_usd")
    year = last_rows(365, "date")

    def figure_before(c: str) -> Column:
        """The last figure that differs from the one that followed it: figures are carried from day to day."""
        ends = F.col(c) != F.coalesce(F.lead(c).over(w), F.col(c))
        return F.last(F.when(ends, F.col(c)), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))

    growth_before = figure_before("gdp_growth_yoy")
    featured = daily.withColumns(
        {
            "_sma50": moving_avg(price, 50, "date"),
            "_sma200": moving_avg(price, 200, "date"),
            "_month": pct_change(price, F.lag(price, 30).over(w)),
            "_rising": F.col("gdp_growth_yoy") >= growth_before,
            "_growth_before": growth_before,
            "_cpi_before": figure_before("cpi_yoy"),
            "_vols": F.collect_list("btc_volatility_30d").over(year),
        }
    )
    v = F.col("btc_volatility_30d")
    below = F.aggregate("_vols", F.lit(0), lambda n, x: n + F.when(x < v, 1).otherwise(0))
    vol_rank = F.when(v.isNotNull() & (F.size("_vols") > 1), below / (F.size("_vols") - 1) * 100)
    growth, rising = F.col("gdp_growth_yoy"), F.col("_rising")
    up = (price > F.col("_sma50")) & (F.col("_sma50") > F.col("_sma200"))
    down = (price < F.col("_sma50")) & (F.col("_sma50") < F.col("_sma200"))
    trend = labels.first_match([(up, "uptrend"), (down, "downtrend")], "sideways")
    phase = labels.first_match([(up, "bull"), (down, "bear"), (F.col("_month") < 0, "distribution")], "accumulation")
    cycle = labels.first_match(
        [
            ((growth > 0) & rising, "expansion"), ((growth > 0) & ~rising, "peak"),
            ((growth <= 0) & ~rising, "contraction"), ((growth <= 0) & rising, "trough"),
        ],
        None,
    )
    parts = [vol_rank, 100 - F.col("fear_greed_value"), F.when(F.col("yield_curve_spread") < 0, 100).otherwise(0)]
    known = sum((p.isNotNull().cast("int") for p in parts[1:]), parts[0].isNotNull().cast("int"))
    total = sum((F.coalesce(p.cast("double"), F.lit(0.0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0.0)))
    scored = featured.select(
        F.col("date").alias("regime_date"),
        cycle.alias("economic_cycle"),
        labels.growth_trend(growth, F.col("_growth_before")).alias("gdp_growth_trend"),
        labels.inflation_regime(F.col("cpi_yoy"), F.coalesce(F.col("cpi_yoy") >= F.col("_cpi_before"), F.lit(True))).alias("inflation_regime"),
        labels.volatility_regime(vol_rank).alias("volatility_regime"),
        labels.fed_stance(F.col("fed_funds_rate")).alias("fed_stance"),
        labels.money_regime(F.col("m2_growth_yoy")).alias("liquidity_conditions"),
        labels.risk_appetite(F.col("fear_greed_value")).alias("risk_appetite"),
        trend.alias("btc_trend"),
        phase.alias("crypto_market_phase"),
        (total / known).alias("risk_score"),
    )
    return scored.withColumn("opportunity_score", 100 - F.col("risk_score"))


def latest_snapshot(daily: DataFrame, regimes: DataFrame) -> DataFrame:
    """Newest day with its regime columns."""
    about = regimes.select(F.col("regime_date").alias("date"), "economic_cycle", "fed_stance", "crypto_market_phase")
    return daily.orderBy(F.desc("date")).limit(1).join(about, "date", "left")


def monthly_performance(daily: DataFrame) -> DataFrame:
    """One row per month: change from first to last value of three assets, mean rates."""
    assets = {"btc": "btc_price_usd", "sp500": "sp500_close", "gold": "gold_price_usd"}

    def gain(c: str) -> Column:
        first = F.min_by(c, F.when(F.col(c).isNotNull(), F.col("date")))
        return pct_change(last_known(c, "date"), first)

    return daily.groupBy(F.trunc("date", "month").alias("month")).agg(
        *[gain(c).alias(f"{a}_return_pct") for a, c in assets.items()],
        F.avg("fed_funds_rate").alias("avg_fed_funds"),
        F.avg("cpi_yoy").alias("avg_inflation"),
    )


def macro_overview(closes: DataFrame, breadth: DataFrame, sentiment: DataFrame, latest: DataFrame) -> DataFrame:
    """One row: two prices, dominance, sentiment and the newest value of five series."""
    newest = closes.agg(
        *[
            F.max_by(F.when(F.col("asset") == a, F.col("price")), F.when(F.col("asset") == a, F.col("date"))).alias(f"{a}_price_usd")
            for a in ("btc", "eth")
        ]
    )
    market = breadth.agg(F.max_by(F.struct("total_market_cap_usd", "btc_dominance_pct"), "market_date").alias("m"))
    mood = sentiment.agg(F.max_by("value", "value_date").alias("v"))
    series = latest.groupBy().pivot("series_id", fv.OVERVIEW_SERIES).agg(F.max("value").cast("double"))
    names = [F.col(c).alias(c.lower()) for c in fv.OVERVIEW_SERIES]
    mood_value = mood.scalar()
    return newest.select(
        "btc_price_usd",
        "eth_price_usd",
        market.select("m.total_market_cap_usd").scalar().alias("total_market_cap_usd"),
        market.select("m.btc_dominance_pct").scalar().alias("btc_dominance_pct"),
        mood_value.alias("fear_greed_value"),
        labels.sentiment_class(mood_value).alias("fear_greed_classification"),
        *[series.select(n).scalar().alias(c.lower()) for n, c in zip(names, fv.OVERVIEW_SERIES)],
        F.lit("neutral").alias("market_sentiment"),
        F.lit("tightening").alias("macro_environment"),
    )


def rate_regime_returns(daily: DataFrame) -> DataFrame:
    """Rate regime per month with the asset's return since the regime began."""
    monthly = daily.groupBy(F.trunc("date", "month").alias("date")).agg(
        last_known("fed_funds_rate", "date").alias("fed_funds_rate"),
        F.max_by("btc_price_usd", "date").alias("btc_price_usd"),
    ).where(F.col("fed_funds_rate").isNotNull())
    w = dated("date")
    moved = F.col("fed_funds_rate") - F.lag("fed_funds_rate").over(w)
    named = labels.first_match([(moved > 0, "hiking"), (moved < 0, "cutting")], "pause")
    runs = streaks(monthly.withColumn("rate_regime", named), "date", "rate_regime", "months_in_regime")
    start = F.first("btc_price_usd").over(W.partitionBy("_run").orderBy("date").rowsBetween(W.unboundedPreceding, 0))
    last_move = F.last(F.when(F.col("rate_regime") != "pause", F.col("date")), ignorenulls=True).over(
        w.rowsBetween(W.unboundedPreceding, 0)
    )
    return runs.withColumns(
        {
            "btc_return_in_regime_pct": pct_change(F.col("btc_price_usd"), start),
            "months_since_last_change": F.floor(F.months_between("date", last_move)),
        }
    ).drop("_run")
