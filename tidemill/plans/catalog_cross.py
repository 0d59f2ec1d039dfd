"""Registered cross-domain queries with their SQL."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.timeseries import asof_last_known, streaks
from tidemill.plans import adapters as ad
from tidemill.plans import cross as cx
from tidemill.plans import macro as mc
from tidemill.plans import market as mk
from tidemill.plans.macro import Macro
from tidemill.plans.market import Market
from tidemill.plans.oracle_tables import TABLES, case_of
from tidemill.plans.registry import register

ASSETS = ["btc", "eth", "sp500", "gold", "dxy"]


@dataclass
class Cross:
    spark: SparkSession
    sf: str

    @cached_property
    def market(self) -> Market:
        return Market(self.spark, self.sf)

    @cached_property
    def macro(self) -> Macro:
        return Macro(self.spark, self.sf)

    @cached_property
    def btc_macro(self) -> DataFrame:
        return cx.btc_macro(self.market.bars, self.macro.yoy)

    @cached_property
    def mart(self) -> DataFrame:
        """Bars and the wide series feed two branches each, so both are written once first."""
        bars, yoy = self.market.bar_table, self.macro.yoy_of_table
        analytics = mk.daily_analytics(bars, self.market.coins)
        return cx.crypto_macro_mart(cx.btc_macro(bars, yoy), analytics, mc.economic_indicators(yoy))

    @cached_property
    def daily(self) -> DataFrame:
        return cx.crypto_macro_daily(
            self.market.closes, self.market.bar_table, self.market.sentiment, self.macro.yoy, self.market.coins
        )


_RELATION = case_of(
    [
        ("inflation_rate_yoy > 3 AND chg > 0", "positive_inflation_btc_up"),
        ("inflation_rate_yoy > 3 AND chg < 0", "positive_inflation_btc_down"),
        ("inflation_rate_yoy < 2 AND chg > 0", "low_inflation_btc_up"),
        ("inflation_rate_yoy < 2 AND chg < 0", "low_inflation_btc_down"),
    ],
    "neutral",
)
_RATES = case_of([("federal_funds_rate > 4", "high_rates"), ("federal_funds_rate > 2", "moderate_rates")], "low_rates")
_MONEY = case_of(
    [
        ("m2_growth_rate_yoy > 10", "high_money_growth"),
        ("m2_growth_rate_yoy > 5", "moderate_money_growth"),
        ("m2_growth_rate_yoy < 0", "money_contraction"),
    ],
    "stable_money_growth",
)
TABLES["x_btc"] = f"""
SELECT *, {_RELATION} AS inflation_btc_relationship, {_RATES} AS rate_environment, {_MONEY} AS money_supply_regime
FROM (SELECT b.trade_date AS date, b.close_price AS btc_close, b.price_change_percentage AS chg, b.volatility_percentage AS vol,
             y.* EXCLUDE (observation_date)
      FROM x_bar b LEFT JOIN x_yoy y ON y.observation_date = b.trade_date WHERE b.symbol = 'BTCUSDT')
"""
_BTC = (
    "d: date | e: btc_close | f: btc_price_change_pct btc_volatility_pct inflation_rate_yoy | e: federal_funds_rate "
    "unemployment_rate | f: m2_growth_rate_yoy gdp_growth_rate_yoy real_interest_rate "
    "| s: inflation_btc_relationship rate_environment money_supply_regime"
)
_BTC_SQL = "SELECT *, chg AS btc_price_change_pct, vol AS btc_volatility_pct FROM {}"
register("btc_macro", _BTC, _BTC_SQL.format("x_btc"))(lambda s, sf: Cross(s, sf).btc_macro)
register(
    "join_on_date", "d: date | f: inflation_rate_yoy | e: federal_funds_rate", "SELECT * FROM x_btc"
)(lambda s, sf: Cross(s, sf).btc_macro)

_ASOF = ["unemployment_rate", "federal_funds_rate", "cpi_all_urban", "inflation_rate_yoy"]
register(
    "join_asof_macro",
    "d: date | e: unemployment_rate federal_funds_rate cpi_all_urban | f: inflation_rate_yoy",
    "SELECT b.trade_date AS date, u.unemployment_rate, f.federal_funds_rate, c.cpi_all_urban, i.inflation_rate_yoy "
    "FROM (SELECT DISTINCT trade_date FROM x_bar WHERE symbol = 'BTCUSDT') b "
    + " ".join(
        f"ASOF LEFT JOIN (SELECT observation_date AS d, {c} FROM x_yoy WHERE {c} IS NOT NULL) {a} ON b.trade_date >= {a}.d"
        for a, c in zip("ufci", _ASOF)
    ),
)(
    lambda s, sf: asof_last_known(
        Cross(s, sf).market.bars.where("symbol = 'BTCUSDT'").select(F.col("trade_date").alias("date")),
        Cross(s, sf).macro.yoy.withColumnRenamed("observation_date", "date"),
        "date",
        _ASOF,
    )
)


def _corr(x: str, y: str, w: str) -> str:
    """Windowed correlation from moments, NULL where a side is constant."""
    px = f"CASE WHEN {y} IS NOT NULL THEN {x} END"
    py = f"CASE WHEN {x} IS NOT NULL THEN {y} END"
    return (
        f"CASE WHEN stddev_pop({px}) OVER {w} > 1e-12 AND stddev_pop({py}) OVER {w} > 1e-12 "
        f"THEN corr({x}, {y}) OVER {w} END"
    )


_W30 = "(ORDER BY date ROWS 29 PRECEDING)"
TABLES["x_mart"] = f"""
SELECT *, {_corr('chg', 'inflation_rate_yoy', _W30)} AS btc_inflation_correlation_30d,
       {_corr('chg', 'federal_funds_rate', _W30)} AS btc_rates_correlation_30d,
       {_corr('chg', 'm2_growth_rate_yoy', _W30)} AS btc_m2_correlation_30d,
       row_number() OVER (PARTITION BY economic_regime ORDER BY date) AS days_in_economic_regime,
       row_number() OVER (PARTITION BY monetary_policy_stance ORDER BY date) AS days_in_policy_stance,
       CASE WHEN inflation_rate_yoy > 3 AND chg > 0 THEN 'btc_inflation_hedge_working'
            WHEN inflation_rate_yoy > 3 AND chg < 0 THEN 'btc_inflation_hedge_failing'
            ELSE 'neutral_inflation_environment' END AS inflation_hedge_status,
       CASE WHEN federal_funds_rate > 4 AND chg < 0 THEN 'rate_pressure_negative'
            WHEN federal_funds_rate < 2 AND chg > 0 THEN 'rate_environment_positive' ELSE 'neutral_rate_impact' END AS rate_impact_on_btc,
       CASE WHEN m2_growth_rate_yoy > 10 AND chg > 0 THEN 'money_printing_bullish'
            WHEN m2_growth_rate_yoy < 0 AND chg < 0 THEN 'money_contraction_bearish' ELSE 'neutral_money_supply' END AS money_supply_impact,
       CASE WHEN economic_regime = 'recession' AND vol > 5 THEN 'high_risk'
            WHEN economic_regime = 'goldilocks' AND vol < 3 THEN 'low_risk' ELSE 'moderate_risk' END AS market_risk_level
FROM (SELECT b.*, a.ma_7d AS btc_ma_7d, a.ma_30d AS btc_ma_30d, a.trend_signal AS btc_trend, a.volume_signal AS btc_volume_signal,
             e.economic_regime, e.monetary_policy_stance, e.labor_market_health, e.inflation_trend, e.rate_trend
      FROM x_btc b LEFT JOIN x_ana a ON a.symbol = 'BTCUSDT' AND a.trade_date = b.date
      LEFT JOIN x_econ e ON e.observation_date = b.date)
"""
_CORR = "f6: btc_inflation_correlation_30d btc_rates_correlation_30d btc_m2_correlation_30d"
_DAYS = "i: days_in_economic_regime days_in_policy_stance"
register(
    "crypto_macro_mart",
    _BTC + " | f6: btc_ma_7d btc_ma_30d | s: btc_trend btc_volume_signal economic_regime monetary_policy_stance "
    f"labor_market_health inflation_trend rate_trend inflation_hedge_status rate_impact_on_btc money_supply_impact "
    f"market_risk_level | {_CORR} | {_DAYS}",
    _BTC_SQL.format("x_mart"),
)(lambda s, sf: Cross(s, sf).mart)
register("regime_days", f"d: date | s: economic_regime monetary_policy_stance | {_DAYS}", "SELECT * FROM x_mart")(
    lambda s, sf: Cross(s, sf).mart
)
register("rolling_corr_macro", f"d: date | {_CORR}", "SELECT * FROM x_mart")(lambda s, sf: Cross(s, sf).mart)
register(
    "regime_streak",
    "d: observation_date | s: economic_regime | i: streak",
    """
SELECT observation_date, economic_regime, row_number() OVER (PARTITION BY economic_regime, n - m ORDER BY observation_date) AS streak
FROM (SELECT *, row_number() OVER (ORDER BY observation_date) AS n,
             row_number() OVER (PARTITION BY economic_regime ORDER BY observation_date) AS m FROM x_econ)
""",
)(lambda s, sf: streaks(Cross(s, sf).macro.indicators, "observation_date", "economic_regime"))

# --- panels -------------------------------------------------------------------------------

TABLES["x_panel"] = (
    "SELECT date, "
    + ", ".join(f"max(r) FILTER (asset = '{a}') AS {a}" for a in ASSETS)
    + " FROM (SELECT asset, date, (price / lag(price) OVER (PARTITION BY asset ORDER BY date) - 1) * 100 AS r FROM x_close) GROUP BY date"
)


def _matrix_sql(assets, where):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS asset_a, '{b}' AS asset_b, corr({a}, {b}) AS correlation FROM x_panel {where}"
        for i, a in enumerate(assets)
        for b in assets[i + 1 :]
    )


_MATRIX = "s: asset_a asset_b | f6: correlation"
register("correlation_matrix", _MATRIX, _matrix_sql(ASSETS, ""))(
    lambda s, sf: cx.correlation_matrix(Cross(s, sf).market.closes, ASSETS)
)
for _days in (30, 90, 365):
    register(
        f"correlation_matrix_{_days}d",
        _MATRIX,
        _matrix_sql(ASSETS, f"WHERE date > (SELECT max(date) FROM x_panel) - {_days}"),
    )(lambda s, sf, _days=_days: cx.correlation_matrix(Cross(s, sf).market.closes, ASSETS, _days))
register(
    "pair_correlation",
    _MATRIX,
    "SELECT 'btc' AS asset_a, 'sp500' AS asset_b, corr(btc, sp500) AS correlation FROM x_panel "
    "WHERE date > (SELECT max(date) FROM x_close WHERE asset IN ('btc', 'sp500')) - 90",
)(lambda s, sf: cx.pair_correlation(Cross(s, sf).market.closes, "btc", "sp500", 90))
register(
    "rolling_corr_30d",
    "d: date | f6: btc_sp500 btc_gold btc_dxy",
    "SELECT date, "
    + ", ".join(f"{_corr('btc', a, _W30)} AS btc_{a}" for a in ("sp500", "gold", "dxy"))
    + " FROM x_panel",
)(
    lambda s, sf: cx.rolling_correlations(
        cx.returns_panel(Cross(s, sf).market.closes, ASSETS), "btc",
        {a: f"btc_{a}" for a in ("sp500", "gold", "dxy")},
    )
)

register(
    "inflation_hedge",
    "s: analysis_period | f2: btc_return_pct average_inflation_pct btc_real_return_pct | b: is_positive_real_return",
    """
SELECT '1995-2001' AS analysis_period, g AS btc_return_pct, i AS average_inflation_pct, g - i AS btc_real_return_pct,
       g > i AS is_positive_real_return
FROM (SELECT (arg_max(price, date) / arg_min(price, date) - 1) * 100 AS g FROM x_close WHERE asset = 'btc' AND year(date) BETWEEN 1995 AND 2001),
     (SELECT (arg_max(value, date) / arg_min(value, date) - 1) * 100 / 7 AS i FROM x_series WHERE series_id = 'CPIAUCSL' AND year(date) BETWEEN 1995 AND 2001)
""",
)(lambda s, sf: cx.inflation_hedge(Cross(s, sf).market.closes, Cross(s, sf).macro.series))


@register(
    "btc_inflation_regression",
    "f6: btc_inflation_beta btc_inflation_r_squared btc_cpi_correlation btc_real_return_pct hedge_effectiveness_score | b: is_effective_hedge",
    """
SELECT regr_slope(g, i) AS btc_inflation_beta, regr_r2(g, i) AS btc_inflation_r_squared, corr(g, i) AS btc_cpi_correlation,
       avg(g - i) AS btc_real_return_pct, 50 * (1 + corr(g, i)) AS hedge_effectiveness_score, avg(g - i) > 0 AND corr(g, i) > 0 AS is_effective_hedge
FROM (SELECT observation_date, inflation_rate_yoy AS i,
             (c / lag(c) OVER (ORDER BY observation_date) - 1) * 100 AS g
      FROM x_yoy JOIN (SELECT date_trunc('month', date) AS m, arg_max(price, date) AS c FROM x_close WHERE asset = 'btc' GROUP BY 1)
      ON m = observation_date)
WHERE g IS NOT NULL AND i IS NOT NULL
""",
)
def _regression(s, sf):
    c = Cross(s, sf)
    monthly = c.market.closes.where("asset = 'btc'").groupBy(F.trunc("date", "month").alias("observation_date")).agg(
        F.max_by("price", "date").alias("c")
    )
    panel = monthly.join(c.macro.yoy.select("observation_date", "inflation_rate_yoy"), "observation_date")
    before = F.lag("c").over(mk.dated("observation_date"))
    panel = panel.withColumn("gain", (F.col("c") / before - 1) * 100)
    return cx.inflation_regression(panel, "gain", "inflation_rate_yoy")


_AFTER = " ".join(
    f"ASOF LEFT JOIN x_close p{d} ON p{d}.asset = a.asset AND p{d}.date >= e.event_date + {d}" for d in (0, 7, 30)
)
register(
    "event_impact",
    "s: asset event_type | d: event_date | e: price_pre | f: return_0d_pct return_1w_pct return_1m_pct",
    f"""
SELECT a.asset, e.event_type, e.event_date, b.price AS price_pre,
       (p0.price - b.price) / b.price * 100 AS return_0d_pct, (p7.price - b.price) / b.price * 100 AS return_1w_pct,
       (p30.price - b.price) / b.price * 100 AS return_1m_pct
FROM x_event e JOIN (SELECT DISTINCT asset FROM x_close) a ON TRUE
ASOF JOIN x_close b ON b.asset = a.asset AND b.date < e.event_date
{_AFTER}
""",
)(
    # The SQL's inner ASOF JOIN asks for events with a close before them only; the operator gives all.
    lambda s, sf: cx.event_impact(
        ad.policy_events(s, sf), Cross(s, sf).market.closes, {"0d": 0, "1w": 7, "1m": 30}
    ).where("price_pre IS NOT NULL")
)

# --- daily context ------------------------------------------------------------------------

_FILL = {
    "unemployment_rate": "unemployment_rate",
    "cpi_yoy": "inflation_rate_yoy",
    "core_cpi_yoy": "core_cpi_yoy",
    "fed_funds_rate": "federal_funds_rate",
    "treasury_10y": "treasury_10y_rate",
    "yield_curve_spread": "treasury_10y_rate - treasury_2y_rate",
    "m2_billions": "m2_money_supply",
    "m2_growth_yoy": "m2_growth_rate_yoy",
    "gdp_growth_yoy": "gdp_growth_rate_yoy",
}
TABLES["x_core"] = """
SELECT *, (cpi_less_food_energy / lag(cpi_less_food_energy, 12) OVER (ORDER BY observation_date) - 1) * 100 AS core_cpi_yoy FROM x_yoy
"""
TABLES["x_cmd"] = (
    "WITH w AS (SELECT date, max(price) FILTER (asset = 'btc') AS btc_price_usd, max(price) FILTER (asset = 'sp500') AS sp500_close, "
    "max(price) FILTER (asset = 'gold') AS gold_price_usd, max(price) FILTER (asset = 'dxy') AS dxy_index FROM x_close GROUP BY 1), "
    "r AS (SELECT *, "
    + ", ".join(
        f"({c} / lag({c}) OVER (ORDER BY date) - 1) * 100 AS {r}"
        for c, r in (
            ("btc_price_usd", "btc_return_daily_pct"), ("sp500_close", "sp500_return_daily_pct"),
            ("gold_price_usd", "gold_return_daily_pct"), ("dxy_index", "dxy_r"),
        )
    )
    + " FROM w WHERE btc_price_usd IS NOT NULL), "
    "c AS (SELECT *, stddev_samp(btc_return_daily_pct) OVER " + _W30 + " AS btc_volatility_30d, "
    + ", ".join(
        f"{_corr('btc_return_daily_pct', x, _W30)} AS btc_{n}_corr_30d"
        for x, n in (("sp500_return_daily_pct", "sp500"), ("gold_return_daily_pct", "gold"), ("dxy_r", "dxy"))
    )
    + " FROM r) SELECT c.*, b.total_value_usd AS btc_volume_usd, k.market_cap_usd AS btc_market_cap_usd, f.value AS fear_greed_value, "
    "f.classification AS fear_greed_classification, "
    + ", ".join(f"g{i}.v AS {name}" for i, name in enumerate(_FILL))
    + " FROM c LEFT JOIN x_bar b ON b.symbol = 'BTCUSDT' AND b.trade_date = c.date "
    "LEFT JOIN x_coinstg k ON k.coin_id = 'bitcoin' AND k.price_date = c.date LEFT JOIN x_feel f ON f.value_date = c.date "
    + " ".join(
        f"ASOF LEFT JOIN (SELECT observation_date AS d, {e} AS v FROM x_core WHERE ({e}) IS NOT NULL) g{i} ON c.date >= g{i}.d"
        for i, e in enumerate(_FILL.values())
    )
)
_CMD = (
    "d: date | e: btc_price_usd sp500_close gold_price_usd dxy_index | f: btc_return_daily_pct sp500_return_daily_pct "
    "gold_return_daily_pct | f6: btc_volatility_30d btc_sp500_corr_30d btc_gold_corr_30d btc_dxy_corr_30d "
    "| e: btc_volume_usd | f2: btc_market_cap_usd | i: fear_greed_value | s: fear_greed_classification "
    "| f: unemployment_rate cpi_yoy core_cpi_yoy fed_funds_rate treasury_10y yield_curve_spread | f6: m2_billions | f: m2_growth_yoy"
)
register("crypto_macro_daily", _CMD, "SELECT * FROM x_cmd")(lambda s, sf: Cross(s, sf).daily)

TABLES["x_regime"] = """
SELECT date, CASE WHEN fed_rate > 4.5 THEN 'hawkish' WHEN fed_rate > 2 THEN 'neutral' WHEN fed_rate <= 2 THEN 'dovish' END AS fed_stance,
       fed_rate AS fed_funds_rate, CASE WHEN mood >= 60 THEN 'risk-on' WHEN mood <= 40 THEN 'risk-off' WHEN mood > 40 THEN 'neutral' END AS risk_appetite,
       mood AS fear_greed_value,
       CASE WHEN mood >= 70 THEN 'euphoria' WHEN mood >= 50 THEN 'optimism' WHEN mood >= 30 THEN 'anxiety' WHEN mood < 30 THEN 'panic' END AS crypto_phase
FROM (SELECT date, fed_funds_rate AS fed_rate, fear_greed_value AS mood FROM x_cmd)
"""
register(
    "market_regime",
    "d: date | s: fed_stance | e: fed_funds_rate | s: risk_appetite | i: fear_greed_value | s: crypto_phase",
    "SELECT * FROM x_regime",
)(lambda s, sf: cx.market_regime(Cross(s, sf).daily))

register(
    "inflation_hedge_daily",
    "d: date | e: btc_price_usd | f6: btc_return_1y_pct cpi_yoy core_cpi_yoy btc_real_return_1y_pct gold_real_return_1y_pct "
    "sp500_real_return_1y_pct btc_vs_gold_return inflation_hedge_score",
    """
WITH r AS (
  SELECT c.asset, c.date, (c.price / p.price - 1) * 100 AS gain
  FROM (SELECT *, CAST(date - INTERVAL 1 YEAR AS DATE) AS ago FROM x_close WHERE asset IN ('btc', 'gold', 'sp500')) c
  ASOF LEFT JOIN x_close p ON p.asset = c.asset AND c.ago >= p.date),
w AS (SELECT date, max(gain) FILTER (asset = 'btc') AS b, max(gain) FILTER (asset = 'gold') AS g, max(gain) FILTER (asset = 'sp500') AS s FROM r GROUP BY 1)
SELECT d.date, btc_price_usd, b AS btc_return_1y_pct, cpi_yoy, core_cpi_yoy, b - cpi_yoy AS btc_real_return_1y_pct, g - cpi_yoy AS gold_real_return_1y_pct,
       s - cpi_yoy AS sp500_real_return_1y_pct, b - g AS btc_vs_gold_return,
       avg(CASE WHEN b > cpi_yoy THEN 1.0 WHEN b <= cpi_yoy THEN 0.0 END) OVER (ORDER BY d.date ROWS 364 PRECEDING) AS inflation_hedge_score
FROM x_cmd d LEFT JOIN w ON w.date = d.date
""",
)(lambda s, sf: cx.inflation_hedge_daily(Cross(s, sf).daily, Market(s, sf).closes_of("btc", "gold", "sp500")))

register(
    "rate_analysis",
    "d: date | e: btc_price_usd | f6: btc_return_mtd_pct btc_return_ytd_pct fed_funds_rate fed_funds_change_mtd treasury_10y real_rate_10y "
    "btc_rate_sensitivity",
    """
WITH m AS (SELECT CAST(date_trunc('month', date) + INTERVAL 1 MONTH AS DATE) AS month, arg_max(btc_price_usd, date) AS p, max_by(fed_funds_rate, date) AS f FROM x_cmd GROUP BY 1),
     l AS (SELECT CAST(date_trunc('month', date) + INTERVAL 1 MONTH AS DATE) AS month, fed_funds_rate AS f FROM x_cmd
           QUALIFY row_number() OVER (PARTITION BY date_trunc('month', date) ORDER BY date DESC) = 1),
     y AS (SELECT year(date) + 1 AS year, arg_max(btc_price_usd, date) AS p FROM x_cmd GROUP BY 1),
     d AS (SELECT *, treasury_10y - lag(treasury_10y) OVER (ORDER BY date) AS moved FROM x_cmd),
     v AS (SELECT *, CASE WHEN btc_return_daily_pct IS NOT NULL THEN moved END AS x, CASE WHEN moved IS NOT NULL THEN btc_return_daily_pct END AS r FROM d)
SELECT v.date, btc_price_usd, (btc_price_usd / m.p - 1) * 100 AS btc_return_mtd_pct, (btc_price_usd / y.p - 1) * 100 AS btc_return_ytd_pct,
       fed_funds_rate, fed_funds_rate - l.f AS fed_funds_change_mtd, treasury_10y, treasury_10y - cpi_yoy AS real_rate_10y,
       CASE WHEN var_pop(x) OVER w > 1e-12 THEN covar_pop(r, x) OVER w / var_pop(x) OVER w END AS btc_rate_sensitivity
FROM v LEFT JOIN m ON m.month = date_trunc('month', v.date) LEFT JOIN l ON l.month = date_trunc('month', v.date) LEFT JOIN y ON y.year = year(v.date)
WINDOW w AS (ORDER BY v.date ROWS 89 PRECEDING)
""",
)(lambda s, sf: cx.rate_analysis(Cross(s, sf).daily))

TABLES["x_scores"] = f"""
WITH f AS (
  SELECT *, avg(btc_price_usd) OVER (ORDER BY date ROWS 49 PRECEDING) AS s50, avg(btc_price_usd) OVER (ORDER BY date ROWS 199 PRECEDING) AS s200,
         lag(btc_price_usd, 30) OVER (ORDER BY date) AS p30,
         list(btc_volatility_30d) FILTER (btc_volatility_30d IS NOT NULL) OVER (ORDER BY date ROWS 364 PRECEDING) AS vols
  FROM x_cmd),
g AS (SELECT gdp_growth_yoy AS growth, min(date) AS since, lag(gdp_growth_yoy) OVER (ORDER BY min(date)) AS growth_before
      FROM x_cmd WHERE gdp_growth_yoy IS NOT NULL GROUP BY 1),
i AS (SELECT cpi_yoy AS cpi, lag(cpi_yoy) OVER (ORDER BY min(date)) AS cpi_before FROM x_cmd WHERE cpi_yoy IS NOT NULL GROUP BY 1),
h AS (SELECT f.*, g.growth_before, i.cpi_before,
             CASE WHEN btc_volatility_30d IS NOT NULL AND len(vols) > 1
                  THEN 100.0 * len(list_filter(vols, lambda x: x < btc_volatility_30d)) / (len(vols) - 1) END AS a,
             100 - fear_greed_value AS b, CASE WHEN yield_curve_spread < 0 THEN 100 ELSE 0 END AS c
      FROM f LEFT JOIN g ON g.growth = f.gdp_growth_yoy LEFT JOIN i ON i.cpi = f.cpi_yoy)
SELECT date AS regime_date,
       CASE WHEN gdp_growth_yoy > growth_before THEN 'accelerating' WHEN gdp_growth_yoy < growth_before THEN 'decelerating'
            WHEN gdp_growth_yoy = growth_before THEN 'stable' END AS gdp_growth_trend,
       CASE WHEN cpi_yoy > 4 THEN 'high' WHEN cpi_yoy > 2 AND cpi_yoy < cpi_before THEN 'disinflation' WHEN cpi_yoy > 2 THEN 'moderate'
            WHEN cpi_yoy <= 2 THEN 'low' END AS inflation_regime,
       CASE WHEN a > 66.7 THEN 'high' WHEN a < 33.3 THEN 'low' WHEN a IS NOT NULL THEN 'normal' END AS volatility_regime,
       CASE WHEN gdp_growth_yoy > 0 AND gdp_growth_yoy >= growth_before THEN 'expansion' WHEN gdp_growth_yoy > 0 AND gdp_growth_yoy < growth_before THEN 'peak'
            WHEN gdp_growth_yoy <= 0 AND gdp_growth_yoy < growth_before THEN 'contraction' WHEN gdp_growth_yoy <= 0 AND gdp_growth_yoy >= growth_before THEN 'trough' END AS economic_cycle,
       CASE WHEN fed_funds_rate > 4.5 THEN 'hawkish' WHEN fed_funds_rate > 2 THEN 'neutral' ELSE 'dovish' END AS fed_stance,
       {_MONEY.replace('m2_growth_rate_yoy', 'm2_growth_yoy')} AS liquidity_conditions,
       CASE WHEN fear_greed_value >= 60 THEN 'risk-on' WHEN fear_greed_value <= 40 THEN 'risk-off' ELSE 'neutral' END AS risk_appetite,
       CASE WHEN btc_price_usd > s50 AND s50 > s200 THEN 'uptrend' WHEN btc_price_usd < s50 AND s50 < s200 THEN 'downtrend' ELSE 'sideways' END AS btc_trend,
       CASE WHEN btc_price_usd > s50 AND s50 > s200 THEN 'bull' WHEN btc_price_usd < s50 AND s50 < s200 THEN 'bear'
            WHEN btc_price_usd < p30 THEN 'distribution' ELSE 'accumulation' END AS crypto_market_phase,
       list_avg([a, b, c]) AS risk_score, 100 - list_avg([a, b, c]) AS opportunity_score
FROM h
"""
register(
    "market_regime_scores",
    "d: regime_date | s: economic_cycle gdp_growth_trend inflation_regime volatility_regime fed_stance liquidity_conditions risk_appetite btc_trend crypto_market_phase "
    "| f6: risk_score opportunity_score",
    "SELECT * FROM x_scores",
)(lambda s, sf: cx.market_regime_scores(Cross(s, sf).daily))

register(
    "latest_snapshot",
    "d: date | e: btc_price_usd | f: btc_return_daily_pct | i: fear_greed_value | s: fear_greed_classification "
    "economic_cycle fed_stance crypto_market_phase | f: unemployment_rate cpi_yoy",
    "SELECT * FROM x_cmd LEFT JOIN x_scores ON regime_date = date ORDER BY date DESC LIMIT 1",
)(lambda s, sf: cx.latest_snapshot(Cross(s, sf).daily, cx.market_regime_scores(Cross(s, sf).daily)))

register(
    "monthly_performance",
    "d: month | f: btc_return_pct sp500_return_pct gold_return_pct avg_fed_funds avg_inflation",
    "SELECT CAST(date_trunc('month', date) AS DATE) AS month, "
    + ", ".join(
        f"(arg_max({c}, date) - arg_min({c}, date)) / arg_min({c}, date) * 100 AS {a}_return_pct"
        for a, c in (("btc", "btc_price_usd"), ("sp500", "sp500_close"), ("gold", "gold_price_usd"))
    )
    + ", avg(fed_funds_rate) AS avg_fed_funds, avg(cpi_yoy) AS avg_inflation FROM x_cmd GROUP BY 1",
)(lambda s, sf: cx.monthly_performance(Cross(s, sf).daily))

register(
    "rate_regime",
    "d: date | e: fed_funds_rate btc_price_usd | s: rate_regime | i: months_in_regime | f: btc_return_in_regime_pct | i: months_since_last_change",
    """
WITH m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS date, arg_max(fed_funds_rate, date) AS fed_funds_rate,
                  arg_max(btc_price_usd, date) AS btc_price_usd FROM x_cmd GROUP BY 1 HAVING count(fed_funds_rate) > 0),
l AS (SELECT *, CASE WHEN fed_funds_rate > lag(fed_funds_rate) OVER w THEN 'hiking' WHEN fed_funds_rate < lag(fed_funds_rate) OVER w THEN 'cutting'
                ELSE 'pause' END AS rate_regime, row_number() OVER w AS n FROM m WINDOW w AS (ORDER BY date)),
k AS (SELECT *, n - row_number() OVER (PARTITION BY rate_regime ORDER BY date) AS island FROM l)
SELECT *, row_number() OVER w AS months_in_regime,
       (btc_price_usd - first_value(btc_price_usd) OVER w) / first_value(btc_price_usd) OVER w * 100 AS btc_return_in_regime_pct,
       date_diff('month', max(CASE WHEN rate_regime <> 'pause' THEN date END) OVER (ORDER BY date), date) AS months_since_last_change
FROM k WINDOW w AS (PARTITION BY rate_regime, island ORDER BY date)
""",
)(lambda s, sf: cx.rate_regime_returns(Cross(s, sf).daily))

register(
    "macro_overview",
    "e: btc_price_usd eth_price_usd | f2: total_market_cap_usd | f: btc_dominance_pct | i: fear_greed_value "
    "| s: fear_greed_classification | e: fedfunds dgs10 cpiaucsl unrate sp500 | s: market_sentiment macro_environment",
    """
SELECT (SELECT arg_max(price, date) FROM x_close WHERE asset = 'btc') AS btc_price_usd,
       (SELECT arg_max(price, date) FROM x_close WHERE asset = 'eth') AS eth_price_usd,
       c.cap AS total_market_cap_usd, c.b / c.cap * 100 AS btc_dominance_pct, f.value AS fear_greed_value, f.classification AS fear_greed_classification,
       (SELECT arg_max(value, date) FROM x_series WHERE series_id = 'FEDFUNDS') AS fedfunds,
       (SELECT arg_max(value, date) FROM x_series WHERE series_id = 'DGS10') AS dgs10,
       (SELECT arg_max(value, date) FROM x_series WHERE series_id = 'CPIAUCSL') AS cpiaucsl,
       (SELECT arg_max(value, date) FROM x_series WHERE series_id = 'UNRATE') AS unrate, NULL AS sp500,
       'neutral' AS market_sentiment, 'tightening' AS macro_environment
FROM (SELECT CAST(sum(market_cap_usd) AS DOUBLE) AS cap, CAST(sum(market_cap_usd) FILTER (coin_id = 'bitcoin') AS DOUBLE) AS b
      FROM x_coinstg WHERE price_date = (SELECT max(price_date) FROM x_coinstg)) c,
     (SELECT * FROM x_feel ORDER BY value_date DESC LIMIT 1) f
""",
)(
    lambda s, sf: cx.macro_overview(
        Cross(s, sf).market.closes, mk.market_breadth(Cross(s, sf).market.coins), Cross(s, sf).market.sentiment,
        mc.latest_values(Cross(s, sf).macro.series),
    )
)
