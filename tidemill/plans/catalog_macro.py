"""Registered macro-economic queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.operators.timeseries import fill_calendar, series_resample, series_transform
from tidemill.plans import macro as mc
from tidemill.plans.macro import Macro
from tidemill.plans.market import Market
from tidemill.plans.oracle_tables import TABLES, case_of, sql_list
from tidemill.plans.registry import register

_CATEGORY = case_of([(f"series_id IN ({sql_list(v)})", k) for k, v in fv.SERIES_CATEGORIES.items()], "other")
register(
    "stg_fred",
    "s: series_id | d: observation_date | s: series_title series_units series_frequency | e: value "
    "| i: observation_year observation_month observation_quarter | s: indicator_category",
    f"SELECT *, date AS observation_date, year(date) AS observation_year, month(date) AS observation_month, "
    f"quarter(date) AS observation_quarter, {_CATEGORY} AS indicator_category FROM x_series",
)(lambda s, sf: Macro(s, sf).series)

_KIND = case_of([(f"starts_with(indicator_code, '{v}')", k) for k, v in fv.INDICATOR_PREFIXES.items()], "other")
TABLES["x_wbstg"] = (
    f"SELECT *, CASE WHEN country_code IN ({sql_list(fv.MAJOR_ECONOMIES)}) THEN 'major_economy' ELSE 'other' END "
    f"AS economy_classification, {_KIND} AS indicator_category FROM x_wb"
)
_WB = (
    "s: country_code country_name indicator_code indicator_name | i: year | e: value | s: economy_classification "
    "indicator_category"
)
register("stg_worldbank", _WB, "SELECT * FROM x_wbstg")(lambda s, sf: Macro(s, sf).countries)

register(
    "pivot_indicators",
    "d: observation_date | i: observation_year observation_month observation_quarter | e: " + " ".join(fv.SERIES_COLUMNS.values()),
    "SELECT * FROM x_wide",
)(lambda s, sf: Macro(s, sf).wide)

_YOY = (
    "d: observation_date | e: cpi_12m_ago | f: inflation_rate_yoy | e: gdp_4q_ago | f: gdp_growth_rate_yoy "
    "| e: m2_12m_ago | f: m2_growth_rate_yoy real_interest_rate"
)
register("yoy_changes", _YOY, "SELECT * FROM x_yoy")(lambda s, sf: Macro(s, sf).yoy)
register(
    "yoy_changes_calendar",
    "d: observation_date | e: cpi_12m_ago | f: inflation_rate_yoy gdp_growth_rate_yoy m2_growth_rate_yoy",
    """
SELECT a.observation_date, b.cpi_all_urban AS cpi_12m_ago, (a.cpi_all_urban / b.cpi_all_urban - 1) * 100 AS inflation_rate_yoy,
       (a.gdp_real_chained / b.gdp_real_chained - 1) * 100 AS gdp_growth_rate_yoy,
       (a.m2_money_supply / b.m2_money_supply - 1) * 100 AS m2_growth_rate_yoy
FROM x_wide a LEFT JOIN x_wide b ON b.observation_date + INTERVAL 1 YEAR = a.observation_date
""",
)(lambda s, sf: mc.yoy_changes(Macro(s, sf).wide, mode="calendar"))

TABLES["x_econ"] = f"""
SELECT *,
  {case_of([("gdp_growth_rate_yoy > 3 AND inflation_rate_yoy < 3", "goldilocks"),
            ("gdp_growth_rate_yoy > 2 AND inflation_rate_yoy > 4", "overheating"),
            ("gdp_growth_rate_yoy < 0 AND inflation_rate_yoy > 3", "stagflation"),
            ("gdp_growth_rate_yoy < 0 AND inflation_rate_yoy < 2", "recession"),
            ("gdp_growth_rate_yoy > 0 AND inflation_rate_yoy < 2", "recovery")], "transition")} AS economic_regime,
  {case_of([("gap > 2", "tight"), ("gap > 0", "neutral"), ("gap < -2", "very_loose")], "loose")} AS monetary_policy_stance,
  {case_of([("unemployment_rate < 4", "very_strong"), ("unemployment_rate < 5", "strong"),
            ("unemployment_rate < 6", "moderate"), ("unemployment_rate < 8", "weak")], "very_weak")} AS labor_market_health,
  {case_of([("inflation_rate_yoy - inflation_prev_month > 0.5", "accelerating"),
            ("inflation_rate_yoy - inflation_prev_month < -0.5", "decelerating")], "stable")} AS inflation_trend,
  {case_of([("federal_funds_rate - fed_rate_prev_month > 0.25", "hiking"),
            ("federal_funds_rate - fed_rate_prev_month < -0.25", "cutting")], "holding")} AS rate_trend
FROM (SELECT *, avg(inflation_rate_yoy) OVER m AS inflation_ma_3m, avg(unemployment_rate) OVER m AS unemployment_ma_3m,
             avg(federal_funds_rate) OVER m AS fed_rate_ma_3m, lag(inflation_rate_yoy) OVER w AS inflation_prev_month,
             lag(unemployment_rate) OVER w AS unemployment_prev_month, lag(federal_funds_rate) OVER w AS fed_rate_prev_month,
             federal_funds_rate - inflation_ma_3m AS gap
      FROM x_yoy WINDOW w AS (ORDER BY observation_date), m AS (ORDER BY observation_date ROWS 2 PRECEDING))
"""
_LABELS = "economic_regime monetary_policy_stance labor_market_health inflation_trend rate_trend"
register(
    "economic_indicators_fct",
    "d: observation_date | e: cpi_all_urban unemployment_rate federal_funds_rate treasury_10y_rate m2_money_supply "
    "gdp_real_chained | f: inflation_rate_yoy real_interest_rate m2_growth_rate_yoy gdp_growth_rate_yoy inflation_ma_3m "
    "unemployment_ma_3m fed_rate_ma_3m inflation_prev_month | e: unemployment_prev_month fed_rate_prev_month | s: " + _LABELS,
    "SELECT * FROM x_econ",
)(lambda s, sf: Macro(s, sf).indicators)
for _n in _LABELS.split():
    register(_n, f"d: observation_date | s: {_n}", "SELECT * FROM x_econ")(lambda s, sf: Macro(s, sf).indicators)

register(
    "lookup_change_by_series",
    "s: series_id | d: observation_date | f: pct_change_mom pct_change_yoy",
    "SELECT series_id, date AS observation_date, (value / nullif(lag(value) OVER w, 0) - 1) * 100 AS pct_change_mom, "
    "(value / nullif(lag(value, 12) OVER w, 0) - 1) * 100 AS pct_change_yoy FROM x_series "
    "WINDOW w AS (PARTITION BY series_id ORDER BY date)",
)(lambda s, sf: mc.change_by_series(Macro(s, sf).series))

_LATEST = "SELECT series_id, max(date) AS observation_date, arg_max(value, date) AS value FROM x_series GROUP BY 1"
register("latest_values", "s: series_id | d: observation_date | e: value", _LATEST)(
    lambda s, sf: mc.latest_values(Macro(s, sf).series)
)
register(
    "series_query",
    "s: series_id title units frequency | d: observation_date | e: value",
    "SELECT series_id, series_title AS title, series_units AS units, series_frequency AS frequency, date AS observation_date, value "
    "FROM x_series WHERE series_id = 'UNRATE' AND date BETWEEN DATE '1996-01-01' AND DATE '1999-06-01'",
)(lambda s, sf: mc.series_query(Macro(s, sf).series, Macro(s, sf).metadata, "UNRATE", "1996-01-01", "1999-06-01"))
register(
    "search_series",
    "s: series_id title | d: observation_start observation_end",
    "SELECT series_id, max(series_title) AS title, min(date) AS observation_start, max(date) AS observation_end FROM x_series "
    "WHERE series_id ILIKE '%gdp%' OR series_title ILIKE '%gdp%' GROUP BY 1 ORDER BY 1",
)(lambda s, sf: mc.search_series(Macro(s, sf).metadata, "gDp"))
register(
    "indicator_query",
    _WB,
    "SELECT * FROM x_wbstg WHERE indicator_code IN ('NY.GDP.MKTP.CD', 'SP.POP.TOTL') AND country_code IN ('USA', 'DEU', 'BRA') "
    "AND year BETWEEN 1996 AND 1999",
)(
    lambda s, sf: mc.indicator_query(
        Macro(s, sf).countries, ["NY.GDP.MKTP.CD", "SP.POP.TOTL"], ["USA", "DEU", "BRA"], 1996, 1999
    )
)
register(
    "compare_countries",
    "s: country_code country_name | i: year | e: value",
    "SELECT country_code, max(country_name) AS country_name, max(year) AS year, arg_max(value, year) AS value FROM x_wbstg "
    "WHERE indicator_code = 'NY.GDP.MKTP.CD' GROUP BY 1",
)(lambda s, sf: mc.compare_countries(Macro(s, sf).countries, "NY.GDP.MKTP.CD"))

# --- treasury -----------------------------------------------------------------------------

_RATE = "d: record_date | s: security_type security_desc | e: avg_interest_rate"
register(
    "treasury_query",
    _RATE,
    "SELECT * FROM x_rate WHERE security_type = 'Treasury Notes' AND record_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' "
    "ORDER BY record_date DESC, avg_interest_rate, security_desc, security_type",
)(
    lambda s, sf: mc.treasury_query(
        Macro(s, sf).rates, "1996-01-01", "1998-12-31", security_type="Treasury Notes"
    )
)
register("union_sources", _RATE, "SELECT * FROM x_rate")(lambda s, sf: mc.union_sources(Macro(s, sf).rates))
register(
    "rate_by_maturity",
    _RATE,
    "SELECT * FROM x_rate WHERE security_type = 'Treasury Notes' "
    "ORDER BY coalesce(regexp_matches(security_desc, '(^|[^0-9])10([^0-9]|$)'), false) DESC, record_date DESC, security_desc LIMIT 1",
)(lambda s, sf: mc.rate_by_maturity(Macro(s, sf).rates, 10))
register(
    "cast_debt_amounts",
    "d: record_date | e: tot_pub_debt_out_amt intragov_hold_amt debt_held_public_amt",
    "SELECT record_date, total AS tot_pub_debt_out_amt, intragov AS intragov_hold_amt, held AS debt_held_public_amt FROM x_debt",
)(lambda s, sf: mc.cast_debt_amounts(Macro(s, sf).debt))

_SPREADS = "least(yield_2y - yield_3m, yield_10y - yield_2y, yield_10y - yield_3m, yield_30y - yield_10y)"
register(
    "yield_curve_spreads",
    "d: record_date | f6: spread_2y_3m spread_10y_2y spread_10y_3m spread_30y_10y | b: is_inverted | f6: inversion_depth "
    "yield_10y_change_1d yield_10y_change_1w yield_10y_change_1m",
    f"""
SELECT record_date, yield_2y - yield_3m AS spread_2y_3m, yield_10y - yield_2y AS spread_10y_2y, yield_10y - yield_3m AS spread_10y_3m,
       yield_30y - yield_10y AS spread_30y_10y, yield_10y < yield_2y AS is_inverted,
       CASE WHEN {_SPREADS} < 0 THEN {_SPREADS} END AS inversion_depth, yield_10y - lag(yield_10y) OVER w AS yield_10y_change_1d,
       yield_10y - lag(yield_10y, 5) OVER w AS yield_10y_change_1w, yield_10y - lag(yield_10y, 21) OVER w AS yield_10y_change_1m
FROM x_yield WINDOW w AS (ORDER BY record_date)
""",
)(lambda s, sf: mc.yield_curve(Macro(s, sf).yields))


@register(
    "debt_changes",
    "d: record_date | f6: total_debt_billions debt_held_by_public_billions intragovernmental_billions daily_change_billions "
    "mtd_change_billions ytd_change_billions yoy_change_pct debt_to_gdp_ratio debt_per_capita_usd",
    """
WITH m AS (SELECT date_trunc('month', record_date) AS p, arg_max(total, record_date) AS v FROM x_debt GROUP BY 1),
     y AS (SELECT date_trunc('year', record_date) AS p, arg_max(total, record_date) AS v FROM x_debt GROUP BY 1),
     ago AS (SELECT CAST(record_date + INTERVAL 1 YEAR AS DATE) AS day, max(total) AS v FROM x_debt GROUP BY 1),
     g AS (SELECT observation_date AS p, gdp_current_dollars AS v FROM x_wide WHERE gdp_current_dollars IS NOT NULL)
SELECT d.record_date, total / 1e9 AS total_debt_billions, held / 1e9 AS debt_held_by_public_billions,
       intragov / 1e9 AS intragovernmental_billions, (total - lag(total) OVER (ORDER BY d.record_date)) / 1e9 AS daily_change_billions,
       (total - m.v) / 1e9 AS mtd_change_billions, (total - y.v) / 1e9 AS ytd_change_billions,
       (total - ago.v) / ago.v * 100 AS yoy_change_pct, total / 1e9 / g.v AS debt_to_gdp_ratio, total / 330e6 AS debt_per_capita_usd
FROM x_debt d ASOF LEFT JOIN g ON d.record_date >= g.p
LEFT JOIN m ON m.p + INTERVAL 1 MONTH = date_trunc('month', d.record_date)
LEFT JOIN y ON y.p + INTERVAL 1 YEAR = date_trunc('year', d.record_date)
LEFT JOIN ago ON ago.day = d.record_date
""",
)
def _debt_changes(s, sf):
    m = Macro(s, sf)
    gdp = m.wide.where(F.col("gdp_current_dollars").isNotNull()).select(
        "observation_date", F.col("gdp_current_dollars").alias("gdp_billions")
    )
    # The last figure stays valid to the end of the debt table.
    end = m.debt.agg(F.max("record_date")).scalar()
    closing = gdp.agg(F.max_by("gdp_billions", "observation_date").alias("gdp_billions")).select(
        F.date_add(end, 1).alias("observation_date"), "gdp_billions"
    )
    known = fill_calendar(gdp.unionByName(closing), "observation_date", "gdp_billions", [], "forward")
    return mc.debt_changes(m.debt, known)


# --- rollups ------------------------------------------------------------------------------

register(
    "us_monthly",
    "i: year month | f: gdp_growth_yoy unemployment_rate cpi_yoy core_cpi_yoy pce_yoy fed_funds_rate_avg treasury_10y_avg "
    "| f4: payrolls_change | f: sp500_return_pct",
    """
WITH p AS (SELECT *, (cpi_less_food_energy / lag(cpi_less_food_energy, 12) OVER w - 1) * 100 AS core, (pce_price_index / lag(pce_price_index, 12) OVER w - 1) * 100 AS pce
           FROM x_yoy WINDOW w AS (ORDER BY observation_date)),
     s AS (SELECT year(date) AS sy, month(date) AS sm, arg_max(price, date) AS c FROM x_close WHERE asset = 'sp500' GROUP BY 1, 2),
     r AS (SELECT sy, sm, (c / lag(c) OVER (ORDER BY sy, sm) - 1) * 100 AS sp500_return_pct FROM s),
     m AS (
SELECT observation_year AS year, observation_month AS month, avg(gdp_growth_rate_yoy) AS gdp_growth_yoy,
       avg(unemployment_rate) AS unemployment_rate, avg(inflation_rate_yoy) AS cpi_yoy, avg(federal_funds_rate) AS fed_funds_rate_avg,
       avg(treasury_10y_rate) AS treasury_10y_avg,
       max(nonfarm_payroll) - lag(max(nonfarm_payroll)) OVER (ORDER BY observation_year, observation_month) AS payrolls_change,
       avg(core) AS core_cpi_yoy, avg(pce) AS pce_yoy
FROM p GROUP BY 1, 2)
SELECT m.*, r.sp500_return_pct FROM m LEFT JOIN r ON r.sy = m.year AND r.sm = m.month
""",
)(lambda s, sf: mc.us_monthly(Macro(s, sf).yoy, Market(s, sf).closes_of("sp500")))
register(
    "us_quarterly",
    "i: year quarter | e: gdp_billions real_gdp_billions | f: unemployment_rate_avg inflation_avg fed_funds_rate_avg "
    "| f6: gdp_growth_qoq_annualized gdp_growth_yoy",
    """
SELECT *, (power(real_gdp_billions / lag(real_gdp_billions) OVER w, 4) - 1) * 100 AS gdp_growth_qoq_annualized,
       (real_gdp_billions / lag(real_gdp_billions, 4) OVER w - 1) * 100 AS gdp_growth_yoy
FROM (SELECT observation_year AS year, observation_quarter AS quarter, arg_max(gdp_current_dollars, observation_date) AS gdp_billions,
             arg_max(gdp_real_chained, observation_date) AS real_gdp_billions, avg(unemployment_rate) AS unemployment_rate_avg,
             avg(inflation_rate_yoy) AS inflation_avg, avg(federal_funds_rate) AS fed_funds_rate_avg FROM x_yoy GROUP BY 1, 2)
WINDOW w AS (ORDER BY year, quarter)
""",
)(lambda s, sf: mc.us_quarterly(Macro(s, sf).yoy))
register(
    "us_annual",
    "i: year | f6: gdp_billions real_gdp_billions unemployment_rate_avg total_jobs_added cpi_annual_avg fed_funds_rate_avg "
    "fed_funds_rate_eoy gdp_growth_pct national_debt_billions debt_to_gdp_ratio sp500_return_pct",
    """
WITH owed AS (SELECT year(record_date) AS dy, CAST(arg_max(total, record_date) AS DOUBLE) / 1e9 AS national_debt_billions FROM x_debt GROUP BY 1),
     s AS (SELECT year(date) AS sy, arg_max(price, date) AS c FROM x_close WHERE asset = 'sp500' GROUP BY 1),
     r AS (SELECT sy, (c / lag(c) OVER (ORDER BY sy) - 1) * 100 AS sp500_return_pct FROM s),
     a AS (
SELECT *, (real_gdp_billions / lag(real_gdp_billions) OVER (ORDER BY year) - 1) * 100 AS gdp_growth_pct
FROM (SELECT observation_year AS year, avg(gdp_current_dollars) AS gdp_billions, avg(gdp_real_chained) AS real_gdp_billions,
             avg(unemployment_rate) AS unemployment_rate_avg,
             arg_max(nonfarm_payroll, observation_date) - arg_min(nonfarm_payroll, observation_date) AS total_jobs_added,
             avg(cpi_all_urban) AS cpi_annual_avg, avg(federal_funds_rate) AS fed_funds_rate_avg,
             arg_max(federal_funds_rate, observation_date) AS fed_funds_rate_eoy FROM x_yoy GROUP BY 1))
SELECT a.*, national_debt_billions, national_debt_billions / gdp_billions AS debt_to_gdp_ratio, sp500_return_pct
FROM a LEFT JOIN owed ON dy = a.year LEFT JOIN r ON sy = a.year
""",
)(lambda s, sf: mc.us_annual(Macro(s, sf).yoy, Macro(s, sf).debt, Market(s, sf).closes_of("sp500")))
register(
    "us_indicators_wide",
    "d: observation_date | e: gdp_billions real_gdp_billions unemployment_rate nonfarm_payrolls_thousands labor_force_participation "
    "fed_funds_rate treasury_10y treasury_2y m2_billions | f: gdp_growth_qoq gdp_growth_yoy payrolls_change_monthly cpi_yoy "
    "core_cpi_yoy pce_yoy yield_curve_spread m2_growth_yoy",
    """
SELECT observation_date, gdp_current_dollars AS gdp_billions, gdp_real_chained AS real_gdp_billions, unemployment_rate,
       nonfarm_payroll AS nonfarm_payrolls_thousands, labor_force_participation, federal_funds_rate AS fed_funds_rate,
       treasury_10y_rate AS treasury_10y, treasury_2y_rate AS treasury_2y, m2_money_supply AS m2_billions,
       (gdp_current_dollars - lag(gdp_current_dollars) OVER w) / lag(gdp_current_dollars) OVER w * 100 AS gdp_growth_qoq,
       gdp_growth_rate_yoy AS gdp_growth_yoy, nonfarm_payroll - lag(nonfarm_payroll) OVER w AS payrolls_change_monthly,
       inflation_rate_yoy AS cpi_yoy,
       (cpi_less_food_energy / lag(cpi_less_food_energy, 12) OVER w - 1) * 100 AS core_cpi_yoy,
       (pce_price_index / lag(pce_price_index, 12) OVER w - 1) * 100 AS pce_yoy,
       treasury_10y_rate - treasury_2y_rate AS yield_curve_spread, m2_growth_rate_yoy AS m2_growth_yoy
FROM x_yoy WINDOW w AS (ORDER BY observation_date)
""",
)(lambda s, sf: mc.us_indicators_wide(Macro(s, sf).yoy))
register(
    "employment_stats",
    "d: observation_date | e: unemployment_rate nonfarm_payrolls_thousands labor_force_participation_rate | f: payrolls_change_thousands unemployment_rate_change",
    "SELECT observation_date, unemployment_rate, nonfarm_payroll AS nonfarm_payrolls_thousands, "
    "labor_force_participation AS labor_force_participation_rate, nonfarm_payroll - lag(nonfarm_payroll) OVER w AS payrolls_change_thousands, "
    "unemployment_rate - lag(unemployment_rate) OVER w AS unemployment_rate_change FROM x_wide WINDOW w AS (ORDER BY observation_date)",
)(lambda s, sf: mc.employment_stats(Macro(s, sf).wide))
register(
    "inflation_metrics",
    "d: observation_date | e: cpi_all_items cpi_core pce_price_index | f: inflation_rate_yoy core_inflation_yoy inflation_rate_mom "
    "core_inflation_mom pce_inflation_yoy",
    """
SELECT observation_date, cpi_all_urban AS cpi_all_items, cpi_less_food_energy AS cpi_core, pce_price_index,
       (cpi_all_urban / lag(cpi_all_urban, 12) OVER w - 1) * 100 AS inflation_rate_yoy,
       (cpi_less_food_energy / lag(cpi_less_food_energy, 12) OVER w - 1) * 100 AS core_inflation_yoy,
       (cpi_all_urban / lag(cpi_all_urban) OVER w - 1) * 100 AS inflation_rate_mom,
       (cpi_less_food_energy / lag(cpi_less_food_energy) OVER w - 1) * 100 AS core_inflation_mom,
       (pce_price_index / lag(pce_price_index, 12) OVER w - 1) * 100 AS pce_inflation_yoy
FROM x_wide WINDOW w AS (ORDER BY observation_date)
""",
)(lambda s, sf: mc.inflation_metrics(Macro(s, sf).wide))

TABLES["x_gl"] = """
SELECT *, (gdp_usd - lag(gdp_usd) OVER w) / lag(gdp_usd) OVER w * 100 AS gdp_growth_pct
FROM (SELECT country_code, year, max(value) FILTER (indicator_code LIKE 'NY.GDP%') AS gdp_usd,
             max(value) FILTER (indicator_code LIKE 'SP.POP%') AS population, max(value) FILTER (indicator_code LIKE 'FP.CPI%') AS inflation_rate,
             max(value) FILTER (indicator_code LIKE 'SL.UEM%') AS unemployment_rate, max(value) FILTER (indicator_code LIKE 'NE.TRD%') AS trade_pct_of_gdp
      FROM x_wb GROUP BY 1, 2) WINDOW w AS (PARTITION BY country_code ORDER BY year)
"""
register(
    "global_indicators_wide",
    "s: country_code | i: year | f: gdp_usd_billions gdp_growth_pct | f6: gdp_per_capita_usd | f: population_millions "
    "| e: inflation_rate unemployment_rate trade_pct_of_gdp",
    "SELECT *, gdp_usd / 1e9 AS gdp_usd_billions, gdp_usd / population AS gdp_per_capita_usd, population / 1e6 AS population_millions FROM x_gl",
)(lambda s, sf: mc.global_indicators_wide(Macro(s, sf).countries))
register(
    "global_comparison",
    "i: year | f: world_gdp_trillions world_population_billions | f6: world_gdp_per_capita g7_gdp_share_pct g20_gdp_share_pct "
    "| s: fastest_growing_economy | f: fastest_growth_rate | s: top_10_by_gdp",
    f"""
SELECT year, sum(gdp_usd) / 1e12 AS world_gdp_trillions, sum(population) / 1e9 AS world_population_billions,
       sum(gdp_usd) / sum(population) AS world_gdp_per_capita,
       sum(gdp_usd) FILTER (country_code IN ({sql_list(fv.G7)})) / sum(gdp_usd) * 100 AS g7_gdp_share_pct,
       sum(gdp_usd) FILTER (country_code IN ({sql_list(fv.G20)})) / sum(gdp_usd) * 100 AS g20_gdp_share_pct,
       arg_max(country_code, gdp_growth_pct) AS fastest_growing_economy, max(gdp_growth_pct) AS fastest_growth_rate,
       string_agg(country_code, ',' ORDER BY r) FILTER (r <= 10) AS top_10_by_gdp
FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY gdp_usd DESC, country_code) AS r FROM x_gl) GROUP BY 1
""",
)(lambda s, sf: mc.global_comparison(mc.global_indicators_wide(Macro(s, sf).countries)))
register(
    "us_summary",
    "s: item | d: date | e: value",
    f"SELECT series_id AS item, max(date) AS date, arg_max(value, date) AS value FROM x_series WHERE series_id IN ({sql_list(fv.US_SUMMARY_SERIES)}) "
    "GROUP BY 1 UNION ALL SELECT 'national_debt', max(record_date), arg_max(total, record_date) FROM x_debt",
)(lambda s, sf: mc.us_summary(Macro(s, sf).series, Macro(s, sf).debt))

# --- unit transforms and resampling ---------------------------------------------------------

_UNITS = {
    "lin": "value",
    "chg": "value - lag(value) OVER w",
    "ch1": "value - lag(value, 12) OVER w",
    "pch": "(value / nullif(lag(value) OVER w, 0) - 1) * 100",
    "pc1": "(value / nullif(lag(value, 12) OVER w, 0) - 1) * 100",
    "pca": "(power(CASE WHEN value / nullif(lag(value) OVER w, 0) > 0 THEN value / lag(value) OVER w END, 12) - 1) * 100",
    "cch": "(ln(CASE WHEN value > 0 THEN value END) - ln(CASE WHEN lag(value) OVER w > 0 THEN lag(value) OVER w END)) * 100",
    "cca": "(ln(CASE WHEN value > 0 THEN value END) - ln(CASE WHEN lag(value) OVER w > 0 THEN lag(value) OVER w END)) * 1200",
    "log": "ln(CASE WHEN value > 0 THEN value END)",
}


def _compared(unit: str, sql: str) -> str:
    if unit != "pca":
        return sql
    return f"CASE WHEN ({sql}) IS NULL THEN ln(2.0) ELSE ln(1 + greatest(abs({sql}), 1.0)) END"


def _transformed(s, sf):
    base = Macro(s, sf).series.select("series_id", F.col("observation_date").alias("date"), "value")
    parts = [series_transform(base, u).withColumn("units", F.lit(u)) for u in _UNITS]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    # Compounding twelve-fold reaches large numbers: compare those relative to their size.
    v = F.col("value")
    size = F.greatest(F.abs(v), F.lit(1.0))
    return out.withColumn("value", F.when(F.col("units") == "pca", F.log1p(size)).otherwise(v))


register(
    "series_transform",
    "s: series_id | d: date | s: units | f6: value",
    " UNION ALL ".join(
        f"SELECT series_id, date, '{u}' AS units, {_compared(u, e)} AS value FROM x_series "
        "WINDOW w AS (PARTITION BY series_id ORDER BY date)"
        for u, e in _UNITS.items()
    ),
)(_transformed)

_FREQ = {
    "w": "date_trunc('week', date)",
    "m": "date_trunc('month', date)",
    "q": "date_trunc('quarter', date)",
    "sa": "make_date(year(date), CASE WHEN month(date) < 7 THEN 1 ELSE 7 END, 1)",
    "a": "date_trunc('year', date)",
    "bw": "date_trunc('week', date) - to_days(CAST((date_diff('day', DATE '1970-01-05', CAST(date_trunc('week', date) AS DATE)) / 7) % 2 AS INTEGER) * 7)",
}


@register(
    "series_resample",
    "s: asset frequency method | d: period | e: value",
    " UNION ALL ".join(
        f"SELECT asset, '{f}' AS frequency, '{m}' AS method, CAST({p} AS DATE) AS period, {a} AS value FROM x_close GROUP BY 1, 4"
        for f, p in _FREQ.items()
        for m, a in (("avg", "CAST(sum(CAST(price AS DECIMAL(28,8))) AS DOUBLE) / count(price)"), ("sum", "CAST(sum(CAST(price AS DECIMAL(28,8))) AS DOUBLE)"), ("eop", "arg_max(price, date)"))
    ),
)
def _resampled(s, sf):
    from tidemill.plans.market import Market

    base = Market(s, sf).closes.withColumnRenamed("price", "value")
    parts = [
        series_resample(base, f, m, keys=("asset",)).withColumns({"frequency": F.lit(f), "method": F.lit(m)})
        for f in _FREQ
        for m in ("avg", "sum", "eop")
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
