"""Economic series, country indicators, treasury curve and debt.

Long series are pivoted to one row per date; from there on everything is calendar grain, so the
windows without a partition hold one row per observation date.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions import labels
from tidemill.functions.scalars import first_known, last_known, pct_change, ratio
from tidemill.operators.timeseries import dated, moving_avg
from tidemill.plans import adapters
from tidemill.session import materialize


def stg_series(raw: DataFrame) -> DataFrame:
    day = F.col("date").cast("date")
    kept = raw.where(F.col("date").isNotNull() & F.col("series_id").isNotNull() & F.col("value").isNotNull())
    return kept.select(
        "series_id",
        day.alias("observation_date"),
        "series_title",
        "series_units",
        "series_frequency",
        F.col("value").cast("decimal(20,4)").alias("value"),
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
        F.year(day).alias("observation_year"),
        F.month(day).alias("observation_month"),
        F.quarter(day).alias("observation_quarter"),
        labels.member_label(F.col("series_id"), fv.SERIES_CATEGORIES, "other").alias("indicator_category"),
        F.lit(True).alias("is_valid_observation"),
    )


def stg_countries(raw: DataFrame) -> DataFrame:
    needed = ["year", "country_code", "indicator_code", "value"]
    kept = raw.dropna(subset=needed)
    return kept.select(
        "country_code",
        "country_name",
        "indicator_code",
        "indicator_name",
        F.col("year").cast("int").alias("year"),
        F.col("value").cast("decimal(20,4)").alias("value"),
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
        F.when(F.col("country_code").isin(fv.MAJOR_ECONOMIES), "major_economy").otherwise("other")
        .alias("economy_classification"),
        labels.prefix_label(F.col("indicator_code"), fv.INDICATOR_PREFIXES, "other").alias("indicator_category"),
        F.lit(True).alias("is_valid_observation"),
    )


def pivot_series(
    long: DataFrame, columns: dict[str, str], by: list[str], key: str = "series_id", value: str = "value"
) -> DataFrame:
    """One column per listed series, largest value per cell; the list is given, so no extra pass."""
    wide = long.groupBy(*by).pivot(key, list(columns)).agg(F.max(value))
    return wide.withColumnsRenamed(columns)


def pivot_indicators(staged: DataFrame) -> DataFrame:
    by = ["observation_date", "observation_year", "observation_month", "observation_quarter"]
    wide = pivot_series(staged, fv.SERIES_COLUMNS, by)
    return wide.withColumns({c: F.col(c).cast("double") for c in fv.SERIES_COLUMNS.values()})


def _months_ago(wide: DataFrame, c: str, months: int) -> DataFrame:
    """date -> value the given number of calendar months later, for an equality join."""
    return wide.select(
        F.add_months("observation_date", months).alias("observation_date"), F.col(c).alias("_then")
    )


def yoy_changes(wide: DataFrame, mode: str = "rows") -> DataFrame:
    """Year-over-year changes of prices, output and money, and the real rate.

    mode="rows" counts rows of the date grid (12 or 4 back), so mixed frequencies shift the
    distance; mode="calendar" looks exactly one year back by date.
    """
    plan = [
        ("cpi_all_urban", 12, "cpi_12m_ago", "inflation_rate_yoy"),
        ("gdp_real_chained", 4, "gdp_4q_ago", "gdp_growth_rate_yoy"),
        ("m2_money_supply", 12, "m2_12m_ago", "m2_growth_rate_yoy"),
    ]
    out = wide
    for source, rows, ago, change in plan:
        if mode == "rows":
            out = out.withColumn(ago, F.lag(source, rows).over(dated("observation_date")))
        else:
            past = _months_ago(wide, source, 12).withColumnRenamed("_then", ago)
            out = out.join(past, "observation_date", "left")
        out = out.withColumn(change, pct_change(F.col(source), F.col(ago)))
    return out.withColumn("real_interest_rate", F.col("federal_funds_rate") - F.col("inflation_rate_yoy"))


def economic_indicators(yoy: DataFrame) -> DataFrame:
    """Trends and regime labels per observation date."""
    day = "observation_date"
    tracked = {
        "inflation": "inflation_rate_yoy",
        "unemployment": "unemployment_rate",
        "fed_rate": "federal_funds_rate",
    }
    kept = yoy.select(
        day, "observation_year", "observation_month", "observation_quarter",
        "cpi_all_urban", "inflation_rate_yoy", "unemployment_rate", "federal_funds_rate",
        "treasury_10y_rate", "real_interest_rate", "m2_money_supply", "m2_growth_rate_yoy",
        "gdp_real_chained", "gdp_growth_rate_yoy",
    )
    trends = kept.withColumns(
        {
            **{f"{short}_ma_3m": moving_avg(F.col(c), 3, day) for short, c in tracked.items()},
            **{f"{short}_prev_month": F.lag(c).over(dated(day)) for short, c in tracked.items()},
        }
    )
    inflation, rate = F.col("inflation_rate_yoy"), F.col("federal_funds_rate")
    return trends.withColumns(
        {
            "economic_regime": labels.economic_regime(F.col("gdp_growth_rate_yoy"), inflation),
            "monetary_policy_stance": labels.policy_stance(rate - F.col("inflation_ma_3m")),
            "labor_market_health": labels.labor_health(F.col("unemployment_rate")),
            "inflation_trend": labels.change_label(
                inflation - F.col("inflation_prev_month"), 0.5, "accelerating", "decelerating", "stable"
            ),
            "rate_trend": labels.change_label(
                rate - F.col("fed_rate_prev_month"), 0.25, "hiking", "cutting", "holding"
            ),
        }
    )


def change_by_series(staged: DataFrame, periods_per_year: int = 12) -> DataFrame:
    """Change over the previous and the year-ago observation of each series, in percent."""
    w = dated("observation_date", "series_id")
    v = F.col("value").cast("double")
    return staged.withColumns(
        {
            "pct_change_mom": (ratio(v, F.lag(v, 1).over(w)) - 1) * 100,
            "pct_change_yoy": (ratio(v, F.lag(v, periods_per_year).over(w)) - 1) * 100,
        }
    )


# --- lookups ------------------------------------------------------------------------------


def latest_values(staged: DataFrame, series: list[str] | None = None) -> DataFrame:
    """Newest observation of each (listed) series."""
    kept = staged.where(F.col("series_id").isin(series)) if series else staged
    newest = F.max(F.struct("observation_date", "value", "series_title")).alias("r")
    return kept.groupBy("series_id").agg(newest).select("series_id", "r.*")


def series_query(
    staged: DataFrame, metadata: DataFrame, series_id: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """One series in a date range, with title, units and frequency from its metadata."""
    kept = staged.where(F.col("series_id") == series_id)
    if start:
        kept = kept.where(F.col("observation_date") >= F.lit(start).cast("date"))
    if end:
        kept = kept.where(F.col("observation_date") <= F.lit(end).cast("date"))
    about = metadata.select("series_id", "title", "units", "frequency")
    return kept.select("series_id", "observation_date", "value").join(about, "series_id", "left")


def search_series(metadata: DataFrame, text: str, limit: int | None = None) -> DataFrame:
    """Metadata rows whose id or title contains the text, ignoring case."""
    needle = F.lit(text.lower())
    hit = F.contains(F.lower("series_id"), needle) | F.contains(F.lower("title"), needle)
    found = metadata.where(hit).orderBy("series_id")
    return found if limit is None else found.limit(limit)


def indicator_query(
    staged: DataFrame,
    indicators: list[str],
    countries: list[str] | None = None,
    first_year: int | None = None,
    last_year: int | None = None,
) -> DataFrame:
    kept = staged.where(F.col("indicator_code").isin(indicators))
    if countries:
        kept = kept.where(F.col("country_code").isin(countries))
    if first_year is not None:
        kept = kept.where(F.col("year") >= first_year)
    if last_year is not None:
        kept = kept.where(F.col("year") <= last_year)
    return kept


def compare_countries(
    staged: DataFrame, indicator: str, countries: list[str] | None = None, year: int | None = None
) -> DataFrame:
    """One indicator over countries in a given or each country's newest year, largest first."""
    kept = indicator_query(staged, [indicator], countries, year, year)
    newest = kept.groupBy("country_code").agg(F.max(F.struct("year", "country_name", "value")).alias("r"))
    return newest.select("country_code", "r.*").orderBy(F.desc(F.coalesce("value", F.lit(0))), "country_code")


# --- treasury -----------------------------------------------------------------------------


def treasury_query(
    table: DataFrame, start: str | None = None, end: str | None = None, limit: int | None = None, **equals: str
) -> DataFrame:
    """Rows of a treasury table by date range and exact values, newest first."""
    kept = table
    if start:
        kept = kept.where(F.col("record_date") >= F.lit(start).cast("date"))
    if end:
        kept = kept.where(F.col("record_date") <= F.lit(end).cast("date"))
    for column, value in equals.items():
        kept = kept.where(F.col(column) == value)
    rest = sorted(c for c in table.columns if c != "record_date")
    newest = kept.orderBy(F.desc("record_date"), *rest)
    return newest if limit is None else newest.limit(limit)


def union_sources(rates: DataFrame, types: list[str] | None = None) -> DataFrame:
    """Rates of each security type, appended."""
    parts = [rates.where(F.col("security_type") == t) for t in types or fv.SECURITY_TYPES]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def rate_by_maturity(rates: DataFrame, years: int) -> DataFrame:
    """Newest rate of the maturity's security type whose description names it, else the newest."""
    kind = rates.where(F.col("security_type") == fv.MATURITY_SECURITY[years])
    named = F.coalesce(F.col("security_desc").rlike(f"(^|[^0-9]){years}([^0-9]|$)"), F.lit(False))
    return kind.orderBy(F.desc(named), F.desc("record_date"), "security_desc").limit(1)


def cast_debt_amounts(raw: DataFrame) -> DataFrame:
    amounts = ["tot_pub_debt_out_amt", "intragov_hold_amt", "debt_held_public_amt"]
    return raw.withColumns({a: F.col(a).try_cast("double") for a in amounts})


def yield_curve(yields: DataFrame) -> DataFrame:
    """Spreads, inversion and changes of the ten-year yield after 1, 5 and 21 trading days."""
    tenors = [f"yield_{t}" for t in fv.YIELD_TENORS]
    base = yields.withColumns({t: F.col(t).cast("double") for t in tenors})
    pairs = [("2y", "3m"), ("10y", "2y"), ("10y", "3m"), ("30y", "10y")]
    spreads = {f"spread_{a}_{b}": F.col(f"yield_{a}") - F.col(f"yield_{b}") for a, b in pairs}
    lowest = F.least(*[F.col(n) for n in spreads])
    ten, w = F.col("yield_10y"), dated("record_date")
    return base.withColumns(spreads).withColumns(
        {
            "is_inverted": F.col("spread_10y_2y") < 0,
            "inversion_depth": F.when(lowest < 0, lowest),
            **{
                f"yield_10y_change_{name}": ten - F.lag(ten, back).over(w)
                for name, back in (("1d", 1), ("1w", 5), ("1m", 21))
            },
        }
    )


def debt_changes(debt: DataFrame, gdp: DataFrame, population: float = 330e6) -> DataFrame:
    """Debt levels in billions with daily, month-, year-to-date and yearly changes and ratios.

    `gdp` has (day, gdp_billions) with the last known figure of each day.
    """
    day = "record_date"
    total = F.col("total_debt_billions")
    w = dated(day)

    levels = cast_debt_amounts(debt).select(
        day,
        (F.col("tot_pub_debt_out_amt") / 1e9).alias("total_debt_billions"),
        (F.col("debt_held_public_amt") / 1e9).alias("debt_held_by_public_billions"),
        (F.col("intragov_hold_amt") / 1e9).alias("intragovernmental_billions"),
    )
    # Opening values per month and year by equality join: the last row of the period before.
    month, year = F.trunc(day, "month"), F.trunc(day, "year")
    out = levels
    for name, unit, months in (("mtd", month, 1), ("ytd", year, 12)):
        closing = levels.groupBy(unit.alias("_p")).agg(F.max_by("total_debt_billions", day).alias(f"_open_{name}"))
        closing = closing.select(F.add_months("_p", months).alias(f"_p_{name}"), f"_open_{name}")
        out = out.withColumn(f"_p_{name}", unit).join(closing, f"_p_{name}", "left")
    past = levels.select(F.add_months(day, 12).alias(day), total.alias("_year_ago")).groupBy(day).agg(
        F.max("_year_ago").alias("_year_ago")
    )
    known = gdp.select(F.col("day").alias(day), "gdp_billions")
    out = out.join(past, day, "left").join(known, day, "left")
    return out.select(
        day, "total_debt_billions", "debt_held_by_public_billions", "intragovernmental_billions",
        (total - F.lag(total).over(w)).alias("daily_change_billions"),
        (total - F.col("_open_mtd")).alias("mtd_change_billions"),
        (total - F.col("_open_ytd")).alias("ytd_change_billions"),
        pct_change(total, F.col("_year_ago")).alias("yoy_change_pct"),
        ratio(total, F.col("gdp_billions")).alias("debt_to_gdp_ratio"),
        (total * 1e9 / F.lit(float(population))).alias("debt_per_capita_usd"),
    )


# --- rollups and wide tables ----------------------------------------------------------------


def price_changes(yoy: DataFrame) -> DataFrame:
    """With core and consumption price changes over twelve rows."""
    w = dated("observation_date")
    return yoy.withColumns(
        {
            "core_cpi_yoy": pct_change(F.col("cpi_less_food_energy"), F.lag("cpi_less_food_energy", 12).over(w)),
            "pce_yoy": pct_change(F.col("pce_price_index"), F.lag("pce_price_index", 12).over(w)),
        }
    )


def period_returns(closes: DataFrame, periods: dict[str, Column]) -> DataFrame:
    """Return of the last close of each period over that of the period before that has one."""
    last = closes.groupBy(*[c.alias(n) for n, c in periods.items()]).agg(F.max_by("price", "date").alias("_close"))
    before = F.lag("_close").over(W.orderBy(*periods))  # a row per period
    return last.select(*periods, pct_change(F.col("_close"), before).alias("sp500_return_pct"))


def us_monthly(yoy: DataFrame, sp500: DataFrame) -> DataFrame:
    """Monthly averages of the indicators; `sp500` has (date, price) of the index."""
    payroll = F.max("nonfarm_payroll")
    rolled = price_changes(yoy).groupBy(F.col("observation_year").alias("year"), F.col("observation_month").alias("month")).agg(
        F.avg("gdp_growth_rate_yoy").alias("gdp_growth_yoy"),
        F.avg("unemployment_rate").alias("unemployment_rate"),
        payroll.alias("_payroll"),
        F.avg("inflation_rate_yoy").alias("cpi_yoy"),
        F.avg("core_cpi_yoy").alias("core_cpi_yoy"),
        F.avg("pce_yoy").alias("pce_yoy"),
        F.avg("federal_funds_rate").alias("fed_funds_rate_avg"),
        F.avg("treasury_10y_rate").alias("treasury_10y_avg"),
    )
    before = F.lag("_payroll").over(W.orderBy("year", "month"))
    out = rolled.withColumn("payrolls_change", F.col("_payroll") - before).drop("_payroll")
    return out.join(period_returns(sp500, {"year": F.year("date"), "month": F.month("date")}), ["year", "month"], "left")


def us_quarterly(yoy: DataFrame) -> DataFrame:
    rolled = yoy.groupBy(F.col("observation_year").alias("year"), F.col("observation_quarter").alias("quarter")).agg(
        last_known("gdp_current_dollars", "observation_date").alias("gdp_billions"),
        last_known("gdp_real_chained", "observation_date").alias("real_gdp_billions"),
        F.avg("unemployment_rate").alias("unemployment_rate_avg"),
        F.avg("inflation_rate_yoy").alias("inflation_avg"),
        F.avg("federal_funds_rate").alias("fed_funds_rate_avg"),
    )
    w = W.orderBy("year", "quarter")
    real = F.col("real_gdp_billions")
    step = ratio(real, F.lag(real, 1).over(w))
    return rolled.withColumns(
        {
            "gdp_growth_qoq_annualized": (F.pow(F.when(step > 0, step), F.lit(4.0)) - 1) * 100,
            "gdp_growth_yoy": pct_change(real, F.lag(real, 4).over(w)),
        }
    )


def us_annual(yoy: DataFrame, debt: DataFrame, sp500: DataFrame) -> DataFrame:
    """Yearly summary; the debt is that of the year's last record, its ratio that to the year's mean product."""
    day = "observation_date"
    rolled = yoy.groupBy(F.col("observation_year").alias("year")).agg(
        F.avg("gdp_current_dollars").alias("gdp_billions"),
        F.avg("gdp_real_chained").alias("real_gdp_billions"),
        F.avg("unemployment_rate").alias("unemployment_rate_avg"),
        (last_known("nonfarm_payroll", day) - first_known("nonfarm_payroll", day)).alias("total_jobs_added"),
        F.avg("cpi_all_urban").alias("cpi_annual_avg"),
        F.avg("federal_funds_rate").alias("fed_funds_rate_avg"),
        last_known("federal_funds_rate", day).alias("fed_funds_rate_eoy"),
    )
    real = F.col("real_gdp_billions")
    grown = rolled.withColumn("gdp_growth_pct", pct_change(real, F.lag(real).over(W.orderBy("year"))))
    owed = cast_debt_amounts(debt).groupBy(F.year("record_date").alias("year")).agg(
        (last_known("tot_pub_debt_out_amt", "record_date") / 1e9).alias("national_debt_billions")
    )
    out = grown.join(owed, "year", "left").join(period_returns(sp500, {"year": F.year("date")}), "year", "left")
    return out.withColumn("debt_to_gdp_ratio", ratio(F.col("national_debt_billions"), F.col("gdp_billions")))


def us_indicators_wide(yoy: DataFrame) -> DataFrame:
    """One row per date: levels, changes, spread; a year is 12 rows, a quarter 1 row back."""
    w = dated("observation_date")

    def yoy_of(c: str) -> Column:
        return pct_change(F.col(c), F.lag(c, 12).over(w))

    return yoy.select(
        "observation_date",
        F.col("gdp_current_dollars").alias("gdp_billions"),
        pct_change(F.col("gdp_current_dollars"), F.lag("gdp_current_dollars", 1).over(w)).alias("gdp_growth_qoq"),
        F.col("gdp_growth_rate_yoy").alias("gdp_growth_yoy"),
        F.col("gdp_real_chained").alias("real_gdp_billions"),
        "unemployment_rate",
        F.col("nonfarm_payroll").alias("nonfarm_payrolls_thousands"),
        (F.col("nonfarm_payroll") - F.lag("nonfarm_payroll").over(w)).alias("payrolls_change_monthly"),
        "labor_force_participation",
        F.col("inflation_rate_yoy").alias("cpi_yoy"),
        yoy_of("cpi_less_food_energy").alias("core_cpi_yoy"),
        yoy_of("pce_price_index").alias("pce_yoy"),
        F.col("federal_funds_rate").alias("fed_funds_rate"),
        F.col("treasury_10y_rate").alias("treasury_10y"),
        F.col("treasury_2y_rate").alias("treasury_2y"),
        (F.col("treasury_10y_rate") - F.col("treasury_2y_rate")).alias("yield_curve_spread"),
        F.col("m2_money_supply").alias("m2_billions"),
        F.col("m2_growth_rate_yoy").alias("m2_growth_yoy"),
    )


def employment_stats(wide: DataFrame) -> DataFrame:
    w = dated("observation_date")
    return wide.select(
        "observation_date",
        "unemployment_rate",
        F.col("nonfarm_payroll").alias("nonfarm_payrolls_thousands"),
        F.col("labor_force_participation").alias("labor_force_participation_rate"),
        (F.col("nonfarm_payroll") - F.lag("nonfarm_payroll").over(w)).alias("payrolls_change_thousands"),
        (F.col("unemployment_rate") - F.lag("unemployment_rate").over(w)).alias("unemployment_rate_change"),
    )


def inflation_metrics(wide: DataFrame) -> DataFrame:
    w = dated("observation_date")

    def change(c: str, rows: int) -> Column:
        return pct_change(F.col(c), F.lag(c, rows).over(w))

    return wide.select(
        "observation_date",
        F.col("cpi_all_urban").alias("cpi_all_items"),
        F.col("cpi_less_food_energy").alias("cpi_core"),
        change("cpi_all_urban", 12).alias("inflation_rate_yoy"),
        change("cpi_less_food_energy", 12).alias("core_inflation_yoy"),
        change("cpi_all_urban", 1).alias("inflation_rate_mom"),
        change("cpi_less_food_energy", 1).alias("core_inflation_mom"),
        "pce_price_index",
        change("pce_price_index", 12).alias("pce_inflation_yoy"),
    )


GLOBAL_COLUMNS = {
    "NY.GDP.MKTP.CD": "gdp_usd",
    "SP.POP.TOTL": "population",
    "FP.CPI.TOTL.ZG": "inflation_rate",
    "SL.UEM.TOTL.ZS": "unemployment_rate",
    "NE.TRD.GNFS.ZS": "trade_pct_of_gdp",
}


def global_indicators_wide(staged: DataFrame) -> DataFrame:
    wide = pivot_series(staged, GLOBAL_COLUMNS, ["country_code", "year"], key="indicator_code")
    wide = wide.withColumns({c: F.col(c).cast("double") for c in GLOBAL_COLUMNS.values()})
    before = F.lag("gdp_usd").over(dated("year", "country_code"))
    return wide.select(
        "country_code", "year",
        (F.col("gdp_usd") / 1e9).alias("gdp_usd_billions"),
        pct_change(F.col("gdp_usd"), before).alias("gdp_growth_pct"),
        ratio(F.col("gdp_usd"), F.col("population")).alias("gdp_per_capita_usd"),
        (F.col("population") / 1e6).alias("population_millions"),
        "inflation_rate", "unemployment_rate", "trade_pct_of_gdp", "gdp_usd", "population",
    )


def global_comparison(wide: DataFrame, g7: list[str] = fv.G7, g20: list[str] = fv.G20) -> DataFrame:
    """World totals per year, shares of country groups, growth leader and ten largest economies.

    Countries are a short closed list, so the ranking keeps one small array per year.
    """
    gdp, country = F.col("gdp_usd"), F.col("country_code")
    world = F.sum(gdp)

    def share(members: list[str]) -> Column:
        return ratio(F.sum(F.when(country.isin(members), gdp)), world) * 100

    ranked = wide.withColumn(
        "_rank", F.row_number().over(W.partitionBy("year").orderBy(F.desc_nulls_last("gdp_usd"), "country_code"))
    )
    leader = F.min(F.when(F.col("gdp_growth_pct").isNotNull(), F.struct((-F.col("gdp_growth_pct")).alias("g"), "country_code")))
    top = F.sort_array(F.collect_list(F.when((F.col("_rank") <= 10) & gdp.isNotNull(), F.struct("_rank", "country_code"))))
    out = ranked.groupBy("year").agg(
        (world / 1e12).alias("world_gdp_trillions"),
        (F.sum("population") / 1e9).alias("world_population_billions"),
        ratio(world, F.sum("population")).alias("world_gdp_per_capita"),
        share(g7).alias("g7_gdp_share_pct"),
        share(g20).alias("g20_gdp_share_pct"),
        leader.alias("_leader"),
        top.alias("_top"),
    )
    return out.withColumns(
        {
            "fastest_growing_economy": F.col("_leader.country_code"),
            "fastest_growth_rate": -F.col("_leader.g"),
            "top_10_by_gdp": F.array_join(F.col("_top.country_code"), ","),
        }
    ).drop("_leader", "_top")


def headline_gdp(nipa: DataFrame) -> DataFrame:
    """Last row of line 1 of a national accounts table."""
    first_line = nipa.where(F.col("line_number") == "1")
    newest = F.max_by(F.struct(*nipa.columns), F.col("time_period"))
    return first_line.groupBy("table_name").agg(newest.alias("r")).select("r.*")


def us_summary(staged: DataFrame, debt: DataFrame) -> DataFrame:
    """Newest value of six series, and the newest total debt, as rows."""
    newest = latest_values(staged, fv.US_SUMMARY_SERIES).select(
        F.col("series_id").alias("item"), F.col("observation_date").alias("date"), F.col("value").cast("double").alias("value")
    )
    owed = cast_debt_amounts(debt).agg(F.max(F.struct("record_date", "tot_pub_debt_out_amt")).alias("r"))
    return newest.unionByName(
        owed.select(
            F.lit("national_debt").alias("item"), F.col("r.record_date").alias("date"),
            F.col("r.tot_pub_debt_out_amt").alias("value"),
        )
    )


@dataclass
class Macro:
    """Lazy macro graph over the given tables."""

    spark: SparkSession
    sf: str

    @cached_property
    def series(self) -> DataFrame:
        return stg_series(adapters.macro_series(self.spark, self.sf))

    @cached_property
    def metadata(self) -> DataFrame:
        return adapters.series_metadata(self.spark, self.sf)

    @cached_property
    def wide(self) -> DataFrame:
        return pivot_indicators(self.series)

    @cached_property
    def wide_table(self) -> DataFrame:
        """The wide table, written once: for plans that read it several times."""
        return materialize(self.wide, "wide-series")

    @cached_property
    def yoy(self) -> DataFrame:
        return yoy_changes(self.wide)

    @cached_property
    def yoy_of_table(self) -> DataFrame:
        return yoy_changes(self.wide_table)

    @cached_property
    def indicators(self) -> DataFrame:
        return economic_indicators(self.yoy)

    @cached_property
    def countries(self) -> DataFrame:
        return stg_countries(adapters.country_indicators(self.spark, self.sf))

    @cached_property
    def yields(self) -> DataFrame:
        return adapters.treasury_yields(self.spark, self.sf)

    @cached_property
    def debt(self) -> DataFrame:
        return adapters.treasury_debt(self.spark, self.sf)

    @cached_property
    def rates(self) -> DataFrame:
        return adapters.treasury_rates(self.spark, self.sf)
