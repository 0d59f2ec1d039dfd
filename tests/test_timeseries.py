import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemill.operators import timeseries as ts
from tidemill.plans import market

DAY = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def closes():
    """500 days: a wave that makes the 50- and 200-day averages cross."""
    days = pd.date_range("2020-01-01", periods=500)
    price = 100 + 40 * np.sin(np.arange(500) / 40) + np.arange(500) % 5
    return pd.DataFrame({"trade_date": days.date, "close_price": price})


@pytest.fixture(scope="module")
def bars(spark, closes):
    rows = [("X", d, float(p), float(p) + 1, float(p) - 1, 10.0 * (1 + i % 9)) for i, (d, p) in enumerate(closes.values)]
    return spark.createDataFrame(
        rows, "symbol string, trade_date date, close_price double, high_price double, low_price double, total_value_usd double"
    )


def test_long_averages_and_crosses(bars, closes):
    got = market.crosses(market.sma_set(bars)).orderBy("trade_date").toPandas()
    fast, slow = closes["close_price"].rolling(50).mean(), closes["close_price"].rolling(200).mean()
    assert np.allclose(got["sma_200d"].dropna(), slow.dropna()) and got["sma_200d"].isna().sum() == 199
    side = np.sign(fast - slow)
    golden = (side > 0) & (side.shift() <= 0)
    death = (side < 0) & (side.shift() >= 0)
    assert list(got["golden_cross_signal"]) == list(golden) and golden.any()
    assert list(got["death_cross_signal"]) == list(death) and death.any()


def test_rsi_matches_simple_averages(bars, closes):
    got = market.rsi(bars).orderBy("trade_date").toPandas()["rsi_14d"]
    change = closes["close_price"].diff()
    up, down = change.clip(lower=0).rolling(14).mean(), (-change).clip(lower=0).rolling(14).mean()
    expected = 100 - 100 / (1 + up / down)
    assert got.isna().sum() == 14
    assert np.allclose(got.dropna(), expected.dropna())


def test_rsi_without_losses_is_100(spark):
    rows = [("X", DAY + dt.timedelta(i), float(i)) for i in range(20)]
    up = spark.createDataFrame(rows, "symbol string, trade_date date, close_price double")
    assert {r[0] for r in market.rsi(up).select("rsi_14d").collect()} == {None, 100.0}


def test_ema_is_recursive(spark, closes):
    df = spark.createDataFrame([("X", i, float(p)) for i, p in enumerate(closes["close_price"])], "k string, t int, c double")
    got = ts.ema(df, ["k"], "t", "c", {"e": 12}).orderBy("t").toPandas()["e"]
    value, expected = None, []
    for c in closes["close_price"]:
        value = c if value is None else value + 2 / 13 * (c - value)
        expected.append(value)
    assert np.allclose(got, expected)


def test_corr_is_null_without_variance(spark):
    df = spark.createDataFrame([(i, 5.0, float(i), None if i % 2 else float(i * i)) for i in range(8)], "t int, flat double, x double, y double")
    row = df.agg(ts.safe_corr(F.col("flat"), F.col("x")).alias("a"), ts.safe_corr(F.col("x"), F.col("y")).alias("b")).first()
    assert row["a"] is None and math.isclose(row["b"], np.corrcoef([0, 2, 4, 6], [0, 4, 16, 36])[0, 1])
    rolled = df.withColumn("r", ts.safe_corr(F.col("x"), F.col("y"), ts.last_rows(3, "t"))).orderBy("t").toPandas()["r"]
    assert math.isnan(rolled[0]) and math.isnan(rolled[1]) and math.isclose(rolled[2], 1.0)


def test_calendar_and_last_known(spark):
    known = spark.createDataFrame([("a", DAY, 1.0), ("a", DAY + dt.timedelta(4), 2.0)], "k string, day0 date, v double")
    back = {r["day"].day: r["v"] for r in ts.fill_calendar(known, "day0", "v", ["k"], "back").collect()}
    assert back == {1: 1.0, 2: 2.0, 3: 2.0, 4: 2.0, 5: 2.0}
    forward = {r["day"].day: r["v"] for r in ts.fill_calendar(known, "day0", "v", ["k"], "forward").collect()}
    assert forward == {1: 1.0, 2: 1.0, 3: 1.0, 4: 1.0, 5: 2.0}
    facts = spark.createDataFrame([(DAY - dt.timedelta(1),), (DAY + dt.timedelta(2),), (DAY + dt.timedelta(9),)], "day0 date")
    filled = ts.asof_last_known(facts, known.select("day0", "v"), "day0", ["v"]).orderBy("day0").collect()
    assert [r["v"] for r in filled] == [None, 1.0, 2.0]


def test_streaks(spark):
    df = spark.createDataFrame(list(enumerate("aabbbaNa")), "t int, l string").withColumn("l", F.nullif("l", F.lit("N")))
    assert [r["streak"] for r in ts.streaks(df, "t", "l").orderBy("t").collect()] == [1, 2, 1, 2, 3, 1, 1, 1]


def test_unit_transforms(spark):
    rows = [("s", DAY + dt.timedelta(31 * i), v) for i, v in enumerate([100.0, 110.0, 0.0, 50.0])]
    df = spark.createDataFrame(rows, "series_id string, date date, value double")

    def made(units):
        return [r["value"] for r in ts.series_transform(df, units, periods_per_year=2).orderBy("date").collect()]

    assert made("chg") == [None, 10.0, -110.0, 50.0]
    assert made("pch")[1] == pytest.approx(10.0) and made("pch")[3] is None
    assert made("pc1")[2] == pytest.approx(-100.0)
    assert made("pca")[1] == pytest.approx((1.1**2 - 1) * 100)
    assert made("cca")[1] == pytest.approx(math.log(1.1) * 200) and made("cca")[2] is None
    assert made("log")[2] is None


def test_mixed_frequencies_rows_against_calendar(spark):
    """Row distance counts rows of the grid, calendar distance looks one year back."""
    from tidemill.plans import macro

    days = pd.date_range("2020-01-01", periods=14, freq="MS").date.tolist() + [dt.date(2020, 6, 15)]
    rows = [(d, 100.0 + i, None, None, 5.0) for i, d in enumerate(days)]
    wide = spark.createDataFrame(
        rows, "observation_date date, cpi_all_urban double, gdp_real_chained double, m2_money_supply double, federal_funds_rate double"
    )
    by_rows = {r["observation_date"]: r["cpi_12m_ago"] for r in macro.yoy_changes(wide).collect()}
    by_date = {r["observation_date"]: r["cpi_12m_ago"] for r in macro.yoy_changes(wide, "calendar").collect()}
    assert by_rows[dt.date(2021, 1, 1)] == 101.0 and by_date[dt.date(2021, 1, 1)] == 100.0
