"""First and last by time as fixed-width state: no raw row is sorted, ties go by id."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemill.functions.scalars import time_key
from tidemill.plans import market


def test_time_key_orders_like_the_pair(spark):
    moments = [None, dt.datetime(1, 1, 2), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(1970, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 1), dt.datetime(9999, 12, 30)]
    ids = [None, -(1 << 63), -1, 0, 1, (1 << 63) - 1]
    made = [(t, i) for t in moments for i in ids]
    random.seed(2)
    random.shuffle(made)
    df = spark.createDataFrame(made, "t timestamp, i long")
    by_key = [tuple(r) for r in df.orderBy(time_key("t", "i")).collect()]
    assert by_key == [tuple(r) for r in df.orderBy("t", "i").collect()]
    assert df.select(time_key("t", "i").alias("k")).distinct().count() == len(made)


def test_bars_equal_plain_ones_with_ties(spark):
    random.seed(3)
    t0 = dt.datetime(2024, 1, 1)
    made = [(f"S{random.randrange(3)}", t0 + dt.timedelta(hours=random.randrange(60)), i * random.choice([-1, 1]), random.randrange(1, 500)) for i in range(1, 900)]
    df = spark.createDataFrame(made, "symbol string, trade_timestamp timestamp, trade_id long, price long").withColumn("price", F.col("price").cast("decimal(18,8)"))
    aggs = [c.alias(n) for n, c in market.bar_aggregates("price", "trade_timestamp", "trade_id").items()]
    got = {r["symbol"]: (int(r["open_price"]), int(r["close_price"])) for r in df.groupBy("symbol").agg(*aggs).collect()}
    for symbol in ("S0", "S1", "S2"):
        rows = sorted((t, i, p) for s, t, i, p in made if s == symbol)
        assert got[symbol] == (rows[0][2], rows[-1][2])


def test_bars_do_not_sort_raw_rows(spark, small):
    trades = market.Market(spark, small, intraday=True).trades
    for bars in (market.daily_ohlcv(trades), market.hourly_ohlcv(trades).drop("hourly_return_pct")):
        plan = bars._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan
