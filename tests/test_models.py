"""Hand-made fixtures for what the given tables cannot show, and accepted-value invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemill import fixed_values as fv
from tidemill.functions import labels, nested
from tidemill.functions import scalars as sc
from tidemill.plans import commerce, commerce_staging, cross, dashboard, macro, market
from tidemill.plans.commerce import Commerce
from tidemill.plans.catalog_cross import Cross

T0 = dt.datetime(2024, 1, 1)


def order(spark, rows):
    return spark.createDataFrame(
        rows,
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, order_approved_at timestamp, "
        "order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp",
    )


@pytest.fixture(scope="module")
def shop(spark):
    late = T0 + dt.timedelta(days=30)
    orders = order(
        spark,
        [
            ("o1", "c1", "delivered", T0, T0, T0, T0 + dt.timedelta(days=4), late),
            ("o2", "c2", "delivered", T0, None, None, late + dt.timedelta(days=2), late),
            ("o3", "c1", " Canceled ", T0, None, None, None, late),
            ("o4", "c9", "canceled", T0, None, None, None, None),
            (None, "c1", "delivered", T0, None, None, None, None),
        ],
    )
    items = spark.createDataFrame(
        [("o1", 1, "p1", "s1", T0, 10.0, 1.0), ("o1", 2, "p1", "s2", T0, 20.0, 2.0), ("o3", 1, "p2", "s1", T0, 5.0, 0.5)],
        "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp, price double, freight_value double",
    ).withColumns({c: F.col(c).cast("decimal(10,2)") for c in ("price", "freight_value")})
    reviews = spark.createDataFrame(
        [("r1", "o1", 5, None, "  ", T0, None), ("r2", "o1", 2, "t", "good", T0, T0), (None, "o1", 1, None, None, T0, None)],
        "review_id string, order_id string, review_score int, review_comment_title string, review_comment_message string, "
        "review_creation_date timestamp, review_answer_timestamp timestamp",
    )
    payments = spark.createDataFrame(
        [("o1", 1, " Credit_Card", 3, 20.0), ("o1", 2, "voucher", 1, 13.0)],
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    )
    return orders, items, payments, reviews


def test_staging_flags_read_the_landed_status(shop):
    rows = {r["order_id"]: r for r in commerce_staging.orders(shop[0]).collect()}
    assert len(rows) == 4
    assert rows["o3"]["order_status"] == "canceled" and rows["o3"]["is_canceled"] is False
    assert rows["o4"]["is_canceled"] is True and rows["o4"]["days_to_deliver"] is None
    assert rows["o2"]["delivery_delta_days"] == -2.0


def test_reviews_blank_is_missing(shop):
    rows = {r["review_id"]: r for r in commerce_staging.reviews(shop[3]).collect()}
    assert set(rows) == {"r1", "r2"}
    assert rows["r1"]["comment_message"] is None and rows["r1"]["has_comment"] is False
    assert rows["r2"]["has_comment"] is True


def test_enriched_keeps_orders_without_items(shop):
    o, i, p, r = shop
    rows = {
        x["order_id"]: x
        for x in commerce.orders_enriched(
            commerce_staging.orders(o), commerce_staging.order_items(i), commerce_staging.payments(p), commerce_staging.reviews(r)
        ).collect()
    }
    assert rows["o4"]["total_items"] == 0 and rows["o4"]["total_order_value"] == 0 and rows["o4"]["has_review_comment"] is False
    one = rows["o1"]
    assert (one["total_items"], one["unique_products"], one["unique_sellers"], one["payment_count"]) == (2, 1, 2, 2)
    assert one["primary_payment_type"] == "voucher" and one["avg_review_score"] == 3.5 and float(one["total_order_value"]) == 33.0


def test_kpis_fan_out_and_deduplicated(shop):
    o, i, _, r = shop
    both = r.where("review_id is not null")
    fan = dashboard.kpis(o.where("order_id is not null"), i, both).first()
    assert fan["total_revenue"] == 66.0 and fan["total_orders"] == 2 and fan["avg_order_value"] == 16.5
    assert fan["avg_delivery_days"] == pytest.approx((4 * 4 + 32) / 5, abs=0.05)
    once = dashboard.kpis(o.where("order_id is not null"), i, both, dedupe=True).first()
    assert once["total_revenue"] == 33.0 and once["avg_delivery_days"] == 18.0 and once["on_time_delivery_pct"] == 50.0


def test_end_date_is_midnight_unless_asked(spark):
    df = spark.createDataFrame([(T0,), (T0 + dt.timedelta(hours=5),)], "t timestamp")
    assert df.where(dashboard.date_range("t", end="2024-01-01")).count() == 1
    assert df.where(dashboard.date_range("t", end="2024-01-01", end_inclusive_day=True)).count() == 2


def test_corrected_recency_flips_scores(spark):
    base = spark.createDataFrame(
        [(i, "c", "s", "Low", 1, float(i + 1), 1.0, 1, T0, T0 + dt.timedelta(days=40 * i), 0.0, None, None) for i in range(10)],
        "customer_unique_id int, city string, state string, customer_segment string, order_count int, total_spend double, avg_order_value double, "
        "total_items_bought int, first_order_at timestamp, last_order_at timestamp, customer_lifetime_days double, avg_review_score double, avg_delivery_days double",
    )
    a = {r["customer_unique_id"]: r for r in commerce.mart_customers(base).collect()}
    b = {r["customer_unique_id"]: r for r in commerce.mart_customers(base, recency="corrected").collect()}
    assert a[9]["recency_score"] == 1 and b[9]["recency_score"] == 5
    assert a[9]["is_churned"] is False and a[0]["is_churned"] is True
    assert a[3]["estimated_annual_value"] == 4.0


def test_open_and_close_break_ties_by_trade_id(spark):
    raw = spark.createDataFrame(
        [
            (2, "S", 11.0, 1.0, T0, True, T0), (1, "S", 10.0, 1.0, T0, False, T0), (3, "S", 0.0, 1.0, T0, False, T0),
            (4, "S", 5.0, -1.0, T0, False, T0), (5, "S", 9.0, 2.0, None, False, T0), (6, "S", 12.0, 2.0, T0 + dt.timedelta(hours=1), False, T0),
            (7, "S", 13.0, 1.0, T0 + dt.timedelta(hours=1), True, T0),
        ],
        "trade_id long, symbol string, price double, quantity double, trade_time timestamp, is_buyer_maker boolean, ingested_at timestamp",
    ).withColumns({c: F.col(c).cast("decimal(30,10)") for c in ("price", "quantity")})
    bar = market.daily_ohlcv(market.stg_trades(raw)).first()
    assert (bar["open_price"], bar["close_price"], bar["high_price"], bar["low_price"], bar["trade_count"]) == (10.0, 13.0, 13.0, 10.0, 4)
    assert bar["buy_volume_usd"] + bar["sell_volume_usd"] == bar["total_value_usd"]


def test_sentiment_bounds(spark):
    df = spark.createDataFrame([(v,) for v in (0, 24, 25, 49, 50, 51, 74, 75, 100, None)], "v int")
    got = [r[0] for r in df.select(labels.sentiment_class(F.col("v"))).collect()]
    assert got == ["Extreme Fear"] * 2 + ["Fear"] * 2 + ["Neutral"] + ["Greed"] * 2 + ["Extreme Greed"] * 2 + [None]


def test_states_have_one_region():
    states = [s for group in fv.REGION_STATES.values() for s in group]
    assert len(states) == len(set(states)) == 27


@pytest.mark.parametrize(
    "table,column,values",
    [
        ("indicators", "economic_regime", {"goldilocks", "overheating", "stagflation", "recession", "recovery", "transition"}),
        ("indicators", "monetary_policy_stance", {"tight", "neutral", "loose", "very_loose"}),
        ("indicators", "labor_market_health", {"very_strong", "strong", "moderate", "weak", "very_weak"}),
        ("analytics", "trend_signal", {"bullish", "bearish", "neutral"}),
        ("analytics", "volume_signal", {"high_volume", "low_volume", "normal_volume"}),
        ("mart", "market_risk_level", {"high_risk", "moderate_risk", "low_risk"}),
    ],
)
def test_accepted_values(spark, small, table, column, values):
    c = Cross(spark, small)
    df = {"indicators": c.macro.indicators, "analytics": c.market.analytics, "mart": c.mart}[table]
    assert {r[0] for r in df.select(column).distinct().collect()} <= values


def test_invariants_of_marts(spark, small):
    m = Commerce(spark, small)
    sales = m.sales
    last = sales.orderBy(F.desc("order_date")).first()
    total = m.fact.agg(F.sum("total_order_value")).first()[0]
    assert last["cumulative_revenue"] == total
    assert sales.count() == sales.select("order_date").distinct().count()
    bars = Cross(spark, small).market.bars
    assert bars.where("low_price > open_price or low_price > close_price or high_price < open_price or high_price < close_price").count() == 0


def test_messages_that_do_not_parse_are_dropped(spark):
    df = spark.createDataFrame([('{"e":"trade","s":"B","t":1,"p":"x","T":1700000000000}',), ("{broken",), (None,)], "value string")
    rows = nested.parse_trade_json(df).collect()
    assert len(rows) == 1 and rows[0]["price"] is None and rows[0]["quantity"] == 0.0


def test_dates_in_many_formats(spark):
    cases = {
        "2024-03-01": dt.datetime(2024, 3, 1), "2024-03-01T10:00:00Z": dt.datetime(2024, 3, 1, 10),
        "2024-03-01T10:00:00.5": dt.datetime(2024, 3, 1, 10, 0, 0, 500000), "01/02/2024": dt.datetime(2024, 2, 1),
        "12/31/2024": dt.datetime(2024, 12, 31), "soon": None, "2024-02-30": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "c string")
    got = {r["c"]: r["t"] for r in df.select("c", sc.parse_any_date(F.col("c")).alias("t")).collect()}
    assert got == cases


def test_title_case_variants(spark):
    df = spark.createDataFrame([("são-paulo d'oeste",)], "c string")
    assert df.select(sc.title_case(F.col("c"))).first()[0] == "São-paulo D'oeste"
    assert df.select(sc.title_case(F.col("c"), after_punctuation=True)).first()[0] == "São-Paulo D'Oeste"


def test_newest_rate_falls_back_to_the_first(spark):
    rows = [(dt.date(2024, 1, 31), "Treasury Notes", "2-Year", 4.0), (dt.date(2024, 2, 29), "Treasury Notes", "7-Year", 5.0)]
    rates = spark.createDataFrame(rows, "record_date date, security_type string, security_desc string, avg_interest_rate double")
    assert macro.rate_by_maturity(rates, 2).first()["avg_interest_rate"] == 4.0
    assert macro.rate_by_maturity(rates, 10).first()["avg_interest_rate"] == 5.0


def test_inflation_hedge_spans_the_years_of_its_tables(spark):
    closes = spark.createDataFrame(
        [("btc", dt.date(2009, 5, 1), 50.0), ("btc", dt.date(2010, 1, 1), 100.0), ("btc", dt.date(2011, 12, 1), 150.0), ("eth", dt.date(2012, 1, 1), 1.0)],
        "asset string, date date, price double",
    )
    months = [(dt.date(2010 + k // 12, k % 12 + 1, 1), 100.0 + k) for k in range(36)]
    staged = spark.createDataFrame(
        [("CPIAUCSL", d, d.year, v) for d, v in months], "series_id string, observation_date date, observation_year int, value double"
    )
    names = ["analysis_period", "btc_return_pct", "average_inflation_pct", "btc_real_return_pct", "is_positive_real_return"]

    def found(*args, **how):
        return tuple(cross.inflation_hedge(*args, **how).select(*names).first())

    assert found(closes, staged) == ("2010-2011", 50.0, 11.5, 38.5, True)
    assert found(closes, staged, start_year=2009) == ("2009-2011", 200.0, 7.67, 192.33, True)
    assert found(closes, staged, start_year=1995, end_year=2001) == ("1995-2001", None, None, None, None)
    assert found(closes.where("asset = 'eth'"), staged) == ("2010-2012", None, round(35 / 3, 2), None, None)
    assert found(closes, staged.where("value < 105")) == ("2010-2010", 0.0, None, None, None)
    assert found(closes.where("asset = 'eth'"), staged.where("value < 0")) == (None, None, None, None, None)


def test_event_impact_keeps_events_before_the_first_close(spark):
    days = [dt.date(2020, 1, k) for k in range(1, 11)]
    closes = spark.createDataFrame(
        [("old", d, 100.0 + k) for k, d in enumerate(days)] + [("late", d, 50.0 + k) for k, d in enumerate(days) if k >= 5],
        "asset string, date date, price double",
    )
    events = spark.createDataFrame([("e1", days[0]), ("e2", days[2]), ("e3", days[5]), ("e4", days[7])], "event_type string, event_date date")
    found = cross.event_impact(events, closes, {"0d": 0, "2d": 2})
    got = {(r.event_type, r.asset): (r.price_pre, r.return_0d_pct, r.return_2d_pct) for r in found.collect()}
    gone = (None, None, None)
    assert found.count() == len(got) == 8
    assert [got[e, "late"] for e in ("e1", "e2", "e3")] == [gone, gone, gone] and got["e1", "old"] == gone
    assert got["e4", "late"] == (56.0, pytest.approx(100 / 56), pytest.approx(300 / 56))
    assert got["e2", "old"] == (101.0, pytest.approx(100 / 101), pytest.approx(300 / 101))


def test_top_products_moves_items_once(spark):
    """Items repeat per review and per copy of their product; they are hashed by order only, and grouped once."""
    orders = order(spark, [(o, "c", status, T0, None, None, None, None) for o, status in (("a", "created"), ("b", "created"), ("c", "canceled"), ("d", None))])
    items = spark.createDataFrame(
        [("a", "p", 1.0, 0.5), ("a", "p", 2.0, 0.5), ("a", "q", 4.0, None), ("b", "p", 8.0, 0.0), ("b", None, 9.0, 0.0), ("c", "p", 9.0, 0.0), (None, "p", 9.0, 0.0), ("d", "p", 9.0, 0.0)],
        "order_id string, product_id string, price double, freight_value double",
    ).withColumns({c: F.col(c).cast("decimal(10,2)") for c in ("price", "freight_value")})
    products = spark.createDataFrame([("p", "x"), ("q", None), ("q", "x")], "product_id string, product_category_name string")
    reviews = spark.createDataFrame([("a", 5), ("a", 2), ("a", None)], "order_id string, review_score int")
    found = dashboard.top_products(orders, items, products, reviews)
    got = [tuple(r) for r in found.collect()]
    assert got == [("x", 20.0, 2, 3.5), ("unknown", None, 1, 3.5)]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "order_id" in plan and not any("product_id" in line for line in plan.splitlines() if "Aggregate" in line)
