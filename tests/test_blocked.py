"""Blocked operators against plain windows and loops, with parts and chunks of a few rows."""

import bisect
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.operators import blocked
from tidemill.session import scratch_path

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def small_parts(spark, monkeypatch):
    """Many parts per series: no merging of small ones, and short chunks."""
    monkeypatch.setattr(blocked, "CHUNK_ROWS", 8)
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "11"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.fixture
def series(spark):
    """One hot series, some short ones, a null key; labels in runs, some of them null."""
    random.seed(11)
    made = []
    for k, n in (("hot", 400), ("a", 1), ("b", 9), (None, 20)):
        label = None
        for i in range(n):
            label = random.choice([label, label, label, "x", "y", None])
            made.append((k, i * 3, random.choice([None, 1.0, 2.0, 5.5, -3.0, 1e6]), label, f"{random.randrange(10**6)}.25"))
    random.shuffle(made)
    df = spark.createDataFrame(made, "k string, t int, x double, label string, money string").withColumn("money", F.col("money").cast("decimal(18,2)"))
    df.repartition(5).write.parquet(path := scratch_path(spark, "series"))
    return spark.read.parquet(path)


def same(got, want, *names):
    read = lambda df: sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
    assert read(got) == read(want)


def test_parts_split_the_hot_series(spark, series, small_parts):
    sizes = [r["count"] for r in blocked.dealt(series, ["k"], "t").where("k = 'hot'").groupBy(blocked.PART).count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 120


def test_running_sums(spark, series, small_parts):
    w = W.partitionBy("k").orderBy("t").rowsBetween(W.unboundedPreceding, 0)
    sums = {"total": F.col("money"), "some": F.when(F.col("t") > 30, F.col("t")), "n": F.lit(1)}
    got = blocked.running_sums(blocked.dealt(series, ["k"], "t"), ["k"], ["t"], sums)
    same(got, series.withColumns({n: F.sum(c).over(w) for n, c in sums.items()}), "k", "t", "total", "some", "n")


@pytest.mark.parametrize("reach", [1, 5, 30])
def test_sliding_frames(spark, series, small_parts, reach):
    def made(window):
        frame = window.rowsBetween(-reach, 0)
        return {"s": F.sum("money").over(frame), "n": F.count("*").over(frame), "was": F.lag("t", reach).over(window), "low": F.min("x").over(frame)}

    got = blocked.sliding(series, ["k"], ["t"], reach, made)
    assert got.columns == [*series.columns, "s", "n", "was", "low"]
    same(got, series.withColumns(made(W.partitionBy("k").orderBy("t"))), "k", "t", "s", "n", "was", "low")


def test_streaks(spark, series, small_parts):
    got = {(r["k"], r["t"]): r["streak"] for r in blocked.streaks(series, ["k"], ["t"], "label").collect()}
    want, before = {}, {}
    for r in sorted(series.collect(), key=lambda r: (repr(r["k"]), r["t"])):
        label, n = before.get(r["k"], (object(), 0))
        before[r["k"]] = (r["label"], n + 1 if r["label"] == label and r["k"] in before else 1)
        want[(r["k"], r["t"])] = before[r["k"]][1]
    assert got == want


def test_ema_of_long_series(spark, series, small_parts):
    spans = {"e1": 1, "e2": 2, "e12": 12, "e300": 300}
    got = {(r["k"], r["t"]): r for r in blocked.ema(series, ["k"], "t", "x", spans).collect()}
    rows = sorted(series.collect(), key=lambda r: (repr(r["k"]), r["t"]))
    assert len(got) == len(rows)
    for name, span in spans.items():
        state = {}
        for r in rows:
            if r["x"] is not None:
                y = state.get(r["k"])
                state[r["k"]] = r["x"] if y is None else y + 2 / (span + 1) * (r["x"] - y)
            found, want = got[(r["k"], r["t"])][name], state.get(r["k"])
            assert (found is None) == (want is None)
            assert found is None or np.isclose(found, want, rtol=1e-11, atol=1e-9)


def test_ema_needs_no_python(spark, series):
    plan = blocked.ema(series, ["k"], "t", "x", {"e": 12})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_asof_join(spark, small_parts):
    random.seed(5)
    at = lambda: None if random.random() < 0.03 else T0 + dt.timedelta(seconds=random.randrange(500))
    key = lambda: random.choice(["hot"] * 8 + ["a", "late", None])
    facts = [(i, key(), at()) for i in range(700)]
    known = [(k, t, random.randrange(50), None if random.random() < 0.2 else "n") for k, t in ((key(), at()) for _ in range(300)) if k != "late" or (t and t > T0 + dt.timedelta(seconds=400))]
    left = spark.createDataFrame(facts, "id int, k string, t timestamp")
    right = spark.createDataFrame(known, "k string, t timestamp, price int, note string")
    got = {r["id"]: (r["price"], r["note"]) for r in blocked.asof_join(left, right, ["k"], "t", ["price", "note"]).collect()}
    newest = {}
    for k, t, price, note in known:
        if t is not None:
            newest.setdefault(k, {}).setdefault(t, []).append((price, note is not None, note))
    for i, k, t in facts:
        times = sorted(newest.get(k, {}))
        place = bisect.bisect_right(times, t) - 1 if t is not None else -1
        best = max(newest[k][times[place]], key=lambda x: x[:2]) if place >= 0 else (None, None, None)
        assert got[i] == (best[0], best[2])
    assert len(got) == len(facts)
    assert blocked.asof_join(left, right.where("false"), ["k"], "t", ["price"]).where("price IS NOT NULL").count() == 0
    assert blocked.asof_join(left.where("false"), right, ["k"], "t", ["price"]).count() == 0
