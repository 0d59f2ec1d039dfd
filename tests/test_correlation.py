"""Correlations of many assets against numpy."""

import datetime as dt

import numpy as np

from tidemill.plans import cross


def test_many_assets_equal_numpy(spark):
    r = np.random.default_rng(12)
    n, days = 120, 60
    prices = np.cumprod(1 + r.normal(0, 0.02, (days, n)), axis=0) * 100
    prices[:, 0] = 50.0  # does not vary
    traded = r.random((days, n)) > 0.2
    traded[:30, 1], traded[30:, 2] = False, False  # never on the same dates
    start = dt.date(2024, 1, 1)
    made = [(f"a{k:03d}", start + dt.timedelta(days=d), float(prices[d, k])) for d in range(days) for k in range(n) if traded[d, k]]
    closes = spark.createDataFrame(made, "asset string, date date, price double")
    names = [f"a{k:03d}" for k in range(n)]
    found = cross.correlation_matrix(closes, names)
    assert len(found.columns) == 3 and found._jdf.queryExecution().analyzed().toString().count("covar_pop") <= 4
    got = {(x["asset_a"], x["asset_b"]): x["correlation"] for x in found.collect()}
    assert len(got) == n * (n - 1) // 2
    returns = np.full((days, n), np.nan)
    for k in range(n):
        at = np.flatnonzero(traded[:, k])
        returns[at[1:], k] = (prices[at[1:], k] / prices[at[:-1], k] - 1) * 100
    for i in range(n):
        for j in range(i + 1, n):
            both = ~np.isnan(returns[:, i]) & ~np.isnan(returns[:, j])
            x, y = returns[both, i], returns[both, j]
            want = np.corrcoef(x, y)[0, 1] if len(x) > 1 and x.std() > 1e-12 and y.std() > 1e-12 else None
            value = got[(names[i], names[j])]
            assert (value is None) == (want is None) and (value is None or abs(value - want) < 1e-9)
    assert cross.correlation_matrix(closes, names[:1]).count() == 0
