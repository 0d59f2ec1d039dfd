import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.operators.ranking import (
    Ordering,
    add_tiles,
    distinct_counts,
    group_percentiles,
    latest_per_key,
    rows_at_ranks,
    table_percentiles,
    tile_ends,
    top_per_group,
)
from tidemill.session import materialize


@pytest.fixture(scope="module")
def scores(spark):
    """1,003 rows; a third of them share one value; a few have none."""
    value = F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 101 == 1, F.lit(None)).otherwise((F.col("id") * 37 % 91).cast("double"))
    return materialize(spark.range(1003).select("id", value.alias("v")))


def test_tile_ends_give_the_remainder_to_the_first_tiles():
    assert tile_ends(12, 5) == [3, 6, 8, 10]
    assert tile_ends(3, 5) == [1, 2, 3, 3]
    assert tile_ends(10, 5) == [2, 4, 6, 8]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("rows", [1003, 17, 3])
def test_large_table_tiles_equal_ntile(scores, descending, rows):
    order = Ordering("v", "id", descending)
    part = scores.where(F.col("id") < rows)
    expected = part.withColumn("t", F.ntile(5).over(W.orderBy(*order.sort_columns())))
    got = add_tiles(part, {"t": order})
    assert got.exceptAll(expected).count() == 0
    assert got.count() == rows


def test_rows_at_ranks_with_a_hot_value(scores):
    order = Ordering("v", "id")
    everything = [(r["v"], r["id"]) for r in scores.orderBy(*order.sort_columns()).collect()]
    found = rows_at_ranks(scores, order, [1, 400, 1003], partitions=7)
    assert {r: (x["v"], x["id"]) for r, x in found.items()} == {r: everything[r - 1] for r in (1, 400, 1003)}


def test_percentiles_of_a_column(scores):
    values = [r["v"] for r in scores.where("v is not null").collect()]
    ps = [0.0, 0.25, 0.5, 0.913, 1.0]
    expected = np.quantile(values, ps)
    assert np.allclose(table_percentiles(scores, "v", "id", ps), expected)
    assert table_percentiles(scores.where("v is null"), "v", "id", [0.5]) == [None]


def test_percentiles_per_group_with_a_hot_group(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7))
    df = spark.range(5000).select(key.alias("k"), (F.col("id") * 7919 % 977 / 13.0 - 20).alias("v"))
    got = {r["k"]: (r["m"], r["p"]) for r in group_percentiles(df, ["k"], "v", {"m": 0.5, "p": 0.95}, step=2.5).collect()}
    pdf = df.toPandas()
    for k, group in pdf.groupby("k"):
        assert np.allclose(got[k], np.quantile(group["v"], [0.5, 0.95]))


def test_latest_top_and_distinct(spark):
    df = spark.createDataFrame(
        [("a", 1, 5.0, "x"), ("a", 2, 1.0, "y"), ("b", 1, 3.0, "q"), ("b", 1, 3.0, "p")], "k string, v int, amount double, name string"
    )
    assert {(r["k"], r["v"], r["name"]) for r in latest_per_key(df, ["k"], "v").collect()} == {("a", 2, "y"), ("b", 1, "q")}
    assert {(r["k"], r["name"]) for r in top_per_group(df, ["k"], "amount", "name").collect()} == {("a", "x"), ("b", "p")}
    (counts,) = distinct_counts(df, "k", {"name": "n"})
    assert {(r["k"], r["n"]) for r in counts.collect()} == {("a", 2), ("b", 2)}
