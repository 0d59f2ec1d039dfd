"""Exact order statistics, tiles, percentiles and newest/top row per group.

Built so that no task ever has to hold or sort a whole unbounded group:

* whole-table ranks come from a range-partitioned sort of (value, key) pairs, of which only the
  few rows that sit on a tile or percentile boundary are fetched;
* percentiles per group work on counted values, split again by a coarse step of the value;
* newest/top row per group is an aggregate with map-side combine, not a window.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.session import materialize

@dataclass(frozen=True)
class Ordering:
    """Sort by a numeric or temporal column, ties by a unique key column.

    NULLs sort as the largest value: last ascending, first descending.
    """

    value: str
    key: str
    descending: bool = False

    def sort_columns(self) -> list[Column]:
        v = F.col(self.value)
        return [v.desc_nulls_first() if self.descending else v.asc_nulls_last(), F.col(self.key).asc()]

    def at_or_before(self, cut: Row) -> Column:
        """Rows that sort at or before the given boundary row."""
        v, k = F.col(self.value), F.col(self.key)
        cut_value, cut_key = cut[self.value], cut[self.key]
        if cut_value is None:
            not_after = F.lit(not self.descending) & v.isNotNull()
            return F.coalesce(not_after | (v.isNull() & (k <= F.lit(cut_key))), F.lit(False))
        earlier = v > F.lit(cut_value) if self.descending else v < F.lit(cut_value)
        if self.descending:
            earlier = v.isNull() | earlier
        return F.coalesce(earlier | ((v == F.lit(cut_value)) & (k <= F.lit(cut_key))), F.lit(False))


def rows_at_ranks(df: DataFrame, order: Ordering, ranks: list[int], partitions: int | None = None) -> dict[int, Row]:
    """The rows at the given 1-based ranks of the whole ordering.

    One range shuffle of (value, key): the key is part of the sort, so a value shared by a
    third of all rows still spreads over many partitions. What reaches the driver is one count
    per partition and one row per requested rank.
    """
    spark = df.sparkSession
    parts = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    ordered = (
        df.select(order.value, order.key)
        .repartitionByRange(parts, *order.sort_columns())
        .sortWithinPartitions(*order.sort_columns())
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    ordered = materialize(ordered, "ranks")
    sizes = {
        r["_part"]: r["n"]
        for r in ordered.groupBy(F.shiftright("_pos", 33).alias("_part")).agg(F.count("*").alias("n")).collect()
    }
    wanted: dict[int, list[int]] = {}
    for rank in set(ranks):
        left = rank
        for part in sorted(sizes):
            if left <= sizes[part]:
                wanted.setdefault((part << 33) + left - 1, []).append(rank)
                break
            left -= sizes[part]
    if not wanted:
        return {}
    found = ordered.where(F.col("_pos").isin(list(wanted))).collect()
    return {rank: row for row in found for rank in wanted[row["_pos"]]}


def tile_ends(rows: int, tiles: int) -> list[int]:
    """Rank of the last row of each tile but the last; earlier tiles take the remainder."""
    size, extra = divmod(rows, tiles)
    return [i * size + min(i, extra) for i in range(1, tiles)]


def add_tiles(df: DataFrame, orders: dict[str, Ordering], tiles: int = 5) -> DataFrame:
    """Add one exact ntile column per ordering over the whole table.

    `df` is read several times: pass a materialized frame. Each row is compared with the rows on
    the tile boundaries; the table is never sorted in one task.
    """
    rows = df.count()
    out, columns, kinds = {}, df.columns, dict(df.dtypes)
    for name, order in orders.items():
        if kinds[order.value] == "timestamp":
            # Boundary values pass through the driver: as numbers they do not depend on its clock.
            number = f"_micros_{order.value}"
            df = df.withColumn(number, F.unix_micros(order.value))
            order = replace(order, value=number)
        ends = tile_ends(rows, tiles)
        cuts = rows_at_ranks(df, order, ends)
        tile = F.lit(tiles)
        for number, end in reversed(list(enumerate(ends, start=1))):
            if end > 0:
                tile = F.when(order.at_or_before(cuts[end]), F.lit(number)).otherwise(tile)
        out[name] = tile
    return df.withColumns(out).select(*columns, *out)


def table_percentiles(df: DataFrame, value: str, key: str, probabilities: list[float]) -> list[float | None]:
    """Exact interpolated percentiles of a whole column, as numbers."""
    df = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias(value), key)
    rows = df.count()
    if rows == 0:
        return [None] * len(probabilities)
    spots = [(rows - 1) * p for p in probabilities]
    ranks = [r for s in spots for r in (math.floor(s) + 1, math.ceil(s) + 1)]
    found = rows_at_ranks(df, Ordering(value, key), ranks)
    out = []
    for s in spots:
        low, high = found[math.floor(s) + 1][value], found[math.ceil(s) + 1][value]
        out.append(low + (high - low) * (s - math.floor(s)))
    return out


def group_percentiles(
    df: DataFrame, keys: list[str], value: str, named: dict[str, float], step: float = 1.0
) -> DataFrame:
    """Exact interpolated percentiles per group, safe for a group that holds most rows.

    Values are counted first (map-side combine), counts are summed per `step`-wide band, and
    only the bands that contain a wanted position are ranked value by value.
    """
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count("*").alias("_c"))
        .withColumn("_band", F.floor(F.col("_v") / step))
    )
    per_key = W.partitionBy(*keys)
    bands = (
        counted.groupBy(*keys, "_band")
        .agg(F.sum("_c").alias("_bc"))
        .withColumn("_n", F.sum("_bc").over(per_key))
        .withColumn("_before", F.sum("_bc").over(per_key.orderBy("_band")) - F.col("_bc"))
    )

    def spot(p: float) -> Column:
        return (F.col("_n") - 1) * F.lit(float(p))

    def covers(start: Column, size: Column, position: Column) -> Column:
        return (position >= start) & (position < start + size)

    edges = [f(spot(p)) for p in named.values() for f in (F.floor, F.ceil)]
    hit = covers(F.col("_before"), F.col("_bc"), edges[0])
    for e in edges[1:]:
        hit = hit | covers(F.col("_before"), F.col("_bc"), e)
    in_band = W.partitionBy(*keys, "_band").orderBy("_v")
    ranked = (
        counted.join(bands.where(hit), [*keys, "_band"])
        .withColumn("_start", F.col("_before") + F.sum("_c").over(in_band) - F.col("_c"))
    )
    aggs = [F.max("_n").alias("_n")]
    for name, p in named.items():
        for side, f in (("lo", F.floor), ("hi", F.ceil)):
            at = covers(F.col("_start"), F.col("_c"), f(spot(p)))
            aggs.append(F.max(F.when(at, F.col("_v"))).alias(f"_{side}_{name}"))
    out = ranked.groupBy(*keys).agg(*aggs)
    return out.select(
        *keys,
        *[
            (
                F.col(f"_lo_{name}")
                + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * (spot(p) - F.floor(spot(p)))
            ).alias(name)
            for name, p in named.items()
        ],
    )


def distinct_counts(df: DataFrame, key: str, columns: dict[str, str]) -> list[DataFrame]:
    """One (key, count) frame per column: the number of distinct values per key.

    Pairs are made unique under a shuffle on (key, value) before they are counted, so a hot key
    is spread by its values. Separate narrow aggregates move less than one aggregate over rows
    repeated for every distinct column, and the ones nobody reads drop out of the plan.
    """
    return [
        df.select(key, c).distinct().groupBy(key).agg(F.count(c).alias(out))
        for c, out in columns.items()
    ]


def latest_per_key(df: DataFrame, keys: list[str], *version: str) -> DataFrame:
    """Keep the newest row of each key. Ties fall back to the remaining columns."""
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*version, *[c for c in rest if c not in version])
    return df.groupBy(*keys).agg(F.max(order).alias("_r")).select(*[k for k in keys], "_r.*").select(*df.columns)


def top_per_group(df: DataFrame, keys: list[str], by: str, name: str) -> DataFrame:
    """The row with the largest `by` per group, ties by the smallest `name`."""
    best = df.groupBy(*keys, by).agg(F.min(name).alias(name))
    return best.groupBy(*keys).agg(
        F.max_by(name, by).alias(name), F.max(by).alias(by)
    )
