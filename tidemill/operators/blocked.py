"""Ordered operators that spread one long series over many tasks.

A window keyed by a series reads the whole series in one task. Here rows are range-partitioned by key and order, so a
series is cut into consecutive parts of about equal size whatever keys it has. Each part is summarised to one row per
key (a count, a sum, a last value), the summaries are combined in order, and what comes before a part is added to its
rows. Parts are kept in a written table, so every step sees the same ones, and a lost executor costs its own parts.

Rows of equal keys and order come in no set order, as in a window.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.session import materialize

PART, ROW = "_part", "_row"
CHUNK_ROWS = 4096


def dealt(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Rows in parts that follow one another in key and order, as a written table with the number of the part."""
    return materialize(df.repartitionByRange(*keys, *order).withColumn(PART, F.spark_partition_id()), "dealt")


def _within(keys: list[str], *order: str) -> WindowSpec:
    return W.partitionBy(*keys, PART).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)


def _earlier(keys: list[str]) -> WindowSpec:
    """All parts before this one: one row per key and part."""
    return W.partitionBy(*keys).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)


def _with_earlier(rows: DataFrame, keys: list[str], summary: DataFrame) -> DataFrame:
    """Rows with the summary columns of their key and part; null keys are keys like others."""
    both = F.struct(*[F.col(k) for k in [*keys, PART]])
    return rows.withColumn("_at", both).join(summary.select(both.alias("_at"), *[c for c in summary.columns if c not in [*keys, PART]]), "_at").drop("_at")


def running_sums(parts: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Dealt rows with the sum of each column from the first row of the key up to this one.

    Over whole numbers and decimals the sums are exact. Nulls add nothing; before the first value the sum is NULL.
    """
    totals = parts.groupBy(*keys, PART).agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()])
    before = totals.select(*keys, PART, *[F.sum(f"_sum_{n}").over(_earlier(keys)).alias(f"_before_{n}") for n in sums])
    local = parts.withColumns({n: F.sum(c).over(_within(keys, *order)) for n, c in sums.items()})
    found = _with_earlier(local, keys, before)
    added = {n: F.coalesce(F.col(n) + F.col(f"_before_{n}"), F.col(n), F.col(f"_before_{n}")) for n in sums}
    return found.withColumns(added).drop(*[f"_before_{n}" for n in sums])


def numbered_rows(parts: DataFrame, keys: list[str], order: list[str], counts: Column | None = None) -> DataFrame:
    """Dealt rows with the number of rows of their key up to this one in `_row`, or of those that count."""
    one = F.lit(1) if counts is None else F.when(counts, 1).otherwise(0)
    return running_sums(parts, keys, order, {ROW: one.cast("long")})


def sliding(
    df: DataFrame, keys: list[str], order: list[str], reach: int, made: Callable[[WindowSpec], dict[str, Column]]
) -> DataFrame:
    """Columns over windows that look back at most `reach` rows.

    `made` gets the ordered window and derives frames of `rowsBetween(-reach or later, 0)` or lags up to `reach` from it.
    Series are cut into chunks of rows; the last `reach` rows of a chunk are also given to the next one, where they stand
    before its own and are dropped after.
    """
    rows = numbered_rows(dealt(df, keys, *order), keys, order)
    size = max(CHUNK_ROWS, 4 * reach)
    place = F.col(ROW) - 1
    home = F.floor(place / size).cast("long")
    edge = place % size >= size - reach
    copies = F.when(edge, F.array(home, home + 1)).otherwise(F.array(home))
    spread = rows.withColumn("_home", home).withColumn("_chunk", F.explode(copies))
    window = W.partitionBy(*keys, "_chunk").orderBy(ROW)
    found = spread.withColumns(made(window)).where(F.col("_chunk") == F.col("_home"))
    return found.drop("_home", "_chunk", PART, ROW)


def streaks(df: DataFrame, keys: list[str], order: list[str], label: str, out: str = "streak") -> DataFrame:
    """Number the rows within each unbroken run of the same label, NULL being a label.

    A part is summarised by its first and last label and the row where its last run starts.
    """
    rows = materialize(numbered_rows(dealt(df, keys, *order), keys, order), "numbered")
    inside = W.partitionBy(*keys, PART).orderBy(ROW)
    last = F.max_by(F.struct(F.col(label).alias("v")), ROW).alias("_last")
    ends = rows.groupBy(*keys, PART).agg(last)
    previous = ends.select(*keys, PART, F.lag("_last").over(W.partitionBy(*keys).orderBy(PART)).alias("_previous"))
    rows = _with_earlier(rows, keys, previous)
    before = F.coalesce(F.lag(F.struct(F.col(label).alias("v"))).over(inside), F.col("_previous"))
    rows = rows.withColumn("_start", F.when(~before.eqNullSafe(F.struct(F.col(label).alias("v"))), F.col(ROW)))
    rows = materialize(rows, "starts")
    starts = rows.groupBy(*keys, PART).agg(F.max("_start").alias("_first"))
    carried = starts.select(*keys, PART, F.max("_first").over(_earlier(keys)).alias("_carried"))
    rows = _with_earlier(rows, keys, carried)
    start = F.coalesce(F.max("_start").over(inside.rowsBetween(W.unboundedPreceding, 0)), F.col("_carried"))
    return rows.withColumn(out, (F.col(ROW) - start + 1).cast("long")).drop(PART, ROW, "_start", "_previous", "_carried")


def asof_join(facts: DataFrame, known: DataFrame, keys: list[str], time: str, columns: list[str]) -> DataFrame:
    """Add to each fact the columns of the last known row of its key at or before its time, NULL where there is none.

    Both sides are put in one order, known rows first where times are equal, and the last known row is carried on, from
    part to part and within each. Of known rows of one time the greatest counts; null times are never known, and facts
    with null times find nothing.
    """
    own = facts.columns
    value = F.struct(*[F.col(c) for c in columns])
    newest = known.where(F.col(time).isNotNull()).groupBy(*keys, time).agg(F.max(value).alias("_known"))
    kind = newest.schema["_known"].dataType
    left = facts.select(*[F.col(k) for k in [*keys, time]], F.struct(*[F.col(c) for c in own]).alias("_fact"), F.lit(None).cast(kind).alias("_known"), F.lit(1).alias("_side"))
    right = newest.select(*keys, time, F.lit(None).cast(left.schema["_fact"].dataType).alias("_fact"), "_known", F.lit(0).alias("_side"))
    parts = dealt(left.unionByName(right), keys, time, "_side")
    known_at = F.when(F.col("_known").isNotNull(), F.col(time))
    ends = parts.groupBy(*keys, PART).agg(F.max_by("_known", known_at).alias("_end"))
    carried = ends.select(*keys, PART, F.last("_end", ignorenulls=True).over(_earlier(keys)).alias("_carried"))
    rows = _with_earlier(parts, keys, carried)
    rows = rows.withColumn("_found", F.coalesce(F.last("_known", ignorenulls=True).over(_within(keys, time, "_side")), F.col("_carried")))
    rows = rows.where(F.col("_side") == 1).withColumn("_found", F.when(F.col(time).isNotNull(), F.col("_found")))
    return rows.select("_fact.*", *[F.col(f"_found.{c}").alias(c) for c in columns])


def _span_chunk(keep: float) -> int:
    """Rows after which an average has forgotten all but 1e-30 of what was before."""
    return max(1, math.ceil(30 * math.log(10) / -math.log(keep))) if keep > 0 else 1


def ema(df: DataFrame, keys: list[str], order: str, value: str, spans: dict[str, int]) -> DataFrame:
    """Exponential moving averages, alpha = 2 / (span + 1), started at the first value.

    Each step is the map y -> (1 - alpha) y + alpha x. Chunks of rows are folded to one such map each, by sums of values
    weighted with powers of 1 - alpha; chunks are so long that a map keeps 1e-30 of its argument, so a row's average
    needs the chunk it is in and the two before. The rest is below a double's last digit by far. NULL values are skipped:
    they repeat the average so far.
    """
    counted = F.col(value).isNotNull()
    found = numbered_rows(dealt(df, keys, order), keys, [order], counted)
    for name, span in spans.items():
        alpha = 2.0 / (span + 1)
        keep = 1.0 - alpha
        size = _span_chunk(keep)
        place = (F.greatest(F.col(ROW), F.lit(1)) - 1) % size
        found = found.withColumn("_chunk", F.floor((F.greatest(F.col(ROW), F.lit(1)) - 1) / size).cast("long")).withColumn("_place", place)
        x = F.col(value).cast("double")
        share = F.when(F.col(ROW) == 1, 1.0).otherwise(alpha)  # the first value counts whole
        weighted = F.when(counted, share * x * F.pow(F.lit(keep), -F.col("_place").cast("double"))) if keep > 0 else F.when(counted, x)
        inside = W.partitionBy(*keys, "_chunk").orderBy(ROW, F.col(value).isNull(), order).rowsBetween(W.unboundedPreceding, 0)
        found = found.withColumn("_own", F.sum(weighted).over(inside) * (F.pow(F.lit(keep), F.col("_place").cast("double")) if keep > 0 else F.lit(1.0)))
        found = materialize(found, "folded")
        folded = found.where(counted).groupBy(*keys, "_chunk").agg(F.max_by("_own", "_place").alias("_end"))
        at = lambda back: F.struct(*[F.col(k) for k in keys], (F.col("_chunk") + back).alias("_chunk"))
        rows = found.withColumn("_at", at(0))
        for back in (1, 2):
            rows = rows.join(folded.select(at(back).alias("_at"), F.col("_end").alias(f"_end{back}")), "_at", "left")
        whole = keep**size
        carry = F.coalesce("_end1", F.lit(0.0)) + whole * F.coalesce("_end2", F.lit(0.0))
        late = F.pow(F.lit(keep), F.col("_place").cast("double") + 1) * carry if keep > 0 else F.lit(0.0)
        found = rows.withColumn(name, F.when(F.col(ROW) > 0, F.col("_own") + late)).drop("_at", "_own", "_end1", "_end2", "_chunk", "_place")
    return found.drop(PART, ROW)
