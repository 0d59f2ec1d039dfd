"""Operators over dated series.

Windows without a key, or keyed by an asset, run over one row per calendar day (or hour):
callers aggregate to that grain first, so a window holds days, never raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions.scalars import mean, ratio
from tidemill.operators.blocked import ema as ema  # spread over tasks; named here with its kin


def dated(order: str, *keys: str) -> WindowSpec:
    return W.partitionBy(*keys).orderBy(order) if keys else W.orderBy(order)


def last_rows(n: int, order: str, *keys: str) -> WindowSpec:
    """Frame of the current row and the n - 1 rows before it."""
    return dated(order, *keys).rowsBetween(-(n - 1), 0)


def moving_avg(c: Column, n: int, order: str, *keys: str) -> Column:
    return F.avg(c.cast("double")).over(last_rows(n, order, *keys))


def full_moving_avg(c: Column, n: int, order: str, *keys: str) -> Column:
    """Moving average that is NULL until n rows exist."""
    frame = last_rows(n, order, *keys)
    return F.when(F.count(c).over(frame) == n, F.avg(c.cast("double")).over(frame))


def safe_corr(x: Column, y: Column, frame: WindowSpec | None = None) -> Column:
    """Pearson correlation; NULL where a side does not vary or fewer than two pairs exist."""
    x, y = x.cast("double"), y.cast("double")
    px, py = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    parts = [F.covar_pop(px, py), F.stddev_pop(px), F.stddev_pop(py)]
    if frame is not None:
        parts = [p.over(frame) for p in parts]
    cov, sx, sy = parts
    return F.try_divide(cov, F.when((sx > 1e-12) & (sy > 1e-12), sx * sy))


def fill_calendar(df: DataFrame, date: str, value: str, keys: list[str], direction: str) -> DataFrame:
    """Spread each dated value over the calendar days it answers for.

    direction="back": day d gets the value of the first row on or after d ("next known").
    direction="forward": day d gets the value of the last row on or before d ("last known").
    The result has one row per key and day, so lookups become equality joins.
    """
    w = dated(date, *keys)
    if direction == "back":
        low = F.coalesce(F.date_add(F.lag(date).over(w), 1), F.col(date))
        days = F.sequence(low, F.col(date))
    else:
        high = F.coalesce(F.date_sub(F.lead(date).over(w), 1), F.col(date))
        days = F.sequence(F.col(date), high)
    return df.select(*keys, F.col(date), F.col(value), days.alias("_days")).select(
        *keys, F.explode("_days").alias("day"), F.col(date).alias("source_date"), F.col(value)
    )


def asof_last_known(facts: DataFrame, known: DataFrame, date: str, columns: list[str]) -> DataFrame:
    """Add to each dated fact the last non-NULL value of each column on or before that date.

    `known` has one row per date. The two date lists are merged first, so the window holds
    calendar days; facts then join by equality.
    """
    days = facts.select(date).distinct().select(date, *[F.lit(None).cast(known.schema[c].dataType).alias(c) for c in columns])
    merged = (
        known.select(date, *columns)
        .unionByName(days)
        .groupBy(date)
        .agg(*[F.max(c).alias(c) for c in columns])
    )
    frame = W.orderBy(date).rowsBetween(W.unboundedPreceding, 0)
    filled = merged.select(date, *[F.last(c, ignorenulls=True).over(frame).alias(c) for c in columns])
    return facts.join(filled, date, "left")


def streaks(df: DataFrame, order: str, label: str, out: str = "streak", keys: list[str] | None = None) -> DataFrame:
    """Number the rows within each unbroken run of the same label."""
    keys = keys or []
    w = dated(order, *keys)
    changed = (~F.col(label).eqNullSafe(F.lag(label).over(w))).cast("int")
    run = df.withColumn("_changed", changed).withColumn("_run", F.sum("_changed").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return run.withColumn(out, F.row_number().over(dated(order, *keys, "_run"))).drop("_changed")


# --- unit transforms and resampling of long series ----------------------------------------


def series_transform(df: DataFrame, units: str, periods_per_year: int = 12, keys=("series_id",), date="date") -> DataFrame:
    """Replace `value` by one of the unit transforms lin chg ch1 pch pc1 pca cch cca log."""
    w = dated(date, *keys)
    v = F.col("value").cast("double")
    prev, year = F.lag(v, 1).over(w), F.lag(v, periods_per_year).over(w)

    def log(c: Column) -> Column:
        return F.ln(F.when(c > 0, c))

    made = {
        "lin": v,
        "chg": v - prev,
        "ch1": v - year,
        "pch": (ratio(v, prev) - 1) * 100,
        "pc1": (ratio(v, year) - 1) * 100,
        "pca": (F.pow(F.when(ratio(v, prev) > 0, ratio(v, prev)), F.lit(float(periods_per_year))) - 1) * 100,
        "cch": (log(v) - log(prev)) * 100,
        "cca": (log(v) - log(prev)) * 100 * periods_per_year,
        "log": log(v),
    }
    return df.withColumn("value", made[units])


def period_start(date: Column, frequency: str) -> Column:
    """First day of the period a date falls in: d w bw m q sa a."""
    if frequency == "d":
        return F.to_date(date)
    if frequency == "bw":
        week = F.to_date(F.date_trunc("week", date))
        odd = F.pmod(F.floor(F.datediff(week, F.lit("1970-01-05").cast("date")) / 7), F.lit(2))
        return F.date_sub(week, (odd * 7).cast("int"))
    if frequency == "sa":
        return F.make_date(F.year(date), F.when(F.month(date) <= 6, 1).otherwise(7), F.lit(1))
    unit = {"w": "week", "m": "month", "q": "quarter", "a": "year"}[frequency]
    return F.to_date(F.date_trunc(unit, date))


def series_resample(df: DataFrame, frequency: str, method: str = "avg", keys=("series_id",), date="date") -> DataFrame:
    """Aggregate each series to a lower frequency by avg, sum or end-of-period value.

    Sums are taken over decimals of eight digits, so they do not depend on the order of the rows.
    """
    v = F.col("value").cast("double")
    exact = F.col("value").cast("decimal(28,8)")
    made = {
        "avg": mean(exact),
        "sum": F.sum(exact).cast("double"),
        "eop": F.max_by(v, F.when(v.isNotNull(), F.col(date))),
    }[method]
    return df.groupBy(*keys, period_start(F.col(date), frequency).alias("period")).agg(made.alias("value"))

