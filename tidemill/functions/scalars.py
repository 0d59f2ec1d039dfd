"""Small column helpers shared by the plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill import fixed_values as fv


def ratio(top: Column, bottom: Column) -> Column:
    """Double division; NULL when the divisor is zero or missing."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def safe_divide(top: Column, bottom: Column, default: float = 0.0) -> Column:
    """Double division with a default where the divisor is zero or NULL."""
    return F.when(bottom.isNull() | (bottom == 0), F.lit(float(default))).otherwise(ratio(top, bottom))


def pct_change(new: Column, old: Column) -> Column:
    """Change in percent; NULL unless the old value is positive."""
    return F.when(old > 0, ratio(new - old, old) * 100)


def mean(c: Column) -> Column:
    """Average as exact sum over count, in double."""
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def last_known(value: str, by: str) -> Column:
    """Aggregate: the value on the latest date that has one."""
    return F.max_by(value, F.when(F.col(value).isNotNull(), F.col(by)))


def first_known(value: str, by: str) -> Column:
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.col(by)))


def time_key(moment: str, tie: str) -> Column:
    """A time and a whole number, by which ties are told apart, as one number of the same order; nulls come first.

    A number of fixed width can be the state of a hash aggregate, so `min_by` and `max_by` over it reduce raw rows where
    they lie; over a struct they sort them all first.
    """
    wide = "decimal(38,0)"
    micros = F.coalesce(F.unix_micros(F.col(moment).cast("timestamp")), F.lit(-(10**17)))  # before the year 1
    place = F.coalesce(F.col(tie).cast("long").cast(wide) + F.expr("9223372036854775809BD"), F.lit(0).cast(wide))
    return (micros.cast(wide) * F.expr("100000000000000000000BD") + place).cast(wide)


def days_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(86_400e6)


def hours_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3_600e6)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def zip_code(c: Column) -> Column:
    return F.lpad(c.cast("string"), 5, "0")


def title_case(c: Column, after_punctuation: bool = False) -> Column:
    """Capitalize each word; optionally also after any non-alphanumeric character."""
    if not after_punctuation:
        return F.initcap(c)
    pieces = F.split(F.lower(c), r"(?<=[^\p{L}\p{N}])")
    upper_first = F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p))))
    return F.array_join(upper_first, "")


def surrogate_key(*columns: Column) -> Column:
    """MD5 over the text forms joined by '|', NULL as empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def cents_to_units(c: Column, precision: int = 2) -> Column:
    return F.round(c.cast("decimal(30,2)") / 100, precision)


def parse_any_date(c: Column, extra_format: str | None = None) -> Column:
    """First format that fits the whole text; NULL when none does."""
    formats = ([extra_format] if extra_format else []) + fv.DATE_FORMATS
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def epoch_to_timestamp(c: Column) -> Column:
    """Seconds or milliseconds since 1970, told apart by size."""
    seconds = F.when(c > F.lit(1e12), c.cast("double") / 1000).otherwise(c.cast("double"))
    return F.timestamp_micros(F.round(seconds * 1e6).cast("bigint"))


def timestamp_to_epoch(c: Column, milliseconds: bool = False) -> Column:
    return F.unix_millis(c) if milliseconds else F.unix_seconds(c)


def satoshi_to_btc(c: Column) -> Column:
    return c.cast("double") / F.lit(1e8)


def decimal_or_null(c: Column, precision: int = 38, scale: int = 10) -> Column:
    """Decimal from text; NULL for '.', blanks and anything unparsable."""
    return c.try_cast(T.DecimalType(precision, scale))


def month_key(c: Column) -> Column:
    return F.date_format(c, "yyyyMM")


def has_fields(*names: str) -> Column:
    """True when every named column holds a value."""
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def nested_get(path: str, default) -> Column:
    return F.coalesce(F.col(path), F.lit(default))


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested structs to flat columns named parent_child."""

    def leaves(fields, path, name):
        for f in fields:
            full = f"{name}{sep}{f.name}" if name else f.name
            here = [*path, f.name]
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType.fields, here, full)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(full)

    return df.select(*leaves(df.schema.fields, [], ""))


def date_spine(spark: SparkSession, start: str, end: str, part: str = "day") -> DataFrame:
    """One row per period between two literal dates, both included."""
    bounds = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr(f"interval 1 {part}"))).alias("d")
    )
    return bounds.select(F.to_date(F.date_trunc(part, "d")).alias(f"date_{part}"))
