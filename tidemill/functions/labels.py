"""Turning ordered lists of bounds and rules into label columns.

The thresholds and label names in the rule lists below are fixed values: results must agree on them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill import fixed_values as fv


def first_match(rules: list[tuple[Column, str]], otherwise: str | None) -> Column:
    """Label of the first rule that holds; a rule over NULL does not hold."""
    (condition, label), *rest = rules
    out = F.when(condition, F.lit(label))
    for condition, label in rest:
        out = out.when(condition, F.lit(label))
    return out if otherwise is None else out.otherwise(F.lit(otherwise))


def upper_bound_label(value: Column, bounds: list[tuple[float | None, str]]) -> Column:
    """Label by ascending inclusive upper bounds; the entry with bound None takes the rest."""
    finite = [(value <= bound, label) for bound, label in bounds if bound is not None]
    rest = next((label for bound, label in bounds if bound is None), None)
    return F.when(value.isNull(), F.lit(None)).otherwise(first_match(finite, rest))


def member_label(value: Column, groups: dict[str, list[str]], otherwise: str) -> Column:
    """Name of the group that lists the value."""
    return first_match([(value.isin(members), name) for name, members in groups.items()], otherwise)


def prefix_label(value: Column, prefixes: dict[str, str], otherwise: str) -> Column:
    return first_match([(value.startswith(p), name) for name, p in prefixes.items()], otherwise)


def score_segment(r: Column, f: Column, m: Column, segments, otherwise: str) -> Column:
    """First segment whose three score ranges all hold."""
    return first_match(
        [
            (r.between(*rr) & f.between(*ff) & m.between(*mm), name)
            for name, rr, ff, mm in segments
        ],
        otherwise,
    )


def state_region(state: Column) -> Column:
    return member_label(state, fv.REGION_STATES, fv.UNKNOWN_REGION)


def sentiment_class(value: Column) -> Column:
    return upper_bound_label(value, fv.SENTIMENT_CLASSES)


def sentiment_signal(value: Column) -> Column:
    return upper_bound_label(value, fv.SENTIMENT_SIGNALS)


def sentiment_score(value: Column) -> Column:
    """Map 0..100 to -1..1."""
    return (value - 50) / F.lit(50.0)


# --- daily market signals ---------------------------------------------------------------


def trend_signal(close: Column, short: Column, long: Column) -> Column:
    return first_match(
        [((close > short) & (short > long), "bullish"), ((close < short) & (short < long), "bearish")],
        "neutral",
    )


def volume_signal(volume: Column, usual: Column) -> Column:
    return first_match(
        [(volume > usual * 1.5, "high_volume"), (volume < usual * 0.5, "low_volume")], "normal_volume"
    )


def volatility_signal(pct: Column) -> Column:
    return first_match([(pct > 5, "high_volatility"), (pct < 2, "low_volatility")], "normal_volatility")


# --- macro regimes ----------------------------------------------------------------------


def economic_regime(growth: Column, inflation: Column) -> Column:
    return first_match(
        [
            ((growth > 3) & (inflation < 3), "goldilocks"),
            ((growth > 2) & (inflation > 4), "overheating"),
            ((growth < 0) & (inflation > 3), "stagflation"),
            ((growth < 0) & (inflation < 2), "recession"),
            ((growth > 0) & (inflation < 2), "recovery"),
        ],
        "transition",
    )


def policy_stance(real_rate: Column) -> Column:
    return first_match([(real_rate > 2, "tight"), (real_rate > 0, "neutral"), (real_rate < -2, "very_loose")], "loose")


def labor_health(rate: Column) -> Column:
    bounds = [(4, "very_strong"), (5, "strong"), (6, "moderate"), (8, "weak")]
    return first_match([(rate < bound, label) for bound, label in bounds], "very_weak")


def change_label(change: Column, limit: float, up: str, down: str, flat: str) -> Column:
    return first_match([(change > limit, up), (change < -limit, down)], flat)


def inflation_regime(inflation: Column, rising: Column) -> Column:
    """high above 4 percent; above 2, disinflation where it falls and moderate where not; low else; NULL if unknown."""
    above = first_match([(inflation > 4, "high"), ((inflation > 2) & ~rising, "disinflation"), (inflation > 2, "moderate")], "low")
    return F.when(inflation.isNotNull(), above)


def growth_trend(growth: Column, before: Column) -> Column:
    """Growth against the figure before; NULL if either is unknown."""
    moved = first_match([(growth > before, "accelerating"), (growth < before, "decelerating")], "stable")
    return F.when(growth.isNotNull() & before.isNotNull(), moved)


def volatility_regime(rank: Column) -> Column:
    """Thirds of the percent rank of volatility within its year; NULL if unknown."""
    return F.when(rank.isNotNull(), first_match([(rank > 66.7, "high"), (rank < 33.3, "low")], "normal"))


def inflation_asset_relation(inflation: Column, change: Column) -> Column:
    up, down = change > 0, change < 0
    return first_match(
        [
            ((inflation > 3) & up, "positive_inflation_btc_up"),
            ((inflation > 3) & down, "positive_inflation_btc_down"),
            ((inflation < 2) & up, "low_inflation_btc_up"),
            ((inflation < 2) & down, "low_inflation_btc_down"),
        ],
        "neutral",
    )


def rate_environment(rate: Column) -> Column:
    return first_match([(rate > 4, "high_rates"), (rate > 2, "moderate_rates")], "low_rates")


def money_regime(growth: Column) -> Column:
    return first_match(
        [
            (growth > 10, "high_money_growth"),
            (growth > 5, "moderate_money_growth"),
            (growth < 0, "money_contraction"),
        ],
        "stable_money_growth",
    )


def hedge_status(inflation: Column, change: Column) -> Column:
    return first_match(
        [
            ((inflation > 3) & (change > 0), "btc_inflation_hedge_working"),
            ((inflation > 3) & (change < 0), "btc_inflation_hedge_failing"),
        ],
        "neutral_inflation_environment",
    )


def rate_impact(rate: Column, change: Column) -> Column:
    return first_match(
        [
            ((rate > 4) & (change < 0), "rate_pressure_negative"),
            ((rate < 2) & (change > 0), "rate_environment_positive"),
        ],
        "neutral_rate_impact",
    )


def money_impact(growth: Column, change: Column) -> Column:
    return first_match(
        [
            ((growth > 10) & (change > 0), "money_printing_bullish"),
            ((growth < 0) & (change < 0), "money_contraction_bearish"),
        ],
        "neutral_money_supply",
    )


def risk_level(regime: Column, volatility: Column) -> Column:
    return first_match(
        [
            ((regime == "recession") & (volatility > 5), "high_risk"),
            ((regime == "goldilocks") & (volatility < 3), "low_risk"),
        ],
        "moderate_risk",
    )


def fed_stance(rate: Column) -> Column:
    return first_match([(rate > 4.5, "hawkish"), (rate > 2.0, "neutral")], "dovish")


def risk_appetite(sentiment: Column) -> Column:
    return first_match([(sentiment >= 60, "risk-on"), (sentiment <= 40, "risk-off")], "neutral")


def crypto_phase(sentiment: Column) -> Column:
    bounds = [(70, "euphoria"), (50, "optimism"), (30, "anxiety")]
    return first_match([(sentiment >= bound, label) for bound, label in bounds], "panic")
