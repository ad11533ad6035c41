"""Column expressions: ratios, clamps, calendar fields, bins, labels. All stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parsed_date(c: Column | str) -> Column:
    """Date, or NULL when the text is not a date."""
    return F.col(c).try_cast("date") if isinstance(c, str) else c.try_cast("date")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double ratio; NULL on a zero or missing denominator."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def per_million(numerator: Column | str, denominator: Column | str) -> Column:
    return ratio(numerator, denominator) * F.lit(1_000_000.0)


def zero_to_null(c: Column | str) -> Column:
    return F.when(col(c) != 0, col(c))


def finite_or_null(c: Column | str) -> Column:
    """NaN and both infinities become NULL, the library's only missing marker."""
    x = col(c).cast("double")
    inf = F.lit(float("inf"))
    return F.when(~F.isnan(x) & (x != inf) & (x != -inf), x)


def clamp(c: Column | str, low=None, high=None) -> Column:
    """Clip that keeps missing values missing (``least``/``greatest`` would not)."""
    x = col(c)
    out = None
    if low is not None:
        out = F.when(x < low, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        top = high if isinstance(high, Column) else F.lit(high)
        out = F.when(x > high, top) if out is None else out.when(x > high, top)
    return x if out is None else out.otherwise(x)


def unit_interval(c: Column | str) -> Column:
    return clamp(col(c).cast("double"), 0.0, 1.0)


def capped_ratio(c: Column | str, cap: float | None, neutral: float | None = 0.5) -> Column | None:
    """``c / cap`` clipped to [0, 1]; the neutral constant when the cap is unusable (None: no factor)."""
    if cap is None or not cap > 0:
        return None if neutral is None else F.lit(neutral)
    return unit_interval(col(c).cast("double") / F.lit(float(cap)))


def mean_of(*factors: Column) -> Column:
    """Plain mean of the factors; one missing factor makes the mean missing."""
    total = factors[0]
    for factor in factors[1:]:
        total = total + factor
    return total / F.lit(float(len(factors)))


def right_closed_bins(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin ``(edges[i], edges[i+1]]``; the lowest edge belongs to the first bin; outside: NULL."""
    x = col(c)
    out = F.when(x < edges[0], F.lit(None))
    for upper, label in zip(edges[1:], labels):
        out = out.when(x <= upper, F.lit(label))
    return out


def calendar_fields(date: Column | str) -> dict[str, Column]:
    """Monday-based weekday, month, quarter and a weekend flag."""
    d = col(date)
    return {
        "day_of_week": F.weekday(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
    }


def null_severity(percent: Column | str) -> Column:
    p = col(percent)
    return F.when(p > 70, "critical").when(p > 50, "high").when(p > 30, "medium").otherwise("low")


def missing_band(percent: Column | str) -> Column:
    p = col(percent)
    return F.when(p < 1, "excellent").when(p < 5, "good").when(p < 10, "acceptable").otherwise("review")


def quality_score(null_percent: Column | str, duplicate_percent: Column | str) -> Column:
    """100 less the penalties for missing cells and repeated rows."""
    n, d = col(null_percent), col(duplicate_percent)
    null_penalty = F.when(n > 10, 30).when(n > 5, 15).when(n > 1, 5).otherwise(0)
    duplicate_penalty = F.when(d > 5, 20).when(d > 1, 10).otherwise(0)
    return F.lit(100) - null_penalty - duplicate_penalty


def quality_status(score: Column | str) -> Column:
    s = col(score)
    return F.when(s >= 90, "excellent").when(s >= 75, "good").when(s >= 60, "acceptable").otherwise("needs work")


def imbalance_band(r: Column | str) -> Column:
    x = col(r)
    return F.when(x < 2, "balanced").when(x < 3, "moderate").otherwise("high")


def agreement_text(ari: Column | str, nmi: Column | str) -> Column:
    a, n = col(ari), col(nmi)
    return (
        F.when((a > 0.7) & (n > 0.7), "strong").when((a > 0.4) & (n > 0.4), "moderate").otherwise("low")
    )


def mean_plus_minus(mean: Column | str, std: Column | str, spaced: bool = False) -> Column:
    return F.format_string("%.4f ± %.4f" if spaced else "%.4f±%.4f", col(mean), col(std))


def four_decimals(c: Column | str) -> Column:
    return F.format_string("%.4f", col(c))


def tradeoff_zone(accuracy: Column | str, seconds: Column | str) -> Column:
    """High accuracy and fast, high accuracy but slow, or not accurate enough."""
    a, s = col(accuracy), col(seconds)
    return (
        F.when((a > 0.99) & (s < 300), "ideal")
        .when((a > 0.99) & (s >= 300), "acceptable")
        .when(a < 0.99, "problematic")
    )


def accuracy_band(accuracy: Column | str) -> Column:
    a = col(accuracy)
    return F.when(a > 0.995, "excellent").when(a > 0.99, "very good").when(a > 0.95, "good").otherwise("insufficient")


def speed_band(seconds: Column | str) -> Column:
    s = col(seconds)
    return F.when(s < 60, "very fast").when(s < 300, "fast").when(s < 1800, "slow").otherwise("very slow")
