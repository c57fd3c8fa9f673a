"""Scalar column functions: guarded arithmetic, vendor-value cleaning, labels.

All are plain Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num: ColumnLike, den: ColumnLike) -> Column:
    """``num / den`` that is NULL (not an ANSI error) when ``den`` is zero.

    Callers that scale a ratio multiply the numerator first
    (``safe_divide(100 * a, b)``); with decimals the order changes the result.
    """
    return as_col(num) / F.nullif(as_col(den), F.lit(0))


def sentinel_to_null(c: ColumnLike, sentinels=(".", "")) -> Column:
    """Vendor string value -> double; the missing-value sentinels become NULL.

    The guard runs before the cast so the sentinel never reaches the strict
    ANSI cast; any other non-numeric text still fails the job.
    """
    c = as_col(c)
    return F.when(c.isNull() | c.isin(*sentinels), F.lit(None).cast("double")).otherwise(
        c.cast("double"))


def nan_to_null(c: ColumnLike) -> Column:
    """Non-numeric text or NaN -> NULL, otherwise the double value."""
    x = as_col(c).try_cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def trunc_int(c: ColumnLike) -> Column:
    """NULL-safe float -> integer, truncating toward zero (2.7 -> 2, -2.7 -> -2)."""
    return as_col(c).cast("bigint")


def epoch_to_date(c: ColumnLike) -> Column:
    """Epoch seconds -> UTC calendar date, independent of the session zone."""
    return F.date_from_unix_date(F.floor(as_col(c) / F.lit(86400)).cast("int"))


def epoch_ms_to_date(c: ColumnLike) -> Column:
    """Epoch milliseconds -> UTC calendar date."""
    return F.date_from_unix_date(F.floor(as_col(c) / F.lit(86_400_000)).cast("int"))


# Period codes and their day counts; unknown codes give 30.
PERIOD_DAYS = {"1W": 7, "1M": 30, "3M": 90, "6M": 180, "1Y": 365, "YTD": 365}
DEFAULT_PERIOD_DAYS = 30


def period_days(c: ColumnLike) -> Column:
    """Period code column -> number of days (case-insensitive)."""
    m = F.create_map(*[x for k, v in PERIOD_DAYS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, F.upper(as_col(c))), F.lit(DEFAULT_PERIOD_DAYS))


def period_days_value(period: str) -> int:
    """Driver-side twin of ``period_days`` for report parameters."""
    return PERIOD_DAYS.get(period.upper(), DEFAULT_PERIOD_DAYS)


def corr_interpretation(c: ColumnLike) -> Column:
    """Plain-language reading of a correlation coefficient.

    |r| >= 0.6 strong, >= 0.3 moderate, else weak; r > 0 positive, else
    negative; NULL -> 'insufficient overlapping data to compute'.
    """
    c = as_col(c)
    a = F.abs(c)
    mag = F.when(a >= 0.6, "strong").when(a >= 0.3, "moderate").otherwise("weak")
    direction = F.when(c > 0, "positive").otherwise("negative")
    return F.when(c.isNull(), F.lit("insufficient overlapping data to compute")).otherwise(
        F.concat(mag, F.lit(" "), direction, F.lit(" correlation")))


def rate_regime(current: ColumnLike, previous: ColumnLike) -> Column:
    """Hiking / Cutting / Holding; a NULL comparison falls through to Holding."""
    cur, prev = as_col(current), as_col(previous)
    return F.when(cur > prev, "Hiking").when(cur < prev, "Cutting").otherwise("Holding")


def vol_regime(vix: ColumnLike, threshold: float = 20) -> Column:
    """'High Vol' when vix >= threshold, else 'Low Vol' (NULL included)."""
    return F.when(as_col(vix) >= threshold, "High Vol").otherwise("Low Vol")


# 0-100 sentiment bands (lower edge inclusive).
SCORE_BANDS = [(25, "Extreme Fear"), (45, "Fear"), (55, "Neutral"), (75, "Greed")]
TOP_BAND = "Extreme Greed"


def score_band(c: ColumnLike) -> Column:
    """0-100 score -> band label on half-open intervals; NULL stays NULL."""
    c = as_col(c)
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for upper, label in SCORE_BANDS:
        expr = expr.when(c < upper, label)
    return expr.otherwise(TOP_BAND)


def inversion_label(spread: ColumnLike) -> Column:
    """'Inverted' when the spread is negative, else 'Normal' (NULL included)."""
    return F.when(as_col(spread) < 0, "Inverted").otherwise("Normal")
