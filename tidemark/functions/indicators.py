"""Technical indicators as window expressions over one (series, time) spec.

Every indicator takes the same partition/order columns, so a DataFrame that
adds several of them is planned as one Exchange + one Sort + one Window
operator. Frames are row based: a partial frame at the start of a series
averages what exists, and NULL values still occupy a row of the frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.scalar import ColumnLike, as_col, safe_divide


def series_window(by: str | Sequence[str], order: str | Sequence[str]) -> WindowSpec:
    by = [by] if isinstance(by, str) else list(by)
    order = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*by).orderBy(*order)


def _frame(by, order, n: int) -> WindowSpec:
    if n < 1:
        raise ValueError("window length must be >= 1")
    return series_window(by, order).rowsBetween(-(n - 1), Window.currentRow)


def moving_average(col: ColumnLike, by, order, n: int) -> Column:
    """Trailing simple moving average over the last ``n`` rows (inclusive)."""
    return F.avg(as_col(col)).over(_frame(by, order, n))


def rsi(change: ColumnLike, by, order, periods: int = 14) -> Column:
    """Relative strength index from a per-row change column.

    Gains and losses are simple trailing averages in which a NULL or
    non-positive change counts as 0, so the first (NULL) change of a series is
    a zero. No losses in the frame -> NULL; no gains -> 0.
    """
    ch = as_col(change)
    w = _frame(by, order, periods)
    avg_gain = F.avg(F.when(ch > 0, ch).otherwise(F.lit(0))).over(w)
    avg_loss = F.avg(F.when(ch < 0, F.abs(ch)).otherwise(F.lit(0))).over(w)
    return F.lit(100) - F.lit(100) / (F.lit(1) + safe_divide(avg_gain, avg_loss))


def bollinger(col: ColumnLike, by, order, window: int = 20, num_std: float = 2,
              bound: str | None = None):
    """Bollinger bands: middle = MA(window), upper/lower = middle +/- k * sample sd.

    With ``bound=None`` returns ``(middle, upper, lower)``; otherwise the named
    line, where any name other than 'middle' or 'lower' means 'upper'. A
    one-row frame has a NULL sample deviation, hence NULL bands.
    """
    w = _frame(by, order, window)
    middle = F.avg(as_col(col)).over(w)
    sd = F.stddev_samp(as_col(col)).over(w)
    upper = middle + F.lit(num_std) * sd
    lower = middle - F.lit(num_std) * sd
    if bound is None:
        return middle, upper, lower
    return {"middle": middle, "lower": lower}.get(bound, upper)
