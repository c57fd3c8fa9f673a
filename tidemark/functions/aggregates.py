"""Aggregate expressions that need care under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalar import ColumnLike, as_col


def pair_count(a: ColumnLike, b: ColumnLike, over=None) -> Column:
    """Number of rows where both inputs are non-NULL (optionally over a window)."""
    c = F.count_if(as_col(a).isNotNull() & as_col(b).isNotNull())
    return c.over(over) if over is not None else c


def pair_corr(a: ColumnLike, b: ColumnLike, min_obs: int = 3, over=None) -> Column:
    """Pearson correlation over pairwise-complete rows.

    NULL when fewer than ``min_obs`` complete pairs exist or either side is
    constant. Built from population moments instead of ``corr`` because
    ``corr`` raises DIVIDE_BY_ZERO on a constant input under ANSI mode. It is
    an ordinary declarative aggregate, so it gets partial (map-side)
    aggregation like any sum. With ``over`` every part is evaluated over that
    window (rolling correlation).
    """
    a, b = as_col(a), as_col(b)
    a2 = F.when(b.isNotNull(), a)
    b2 = F.when(a.isNotNull(), b)

    def w(c: Column) -> Column:
        return c.over(over) if over is not None else c

    den = F.nullif(w(F.stddev_pop(a2)) * w(F.stddev_pop(b2)), F.lit(0.0))
    return F.when(pair_count(a, b, over) >= min_obs, w(F.covar_pop(a2, b2)) / den)
