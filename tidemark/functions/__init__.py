"""Column-level building blocks (scalar, window and aggregate expressions)."""

from tidemark.functions.scalar import (  # noqa: F401
    corr_interpretation, epoch_ms_to_date, epoch_to_date, inversion_label,
    nan_to_null, period_days, rate_regime, safe_divide, score_band,
    sentinel_to_null, trunc_int, vol_regime, as_col,
)
from tidemark.functions.indicators import (  # noqa: F401
    bollinger, moving_average, rsi, series_window,
)
from tidemark.functions.aggregates import pair_corr, pair_count  # noqa: F401
