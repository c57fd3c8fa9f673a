"""Window operators: latest-row dedup, lags and returns, technicals, shares.

Partitioned windows shuffle once on the series key and sort inside each
partition; several window columns over the same spec share that one
Exchange + Sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.indicators import bollinger, moving_average, rsi, series_window
from tidemark.functions.scalar import safe_divide
from tidemark.operators.frames import frame_technicals


def _cols(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def dedup_latest(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (latest-load-wins).

    ``order`` must be explicit about direction and NULL placement. Spark plans
    ``row_number() = 1`` with a partial WindowGroupLimit before the shuffle,
    so each map task ships at most one row per key: a key holding a third of
    all rows costs no more shuffle than any other key.
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


def latest_per_key(df: DataFrame, keys, date_col: str) -> DataFrame:
    """Newest row per key by ``date_col`` (a NULL date sorts first, so it wins)."""
    return dedup_latest(df, keys, [F.col(date_col).desc_nulls_first()])


def with_returns(df: DataFrame, value: str, by, order, prev: str = "prev_value",
                 change: str = "daily_change", ret: str = "daily_return") -> DataFrame:
    """Add previous value, change and return along each series.

    'Previous' is the previous row of the series, not the previous calendar
    day. The first row of a series has NULL change and return; a zero
    previous value gives a NULL return.
    """
    w = series_window(by, order)
    prev_c = F.lag(F.col(value)).over(w)
    out = df.withColumn(prev, prev_c).withColumn(change, F.col(value) - F.col(prev))
    return out.withColumn(ret, safe_divide(F.col(change), F.col(prev)))


def prefix_moving_averages(df: DataFrame, value: str, by, order, windows: Sequence[int],
                           names: Sequence[str] | None = None) -> DataFrame:
    """Trailing n-row means from running sums: O(1) per row for any n.

    ``mean_n = (S_i - S_{i-n}) / (C_i - C_{i-n})`` with ``S`` the running sum
    and ``C`` the running count of non-NULL values, so NULLs are skipped but
    occupy their row of the frame, exactly like ``avg`` over
    ``rowsBetween(-(n-1), 0)``. Sums are exact decimals (no cancellation on
    long series); the mean is returned as double. A sliding frame recomputes
    all n rows per output row instead.
    """
    names = list(names or [f"ma_{n}" for n in windows])
    w = series_window(by, order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    exact = F.col(value).cast("decimal(38,12)")
    base = df.select("*", F.sum(exact).over(run).alias("_cs"), F.count(F.col(value)).over(run).alias("_cn"))
    cols = []
    for n, name in zip(windows, names):
        s = F.col("_cs") - F.coalesce(F.lag("_cs", n).over(w), F.lit(0))
        c = F.col("_cn") - F.coalesce(F.lag("_cn", n).over(w), F.lit(0))
        cols.append((s / F.nullif(c, F.lit(0))).cast("double").alias(name))
    return base.select("*", *cols).drop("_cs", "_cn")


def with_technicals(df: DataFrame, value: str = "close_price", by="ticker",
                    order="price_date", ma_windows: Sequence[int] = (20, 50, 200),
                    rsi_periods: int = 14, bb_window: int = 20, bb_std: float = 2,
                    ma_method: str = "frame", clustered: bool = False) -> DataFrame:
    """Daily change/return, moving averages, RSI and Bollinger bands per series.

    All columns use the same (by, order) spec: one shuffle, one sort.
    ``ma_method="frame"`` computes each moving average as ``avg`` over its
    row frame (bit-identical to a SQL engine's frame average);
    ``"prefix"`` uses exact running sums, O(1) per row, for very long windows;
    ``"arrow"`` computes all columns from Arrow batches of the sorted series, with
    the same bits as ``"frame"`` in far less time, for consumers of all columns
    (filters and unused columns do not pass it; ``value`` is a double), without an
    exchange where the series are ``clustered``: each one's rows in one task.
    """
    if ma_method == "arrow":
        return frame_technicals(df, value, _cols(by), _cols(order), ma_windows, rsi_periods, bb_window, bb_std, clustered)
    out = with_returns(df, value, by, order, prev="_prev", change="daily_change",
                       ret="daily_return").drop("_prev")
    if ma_method == "prefix":
        out = prefix_moving_averages(out, value, by, order, ma_windows)
        cols = []
    else:
        cols = [moving_average(value, by, order, n).alias(f"ma_{n}") for n in ma_windows]
    middle, upper, lower = bollinger(value, by, order, bb_window, bb_std)
    cols += [rsi("daily_change", by, order, rsi_periods).alias(f"rsi_{rsi_periods}"),
             middle.alias("bb_middle"), upper.alias("bb_upper"), lower.alias("bb_lower")]
    return out.select("*", *cols)


def global_row_index(df: DataFrame, order: str, bucket: Column | None = None,
                     index: str = "_row_idx") -> DataFrame:
    """Dense 0-based position of each row in the global ``order``.

    Done without a single-partition window: rows are numbered inside coarse
    buckets of the order key (default: its year), bucket sizes are counted,
    and a prefix sum over the (small) bucket table gives each bucket's offset.
    Deterministic, so a recomputed partition gets the same numbers.
    ``order`` must be unique, as on a day grain; rows without one come last.
    The input is read twice (numbering and bucket sizes): give a stored table
    where its own plan is expensive.
    """
    bucket = bucket if bucket is not None else F.year(F.col(order))
    b = df.withColumn("_bucket", bucket)
    local = b.withColumn("_local", F.row_number().over(
        Window.partitionBy("_bucket").orderBy(F.col(order).asc_nulls_last())) - 1)
    sizes = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_bucket",
        (F.sum("_n").over(Window.orderBy(F.col("_bucket").asc_nulls_last())
                          .rowsBetween(Window.unboundedPreceding, -1))).alias("_offset"))
    offsets = offsets.withColumnRenamed("_bucket", "_of")
    return (local.join(offsets, F.col("_bucket").eqNullSafe(F.col("_of")), "left").drop("_of")
                 .withColumn(index, F.coalesce(F.col("_offset"), F.lit(0)) + F.col("_local"))
                 .drop("_bucket", "_local", "_offset"))


def lag_k(df: DataFrame, col: str, k: int, order: str, by=None, out: str | None = None) -> DataFrame:
    """Value of ``col`` ``k`` rows earlier along ``order``.

    With ``by`` this is an ordinary partitioned ``lag``. Without it (one global
    series, e.g. a day-grain fact) the rows are indexed by ``global_row_index``
    and joined to themselves on ``idx - k``, so no step runs in one task.
    """
    out = out or f"{col}_lag{k}"
    if by is not None:
        return df.withColumn(out, F.lag(F.col(col), k).over(series_window(by, order)))
    idx = global_row_index(df, order)
    prev = idx.select((F.col("_row_idx") + F.lit(k)).alias("_row_idx"), F.col(col).alias(out))
    return idx.join(prev, "_row_idx", "left").drop("_row_idx")


def share_of_total(df: DataFrame, value: str, by, out: str = "share_pct",
                   scale: int | float = 100, total: str = "_total") -> DataFrame:
    """``scale * value / sum(value) over by`` without a partition-wide window.

    The totals come from an aggregate (map-side combined, one row per group)
    joined back on the group key. A hot group then costs one more row in a
    small table instead of one giant window partition; AQE broadcasts the
    totals when they are small and splits skewed partitions when not.
    """
    by = _cols(by)
    totals = df.groupBy(*by).agg(F.sum(F.col(value)).alias(total))
    joined = df.join(totals, by, "left")
    return joined.withColumn(out, safe_divide(F.lit(scale) * F.col(value), F.col(total)))


def forward_fill(df: DataFrame, cols: Sequence[str], by, order) -> DataFrame:
    """Carry the last non-NULL value forward along each series."""
    w = series_window(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(*[F.last(F.col(c), ignorenulls=True).over(w).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def global_frames(df: DataFrame, order: str, width: int, columns, bucket_rows: int = 4096) -> DataFrame:
    """Trailing frame aggregates (up to ``width`` rows) over one global order, in parallel.

    Rows get their global position (``global_row_index``) and are cut into
    buckets of ``bucket_rows``; each bucket also receives a halo copy of the
    previous bucket's last ``width - 1`` rows, so every frame is complete
    inside one bucket. ``columns(frame)`` returns the aggregate Columns, where
    ``frame(n)`` is the trailing ``n``-row WindowSpec (``n <= width``). Halo
    rows are dropped afterwards.
    """
    bucket_rows = max(bucket_rows, width)
    idx = global_row_index(df, order)
    b = F.floor(F.col("_row_idx") / F.lit(bucket_rows))
    main = idx.withColumn("_bkt", b).withColumn("_halo", F.lit(False))
    halo = (idx.filter(F.col("_row_idx") % F.lit(bucket_rows) >= F.lit(bucket_rows - (width - 1)))
               .withColumn("_bkt", b + 1).withColumn("_halo", F.lit(True)))
    def frame(n: int):
        if n > width:
            raise ValueError("frame longer than width")
        return Window.partitionBy("_bkt").orderBy("_row_idx").rowsBetween(-(n - 1), Window.currentRow)

    both = main.unionByName(halo)
    out = both.select(*[F.col(c) for c in df.columns], "_halo", *columns(frame))
    return out.filter(~F.col("_halo")).drop("_halo")


def forward_fill_global(df: DataFrame, order: str, cols: Sequence[str], bucket: Column | None = None) -> DataFrame:
    """Carry the last non-NULL value forward along one global order.

    Filled inside coarse buckets (default: the year of ``order``); each
    bucket's last non-NULL value is carried into later buckets through a
    small per-bucket table, so no step sees the whole series in one task.
    Rows without an order value come last. The input is read twice: give a
    stored table where its own plan is expensive.
    """
    bucket = bucket if bucket is not None else F.year(F.col(order))
    b = df.withColumn("_bkt", bucket)
    run = Window.partitionBy("_bkt").orderBy(F.col(order).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = b.select(*[F.col(c) for c in df.columns], "_bkt",
                     *[F.last(F.col(c), ignorenulls=True).over(run).alias(f"_in_{c}") for c in cols])
    tails = b.groupBy("_bkt").agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_tail_{c}") for c in cols])
    before = Window.orderBy(F.col("_bkt").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select(F.col("_bkt").alias("_of"), *[F.last(F.col(f"_tail_{c}"), ignorenulls=True).over(before).alias(f"_carry_{c}")
                                   for c in cols])
    out = inner.join(carry, F.col("_bkt").eqNullSafe(F.col("_of")), "left")
    return out.select(*[F.coalesce(F.col(f"_in_{c}"), F.col(f"_carry_{c}")).alias(c) if c in cols else F.col(c)
                        for c in df.columns])


def zscore(df: DataFrame, value: str, by, out: str = "zscore") -> DataFrame:
    """``(x - mean) / sample sd`` within each group (aggregate + join back)."""
    by = _cols(by)
    stats = df.groupBy(*by).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sd"))
    return df.join(stats, by, "left").withColumn(
        out, safe_divide(F.col(value) - F.col("_mean"), F.col("_sd"))).drop("_mean", "_sd")


def top_k_per_group(df: DataFrame, by, order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group under ``order`` (partial WindowGroupLimit first)."""
    w = Window.partitionBy(*_cols(by)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
