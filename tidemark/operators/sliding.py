"""Sliding windows over long series: positions and halo buckets per series, sums in constant time a row.

A series is cut into buckets of consecutive rows; each bucket also gets copies of the last rows
before it (its halo), so every trailing frame is whole inside one bucket. A series with a third of
all rows is many tasks, and a frame's sum is the difference of two running sums of its bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.scalar import safe_divide

BUCKET_ROWS = 2048


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def series_positions(df: DataFrame, by, order: str, bucket: Column | None = None, index: str = "_pos") -> DataFrame:
    """Dense 0-based position of each row in its series by ``order`` (unique in a series; NULL first).

    Rows are numbered inside coarse buckets of the order key (default: its year), and the buckets'
    sizes are summed up before them, so no task orders a whole series. The input is read twice
    (numbering and sizes): give a stored table where its own plan is expensive.
    """
    by = _cols(by)
    # Series and bucket are one struct, equal also where they are NULL: numbering and join share its exchange.
    key = F.struct(*by, (bucket if bucket is not None else F.year(F.col(order))).alias("_bucket"))
    b = df.select(key.alias("_bucket_key"), *[c for c in df.columns if c not in by])
    own = b.withColumn("_local", F.row_number().over(Window.partitionBy("_bucket_key").orderBy(F.col(order).asc_nulls_first())) - 1)
    before = Window.partitionBy(*by).orderBy(F.col("_bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = b.groupBy(F.col("_bucket_key").alias("_of")).agg(F.count("*").alias("_n")).select("_of", "_n", "_of.*").select(
        "_of", F.sum("_n").over(before).alias("_offset"))
    out = own.join(offsets, F.col("_bucket_key") == F.col("_of"), "left")
    return out.select(*[F.col("_bucket_key")[c].alias(c) if c in by else F.col(c) for c in df.columns],
                      (F.coalesce("_offset", F.lit(0)) + F.col("_local")).alias(index))


def with_halo(df: DataFrame, position: str, width: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows dealt into buckets ``_bkt`` of their series; the last ``width`` positions of a bucket
    also go to the next one, marked ``_halo``."""
    rows = max(bucket_rows, width)
    b = F.floor(F.col(position) / rows)
    tail = F.col(position) % rows >= rows - width
    dealt = df.withColumn("_bkt", F.explode(F.when(tail, F.array(b, b + 1)).otherwise(F.array(b))))
    return dealt.withColumn("_halo", F.col("_bkt") != b)


def series_frames(df: DataFrame, by, order: str, width: int, columns, bucket_rows: int = BUCKET_ROWS,
                  bucket: Column | None = None) -> DataFrame:
    """``df`` with trailing frame aggregates (up to ``width`` rows) per series, in halo buckets.

    ``columns(frame)`` returns the Columns; ``frame(n)`` is the trailing ``n``-row WindowSpec and
    ``frame(None)`` the whole bucket's order (for ``lag`` of fewer than ``width`` rows).
    """
    by = _cols(by)
    dealt = with_halo(series_positions(df, by, order, bucket), "_pos", width, bucket_rows)
    series = Window.partitionBy(*by, "_bkt").orderBy("_pos")

    def frame(n: int | None) -> WindowSpec:
        if n is not None and n > width:
            raise ValueError("frame longer than width")
        return series if n is None else series.rowsBetween(-(n - 1), Window.currentRow)

    out = dealt.select(*df.columns, "_halo", *columns(frame))
    return out.filter(~F.col("_halo")).drop("_halo")


def sliding_technicals(df: DataFrame, value: str = "close_price", by="ticker", order: str = "price_date",
                       ma_windows: Sequence[int] = (20, 50, 200), rsi_periods: int = 14, bb_window: int = 20,
                       bb_std: float = 2, bucket_rows: int = BUCKET_ROWS, bucket: Column | None = None) -> DataFrame:
    """The columns of ``with_technicals`` at a constant cost per row, for series of any length.

    Running sums of the value, its square, gains and losses are exact decimals (8 digits behind the
    point of a value below 1e10), so differences lose nothing and a constant frame has deviation 0.
    Frames are rows of the series, as there: NULL values take their place and are skipped, the first
    row has no change, a frame without losses has a NULL index, one value a NULL deviation.
    """
    by = _cols(by)
    frames = sorted({*ma_windows, rsi_periods, bb_window})
    width = max(frames[-1], rsi_periods + 1)
    dealt = with_halo(series_positions(df, by, order, bucket), "_pos", width, bucket_rows)
    series = Window.partitionBy(*by, "_bkt").orderBy("_pos")
    run = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    v, prev = F.col(value), F.lag(value).over(series)
    steps = dealt.withColumn("daily_change", v - prev).withColumn(
        "daily_return", safe_divide(F.col("daily_change"), prev))
    x = v.cast("decimal(18,8)")
    change = F.col("daily_change").cast("decimal(18,8)")
    zero = F.lit(0).cast("decimal(18,8)")
    steps = steps.select("*", x.alias("_x"), (x * x).alias("_xx"), F.when(change > 0, change).otherwise(zero).alias("_up"),
                         F.when(change < 0, -change).otherwise(zero).alias("_down"))
    steps = steps.select("*", *[F.coalesce(F.sum(f"_{c}").over(run), F.lit(0)).alias(f"_s{c}") for c in ("x", "xx", "up", "down")],
                         F.count(value).over(run).alias("_sn"))

    def within(c: str, n: int, kind: str) -> Column:
        return (F.col(f"_s{c}") - F.coalesce(F.lag(f"_s{c}", n).over(series), F.lit(0))).cast(kind)

    need = {("x", n) for n in (*ma_windows, bb_window)} | {("n", n) for n in (*ma_windows, bb_window)}
    need |= {("xx", bb_window), ("up", rsi_periods), ("down", rsi_periods)}
    kinds = {"x": "decimal(18,8)", "xx": "decimal(31,16)", "n": "int", "up": "decimal(18,8)", "down": "decimal(18,8)"}
    steps = steps.select("*", *[within(c, n, kinds[c]).alias(f"_{c}_{n}") for c, n in sorted(need)])

    def mean(n: int) -> Column:
        return F.col(f"_x_{n}").cast("double") / F.nullif(F.col(f"_n_{n}"), F.lit(0))

    n = F.col(f"_n_{bb_window}")
    spread = (F.col(f"_xx_{bb_window}") * n.cast("decimal(6,0)")
              - F.col(f"_x_{bb_window}") * F.col(f"_x_{bb_window}")).cast("double")
    sd = F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n * (n - 1))))
    up, down = F.col(f"_up_{rsi_periods}").cast("double"), F.col(f"_down_{rsi_periods}").cast("double")
    out = steps.filter(~F.col("_halo"))
    return out.select(*df.columns, "daily_change", "daily_return", *[mean(k).alias(f"ma_{k}") for k in ma_windows],
                      (F.lit(100) - F.lit(100) / (F.lit(1) + safe_divide(up, down))).alias(f"rsi_{rsi_periods}"),
                      mean(bb_window).alias("bb_middle"), (mean(bb_window) + F.lit(bb_std) * sd).alias("bb_upper"),
                      (mean(bb_window) - F.lit(bb_std) * sd).alias("bb_lower"))
