"""As-of alignment: the newest observation at or before each row's time, per series.

Both sides are put in one order per (series, time bucket); each row takes the greatest
observation seen so far there, or the one carried in from earlier buckets. So there is no range
join, and no series, however long, is ordered by one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def asof_join(left: DataFrame, right: DataFrame, by, on: str, values: Sequence[str], right_on: str | None = None,
              right_by=None, as_of: str = "as_of", max_age_days: int | None = None, strict: bool = False,
              bucket: Column | None = None) -> DataFrame:
    """``left`` with ``values`` and ``as_of`` of the last ``right`` row per ``by`` whose time is not after ``on``.

    ``on`` and ``right_on`` are both dates or both timestamps; ``by`` and ``right_by`` name the series
    keys (NULL is a key like others). With ``strict`` an observation must be earlier than the row.
    ``max_age_days`` is the staleness limit: an older observation leaves NULLs, as does none. A left
    row without a time stays, with NULLs; a right row without one is no observation. Of right rows
    with the same key and time the one with the greatest values (in their order, NULLs least) counts.
    ``bucket`` is an expression over the column ``_t`` that grows with it (default: its month);
    it bounds what one task orders and does not change the result.
    """
    by, values = _cols(by), list(values)
    right_by, right_on = _cols(right_by or by), right_on or on
    bucket = bucket if bucket is not None else F.date_trunc("month", F.col("_t"))
    keys = [f"_k{i}" for i in range(len(by))]
    seen = F.struct(F.col(right_on).alias("t"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    obs = right.filter(F.col(right_on).isNotNull()).select(
        *[F.col(c).alias(k) for c, k in zip(right_by, keys, strict=True)], F.col(right_on).alias("_t"),
        seen.alias("_obs"))
    rows = left.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(on).alias("_t"),
                       F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"))
    both = rows.withColumn("_obs", F.lit(None).cast(obs.schema["_obs"].dataType)).unionByName(
        obs.withColumn("_row", F.lit(None).cast(rows.schema["_row"].dataType))).withColumn("_b", bucket)
    # At equal times observations come before rows, or behind them where they must be earlier.
    first = F.col("_row").isNotNull() if not strict else F.col("_row").isNull()
    series = Window.partitionBy(*keys, "_b")
    inner = F.max("_obs").over(series.orderBy("_t", first).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own = both.withColumn("_in", inner).filter("_row is not null")
    # The last observation of each bucket, carried on along the (short) list of buckets of a series.
    tails = both.groupBy(*keys, "_b").agg(F.max("_obs").alias("_tail"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select(*[F.col(k).alias(f"{k}r") for k in keys], F.col("_b").alias("_br"),
                         F.max("_tail").over(before).alias("_carry"))
    match = F.col("_b").eqNullSafe(F.col("_br"))
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"{k}r"))
    found = F.when(F.col("_t").isNotNull(), F.coalesce("_in", "_carry"))
    if max_age_days is not None:
        found = F.when(F.datediff("_t", F.coalesce("_in", "_carry")["t"]) <= max_age_days, found)
    out = own.join(carry, match, "left").select("_row", found.alias("_f"))
    return out.select(*[F.col("_row")[c].alias(c) for c in left.columns], F.col("_f.t").alias(as_of),
                      *[F.col("_f")[f"v{i}"].alias(v) for i, v in enumerate(values)])


def series_days(obs: DataFrame, by, on: str, last_day: Column | None = None, days: DataFrame | None = None,
                day: str = "date_day") -> DataFrame:
    """(series, day) from each series' first observation to ``last_day`` (a literal or scalar; default: the
    newest observation of all series): every calendar day, or those of ``days`` (column ``day``).

    The days of a series are made from its own bounds, so nothing is crossed with a calendar.
    """
    by = _cols(by)
    if last_day is None:
        last_day = obs.agg(F.max(on)).scalar()
    bounds = obs.groupBy(*by).agg(F.min(on).alias("_from")).withColumn("_to", last_day)
    out = bounds.filter("_from <= _to").select(*by, F.explode(F.sequence("_from", "_to")).alias(day))
    return out if days is None else out.join(days.select(day).distinct(), day, "left_semi")


def carry_forward(obs: DataFrame, by, on: str, value: str, last_day: Column | None = None, days: DataFrame | None = None,
                  max_age_days: int | None = None, day: str = "date_day", bucket: Column | None = None) -> DataFrame:
    """(series, day, value, as_of, age_days): each series' last known value on every day of its spine.

    NULL values are no observations. Days on which the last one is older than ``max_age_days`` stay,
    with NULLs. See ``series_days`` for the spine and ``asof_join`` for ties.
    """
    by = _cols(by)
    known = obs.filter(F.col(value).isNotNull() & F.col(on).isNotNull())
    spine = series_days(known, by, on, last_day, days, day)
    out = asof_join(spine, known, by, day, [value], right_on=on, max_age_days=max_age_days, bucket=bucket)
    return out.select(*by, day, value, "as_of", F.datediff(day, "as_of").alias("age_days"))
