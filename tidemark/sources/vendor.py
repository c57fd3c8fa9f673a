"""Vendor payload normalisation as Spark jobs over landed raw payloads.

The extract step of each source (flatten nested observations, clean vendor
values, downsample intraday points, align parallel series) runs here on
DataFrames, so it scales with the payload volume instead of looping in
Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import epoch_ms_to_date, epoch_to_date, sentinel_to_null


def flatten_observations(payloads: DataFrame, series: DataFrame | None = None,
                         payload: str = "payload", series_id: str = "series_id") -> DataFrame:
    """``{observations: [{date, value, realtime_start, realtime_end}]}`` per series
    -> one row per (series, date), value cleaned ('.' / '' / null -> NULL).

    ``series`` (series_id, series_name) tags each row with its name.
    """
    obs_type = "array<struct<date:string,value:string,realtime_start:string,realtime_end:string>>"
    p = F.col(payload)
    obs = F.variant_get(p, "$.observations", obs_type) if dict(payloads.dtypes)[payload] == "variant" \
        else p.getField("observations")
    rows = payloads.select(F.col(series_id), F.explode(obs).alias("o")).select(
        series_id, F.col("o.date").alias("date"), sentinel_to_null(F.col("o.value")).alias("value"),
        F.col("o.realtime_start").alias("realtime_start"), F.col("o.realtime_end").alias("realtime_end"))
    if series is not None:
        rows = rows.join(series.select(series_id, "series_name"), series_id, "left")
    return rows


def readings_to_daily(readings: DataFrame, start: str, end: str, ts: str = "timestamp",
                      value: str = "value", label: str = "value_classification") -> DataFrame:
    """Index readings with epoch-second timestamps -> (date, value, classification),
    kept when ``start <= date <= end`` (both inclusive, UTC dates)."""
    d = epoch_to_date(F.col(ts).cast("bigint"))
    return readings.select(d.alias("date"), F.col(value).cast("int").alias("value"),
                           F.col(label).alias("classification")) \
        .filter(F.col("date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))


def daily_downsample(ticks: DataFrame, key: str, ts_ms: str, values: Sequence[str],
                     seq: str | None = None, date: str = "date") -> DataFrame:
    """Per key and UTC day keep the point with the greatest millisecond timestamp.

    On equal timestamps the first-seen point (lowest ``seq``) stays. Runs as an
    aggregate with map-side combining, so a hot key or day is reduced before
    the shuffle.
    """
    day = epoch_ms_to_date(F.col(ts_ms))
    earlier = F.lit(0) if not seq else F.col(seq)
    if seq and dict(ticks.dtypes)[seq].startswith("struct"):
        earlier = F.struct(*[-F.col(f"{seq}.{f.name}") for f in ticks.schema[seq].dataType])
    elif seq:
        earlier = -earlier
    order = F.struct(F.col(ts_ms), earlier)
    payload = F.struct(F.col(ts_ms).alias(ts_ms), *[F.col(v).alias(v) for v in values])
    agg = ticks.groupBy(F.col(key), day.alias(date)).agg(F.max_by(payload, order).alias("_p"))
    return agg.select(key, date, *[F.col(f"_p.{c}").alias(c) for c in [ts_ms, *values]])


def explode_pairs(charts: DataFrame, key: str, pairs: str, value: str, seq: str) -> DataFrame:
    """``[[timestamp ms, value], ...]`` arrays -> (key, ts_ms, value, pos), pos in order of arrival."""
    rows = charts.select(F.col(key), F.col(seq), F.posexplode(F.col(pairs)).alias("at", "pair"))
    return rows.select(key, F.get("pair", F.lit(0)).cast("bigint").alias("ts_ms"), F.get("pair", F.lit(1)).alias(value),
                       F.struct(F.col(seq), F.col("at")).alias("pos"))


def align_series(points: DataFrame, key: str, ts_ms: str, price: str, lookups: Sequence[DataFrame],
                 lookup_values: Sequence[str], pos: str = "pos", date: str = "date") -> DataFrame:
    """Daily price points with parallel series looked up at the chosen timestamp.

    ``lookups`` are (key, ts, value, pos) frames (e.g. market caps, volumes).
    A duplicated timestamp in a lookup keeps its last entry (greatest
    ``pos``); a timestamp absent from a lookup gives NULL.
    """
    daily = daily_downsample(points, key, ts_ms, [price], seq=pos, date=date)
    out = daily
    for frame, name in zip(lookups, lookup_values):
        last = frame.groupBy(key, ts_ms).agg(F.max_by(F.col(name), F.col(pos)).alias(name))
        out = out.join(last, [key, ts_ms], "left")
    return out


def ohlcv_bars(ticks: DataFrame, key: str, ts: str, price: str, size: str | None = None,
               date: str = "date", seq: str | None = None) -> DataFrame:
    """Intraday ticks -> daily open/high/low/close/volume per key.

    open/close are the first/last price by timestamp, equal timestamps by ``seq``
    (or by price, so that the result never depends on task order); volume sums
    ``size`` (or counts ticks). One aggregate, combined map-side.
    """
    vol = F.sum(F.col(size)) if size else F.count(F.lit(1))
    at = F.struct(F.col(ts), F.col(seq or price))
    return ticks.groupBy(F.col(key), F.to_date(F.col(ts)).alias(date)).agg(
        F.min_by(F.col(price), at).alias("open"), F.max(F.col(price)).alias("high"),
        F.min(F.col(price)).alias("low"), F.max_by(F.col(price), at).alias("close"),
        vol.alias("volume"))


def normalise_ohlcv(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename vendor OHLCV fields to open/high/low/close/adj_close/volume."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def stamp(df: DataFrame, run_date: str, col: str = "date") -> DataFrame:
    """Stamp a point-in-time snapshot with the run date (ISO text)."""
    return df.withColumn(col, F.lit(run_date))


def top_n_by(df: DataFrame, metric: str, n: int, tie: str | None = None) -> DataFrame:
    """Top ``n`` rows by ``metric`` descending (ties by ``tie`` ascending)."""
    order = [F.col(metric).desc_nulls_last()] + ([F.col(tie).asc_nulls_last()] if tie else [])
    return df.orderBy(*order).limit(n)


def universe_filter(df: DataFrame, universe: DataFrame, key: str, universe_key: str | None = None) -> DataFrame:
    """Keep rows whose ``key`` is in the universe table (left semi join)."""
    u = universe.select(F.col(universe_key or key).alias(key))
    return df.join(u, key, "left_semi")


def date_sequence(spark: SparkSession, start: str, end: str, name: str = "date") -> DataFrame:
    """Every day from start to end, both inclusive."""
    from tidemark.operators.relational import date_spine
    return date_spine(spark, start, end, inclusive=True, name=name)
