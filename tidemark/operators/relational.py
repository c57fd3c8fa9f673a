"""Relational operators: pivots, breadth, group statistics, correlation
matrices, best/worst rows, nested series, spines, unions and top-k.

Everything aggregates with built-in functions, so Spark runs a partial
aggregate before every shuffle (a hot group is combined map-side).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.aggregates import pair_corr, pair_count
from tidemark.functions.scalar import ColumnLike, as_col, safe_divide


def _cols(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def pivot_long(df: DataFrame, key, name_col: str, value_col: str,
               names: Mapping[str, str], agg=F.max) -> DataFrame:
    """Long -> wide by conditional aggregation over a fixed name list.

    ``names`` maps each value of ``name_col`` to an output column. The list is
    explicit, so the schema is stable and no extra job discovers the values;
    names absent from the data give all-NULL columns.
    """
    cols = [agg(F.when(F.col(name_col) == F.lit(n), F.col(value_col))).alias(alias)
            for n, alias in names.items()]
    return df.groupBy(*_cols(key)).agg(*cols)


def breadth(df: DataFrame, ret: str, by, universe: DataFrame | None = None,
            key: str | None = None, up: str = "advancers", down: str = "decliners") -> DataFrame:
    """Count rising and falling members per group.

    With ``universe`` the rows are first restricted by an inner join on
    ``key``; duplicates in the universe multiply rows, as an inner join does.
    A NULL return counts in neither column.
    """
    if universe is not None:
        df = df.join(universe.select(key), key, "inner")
    return df.groupBy(*_cols(by)).agg(F.count_if(F.col(ret) > 0).alias(up),
                                      F.count_if(F.col(ret) < 0).alias(down))


def corr_matrix(df: DataFrame, lefts: Mapping[str, str], rights: Sequence[str] | Mapping[str, str],
                min_obs: int = 3, left_name: str = "asset", right_name: str = "macro_indicator",
                value_name: str = "correlation", count_name: str = "n_obs") -> DataFrame:
    """Pairwise Pearson correlations between two column families, unpivoted.

    One aggregate computes every (left, right) pair (partial + final), then
    the single result row is unpivoted to one row per pair. Pairs naming a
    column the frame lacks are skipped. See ``pair_corr`` for NULL rules.
    """
    rights = dict(rights) if isinstance(rights, Mapping) else {r: r for r in rights}
    present = set(df.columns)
    pairs = [(ln, lc, rn, rc) for ln, lc in lefts.items() for rn, rc in rights.items()
             if lc in present and rc in present]
    if not pairs:
        raise ValueError("no column pair present in the frame")
    aggs = []
    for i, (_, lc, _, rc) in enumerate(pairs):
        aggs.append(pair_corr(lc, rc, min_obs).alias(f"c{i}"))
        aggs.append(pair_count(lc, rc).alias(f"n{i}"))
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(ln).alias(left_name), F.lit(rn).alias(right_name),
                        F.col(f"c{i}").cast("double").alias(value_name),
                        F.col(f"n{i}").alias(count_name))
               for i, (ln, _, rn, _) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*structs)))


def asset_stats(df: DataFrame, id_col: str, date_col: str, close: str, ret: str,
                first_cols: Sequence[str] = ()) -> DataFrame:
    """Per-entity period statistics.

    num_days counts all rows; latest_close and the cumulative return
    (last / first - 1) use non-NULL closes only and need two of them;
    avg_daily_return is the mean of non-NULL returns and volatility their
    population standard deviation (NULL below two returns). ``first_cols`` are
    taken from the entity's earliest row. A zero first close gives NULL.
    """
    has_close = F.when(F.col(close).isNotNull(), F.col(date_col))
    last_c = F.max_by(F.col(close), has_close)
    first_c = F.min_by(F.col(close), has_close)
    n_ret = F.count(F.col(ret))
    first_row = [F.min_by(F.col(c), F.col(date_col)).alias(c) for c in first_cols]
    return df.groupBy(id_col).agg(
        *first_row,
        F.count(F.lit(1)).alias("num_days"),
        last_c.alias("latest_close"),
        F.when(F.count(F.col(close)) >= 2, safe_divide(last_c, first_c) - F.lit(1))
         .alias("cumulative_return"),
        F.avg(F.col(ret)).alias("avg_daily_return"),
        F.when(n_ret >= 2, F.stddev_pop(F.col(ret))).alias("volatility"),
    )


def best_worst(df: DataFrame, by, date_col: str, value: str, zero_is_missing: bool = False,
               prefix: tuple[str, str] = ("best", "worst")) -> DataFrame:
    """Best and worst (date, value) per group.

    Ties go to the earliest date and a missing value loses to any present one;
    with every value missing the earliest row is returned. With
    ``zero_is_missing`` an exact 0.0 also counts as missing (it still reports
    its value).
    """
    v = F.col(value)
    present = v.isNotNull() & (v != 0) if zero_is_missing else v.isNotNull()
    present = F.coalesce(present, F.lit(False))
    day = F.unix_date(F.col(date_col))
    row = F.struct(F.col(date_col).alias("date"), v.alias("return"))
    best_key = F.struct(present, F.when(present, v), -day)
    worst_key = F.struct(~present, F.when(present, v), day)
    b, w = prefix
    return df.groupBy(*_cols(by)).agg(F.max_by(row, best_key).alias(f"{b}_day"),
                                      F.min_by(row, worst_key).alias(f"{w}_day"))


def nested_series(df: DataFrame, by, order_field: str, fields: Sequence[str],
                  out: str = "daily_series") -> DataFrame:
    """One row per group holding its rows as an ordered array of structs.

    For report-sized groups (a bounded period of days per group).
    """
    fields = [order_field] + [f for f in fields if f != order_field]
    return df.groupBy(*_cols(by)).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias(out))


def date_spine(spark: SparkSession, start: str, end: str, inclusive: bool = False,
               name: str = "date_day") -> DataFrame:
    """One row per day from ``start`` up to ``end`` (excluded unless ``inclusive``).

    Generated from ``spark.range`` so the days are spread over tasks.
    """
    days = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + (1 if inclusive else 0)
    return spark.range(0, max(days, 0)).select(
        F.date_add(F.to_date(F.lit(start)), F.col("id").cast("int")).alias(name))


def spine_between(bounds: DataFrame, start_col: str, end_col: str, inclusive: bool = True,
                  name: str = "date_day") -> DataFrame:
    """Day spine between two date columns of a bounds frame (one row per range)."""
    end = F.col(end_col) if inclusive else F.date_sub(F.col(end_col), 1)
    return bounds.where(end >= F.col(start_col)).select(
        F.explode(F.sequence(F.col(start_col), end)).alias(name))


def between_dates(df: DataFrame, col: str, start: str, end: str) -> DataFrame:
    """Rows whose day lies in [start, end], both inclusive.

    On a timestamp column the bounds are written as ``start <= ts <
    end + 1 day`` on the raw column, so the predicate reaches the parquet scan
    (row-group skipping) instead of wrapping the column in ``to_date``.
    """
    dtype = dict(df.dtypes)[col]
    if dtype == "date":
        return df.filter(F.col(col).between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    ts_type = "timestamp_ntz" if dtype == "timestamp_ntz" else "timestamp"
    lo = F.lit(start).cast(ts_type)
    hi = F.date_add(F.to_date(F.lit(end)), 1).cast(ts_type)
    return df.filter((F.col(col) >= lo) & (F.col(col) < hi))


def spine_join(spine: DataFrame, df: DataFrame, spine_col: str, df_col: str) -> DataFrame:
    """Left join a source onto a day spine so no day is dropped."""
    return spine.join(df.withColumnRenamed(df_col, spine_col), spine_col, "left")


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows under ``order`` (planned as TakeOrderedAndProject:
    each task keeps its own top ``n`` before the final merge)."""
    return df.orderBy(*order).limit(n)


def ci_in(cols: Sequence[ColumnLike], values: Sequence[str]) -> Column:
    """Case-insensitive membership of any of ``cols`` in ``values``."""
    keys = [v.upper() for v in values]
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.upper(as_col(c)).isin(*keys)
    return cond


def ilike_contains(c: ColumnLike, text: str, escape: bool = False) -> Column:
    """Case-insensitive 'contains'. User text is a live pattern unless ``escape``."""
    if escape:
        text = text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return as_col(c).ilike(f"%{text}%")


def trailing_days(date_col: ColumnLike, days: int, as_of: Column | None = None) -> Column:
    """``date >= as_of - days`` (as_of defaults to today)."""
    as_of = as_of if as_of is not None else F.current_date()
    return as_col(date_col) >= F.date_sub(as_of, days)


def tagged_left_join(left: DataFrame, right: DataFrame, when: Column, on: Mapping[str, str]) -> DataFrame:
    """Left join on keys (left column -> right column) of the left rows for which ``when`` holds.

    The test is part of the join condition: rows that fail it stay, with NULLs.
    It also nulls their key, so that they need not meet in the join at all.
    """
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") for c in right.columns])
    cond = F.lit(True)
    for a, b in on.items():
        cond = cond & (F.when(when, F.col(a)) == F.col(f"_r_{b}"))
    return left.join(renamed, cond, "left").select(
        *left.columns, *[F.col(f"_r_{c}").alias(c) for c in right.columns if c not in left.columns])
