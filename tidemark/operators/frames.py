"""Row frames of sorted series in Arrow batches: the values of Spark's sliding frames at a fraction of their time.

Spark's sliding frame goes over all its rows again for each row, one at a time. Here a batch is one
array and a frame of n rows is n additions of arrays, in the frame's own order, so that sums and
deviations come out equal to the last bit. A task streams its sorted rows and keeps no more than the
longest frame of them between two batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType


def _differs():
    """The function is made here, so that it goes along to Python workers which do not have this package."""

    def differs(column: pa.Array) -> np.ndarray:
        """Whether each element but the first differs from the one before it; NULL equals NULL."""
        a, b = column.slice(1), column.slice(0, len(column) - 1)
        return np.asarray(pc.fill_null(pc.not_equal(a, b), False)) | (np.asarray(a.is_null()) != np.asarray(b.is_null()))

    return differs


def _firsts(keys: Sequence[str]):
    """The function of one task of ``first_in_task``: sorted rows in, the first of each key out."""
    differs = _differs()

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k) for k in keys]
            new = np.zeros(batch.num_rows, bool)
            for i, c in enumerate(columns):
                new[1:] |= differs(c)
                new[0] |= last is None or bool(differs(pa.concat_arrays([last[i], c.slice(0, 1)]))[0])
            yield batch.filter(pa.array(new))
            last = [c.slice(len(c) - 1) for c in columns]

    return stream


def first_in_task(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row under ``order`` of each key among the rows of a task, before an exchange by fewer columns than ``keys``.

    A key may come from many tasks. Where the exchange is by all ``keys``, ``windows.dedup_latest`` does as much.
    """
    return df.sortWithinPartitions(*keys, *order).mapInArrow(_firsts(list(keys)), df.schema)


def _technicals(value: str, by: Sequence[str], names: Sequence[str], ma_windows: Sequence[int], rsi_periods: int,
                bb_window: int, bb_std: float):
    """The function of one task of ``frame_technicals``: sorted rows in, the same rows with their technicals out.

    All of it is in here, so that it goes to Python workers which do not have this package.
    """
    keep = max(*ma_windows, bb_window, rsi_periods + 1)

    class Frames:
        """Frames over the values ``v`` (0 where not ``ok``) of which the first ``skip`` are earlier rows.

        ``age`` counts the rows of the same series before each row; aggregates are of the rows after ``skip``.
        """

        def __init__(self, v: np.ndarray, ok: np.ndarray, age: np.ndarray, skip: int):
            self.v, self.ok, self.age, self.skip = np.where(ok, v, 0.0), ok, age[skip:], skip

        def _steps(self, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """(value, is present) of the row 'back' rows earlier, oldest first."""
            rows = len(self.v) - self.skip
            for back in range(min(n - 1, int(self.age.max(initial=0))), -1, -1):
                at = self.skip - back
                v, ok = self.v[max(at, 0):at + rows], self.ok[max(at, 0):at + rows]
                if at < 0:  # those rows are of no series here
                    v, ok = np.concatenate([np.zeros(-at), v]), np.concatenate([np.zeros(-at, bool), ok])
                yield v, ok & (self.age >= back)

        def mean(self, n: int) -> tuple[np.ndarray, np.ndarray]:
            total, count = np.zeros(len(self.age)), np.zeros(len(self.age))
            for v, ok in self._steps(n):
                total += np.where(ok, v, 0.0)
                count += ok
            return total / count, count > 0

        def deviation(self, n: int) -> tuple[np.ndarray, np.ndarray]:
            """Sample standard deviation by Spark's own updates of count, mean and squares."""
            count, mean, squares = (np.zeros(len(self.age)) for _ in range(3))
            for v, ok in self._steps(n):
                more = count + 1.0
                delta = v - mean
                part = delta / more
                squares = np.where(ok, squares + delta * (delta - part), squares)
                mean = np.where(ok, mean + part, mean)
                count = np.where(ok, more, count)
            return np.sqrt(squares / (count - 1.0)), count > 1

    def doubles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ok = np.asarray(column.is_valid())
        return pc.fill_null(column, 0.0).to_numpy(zero_copy_only=False), ok

    differs = _differs()

    def divide(a, a_ok, b, b_ok):
        """``safe_divide``: NULL where either is NULL or the divisor is zero."""
        return a / b, a_ok & b_ok & (b != 0)

    def columns(v, ok, age, skip):
        one = np.maximum(np.arange(len(v)) - 1, 0)
        prev, prev_ok = v[one], ok[one] & (age > 0)
        change, change_ok = v - prev, ok & prev_ok
        yield change[skip:], change_ok[skip:]
        yield tuple(c[skip:] for c in divide(change, change_ok, prev, prev_ok))
        prices = Frames(v, ok, age, skip)
        for n in ma_windows:
            yield prices.mean(n)
        every = np.ones(len(v), bool)
        # As in SQL, NaN is above every number.
        gain = Frames(np.where(change_ok & ~(change <= 0), change, 0.0), every, age, skip).mean(rsi_periods)
        loss = Frames(np.where(change_ok & (change < 0), np.abs(change), 0.0), every, age, skip).mean(rsi_periods)
        ratio, ratio_ok = divide(*gain, *loss)
        yield 100.0 - 100.0 / (1.0 + ratio), ratio_ok
        middle, has = prices.mean(bb_window)
        sd, spread = prices.deviation(bb_window)
        yield middle, has
        yield middle + bb_std * sd, has & spread
        yield middle - bb_std * sd, has & spread

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, v0, ok0, age0 = None, np.zeros(0), np.zeros(0, bool), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(b) for b in by]
            new = np.zeros(batch.num_rows, bool)
            for i, k in enumerate(keys):
                new[1:] |= differs(k)
                new[0] |= last is None or bool(differs(pa.concat_arrays([last[i], k.slice(0, 1)]))[0])
            if new[0]:
                v0, ok0, age0 = v0[:0], ok0[:0], 0
            v, ok = doubles(batch.column(value))
            place = np.arange(batch.num_rows)
            first = np.maximum.accumulate(np.where(new, place, -1))
            age = np.where(first >= 0, place - first, place + age0)
            ages = np.concatenate([np.arange(age0 - len(v0), age0), age])
            v, ok = np.concatenate([v0, v]), np.concatenate([ok0, ok])
            with np.errstate(all="ignore"):
                found = [pa.array(c, pa.float64(), mask=~has) for c, has in columns(v, ok, ages, len(v0))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, *names])
            last, age0 = [k.slice(len(k) - 1) for k in keys], int(ages[-1]) + 1
            held = min(keep, age0, len(v))
            v0, ok0 = v[len(v) - held:].copy(), ok[len(v) - held:].copy()

    return stream


def frame_technicals(df: DataFrame, value: str, by: Sequence[str], order: Sequence[str], ma_windows: Sequence[int],
                     rsi_periods: int, bb_window: int, bb_std: float, clustered: bool = False) -> DataFrame:
    """The columns of ``windows.with_technicals`` for a double ``value``, equal to its frames' in every bit.

    The rows of a series are sorted in one task and streamed through it; ``clustered`` says that they
    are in one task already.
    """
    by, order = list(by), list(order)
    names = ["daily_change", "daily_return", *[f"ma_{n}" for n in ma_windows], f"rsi_{rsi_periods}",
             "bb_middle", "bb_upper", "bb_lower"]
    schema = StructType([*df.schema.fields, *[StructField(n, DoubleType()) for n in names]])
    stream = _technicals(value, by, names, ma_windows, rsi_periods, bb_window, bb_std)
    return (df if clustered else df.repartition(*by)).sortWithinPartitions(*by, *order).mapInArrow(stream, schema)
