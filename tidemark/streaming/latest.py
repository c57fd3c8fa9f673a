"""Latest row per key as keyed state of the stream: one row a key in the state store.

Every batch is held against the newest row known of each key, so what a batch writes is the state
of the keys it touched, and no earlier batch is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.streaming.jobs import write_changes


def latest_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is first by ``order`` (columns, all descending, NULLs first); ties go to the
    greatest row. On a stream the aggregate is kept as state and comes out when a batch touches its key."""
    rank = F.struct(*[x for i, c in enumerate(order) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))])
    newest = F.max(F.struct(rank.alias("rank"), F.struct(*rows.columns).alias("row")))
    return rows.groupBy(*keys).agg(newest.alias("newest")).select("newest.row.*")


def upsert_latest_state(stream: DataFrame, keys: Sequence[str], order: Sequence[str], target_root: str,
                        checkpoint: str) -> StreamingQuery:
    """Write, for every batch, the newest rows of the keys it touched, as ``upsert_latest_stream`` lays them out.

    Late and replayed rows never win against the state, which a restarted query takes from the
    checkpoint. The last batch that holds a key has its current row (``read_latest`` finds it).
    State is kept for all keys.
    """
    return (latest_rows(stream, keys, order).writeStream.outputMode("update").foreachBatch(write_changes(target_root))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
