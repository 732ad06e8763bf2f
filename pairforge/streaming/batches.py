"""Training batches over a stream."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = T.StructType([T.StructField("next_batch", T.LongType()), T.StructField("open_rows", T.BinaryType())])


def _packed(rows: pd.DataFrame) -> bytes:
    out = io.BytesIO()
    rows.to_parquet(out, index=False)
    return out.getvalue()


def stream_batches(rows: DataFrame, batch_size: int, order: str, shard: str) -> DataFrame:
    """Rows of a stream with ``batch_id`` and ``pos_in_batch``, once their batch is full.

    Every shard is batched on its own, in the order in which its micro batches arrive and by ``order`` within one. Its state
    is the number of the open batch and that batch's rows, fewer than ``batch_size``; the next micro batch goes on from
    there, also after a restart from the checkpoint. The incomplete last batch stays in the state and is not given out.
    A shard is one task in a micro batch, so the number of shards spreads the work; what a task holds is bounded by
    the rows that the source admits per trigger. Repeated and null values of ``order`` keep some order among each other.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("pos_in_batch", T.IntegerType())])
    names = rows.columns

    def batched(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, kept = state.get if state.exists else (0, None)
        arrived = pd.concat(list(frames)).sort_values(order, kind="stable")
        if kept:
            arrived = pd.concat([pd.read_parquet(io.BytesIO(kept)), arrived])
        full = len(arrived) // batch_size
        left = arrived.iloc[full * batch_size :]
        state.update((number + full, _packed(left[names]) if len(left) else None))
        if full:
            out = arrived.iloc[: full * batch_size].copy()
            place = pd.RangeIndex(len(out)).to_numpy()
            out["batch_id"] = number + place // batch_size
            out["pos_in_batch"] = (place % batch_size).astype("int32")
            yield out

    return rows.groupBy(shard).applyInPandasWithState(batched, schema, STATE, "append", GroupStateTimeout.NoTimeout)


def run_stream_batches(rows: DataFrame, target: str, checkpoint: str, batch_size: int, order: str, shard: str) -> StreamingQuery:
    """Append the full batches of a stream to the Parquet folder ``target``; each row lands once."""
    batches = stream_batches(rows, batch_size, order, shard)
    return (
        batches.writeStream.outputMode("append").format("parquet").option("path", target)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
