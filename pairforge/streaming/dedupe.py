"""Rows that are delivered more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def first_deliveries(rows: DataFrame, keys: list[str], arrived: str = "arrived", within: str = "1 day") -> DataFrame:
    """The first delivery of every key, on a stream or a table.

    On a stream, a key is known for ``within`` after its first delivery; then the watermark lets it go, so the state holds the
    keys of that time only. A copy that comes later than that is taken for new and lands again; a row that is older than the
    watermark is dropped. On a table all copies are known.
    """
    if not rows.isStreaming:
        return rows.groupBy(*keys).agg(F.min(F.struct(arrived, *[c for c in rows.columns if c not in (arrived, *keys)])).alias("_first")).select(
            *[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in rows.columns])
    return rows.withWatermark(arrived, within).dropDuplicatesWithinWatermark(keys)


def store_first_deliveries(
    spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, keys: list[str], within: str = "1 day",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Append the rows of new Parquet files below ``source``, such as the good rows of an ingest, to ``target``, each key
    once. A row arrives with its file."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(source).select("*", F.col("_metadata.file_modification_time").alias("arrived"))
    return (
        first_deliveries(rows, keys, within=within).writeStream.outputMode("append").format("parquet").option("path", target)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
