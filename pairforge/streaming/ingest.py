"""Incremental ingest of pair files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pairforge.session import scratch_scope
from pairforge.sources.files import split_lines
from pairforge.sources.pairs import prepare_pairs
from pairforge.sources.schemas import record_schema


def ingest_pairs(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    split: str = "train",
    name: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Parse new JSON-lines files into ``target/good`` and ``target/quarantine``.

    The quarantine has the file, line number, text and problem of each bad line. A micro batch is parsed once and
    overwrites its own ``batch_id`` folder, so a batch that is replayed after a failure replaces what it wrote and
    every line lands exactly once.
    """
    schema, required = record_schema(split)
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.text(source).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(spark):
            good, bad = split_lines(batch, schema, required)
            prepare_pairs(good, split, name).write.mode("overwrite").parquet(f"{target}/good/batch_id={batch_id}")
            bad.write.mode("overwrite").parquet(f"{target}/quarantine/batch_id={batch_id}")

    return (
        lines.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
