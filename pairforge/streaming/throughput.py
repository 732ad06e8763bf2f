"""Rates over event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def throughput(df: DataFrame, ts: str = "ts", by: list[str] | None = None) -> DataFrame:
    """Rows, elapsed seconds and rows per second; 0 when no time has passed."""
    micros = F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))
    counted = df.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"), (micros / 1e6).alias("elapsed"))
    rate = F.when(F.col("elapsed") > 0, F.col("n") / F.col("elapsed")).otherwise(F.lit(0.0))
    return counted.withColumn("rate", rate)


EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _as_utc(ts: str) -> Column:
    """A timestamp without zone read as UTC, whatever the session's zone is."""
    return F.concat(F.col(ts).cast("string"), F.lit("Z")).cast("timestamp")


def _without_zone(ts: str) -> Column:
    """The UTC wall-clock of a timestamp."""
    return F.expr(f"{EPOCH} + make_dt_interval(0, 0, 0, unix_micros({ts}) / 1000000BD)")


def windowed_counts(
    events: DataFrame, ts: str = "ts", kind: str = "event_type", width: str = "1 hour", lateness: str = "1 hour"
) -> DataFrame:
    """Rows per window and type; works on a table and, with its watermark, on a stream.

    Windows follow the wall-clock of a timestamp without zone. A watermark needs a zone, so on a stream
    such values are read as UTC and the window bounds are returned without zone again.
    """
    zoneless = dict(events.dtypes)[ts] == "timestamp_ntz"
    stamped = events
    if events.isStreaming:
        if zoneless:
            stamped = stamped.withColumn(ts, _as_utc(ts))
        stamped = stamped.withWatermark(ts, lateness)
    counts = stamped.groupBy(F.window(ts, width).alias("window"), kind).agg(F.count(F.lit(1)).alias("n"))
    bounds = counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), kind, "n"
    )
    if not (events.isStreaming and zoneless):
        return bounds
    return bounds.select(
        *[_without_zone(c).alias(c) for c in ("window_start", "window_end")], kind, "n"
    )


def run_windowed_counts(
    events: DataFrame, target: str, checkpoint: str, final: bool = True, **options
) -> StreamingQuery:
    """Write the windowed counts of a stream to ``target``.

    ``final`` writes the counts that a micro batch changed below ``target/batch_id=...``, open windows included;
    :func:`read_windowed_counts` gives the latest of each. A batch that is replayed after a failure replaces its own
    folder, and no earlier count is rewritten. Otherwise windows are appended once the watermark has passed them.
    Both forget a window when the watermark passes it, and rows that come later than that are not counted.
    """
    counts = windowed_counts(events, **options)
    writer = counts.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if not final:
        return writer.outputMode("append").format("parquet").option("path", target).start()

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return writer.outputMode("update").foreachBatch(store).start()


def read_windowed_counts(spark: SparkSession, target: str, kind: str = "event_type") -> DataFrame:
    """The latest count per window and type of a ``final`` run."""
    return (
        spark.read.parquet(target)
        .groupBy("window_start", "window_end", kind)
        .agg(F.max_by("n", "batch_id").alias("n"))
    )


def run_throughput(events: DataFrame, target: str, checkpoint: str, by: list[str], ts: str = "ts") -> StreamingQuery:
    """The running rate of a stream: the keys that a micro batch changed, below ``target/batch_id=...``, with rows so far and the
    first and last event time; :func:`read_throughput` gives the rates.

    The state is one row per key. Late rows count like others, since a rate is over all that was seen; a batch that is
    replayed after a failure replaces its own folder.
    """
    seen = events.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last"))

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    writer = seen.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(store).start()


def read_throughput(spark: SparkSession, target: str, by: list[str]) -> DataFrame:
    """The latest ``(*by, n, elapsed, rate)`` of every key, as :func:`throughput` gives them for a table."""
    latest = spark.read.parquet(target).groupBy(*by).agg(F.max_by(F.struct("n", "first", "last"), "batch_id").alias("of"))
    micros = F.unix_micros(F.col("of.last").cast("timestamp")) - F.unix_micros(F.col("of.first").cast("timestamp"))
    timed = latest.select(*by, F.col("of.n").alias("n"), (micros / 1e6).alias("elapsed"))
    return timed.withColumn("rate", F.when(F.col("elapsed") > 0, F.col("n") / F.col("elapsed")).otherwise(F.lit(0.0)))
