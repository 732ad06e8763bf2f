"""Batches, chunks, accumulation groups, padding and packing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.functions.keys import block_index

IGNORED_LABEL = -100  # fixed value: labels that do not count


def assign_batches(
    df: DataFrame, batch_size: int, idx: str = "draw", drop_last: bool = True, shard: str | None = None
) -> DataFrame:
    """Sequential batches over a dense index; an incomplete last batch is dropped on request.

    With ``shard``, every shard is batched on its own by its dense index.
    """
    out = df.withColumn("batch_id", F.expr(f"`{idx}` div {batch_size}")).withColumn(
        "pos_in_batch", F.expr(f"cast(`{idx}` % {batch_size} as int)")
    )
    if not drop_last:
        return out
    if shard is None:
        sized = out.withColumn("_n", df.agg(F.count(F.lit(1))).scalar())
    else:  # one row per shard
        sized = out.join(F.broadcast(df.groupBy(shard).agg(F.count(F.lit(1)).alias("_n"))), shard)
    return sized.where(F.col(idx) < F.col("_n") - F.col("_n") % F.lit(batch_size)).drop("_n")


def batch_composition(df: DataFrame, name: str = "global_dataset_name") -> DataFrame:
    return df.groupBy("batch_id", name).agg(F.count(F.lit(1)).alias("n"))


def chunk_batches(df: DataFrame, chunk_size: int, pos: str = "pos_in_batch") -> DataFrame:
    """Cut every batch into chunks of ``chunk_size`` rows."""
    return df.withColumn("chunk_id", F.expr(f"cast(`{pos}` div {chunk_size} as int)")).withColumn(
        "pos_in_chunk", F.expr(f"cast(`{pos}` % {chunk_size} as int)")
    )


def collect_chunks(df: DataFrame, columns: list[str], batch: str = "batch_id") -> DataFrame:
    """One row per chunk with its members in order; a chunk holds ``chunk_size`` rows at most."""
    member = F.struct("pos_in_chunk", *columns)
    return df.groupBy(batch, "chunk_id").agg(F.sort_array(F.collect_list(member)).alias("members"))


def combine_chunks(chunks: DataFrame, chunk_size: int, batch: str = "batch_id") -> DataFrame:
    """Rows of the chunks back at their place in the batch."""
    rows = chunks.select(batch, "chunk_id", F.inline("members"))
    at = (F.col("chunk_id") * chunk_size + F.col("pos_in_chunk")).alias("pos_in_batch")
    return rows.select(batch, at, *[c for c in rows.columns if c not in (batch, "chunk_id", "pos_in_chunk")])


def step_plan(
    df: DataFrame, accumulation: int = 1, num_epochs: float = 1.0, max_steps: int = 0, batch: str = "batch_id"
) -> DataFrame:
    """One row: batches, updates per epoch, total updates and epochs.

    Steps follow from epochs, or epochs from a positive ``max_steps``; both round up.
    """
    counted = df.agg(F.count_distinct(batch).alias("batches"))
    updates = F.greatest(F.lit(1).cast("long"), F.expr(f"batches div {accumulation}"))
    planned = counted.withColumn("updates_per_epoch", updates)
    if max_steps > 0:
        steps = F.lit(max_steps).cast("long")
        epochs = F.expr(f"({max_steps} + updates_per_epoch - 1) div updates_per_epoch")
    else:
        steps = F.ceil(F.lit(float(num_epochs)) * F.col("updates_per_epoch"))
        epochs = F.lit(math.ceil(num_epochs)).cast("long")
    return planned.withColumn("max_steps", steps).withColumn("num_epochs", epochs)


def accumulation_groups(df: DataFrame, accumulation: int, batch: str = "batch_id") -> DataFrame:
    return df.withColumn("update_id", F.expr(f"`{batch}` div {accumulation}"))


def resume_point(plan: DataFrame, global_step: int, accumulation: int = 1, ignore_data_skip: bool = False) -> DataFrame:
    """Finished epochs and the batches to skip in the current one, from a :func:`step_plan` row."""
    skip = F.lit(0).cast("long") if ignore_data_skip else (
        F.expr(f"{global_step} % updates_per_epoch") * accumulation
    )
    return plan.select(
        F.expr(f"{global_step} div updates_per_epoch").alias("epochs_done"), skip.alias("batches_to_skip")
    )


def skip_batches(
    df: DataFrame, global_step: int, accumulation: int = 1, ignore_data_skip: bool = False, batch: str = "batch_id"
) -> DataFrame:
    """The rows that are left in the epoch in which training resumes."""
    plan = step_plan(df, accumulation, batch=batch)
    skip = resume_point(plan, global_step, accumulation, ignore_data_skip).select("batches_to_skip").scalar()
    return df.withColumn("_skip", skip).where(F.col(batch) >= F.col("_skip")).drop("_skip")


def counted_labels(labels) -> Column:
    """Labels in an array that are not ignored."""
    return F.size(F.filter(labels, lambda x: x != IGNORED_LABEL))


def label_counts(df: DataFrame, labels: str = "labels", update: str = "update_id") -> DataFrame:
    return df.groupBy(update).agg(F.sum(counted_labels(labels)).alias("num_items"))


def pad_batches(
    df: DataFrame,
    ids: str = "ids",
    batch: str = "batch_id",
    max_length: int | None = None,
    pad_id: int = 0,
    bos_id: int = 1,
) -> DataFrame:
    """Cut to ``max_length``, pad on the right to the longest row of the batch, and mask by position.

    An empty sequence keeps one begin token. The batch maximum is an aggregate joined back, so rows of
    a large batch are not gathered in one task.
    """
    seq = F.when(F.size(ids) > 0, F.col(ids)).otherwise(F.array(F.lit(bos_id).cast("int")))
    cut = seq if max_length is None else F.slice(seq, 1, max_length)
    trimmed = df.withColumn("_seq", cut)
    longest = trimmed.groupBy(batch).agg(F.max(F.size("_seq")).alias("_len"))
    rest = F.col("_len") - F.size("_seq")
    return (
        trimmed.join(longest, batch)
        .withColumn("input_ids", F.concat("_seq", F.array_repeat(F.lit(pad_id).cast("int"), rest)))
        .withColumn(
            "attention_mask",
            F.concat(
                F.transform("_seq", lambda _: F.lit(1)), F.array_repeat(F.lit(0), rest)
            ),
        )
        .drop("_seq", "_len")
    )


def packing_offsets(
    df: DataFrame, mask: str = "attention_mask", batch: str = "batch_id", pos: str = "pos_in_batch",
    block: int = 1 << 16,
) -> DataFrame:
    """Per row: real tokens, the tokens before it in its batch, and the longest row of the batch.

    ``pos`` is dense within the batch, so the running sum is taken block by block.
    """
    lengths = df.withColumn("seqlen", F.aggregate(mask, F.lit(0).cast("long"), lambda s, x: s + x))
    longest = lengths.groupBy(batch).agg(F.max("seqlen").alias("max_seqlen"))
    summed = block_index(
        lengths, pos, [batch], out="_row", block=block, running=F.col("seqlen"), running_out="cu_seqlen"
    )
    return summed.join(longest, batch).drop("_row")


def packed_positions(
    df: DataFrame, mask: str = "attention_mask", batch: str = "batch_id", pos: str = "pos_in_batch"
) -> DataFrame:
    """Place of every real token in the flattened batch, and in the packed sequence."""
    packed = packing_offsets(df, mask, batch, pos)
    real = F.filter(
        F.transform(mask, lambda x, i: F.when(x == 1, i)), lambda i: i.isNotNull()
    )
    width = F.size(mask).cast("long")
    tokens = packed.select(
        batch, pos, "cu_seqlen", width.alias("_width"), F.posexplode(real).alias("_rank", "_col")
    )
    return tokens.select(
        batch,
        (F.col(pos) * F.col("_width") + F.col("_col")).alias("flat_position"),
        (F.col("cu_seqlen") + F.col("_rank")).alias("packed_position"),
    )
