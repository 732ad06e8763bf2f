"""Weighted interleaving of several sources, and sharding of the result."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.functions.keys import HOT_ROWS, SEED, block_index, hash_index, hash_long

DRAW_BLOCK = 1 << 18
STRATEGIES = {"first_exhausted": min, "all_exhausted": max}


@dataclass
class Source:
    name: str
    rows: DataFrame
    weight: float = 1.0


def mix_probabilities(config: DataFrame, weight: str = "weight") -> DataFrame:
    """Weights divided by their sum; the config table has one row per source."""
    return config.withColumn("probability", F.col(weight) / config.agg(F.sum(weight)).scalar())


def _upper_bounds(weights: Sequence[float]) -> list[float]:
    total, bounds, so_far = sum(weights), [], 0.0
    for w in weights:
        so_far += w / total
        bounds.append(so_far)
    return bounds


def draw_source(draw: str, weights: Sequence[float], seed: int = SEED) -> Column:
    """Number of the source that a draw picks: the first whose cumulative share exceeds the hash."""
    u = hash_long(draw, seed=f"mix{seed}", digits=8) / F.lit(float(1 << 32))
    picked = F.lit(len(weights) - 1)
    for i, bound in reversed(list(enumerate(_upper_bounds(weights)))[:-1]):
        picked = F.when(u < F.lit(bound), F.lit(i)).otherwise(picked)
    return picked


def last_draw(draws: DataFrame, sizes: Sequence[int], strategy: str) -> int | None:
    """The draw at which the first (or the last) source has been read once in full.

    Counts per source and block of draws say in which block a source runs out; only that block is
    ranked. None when the draws do not reach that point.
    """
    size_of = F.element_at(
        F.array(*[F.lit(int(n)).cast("long") for n in sizes]), F.col("source_no") + 1
    )
    blocks = draws.withColumn("_block", F.expr(f"draw div {DRAW_BLOCK}"))
    upto = Window.partitionBy("source_no").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    final_block = (
        blocks.groupBy("source_no", "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(upto))
        .where((F.col("_upto") >= size_of) & (F.col("_upto") - F.col("_n") < size_of))
        .select("source_no", "_block", (size_of - F.col("_upto") + F.col("_n")).alias("_local"))
    )
    in_block = Window.partitionBy("source_no").orderBy("draw")
    ends = (
        blocks.join(F.broadcast(final_block), ["source_no", "_block"])  # one row per source
        .withColumn("_rank", F.row_number().over(in_block))
        .where("_rank = _local")
        .agg(F.count(F.lit(1)).alias("n"), F.min("draw").alias("first"), F.max("draw").alias("last"))
        .first()
    )
    if strategy == "first_exhausted":
        return ends["first"]
    return ends["last"] if ends["n"] == len(sizes) else None


def interleave(
    sources: Sequence[Source],
    key: str,
    strategy: str = "all_exhausted",
    seed: int = SEED,
    name_col: str = "global_dataset_name",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows of all sources in drawn order, with ``draw`` as a dense zero-based position.

    Every draw picks a source by weight; its k-th draw reads row ``k mod size`` of the source, whose
    rows are in hash order of ``key`` (unique within a source; ``keys.with_row_id`` makes one). Stops when the first source, or all
    sources, have been read once. The sources' sizes and the stop are the only values brought to the
    driver: one number per configured source.

    A row of a small source with a large weight is drawn many times; such a source is replicated and
    its draws salted, so that no join key carries more than about ``hot_rows`` draws.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown stopping strategy {strategy!r}")
    if not sources:
        raise ValueError("nothing to interleave")
    spark = sources[0].rows.sparkSession
    tagged = None
    for i, s in enumerate(sources):
        part = s.rows.withColumn(name_col, F.lit(s.name)).withColumn("source_no", F.lit(i))
        tagged = part if tagged is None else tagged.unionByName(part, allowMissingColumns=True)
    sizes = [s.rows.count() for s in sources]
    indexed = hash_index(tagged, [key], ["source_no"], seed=f"order{seed}", out="pos")
    if len(sources) == 1:
        return indexed.withColumnRenamed("pos", "draw").drop("source_no")
    if 0 in sizes:
        raise ValueError("every source needs at least one row")

    weights = [float(s.weight) for s in sources]
    shares = [w / sum(weights) for w in weights]
    expected = STRATEGIES[strategy](n / p for n, p in zip(sizes, shares))
    length = int(expected * 1.2) + 1000
    while True:
        draws = spark.range(length).withColumnRenamed("id", "draw")
        draws = draws.withColumn("source_no", draw_source("draw", weights, seed))
        stop = last_draw(draws, sizes, strategy)
        if stop is not None:
            break
        length *= 2

    copies = [max(1, -(-int((stop + 1) * p / n) // hot_rows)) for n, p in zip(sizes, shares)]
    size_of = F.element_at(F.array(*[F.lit(n).cast("long") for n in sizes]), F.col("source_no") + 1)
    copies_of = F.element_at(F.array(*[F.lit(c).cast("long") for c in copies]), F.col("source_no") + 1)
    counted = block_index(draws.where(F.col("draw") <= stop), "draw", ["source_no"], "_k", DRAW_BLOCK)
    wanted = counted.select(
        "draw", "source_no", F.pmod("_k", size_of).alias("pos"), F.pmod("draw", copies_of).alias("_salt")
    )
    offered = indexed
    if max(copies) > 1:
        salts = F.explode(F.sequence(F.lit(0).cast("long"), copies_of - 1))
        offered = indexed.withColumn("_salt", salts)
        joined = wanted.join(offered, ["source_no", "pos", "_salt"])
    else:
        joined = wanted.drop("_salt").join(offered, ["source_no", "pos"])
    return joined.drop("source_no", "pos", "_salt")


def mix_plan(
    df: DataFrame, per_device_batch: int, world_size: int = 1, interleave_batch_size: float | None = 0.0
) -> DataFrame:
    """One row: total rows, global batch, steps per epoch, interleave batch size and whether it fits."""
    global_batch = per_device_batch * world_size
    size = interleave_batch_size
    if size and size <= 1.0:
        size = global_batch * size
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows",
        F.lit(global_batch).cast("long").alias("global_batch_size"),
        (F.col("total_rows") / global_batch).alias("steps_per_epoch"),
        F.lit(None if size is None else float(size)).cast("double").alias("interleave_batch_size"),
        (F.col("total_rows") >= global_batch).alias("enough_rows"),
    )


def shard_rows(df: DataFrame, world_size: int, idx: str = "draw") -> DataFrame:
    """Contiguous shards by dense index; the first ``n mod world_size`` shards hold one row more."""
    n = df.agg(F.count(F.lit(1))).scalar()
    sized = df.withColumn("_n", n)
    quot, rest = F.expr(f"_n div {world_size}"), F.expr(f"_n % {world_size}")
    at = F.col(idx)
    longer = rest * (quot + 1)
    head = F.call_function("div", at, quot + 1)
    tail = rest + F.call_function("div", at - longer, F.greatest(quot, F.lit(1)))
    shard = F.when(at < longer, head).otherwise(tail)
    start = F.when(at < longer, F.col("shard") * (quot + 1)).otherwise(
        longer + (F.col("shard") - rest) * quot
    )
    return (
        sized.withColumn("shard", shard.cast("int"))
        .withColumn("shard_idx", at - start)
        .drop("_n")
    )


def write_shards(df: DataFrame, path: str, shard: str = "shard", rows_per_file: int = 1_000_000) -> None:
    """One directory per shard; large shards are spread over many tasks and files."""
    part = F.expr(f"shard_idx div {rows_per_file}")
    df.withColumn("_part", part).repartition(shard, "_part").drop("_part").write.partitionBy(shard).parquet(path)
