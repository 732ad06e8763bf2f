"""Configured sources to sharded training batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import pairforge.sources.pairs  # noqa: F401  (registers the built-in parser)
from pairforge.functions.keys import SEED
from pairforge.operators.batching import assign_batches
from pairforge.operators.mixing import Source, interleave, mix_plan, shard_rows
from pairforge.session import written
from pairforge.sources.registry import instantiate


def load_sources(spark: SparkSession, config: dict[str, dict]) -> list[Source]:
    """One source per entry ``name -> {dataset_parser, weight, ...parser settings}``."""
    out = []
    for name, entry in config.items():
        settings = {k: v for k, v in entry.items() if k != "weight"}
        settings.setdefault("subset_name", name)
        out.append(Source(name, instantiate(spark, **settings), float(entry.get("weight", 1.0))))
    return out


def training_feed(
    spark: SparkSession,
    config: dict[str, dict],
    per_device_batch: int,
    world_size: int = 1,
    key: str = "style_id",
    strategy: str = "all_exhausted",
    drop_last: bool = True,
    seed: int = SEED,
) -> DataFrame:
    """Rows of all sources with ``shard``, ``batch_id`` and ``pos_in_batch``.

    Rows are mixed by weight, cut into one contiguous shard per rank and batched within each shard. The
    mix is written once, because its size decides the shards. Fails when the sources hold fewer rows
    than one global batch.
    """
    sources = load_sources(spark, config)
    pooled = sources[0].rows.select(key)
    for s in sources[1:]:
        pooled = pooled.unionByName(s.rows.select(key))
    plan = mix_plan(pooled, per_device_batch, world_size).first()  # one row
    if not plan["enough_rows"]:
        raise ValueError(f"{plan['total_rows']} rows are fewer than one global batch of {plan['global_batch_size']}")
    mixed = written(interleave(sources, key, strategy, seed), "mixed")
    return assign_batches(shard_rows(mixed, world_size), per_device_batch, "shard_idx", drop_last, shard="shard")
