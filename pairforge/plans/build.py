"""Catalogue to split files: the complete build."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pairforge.functions.keys import SEED
from pairforge.operators.catalogue import MIN_SUPPORT, drop_incomplete, image_universe, train_records
from pairforge.operators.negatives import (
    NUM_CANDIDATES,
    eval_records,
    index_universe,
    mine_candidates,
)
from pairforge.operators.splits import assign_splits, split_histogram
from pairforge.session import scratch_scope, written
from pairforge.sources.files import read_catalogue
from pairforge.sources.sinks import split_is_complete, split_manifest, write_split, write_splits

EVAL_SPLITS = ("val", "test")


def clean_and_split(
    catalogue: DataFrame, min_support: int = MIN_SUPPORT, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """The cleaned catalogue, and the same rows with their split.

    One histogram of classes and hash prefixes serves the support filter and the split quotas.
    """
    complete = drop_incomplete(catalogue)
    histogram = split_histogram(complete, seed=seed)
    support = histogram.groupBy("category").agg(F.sum("n").alias("total")).where(F.col("total") >= min_support)
    kept = written(support.select(F.col("category").alias("master_category")), "categories")
    cleaned = complete.join(kept, "master_category", "left_semi").select(*catalogue.columns)
    counted = histogram.join(kept.withColumnRenamed("master_category", "category"), "category", "left_semi")
    return cleaned, assign_splits(cleaned, seed=seed, histogram=counted)


def build_splits(
    catalogue: DataFrame,
    out: str,
    num_candidates: int = NUM_CANDIDATES,
    sampler: str = "uniform",
    min_support: int = MIN_SUPPORT,
    seed: int = SEED,
    skip: tuple[str, ...] = ("train",),
) -> DataFrame:
    """Clean, split, mine and write train, val and test; returns the manifest.

    Splits named in ``skip`` are left alone when they are already committed. The evaluation splits are
    mined and written in one pass.
    """
    spark = catalogue.sparkSession
    with scratch_scope(spark):
        rows = _write_splits(catalogue, out, num_candidates, sampler, min_support, seed, skip)
    return split_manifest(spark, out, rows=rows)


def _write_splits(catalogue, out, num_candidates, sampler, min_support, seed, skip) -> dict[str, int]:
    """Write the splits that are due; returns the rows written per split."""
    spark = catalogue.sparkSession
    cleaned, assigned = clean_and_split(catalogue, min_support, seed)
    # Rows are counted while they are written.
    rows, counted = {}, Observation()
    train = train_records(assigned.where("split = 'train'")).observe(counted, F.count(F.lit(1)).alias("train"))
    if write_split(train, out, "train", "train" in skip):
        rows |= counted.get
    due = [s for s in EVAL_SPLITS if not (s in skip and split_is_complete(spark, out, s))]
    if due:
        universe = index_universe(image_universe(cleaned), seed)
        queries = assigned.where(F.col("split").isin(*EVAL_SPLITS))
        mined = mine_candidates(queries, universe, num_candidates, sampler, seed)
        counted = Observation()
        records = eval_records(mined, keep=["split"]).observe(
            counted, *[F.count_if(F.col("split") == s).alias(s) for s in due]
        )
        write_splits(records, out, due)
        rows |= counted.get
    return rows


def build_from_csv(spark: SparkSession, path: str, out: str, sample_size: int | None = None,
                   multi_line: bool | str = True, **options) -> DataFrame:
    """Build from a CSV file, which is parsed once: the passes that follow read only their own columns of
    its complete rows."""
    catalogue = drop_incomplete(read_catalogue(spark, path, sample_size, multi_line=multi_line))
    with scratch_scope(spark):
        return build_splits(written(catalogue, "catalogue"), out, **options)
