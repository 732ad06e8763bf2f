"""Built-in parser for pair files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.functions.text import full_query_text
from pairforge.operators.catalogue import row_cap
from pairforge.operators.retrieval import expand_candidates
from pairforge.sources.conform import tag
from pairforge.sources.files import read_jsonl
from pairforge.sources.registry import register
from pairforge.sources.schemas import record_schema


def prepare_pairs(records: DataFrame, split: str = "train", name: str | None = None) -> DataFrame:
    """Records as ``query_text, passage_text, passage_path`` rows: one per pair or per candidate."""
    if split != "train":
        rows = expand_candidates(records)
    else:
        rows = records.select(
            "style_id",
            full_query_text("instruction_text", "query_text").alias("query_text"),
            F.lit("").alias("passage_text"),
            F.col("target_image_path").alias("passage_path"),
        )
    return tag(rows, name)


@register("jsonl_pairs")
def jsonl_pairs(
    spark: SparkSession,
    jsonl_path: str,
    subset_name: str | None = None,
    dataset_split: str = "train",
    num_sample_per_subset: int | str | None = None,
    **_,
) -> DataFrame:
    """A JSON-lines file of records, capped (head for train, random for eval) and prepared.

    Lines that it cannot use are given by ``jsonl_pairs_quarantine``."""
    schema, required = record_schema(dataset_split)
    good, _bad = read_jsonl(spark, jsonl_path, schema, required)
    mode = "head" if dataset_split == "train" else "random"
    capped = row_cap(good, num_sample_per_subset, "style_id", mode)
    return prepare_pairs(capped, dataset_split, subset_name)


@register("jsonl_pairs_quarantine")
def jsonl_pairs_quarantine(
    spark: SparkSession, jsonl_path: str, subset_name: str | None = None, dataset_split: str = "train", **_
) -> DataFrame:
    """The lines that ``jsonl_pairs`` leaves out, with their file, line number and problem."""
    schema, required = record_schema(dataset_split)
    _good, bad = read_jsonl(spark, jsonl_path, schema, required, require_valid=False)
    return tag(bad, subset_name)
