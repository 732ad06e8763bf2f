"""Cleaning, counting and record projection of the product catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.functions.keys import SEED, first_by_hash, ordered_index
from pairforge.functions.text import instruction_text
from pairforge.session import written

REQUIRED = ("description", "default_image", "master_category")
# Fixed values of the written records.
TASK_CATEGORY = "retrieval"
MIN_SUPPORT = 100


def drop_incomplete(df: DataFrame, required=REQUIRED) -> DataFrame:
    return df.na.drop(subset=list(required))


def category_distribution(df: DataFrame, category: str = "master_category") -> DataFrame:
    """Rows per category, largest first."""
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), category)


def min_support_filter(
    df: DataFrame, category: str = "master_category", min_support: int = MIN_SUPPORT
) -> DataFrame:
    """Keep the rows of categories with at least ``min_support`` rows.

    The kept categories are written first, so the semi join broadcasts them when their real size
    allows it and the wide rows are then filtered in place; a hot category causes no shuffle.
    """
    keep = df.groupBy(category).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_support)
    return df.join(written(keep.select(category), "categories"), category, "left_semi")


def clean(df: DataFrame, min_support: int = MIN_SUPPORT) -> DataFrame:
    return min_support_filter(drop_incomplete(df), min_support=min_support)


def image_universe(df: DataFrame, path: str = "default_image", id_col: str = "style_id") -> DataFrame:
    """Distinct image paths with the first id they occur under."""
    return df.groupBy(F.col(path).alias("path")).agg(F.min(id_col).alias("first_id"))


def strict_long(column: str):
    """Truncating cast that refuses missing ids instead of writing NULL."""
    return F.when(
        F.col(column).isNull(), F.raise_error(F.lit(f"{column} is missing")).cast("long")
    ).otherwise(F.col(column).cast("long"))


def train_records(df: DataFrame, strict: bool = True) -> DataFrame:
    style_id = strict_long("style_id") if strict else F.col("style_id").cast("long")
    return df.select(
        instruction_text("master_category").alias("instruction_text"),
        F.col("description").alias("query_text"),
        F.lit(None).cast("string").alias("query_image_path"),
        F.col("default_image").alias("target_image_path"),
        F.lit(TASK_CATEGORY).alias("task_category"),
        style_id.alias("style_id"),
    )


def split_summary(df: DataFrame, split: str = "split", category: str = "master_category") -> DataFrame:
    """Rows and share per split and category, with subtotals (category NULL) and total (both NULL)."""
    counts = df.rollup(split, category).agg(
        F.count(F.lit(1)).alias("n"),
        F.grouping_id().alias("level"),
    )
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("fraction", F.col("n") / total)


def _wanted(n) -> int | None:
    if isinstance(n, str):
        return int(n) if n.isdigit() else None
    return n


def row_cap(
    df: DataFrame,
    n: int | str | None,
    key: str,
    mode: str = "head",
    seed: int = SEED,
) -> DataFrame:
    """First ``n`` rows by key (train) or ``n`` random rows without replacement (eval).

    Digit strings are accepted, other strings and None mean no cap. A random cap compares hashes with
    the n-th smallest one. A head cap ranks the keys alone and compares every row with the n-th, so rows
    stay where they are; of the rows that share this key, only as many as fit are kept.
    """
    wanted = _wanted(n)
    if wanted is None:
        return df
    if mode == "random":
        return first_by_hash(df, wanted, [key], seed)
    head = ordered_index(df.select(key), [], key, out="_at").where(F.col("_at") < wanted)
    copies = head.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    last = copies.agg(F.max(F.struct(F.col(key).alias("at"), "_n")).alias("last")).first()["last"]
    if last is None:
        return df.limit(0)
    at = F.lit(last["at"]).cast(df.schema[key].dataType)
    before = F.lit(False) if last["at"] is None else F.col(key).isNull() | (F.col(key) < at)
    return df.where(before).unionByName(df.where(F.col(key).eqNullSafe(at)).limit(last["_n"]))
