"""Thin the members of each group to an evenly spaced or random subset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.functions.keys import HOT_ROWS, SEED, hash_index, ordered_index
from pairforge.session import written

KEEP_ALL = -1  # members with this label are never thinned


def on_even_grid(idx: Column, n: Column, m: Column) -> Column:
    """Whether ``idx`` is one of trunc(linspace(0, n - 1, m)), without building the grid.

    The grid point at idx, if any, is within one of idx / step, so three candidates decide it.
    """
    step = (n - 1).cast("double") / (m - 1)
    near = F.round(idx / step).cast("long")

    def hits(k: Column) -> Column:
        point = F.when(k == m - 1, n - 1).otherwise(F.floor(k * step))
        return (k >= 0) & (k < m) & (point == idx)

    return F.when(m <= 1, idx == 0).otherwise(hits(near - 1) | hits(near) | hits(near + 1))


def thin_groups(
    df: DataFrame,
    group: str,
    position: str,
    skip_ratio: float = 0.0,
    rand: bool = False,
    seed: int = SEED,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``retained``: max(1, n - round(n * skip_ratio)) members per group, halves to even.

    Label -1 and singletons are always kept. ``position`` orders the members and must be unique.
    """
    if rand:
        indexed = hash_index(df, [position], [group], seed=f"thin{seed}", out="_at")
    else:
        indexed = ordered_index(df, [group], position, "_at", hot_rows)
    sizes = written(df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")), "group_sizes")
    sized = indexed.join(sizes.withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g")))
    n = F.col("_n")
    keep = F.greatest(F.lit(1).cast("long"), n - F.bround(n * F.lit(float(skip_ratio))).cast("long"))
    chosen = F.col("_at") < keep if rand else on_even_grid(F.col("_at"), n, keep)
    retained = F.coalesce(F.col(group) == KEEP_ALL, F.lit(False)) | (n == 1) | chosen
    return sized.withColumn("retained", retained).select(*df.columns, "retained")
