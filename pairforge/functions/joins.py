"""Lookups that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.functions.keys import HOT_ROWS
from pairforge.session import written

BROADCAST_ROWS = 100_000


def bounded_broadcast(table: DataFrame, counted: DataFrame | None = None, max_rows: int | None = None) -> DataFrame:
    """``table`` for the small side of a join: with more than ``max_rows`` rows it is never broadcast.

    Spark compares the size of files with its threshold, and packed paths and indexes are a tenth of what the driver holds
    to broadcast them. ``counted`` names a written table with the rows to count, if ``table`` itself is dear to count.
    """
    n = (table if counted is None else counted).count()
    return table.hint("merge") if n > (BROADCAST_ROWS if max_rows is None else max_rows) else table


def salted_lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    salt_by: list[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    count_in: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` with a ``table`` that has one row per key.

    Keys with more than ``hot_rows`` rows are counted first; their rows are spread over n / hot_rows
    salts and only their table rows are repeated. All other keys join as usual. ``salt_by`` are columns
    that tell the rows of one key apart. When ``rows`` is itself the result of a join, ``count_in`` names
    a cheaper table with the same number of rows per key.
    """
    counts = (rows if count_in is None else count_in).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    hot = written(
        counts.where(F.col(key).isNotNull()).select(key, F.ceil(F.col("_n") / hot_rows).alias("_salts")),
        "hot_keys",
    )
    salts = F.coalesce(F.col("_salts"), F.lit(1).cast("long"))
    spread = rows.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*salt_by), salts))
    repeated = table.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))
    )
    return spread.drop("_salts").join(repeated.drop("_salts"), [key, "_salt"], how).drop("_salt")
