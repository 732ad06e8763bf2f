"""Portable hashes, and dense indexes that never sort a whole group in one task.

Every index here is computed per *bucket*: rows are counted per bucket (a map-side combined
aggregate), the counts are summed into bucket offsets, and only the rows of one bucket are sorted
together. How the buckets are made decides the bound:

* hash order: a bucket is a prefix of the hash of a unique id, so buckets are even whatever the data
  looks like; the prefix grows with the row count, so a bucket stays below ``hot_rows`` rows;
* a natural order: groups above ``hot_rows`` are cut at splitters taken from a hash-chosen subset of
  their own keys, one per ``hot_rows`` rows, so a group that holds a third of the table still spreads over
  many tasks. The splitters only balance the work, the index is exact.

Ids must be unique. ``with_row_id`` makes them so for sources without a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.session import written

SEED = 42
BUCKET_DIGITS = 3  # hex digits of the hash at least: 4096 buckets
HOT_ROWS = 1_000_000

def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_hex(*cols, seed: int | str = SEED) -> Column:
    """md5 of ``seed|col|col...`` as 32 hex digits: equal across engines, partitionings and retries."""
    parts = [F.lit(str(seed))]
    for c in cols:
        parts += [F.lit("|"), F.coalesce(_col(c).cast("string"), F.lit(""))]
    return F.md5(F.concat(*parts))


def hex_to_long(hex_col: Column, digits: int = 15, start: int = 1) -> Column:
    return F.conv(F.substring(hex_col, start, digits), 16, 10).cast("long")


def hash_long(*cols, seed: int | str = SEED, digits: int = 15) -> Column:
    """Non-negative integer from the first ``digits`` hex digits of the hash."""
    return hex_to_long(hash_hex(*cols, seed=seed), digits)


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """A unique id for rows without one, fixed by a written table so retries cannot change it.

    The table lies below the shared folder; ``session.scratch_scope`` drops it with the job that needed it."""
    return written(df.withColumn(name, F.monotonically_increasing_id()), "row_ids")


def bucketed_index(
    df: DataFrame,
    bucket: Column,
    order_by: Sequence[Column | str],
    group_by: Sequence[str] = (),
    out: str = "idx",
    running: Column | None = None,
    running_out: str = "running",
) -> DataFrame:
    """Zero-based dense index in ``order_by`` order within ``group_by``.

    ``bucket`` must be monotone in the order. With ``running``, also the exclusive running sum of that
    expression. The row side is exchanged once: the window and the offset join share one key.
    """
    # A struct key equates NULL groups with each other, unlike a plain equi-join.
    clash = [c for c in df.columns if c.startswith(("_ix_key", "_ix_group", "_ix_bucket"))]
    if clash:
        raise ValueError(f"reserved column names: {clash}")
    keyed = df.withColumn("_ix_group", _grouping(group_by))
    keyed = keyed.withColumn("_ix_bucket", bucket)
    keyed = keyed.withColumn("_ix_key", F.struct("_ix_group", "_ix_bucket"))
    within = Window.partitionBy("_ix_key").orderBy(*order_by)
    ranked = keyed.withColumn("_ix_rank", F.row_number().over(within).cast("long") - 1)

    sizes = keyed.groupBy("_ix_key").agg(
        F.count(F.lit(1)).alias("_ix_n"),
        *([F.sum(running).alias("_ix_total")] if running is not None else []),
    )
    before = (
        Window.partitionBy(F.col("_ix_key._ix_group"))
        .orderBy(F.col("_ix_key._ix_bucket"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select("_ix_key", F.coalesce(F.sum("_ix_n").over(before), F.lit(0)).alias("_ix_offset"),
                           *([F.coalesce(F.sum("_ix_total").over(before), F.lit(0)).alias("_ix_base")]
                             if running is not None else []))
    if running is not None:
        earlier = within.rowsBetween(Window.unboundedPreceding, -1)
        ranked = ranked.withColumn("_ix_local", F.coalesce(F.sum(running).over(earlier), F.lit(0)))
    joined = ranked.join(offsets, "_ix_key")
    result = [*df.columns, (F.col("_ix_offset") + F.col("_ix_rank")).alias(out)]
    if running is not None:
        result.append((F.col("_ix_base") + F.col("_ix_local")).alias(running_out))
    return joined.select(*result)


def bucket_digits(df: DataFrame, hot_rows: int = HOT_ROWS) -> Column:
    """Hex digits that keep a bucket of hashes near ``hot_rows`` rows: a subquery that counts ``df`` when it is used."""
    n = df.agg(F.count(F.lit(1))).scalar()
    return F.greatest(F.lit(BUCKET_DIGITS), F.ceil(F.log(16.0, n / F.lit(hot_rows))).cast("int"))


def hash_index(
    df: DataFrame,
    id_cols: Sequence[str],
    group_by: Sequence[str] = (),
    seed: int | str = SEED,
    out: str = "idx",
    digits: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Dense index in hash order of a unique id: a reproducible shuffle. ``digits`` fixes the number of buckets, which
    otherwise follows the row count; the index is the same."""
    length = bucket_digits(df, hot_rows) if digits is None else F.lit(digits)
    hashed = df.withColumn("_ix_hash", hash_hex(*id_cols, seed=seed))
    indexed = bucketed_index(
        hashed, F.substring("_ix_hash", F.lit(1), length), ["_ix_hash", *id_cols], group_by, out
    )
    return indexed.drop("_ix_hash")


def block_index(
    df: DataFrame,
    position: str,
    group_by: Sequence[str] = (),
    out: str = "idx",
    block: int = 1 << 20,
    running: Column | None = None,
    running_out: str = "running",
) -> DataFrame:
    """Dense index by a position that is unique and non-negative; a bucket holds at most ``block`` rows."""
    bucket = F.expr(f"`{position}` div {block}")
    return bucketed_index(df, bucket, [position], group_by, out, running, running_out)


def _grouping(group_by: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in group_by], F.lit(0).alias("_ix_all")).alias("_ix_group")


def hot_groups(df: DataFrame, group_by: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Groups with more than ``hot_rows`` rows; at most rows / hot_rows of them."""
    counts = df.select(_grouping(group_by)).groupBy("_ix_group").agg(F.count(F.lit(1)).alias("_ix_n"))
    return written(counts.where(F.col("_ix_n") > hot_rows), "hot_groups")


def splitters(
    df: DataFrame, hot: DataFrame, group_by: Sequence[str], key: str, hot_rows: int = HOT_ROWS, seed: int = SEED
) -> DataFrame:
    """Cut points for the hot groups.

    A group of n rows gets n / hot_rows cut points out of about 32 times as many keys, chosen by hash.
    Only those keys are sorted, so no task sees the whole group. All cut points together are as many as
    the table has millions of rows (at the default), and reach the rows by one join on the group.
    """
    wanted = hot.withColumn("_ix_cuts", F.ceil(F.col("_ix_n") / hot_rows))
    chance = F.col("_ix_cuts") * 32 / F.col("_ix_n") * float(1 << 32)
    keys = df.select(_grouping(group_by), F.col(key).alias("_ix_cut"))
    chosen = keys.join(wanted, "_ix_group").where(hash_long("_ix_cut", seed=f"cut{seed}", digits=8) < chance)
    by_key = Window.partitionBy("_ix_group").orderBy("_ix_cut")
    return (
        chosen.withColumn("_ix_at", F.row_number().over(by_key))
        .where(F.col("_ix_at") % 32 == 0)
        .groupBy("_ix_group")
        .agg(F.sort_array(F.collect_list("_ix_cut")).alias("_ix_splitters"))
    )


def _steps(cuts: DataFrame) -> DataFrame:
    """Every ``_ix_step``-th splitter of a group, about the square root of their number, as ``_ix_heads``."""
    stepped = cuts.withColumn("_ix_step", F.ceil(F.sqrt(F.size("_ix_splitters"))).cast("int"))
    return stepped.withColumn("_ix_heads", F.expr("filter(_ix_splitters, (s, i) -> i % _ix_step = 0)"))


def _part(key: str) -> Column:
    """Number of splitters up to the key. The heads tell the run of splitters that it falls into, so a row is compared with
    about twice the square root of their number."""
    upto = lambda cuts: F.size(F.filter(cuts, lambda s: s <= F.col(key)))
    skipped = F.greatest(upto("_ix_heads") - 1, F.lit(0)) * F.col("_ix_step")
    inside = upto(F.slice("_ix_splitters", skipped + 1, F.col("_ix_step")))
    return F.when(F.col("_ix_step").isNull(), 0).otherwise(skipped + inside)


def ordered_index(
    df: DataFrame,
    group_by: Sequence[str],
    key: str,
    out: str = "idx",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Dense index by any orderable key that is unique within its group.

    Without hot groups this is a plain window over the groups.
    """
    hot = hot_groups(df, group_by, hot_rows)
    grouped = df.withColumn("_ix_group", _grouping(group_by))
    if hot.isEmpty():
        within = Window.partitionBy("_ix_group").orderBy(key)
        return grouped.withColumn(out, F.row_number().over(within).cast("long") - 1).drop("_ix_group")
    cuts = written(_steps(splitters(df, hot, group_by, key, hot_rows)), "splitters")
    located = grouped.join(cuts, "_ix_group", "left").withColumn("_ix_part", _part(key))
    located = located.select(*df.columns, "_ix_part")
    return bucketed_index(located, F.col("_ix_part"), [key], group_by, out).drop("_ix_part")


def first_by_hash(
    df: DataFrame, n: int, id_cols: Sequence[str], seed: int | str = SEED, digits: int | None = None
) -> DataFrame:
    """The ``n`` rows with the smallest hash, without sorting or moving the table.

    A histogram over hash prefixes says which bucket holds the n-th row; only that bucket is sorted to
    find the n-th key, and the rows are kept by comparing with it. Copies of an id stay together.
    """
    if n <= 0:
        return df.limit(0)
    key = F.struct(hash_hex(*id_cols, seed=seed).alias("h"), *[F.col(c) for c in id_cols])
    length = bucket_digits(df) if digits is None else F.lit(digits)
    keys = df.select(key.alias("_ix_key")).withColumn("_ix_bucket", F.substring("_ix_key.h", F.lit(1), length))
    sizes = keys.groupBy("_ix_bucket").agg(F.count(F.lit(1)).alias("_ix_n"))
    upto = Window.partitionBy(F.lit(0)).orderBy("_ix_bucket").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        sizes.withColumn("_ix_upto", F.sum("_ix_n").over(upto))
        .where((F.col("_ix_upto") >= n) & (F.col("_ix_upto") - F.col("_ix_n") < n))
        .select("_ix_bucket", (F.lit(n) - F.col("_ix_upto") + F.col("_ix_n")).alias("_ix_local"))
    )
    in_bucket = (
        Window.partitionBy("_ix_bucket").orderBy("_ix_key").rowsBetween(Window.unboundedPreceding, 0)
    )
    last = (
        keys.join(F.broadcast(cut), "_ix_bucket")  # at most one row
        .groupBy("_ix_bucket", "_ix_key")
        .agg(F.count(F.lit(1)).alias("_ix_n"), F.max("_ix_local").alias("_ix_local"))
        .withColumn("_ix_upto", F.sum("_ix_n").over(in_bucket))
        .where(F.col("_ix_upto") - F.col("_ix_n") < F.col("_ix_local"))
        .agg(F.max("_ix_key").alias("_ix_last"))  # one row, NULL when the table has fewer than n
    )
    kept = df.withColumn("_ix_key", key).withColumn("_ix_last", last.scalar())
    return kept.where(F.col("_ix_last").isNull() | (F.col("_ix_key") <= F.col("_ix_last"))).drop("_ix_key", "_ix_last")
