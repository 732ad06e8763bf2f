"""Stratified train/val/test assignment without moving the catalogue.

Rows are ordered by the hash of their id within each class. Instead of ranking every row, the exact
place of each cut is found: a histogram of (class, hash prefix) tells which bucket holds the last row
of a split, only those buckets are sorted, and the key of that last row becomes the cut. The final
pass compares every row's key with the cuts of its class, which is a map-side join with one row per
class. A class that holds a third of the catalogue is scanned in place like any other.
"""

from __future__ import annotations

from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.functions.keys import BUCKET_DIGITS, HOT_ROWS, SEED, hash_hex, ordered_index
from pairforge.session import written

VAL_RATIO = 0.1
TEST_RATIO = 0.1


def _ceil_share(count: str, share: Fraction) -> str:
    """SQL for ceil(count * share) in integers."""
    return f"(({count} * {share.numerator} + {share.denominator - 1}) div {share.denominator})"


def _apportion(classes: DataFrame, size: str, target: str, total: str, out: str, hot_rows: int | None) -> DataFrame:
    """Share ``target`` out over the classes in proportion to ``size`` by largest remainders.

    Products are decimals, so large classes do not overflow. Ties go to the first class by name. With ``hot_rows``, more
    classes than that are cut at splitters of their own order, so no task ranks them all.
    """
    product = f"(cast({size} as decimal(19,0)) * cast({target} as decimal(19,0)))"
    shared = classes.withColumn("_floor", F.expr(f"if({total} = 0, 0L, {product} div {total})")).withColumn(
        "_rest", F.expr(f"if({total} = 0, cast(0 as decimal(38,0)), {product} % {total})")
    )
    if hot_rows is None:
        whole = Window.partitionBy(F.lit(0))
        by_remainder = whole.orderBy(F.desc("_rest"), "category")
        placed = shared.withColumn("_left", F.col(target) - F.sum("_floor").over(whole)).withColumn(
            "_turn", F.row_number().over(by_remainder) - 1
        )
    else:
        order = F.struct((-F.col("_rest")).alias("rest"), "category")
        shared = written(shared.withColumn("_order", order), "class_shares")
        placed = ordered_index(shared, [], "_order", "_turn", hot_rows).drop("_order").withColumn(
            "_left", F.col(target) - shared.agg(F.sum("_floor")).scalar()
        )
    return placed.withColumn(out, F.col("_floor") + F.expr("if(_turn < _left, 1L, 0L)")).drop(
        "_floor", "_rest", "_left", "_turn"
    )


def _overall(table: DataFrame, hot_rows: int | None, **columns: Column) -> DataFrame:
    """Add aggregates over all classes: a window, or one row per aggregate when the classes are many."""
    if hot_rows is None:
        whole = Window.partitionBy(F.lit(0))
        return table.select("*", *[c.over(whole).alias(name) for name, c in columns.items()])
    table = written(table, "classes")
    return table.select("*", *[table.agg(c).scalar().alias(name) for name, c in columns.items()])


def split_quotas(
    class_sizes: DataFrame, val_ratio=VAL_RATIO, test_ratio=TEST_RATIO, stratify: bool | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Rows per class and split from a ``(category, n)`` table: one row per class.

    The held-out share is rounded up, then its test half is rounded up. ``stratify=None`` checks
    whether every class can be represented (two members, as many slots as classes, in both steps) and
    falls back to a random split over the whole table when it cannot; True and False force one way.
    Give ``hot_rows`` when one task could not sort all classes; the quotas are the same.
    """
    val, test = Fraction(str(val_ratio)), Fraction(str(test_ratio))
    q = (
        _overall(class_sizes, hot_rows, total=F.sum("n"), classes=F.count(F.lit(1)), smallest=F.min("n"))
        .withColumn("n_hold", F.expr(_ceil_share("total", val + test)))
        .withColumn("n_train", F.expr("total - n_hold"))
        .withColumn("n_test", F.expr(_ceil_share("n_hold", test / (val + test))))
        .withColumn("n_val", F.expr("n_hold - n_test"))
    )
    q = _apportion(q, "n", "n_train", "total", "train", hot_rows)
    q = q.withColumn("hold", F.expr("n - train"))
    q = _apportion(q, "hold", "n_val", "n_hold", "val", hot_rows)
    q = q.withColumn("test", F.expr("hold - val"))
    if stratify is None:
        q = _overall(q, hot_rows, smallest_hold=F.min("hold"))
        feasible = (
            (F.col("smallest") >= 2)
            & (F.col("smallest_hold") >= 2)
            & (F.least("n_train", "n_val", "n_test") >= F.col("classes"))
        )
    else:
        feasible = F.lit(stratify)
    return q.withColumn("stratified", feasible).select(
        "category", "n", "stratified", "train", "val", "test", "n_train", "n_val", "n_test"
    )


def _count_classes(histogram: DataFrame):
    """Rows, classes and the smallest class: one row, which reaches the driver."""
    sizes = histogram.groupBy("category").agg(F.sum("n").alias("n"))
    return sizes.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("classes"), F.min("n").alias("smallest")).first()


def _can_stratify(found, val_ratio, test_ratio) -> bool:
    """Whether all classes have two rows and no split has fewer rows than there are classes.

    Tables that fail, such as those with a class per row, are cut as one class and never rank their classes.
    """
    if not found["classes"]:
        return True
    val, test = Fraction(str(val_ratio)), Fraction(str(test_ratio))
    held = ceil(found["total"] * (val + test))
    n_test = ceil(held * test / (val + test))
    return found["smallest"] >= 2 and min(found["total"] - held, n_test, held - n_test) >= found["classes"]


def _class(category: str | None) -> Column:
    """The class of a row; without a class column all rows are one class."""
    return F.coalesce(F.col(category).cast("string"), F.lit("")) if category else F.lit("")


def _split_keys(df: DataFrame, id_col: str, category: str | None, seed: int, digits: int) -> DataFrame:
    return df.select(
        _class(category).alias("category"),
        F.struct(hash_hex(id_col, seed=seed).alias("h"), F.col(id_col).alias("id")).alias("key"),
    ).withColumn("bucket", F.substring("key.h", 1, digits))


def split_histogram(
    df: DataFrame, id_col: str = "style_id", category: str = "master_category", seed: int = SEED,
    digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Rows per class and hash prefix: at most 16 ** digits rows per class, written once."""
    keys = _split_keys(df, id_col, category, seed, digits)
    return written(keys.groupBy("category", "bucket").agg(F.count(F.lit(1)).alias("n")), "split_histogram")


def _split_cuts(df, histogram, id_col, category, val_ratio, test_ratio, stratify, seed, digits, hot_rows=None) -> DataFrame:
    """Per class, the (hash, id) key of the last train row and of the last train-or-val row."""
    keys = _split_keys(df, id_col, category, seed, digits)
    quotas = split_quotas(
        histogram.groupBy("category").agg(F.sum("n").alias("n")), val_ratio, test_ratio, stratify, hot_rows
    )
    # Without stratification all classes form one pool with the overall sizes.
    pooled = quotas.select(
        "category",
        F.expr("if(stratified, category, '')").alias("pool"),
        F.expr("if(stratified, train, n_train)").alias("last_train"),
        F.expr("if(stratified, train + val, n_train + n_val)").alias("last_val"),
    )
    # Where each pool's cuts fall: a bucket and the place of the last row within it.
    upto = Window.partitionBy("pool").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    places = (
        histogram.join(pooled, "category")
        .groupBy("pool", "bucket")
        .agg(F.sum("n").alias("n"), F.max("last_train").alias("train"), F.max("last_val").alias("val"))
        .withColumn("upto", F.sum("n").over(upto))
        .groupBy("pool")
        .agg(*[
            F.max(
                F.when(
                    (F.col(cut) > F.col("upto") - F.col("n")) & (F.col(cut) <= F.col("upto")),
                    F.struct("bucket", (F.col(cut) - F.col("upto") + F.col("n")).alias("local")),
                )
            ).alias(f"{cut}_at")
            for cut in ("train", "val")
        ])
    )
    classes = written(pooled.select("category", "pool").join(places, "pool"), "split_places")

    # Sort only the keys of those buckets, copies of an id counted first.
    at_cut = (
        keys.join(classes, "category")
        .where((F.col("bucket") == F.col("train_at.bucket")) | (F.col("bucket") == F.col("val_at.bucket")))
        .groupBy("pool", "bucket", "key")
        .agg(F.count(F.lit(1)).alias("n"), *[F.max(f"{cut}_at").alias(f"{cut}_at") for cut in ("train", "val")])
        .withColumn("upto", F.sum("n").over(
            Window.partitionBy("pool", "bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
        ))
    )
    cut_keys = at_cut.groupBy("pool").agg(*[
        F.max(
            F.when(
                (F.col("bucket") == F.col(f"{cut}_at.bucket")) & (F.col("upto") - F.col("n") < F.col(f"{cut}_at.local")),
                F.col("key"),
            )
        ).alias(f"{cut}_key")
        for cut in ("train", "val")
    ])
    return classes.join(cut_keys, "pool", "left").select(
        F.col("category").alias("_category"), "train_key", "val_key"
    )


def assign_splits(
    df: DataFrame,
    id_col: str = "style_id",
    category: str = "master_category",
    val_ratio=VAL_RATIO,
    test_ratio=TEST_RATIO,
    stratify: bool | None = None,
    seed: int = SEED,
    digits: int = BUCKET_DIGITS,
    histogram: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``split`` in {train, val, test}.

    Up to ``hot_rows`` classes are ranked in one task, more are not. Rows with the same id stay in one split; the quotas are exact when ids are unique. A histogram of the same rows from :func:`split_histogram` saves the first of three passes.
    """
    if histogram is None:
        histogram = split_histogram(df, id_col, category, seed, digits)
    many = False
    if stratify is not False:
        found = _count_classes(histogram)
        many = found["classes"] > hot_rows
        if stratify is None and not _can_stratify(found, val_ratio, test_ratio):
            stratify = False
    if stratify is False:
        category = None
        histogram = histogram.groupBy(F.lit("").alias("category"), "bucket").agg(F.sum("n").alias("n"))
    several = hot_rows if many and stratify is not False else None
    cuts = written(
        _split_cuts(df, histogram, id_col, category, val_ratio, test_ratio, stratify, seed, digits, several), "split_cuts"
    )
    key = F.struct(hash_hex(id_col, seed=seed).alias("h"), F.col(id_col).alias("id"))
    keyed = df.withColumn("_category", _class(category))
    split = (
        F.when(key <= F.col("train_key"), F.lit("train"))
        .when(key <= F.col("val_key"), F.lit("val"))
        .otherwise(F.lit("test"))
    )
    return keyed.join(cuts, "_category").withColumn("split", split).select(*df.columns, "split")
