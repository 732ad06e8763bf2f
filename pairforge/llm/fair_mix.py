"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its shuffled documents, repeated up to ``epochs`` times. A document's virtual finish
time is the words of its source up to and including it, divided by the source's target. All sources so reach
time 1 together; documents are taken in the order of finish time until the budget is used.

The shuffle order is a hash of the seed and the document, hence the same on every run. Running sums are taken per
hash bucket and per range of finish time, and bucket totals are added, so no source is sorted in one task. The
number of buckets follows the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.session import written

WEIGHTS = (5.0, 2.0, 1.0)
EPOCHS = 3
SEED = "fair-mix-1"
BUCKET_ROWS = 20_000  # rows that are sorted together


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    plain = F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    return F.when(F.coalesce(F.length(plain), F.lit(0)) == 0, 0).otherwise(F.size(F.split(plain, " +"))).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``(source, source_size, target)``: the total size shared by weight, at most ``epochs`` times a source's size.

    Sources in code-point order, null last, weigh ``weights`` in turn. The excess of capped sources goes to the others
    by weight: with the sources sorted by size per weight, the first that stays below its cap sets the common level.
    The table has one row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    turn = F.row_number().over(everything.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(turn, F.lit(len(weights))) + 1)
    listed = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * epochs)
    by_ratio = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before, onward = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    levels = listed.withColumn("level", level).withColumn("place", F.row_number().over(by_ratio))
    fits = F.col("level") <= F.col("cap") / F.col("weight")
    common = F.min(F.when(fits, F.struct("place", "level"))).over(everything)["level"]
    return levels.select(
        "source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * common).alias("target")
    )


def _running(rows: DataFrame, group: list[str], bucket: str, order: list[str], size: str, out: str) -> DataFrame:
    """Inclusive running sum of ``size`` in ``order`` within ``group``; ``bucket`` is monotone in the order.

    The window sorts one bucket at a time; the totals before a bucket come from the table of bucket totals."""
    own = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = rows.groupBy(*group, bucket).agg(F.sum(size).alias("_total"))
    upto = Window.partitionBy(*group, F.lit(0)).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_total").over(upto), F.lit(0))).drop("_total")
    local = rows.withColumn("_local", F.sum(size).over(own))
    return local.join(totals, [*group, bucket]).withColumn(out, F.col("_before") + F.col("_local")).drop("_before", "_local")


def _order(seed: str, text: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"), F.md5(text)))


def mix_plan(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: str = SEED,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``(doc_id, source, order, size, source_size, target, taken)``, one narrow row per row of ``docs``.

    ``taken`` is the words the mix takes of a row: its size times the number of times it is taken. Null and empty
    texts have size 0 and take nothing. Null is a source of its own. Rows that share id, source and text are taken
    together, one after the other. The sum of ``taken`` is the sum of sizes but for the documents at the cut.
    """
    narrow = written(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _order(seed, F.col("text")).alias("order")),
        "mix_sizes",
    )
    stats = narrow.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("budget")).first()
    buckets = max(16, -(-stats["n"] // bucket_rows))
    targets = written(source_targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs), "mix_targets")
    known = targets.select(F.struct("source").alias("group"), "source_size", "target")

    distinct = narrow.where("size > 0").groupBy("source", "order", "size").agg(F.count(F.lit(1)).alias("copies"))
    placed = distinct.select(
        F.struct("source").alias("group"), "order", "size", (F.col("size") * F.col("copies")).alias("total"),
        F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("long") * buckets / F.lit(float(1 << 32))).alias("bucket"),
    )
    queued = _running(placed, ["group"], "bucket", ["order", "size"], "total", "upto").join(known, "group")
    finish = F.try_divide((F.col("source_size") * F.col("epoch") + F.col("upto")).cast("double"), F.col("target"))
    turns = queued.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))).withColumn("finish", finish)
    turns = written(  # every queue that is not all taken passes time 1 at the cut
        turns.where("finish < 2").select("group", "order", "size", "total", "epoch", "finish", F.floor(F.col("finish") * buckets).alias("range")),
        "mix_turns",
    )
    served = _running(turns, [], "range", ["finish", "order", "epoch", "size"], "total", "served")
    key = F.struct(F.col("group.source").alias("source"), "order", "size")
    taken = served.where(F.col("served") <= stats["budget"]).groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("times"))
    rows = narrow.withColumn("key", F.struct("source", "order", "size")).withColumn("group", F.struct("source"))
    out = rows.join(taken, "key", "left").join(known, "group", "left")
    return out.select(
        "doc_id", "source", "order", "size", "source_size", "target",
        (F.col("size") * F.coalesce("times", F.lit(0))).alias("taken"),
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """``docs`` with all its columns, and ``size, source_size, target, taken`` in place of columns of these names.

    One row per input row; rows that the mix does not take have ``taken`` 0. See ``mix_plan``.
    """
    new = ["size", "source_size", "target", "taken"]
    plan = mix_plan(docs, weights, epochs, seed).select(F.struct("source", "order").alias("key"), *new).dropDuplicates(["key"])
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.struct("source", _order(seed, F.col("text")).alias("order")).alias("key"),
    )
    return rows.join(plan, "key").select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in new], *new)
