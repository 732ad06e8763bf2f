"""Splits, negatives and candidate lists: quotas, invariants and edge cases."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairforge.operators import catalogue as C
from pairforge.operators import negatives as N
from pairforge.operators.splits import assign_splits, split_quotas
from pairforge.session import spread


def _catalogue(spark, n, categories=3, hot=False, images=None):
    cat = F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % categories)) if hot \
        else F.concat(F.lit("c"), F.col("id") % categories)
    return spark.range(n).select(
        F.col("id").alias("style_id"), F.lit("text").alias("description"),
        F.concat(F.lit("img/"), (F.col("id") % (images or n)).cast("string")).alias("default_image"),
        cat.alias("master_category"),
    )


def _apportion(sizes, target):
    total = sum(sizes.values())
    base = {c: n * target // total for c, n in sizes.items()}
    rest = sorted(sizes, key=lambda c: (-(sizes[c] * target % total), c))
    for c in rest[: target - sum(base.values())]:
        base[c] += 1
    return base


@pytest.mark.parametrize("n,categories,hot", [(1000, 3, False), (997, 7, False), (3001, 11, True)])
def test_quotas(spark, n, categories, hot):
    rows = assign_splits(_catalogue(spark, n, categories, hot), digits=1).collect()
    assert len(rows) == n and len({r["style_id"] for r in rows}) == n
    sizes = Counter(r["master_category"] for r in rows)
    hold = math.ceil(n / 5)
    test = math.ceil(hold / 2)
    train = _apportion(sizes, n - hold)
    held = {c: sizes[c] - train[c] for c in sizes}
    val = _apportion(held, hold - test)
    got = Counter((r["split"], r["master_category"]) for r in rows)
    for c in sizes:
        assert (got["train", c], got["val", c], got["test", c]) == (train[c], val[c], held[c] - val[c])


@pytest.mark.parametrize("stratify", [None, True])
def test_quotas_of_many_classes(spark, stratify):
    """40 classes, of which 7 may be ranked in one task: cut at splitters, the splits are the same."""
    df = _catalogue(spark, 1200, 40, True)
    want = {r["style_id"]: r["split"] for r in assign_splits(df, digits=1, stratify=stratify).collect()}
    got = {r["style_id"]: r["split"] for r in assign_splits(df, digits=1, stratify=stratify, hot_rows=7).collect()}
    assert got == want
    sizes = df.groupBy(F.col("master_category").alias("category")).agg(F.count(F.lit(1)).alias("n"))
    assert sorted(split_quotas(sizes, hot_rows=7).collect()) == sorted(split_quotas(sizes).collect())


def test_falls_back_to_a_random_split(spark):
    """A class with a single member cannot be stratified."""
    df = _catalogue(spark, 100).withColumn(
        "master_category", F.when(F.col("style_id") == 5, F.lit("rare")).otherwise(F.col("master_category"))
    )
    got = Counter(r["split"] for r in assign_splits(df).collect())
    assert got == {"train": 80, "val": 10, "test": 10}
    order = sorted(range(100), key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())
    train = {r["style_id"] for r in assign_splits(df).where("split = 'train'").collect()}
    assert train == set(order[:80])


@pytest.mark.parametrize("n", [0, 1, 2, 6])
def test_tiny_tables(spark, n):
    assert assign_splits(_catalogue(spark, max(n, 1), 1).limit(n)).count() == n


def test_split_does_not_depend_on_partitions(spark):
    df = _catalogue(spark, 500, 4)
    want = {r["style_id"]: r["split"] for r in assign_splits(df).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", 3)
    try:
        got = {r["style_id"]: r["split"] for r in assign_splits(df.repartition(13)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert got == want


@pytest.mark.parametrize("sampler", sorted(N.SAMPLERS))
@pytest.mark.parametrize("images,num", [(400, 25), (30, 25), (10, 25), (1, 5)])
def test_candidate_lists(spark, sampler, images, num):
    """Lists are distinct, hold the truth once at its index, and are complete unless images run out."""
    cat = _catalogue(spark, 400, 2, images=images)
    universe = N.index_universe(C.image_universe(cat))
    queries = cat.where("style_id % 4 = 0").withColumn(
        "split", F.when(F.col("style_id") % 8 == 0, "val").otherwise("test")
    )
    rows = N.mine_candidates(queries, universe, num, sampler).collect()
    assert len(rows) == 100
    wanted = min(num, images)
    for r in rows:
        paths = [c["path"] for c in r["candidate_targets"]]
        assert len(set(paths)) == len(paths)
        assert paths[r["ground_truth_index"]] == r["default_image"]
        if sampler != "rolling" or images >= num + N.WINDOW_MARGIN:
            assert len(paths) == wanted


def test_truth_outside_the_universe(spark):
    cat = _catalogue(spark, 60, 1)
    universe = N.index_universe(C.image_universe(cat))
    queries = cat.limit(5).withColumn("default_image", F.lit("elsewhere")).withColumn("split", F.lit("val"))
    for sampler in N.SAMPLERS.values():
        for r in sampler(queries, universe, 10).collect():
            assert len(set(r["negatives"])) == 10


def test_uniform_negatives_cover_the_universe(spark):
    cat = _catalogue(spark, 300, 1, images=50)
    universe = N.index_universe(C.image_universe(cat))
    found = N.uniform_negatives(cat, universe, 10).select(F.explode("negatives").alias("p")).groupBy("p").count()
    counts = [r["count"] for r in found.collect()]
    assert len(counts) == 50 and max(counts) < 3 * min(counts)


def _broadcast_keys(df):
    return re.findall(r"BroadcastHashJoin \[(\w+)#", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("images", [2000, 150_000])
def test_large_universes_are_not_broadcast(spark, images):
    """The files of 150,000 images are smaller than Spark's threshold, what the driver would hold of them is not bounded by it."""
    universe = N.index_universe(spark.range(images).select(F.concat(F.lit("img/"), F.col("id").cast("string")).alias("path")))
    queries = _catalogue(spark, 40, 1).withColumn("split", F.lit("val"))
    for found, key in ((N.uniform_negatives(queries, universe, 5), "idx"), (N.rolling_negatives(queries, universe, 5), "_window")):
        assert (key in _broadcast_keys(found)) == (images < 100_000)
        rows = found.collect()
        assert len(rows) == 40 and all(len(set(r["negatives"]) - {r["default_image"]}) == 5 for r in rows)


def test_every_subset_is_equally_likely(spark):
    """Seven positions, three of them: 35 sets and 42 ordered pairs, each as frequent as the next."""
    queries = spark.range(14_000).withColumnRenamed("id", "style_id")
    drawn = N.draw_subsets(queries, "style_id", F.lit(7).cast("long"), 3)
    lists = drawn.groupBy("style_id").agg(F.sort_array(F.collect_list(F.struct("_k", "idx"))).alias("at"))
    rows = [tuple(p["idx"] for p in r["at"]) for r in lists.collect()]
    assert len(rows) == 14_000 and all(len(set(r)) == 3 for r in rows)
    sets = Counter(frozenset(r) for r in rows)
    assert len(sets) == math.comb(7, 3) and max(sets.values()) < 480 and min(sets.values()) > 320
    pairs = Counter(r[:2] for r in rows)
    assert len(pairs) == 42 and max(pairs.values()) < 410 and min(pairs.values()) > 260


@pytest.mark.parametrize("size,n", [(1, 4), (12, 12), (30, 20), (400, 40), (10**12, 40)])
def test_subsets_equal_the_walk(spark, size, n):
    """Floyd's walk step by step, in plain Python: repeated numbers, chains of them, and lists without any."""
    def number(i, k, below):
        return int(hashlib.md5(f"floyd42|{i}|{k}".encode()).hexdigest()[:15], 16) % below

    drawn = N.draw_subsets(spark.range(60).withColumnRenamed("id", "style_id"), "style_id", F.lit(size).cast("long"), n)
    got = {}
    for r in sorted(drawn.collect(), key=lambda r: r["_k"]):
        got.setdefault(r["style_id"], []).append(r["idx"])
    for i in range(60):
        chosen, wanted = [], min(size, n)
        for k in range(wanted):
            t = number(i, k, size - wanted + k + 1)
            chosen.append(size - wanted + k if t in chosen else t)
        assert got[i] == sorted(chosen, key=lambda j: hashlib.md5(f"order42|{i}|{j}".encode()).hexdigest())


def test_subsets_are_drawn_once_and_in_many_tasks(spark):
    queries = spark.range(2000).selectExpr("id % 500 AS style_id")
    drawn = N.draw_subsets(queries, "style_id", F.lit(5000).cast("long"), 20)
    plan = drawn._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("floyd42") == 1 and plan.toString().count("order42") == 1
    tasks = spread(queries.distinct(), "style_id").select(F.spark_partition_id()).collect()
    assert len(set(tasks)) == 9


def test_subsets_of_small_universes(spark):
    queries = spark.range(50).withColumnRenamed("id", "style_id")
    for size, n in ((0, 3), (1, 3), (3, 3), (5, 3)):
        drawn = N.draw_subsets(queries, "style_id", F.lit(size).cast("long"), n).collect()
        got = Counter(r["style_id"] for r in drawn)
        assert set(got.values()) == ({min(size, n)} if size else set())
        assert all(0 <= r["idx"] < size for r in drawn)


def _cursor_windows(universe, n_queries, width):
    """The sequential rule: take the next window; wrap to the start when it would reach the end."""
    at, out = 0, []
    for _ in range(n_queries):
        start, end = at, at + width
        if end >= universe:
            start, end = 0, width
        out.append(start)
        at = end
    return out


@pytest.mark.parametrize("images", [20, 35, 69, 70, 71, 200])
def test_rolling_windows_equal_the_cursor(spark, images):
    n = 24
    width = n + N.WINDOW_MARGIN
    cat = _catalogue(spark, 40, 1, images=images if images <= 40 else None)
    universe = N.index_universe(
        spark.range(images).select(F.concat(F.lit("img/"), F.col("id").cast("string")).alias("path"))
    )
    order = {r["idx"]: r["path"] for r in universe.collect()}
    queries = cat.withColumn("split", F.when(F.col("style_id") % 3 == 0, "val").otherwise("test"))
    got = {r["style_id"]: r["negatives"] for r in N.rolling_negatives(queries, universe, n).collect()}
    truth = {r["style_id"]: r["default_image"] for r in queries.collect()}
    turn = sorted(got, key=lambda i: (i % 3 != 0, hashlib.md5(f"roll42|{i}".encode()).hexdigest()))
    for i, start in zip(turn, _cursor_windows(images, len(turn), width)):
        window = [order[j] for j in range(start, min(start + width, images))]
        assert got[i] == [p for p in window if p != truth[i]][:n]


@pytest.mark.parametrize("sampler", sorted(N.SAMPLERS))
def test_copies_of_an_id(spark, sampler):
    """Rows that share an id, a third of them one id, are neither lost nor multiplied, and lists stay distinct."""
    cat = _catalogue(spark, 900, 3).withColumn(
        "style_id", F.when(F.col("style_id") % 3 == 0, F.lit(0)).otherwise(F.col("style_id") % 250)
    )
    split = assign_splits(cat, digits=1)
    assert split.count() == 900
    assert split.groupBy("style_id", "master_category").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    universe = N.index_universe(C.image_universe(cat))
    queries = cat.withColumn("split", F.when(F.col("style_id") % 2 == 0, "val").otherwise("test"))
    mined = N.mine_candidates(queries, universe, 25, sampler)
    assert mined.count() == 900
    assert N.audit_candidates(mined, 25).count() == 0


def test_strict_ids(spark):
    df = _catalogue(spark, 3).withColumn("style_id", F.lit(None).cast("long"))
    assert C.train_records(df, strict=False).count() == 3
    with pytest.raises(Exception, match="style_id is missing"):
        C.train_records(df).collect()


def test_row_cap(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert sorted(r["k"] for r in C.row_cap(df, "7", "k").collect()) == list(range(7))
    assert C.row_cap(df, "seven", "k").count() == 100
    assert C.row_cap(df, None, "k").count() == 100
    assert C.row_cap(df, 1000, "k", mode="random").count() == 100
    assert C.row_cap(df, 30, "k", mode="random").distinct().count() == 30


def test_head_cap_with_ties_and_nulls(spark):
    df = spark.range(100).selectExpr("if(id < 3, null, id div 4) AS k", "id AS v").repartition(7)
    for n in (0, 1, 3, 4, 40, 41, 100, 200):
        kept = [r["k"] for r in C.row_cap(df, n, "k").collect()]
        want = sorted((r["k"] for r in df.collect()), key=lambda k: -1 if k is None else k)[:n]
        assert sorted(kept, key=lambda k: -1 if k is None else k) == want
    assert C.row_cap(df.where("v < 0"), 5, "k").count() == 0


def test_class_per_row_is_split_as_one_class(spark):
    df = spark.range(500).selectExpr("id AS style_id", "cast(id AS string) AS master_category")
    got = assign_splits(df)
    assert Counter(r["split"] for r in got.collect()) == {"train": 400, "val": 50, "test": 50}
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, assign_splits(df, stratify=False).collect()))
    assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()  # one row of cuts, not one per class


def test_empty_table_is_split(spark):
    assert assign_splits(spark.createDataFrame([], "style_id long, master_category string")).count() == 0


def test_support_counts_complete_rows_only(spark):
    rows = [(i, "d", "p" if i else None, "a") for i in range(10)] + [(i, "d", "p", "b") for i in range(10, 20)]
    df = spark.createDataFrame(rows, "style_id long, description string, default_image string, master_category string")
    assert {r["master_category"] for r in C.clean(df, 10).collect()} == {"b"}
    assert C.clean(df, 11).count() == 0


def test_audit_finds_overlap(spark):
    df = spark.createDataFrame([(1, "val"), (1, "test"), (2, "val"), (2, "val")], "style_id long, split string")
    assert [tuple(r) for r in N.audit_split_overlap(df).collect()] == [(1, "split_overlap")]
