"""Dense indexes: exact whatever the buckets, the hot-group threshold and the partitioning."""

import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pairforge.functions import keys as K
from pairforge.functions.joins import salted_lookup
from pairforge.session import scratch_scope, shared_dir


def _h(*parts, seed=42):
    return hashlib.md5("|".join([str(seed), *map(str, parts)]).encode()).hexdigest()


def test_hash_is_md5_of_the_joined_key(spark):
    row = spark.createDataFrame([(7, "x")], "a long, b string").select(
        K.hash_hex("a", "b").alias("h"), K.hash_long("a", digits=15).alias("n"), K.hash_hex(F.lit(None)).alias("z")
    ).first()
    assert row["h"] == _h(7, "x")
    assert row["n"] == int(_h(7)[:15], 16)
    assert row["z"] == _h("")


@pytest.mark.parametrize("partitions", [1, 7, 200])
def test_hash_index_equals_sorting(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(3000).withColumn("g", F.when(F.col("id") % 3 == 0, F.col("id") % 2))
        got = {(r["g"], r["id"]): r["idx"] for r in K.hash_index(df, ["id"], ["g"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert len(got) == 3000
    for group in (None, 0, 1):
        ids = sorted((i for g, i in got if g == group), key=lambda i: (_h(i), i))
        assert [got[group, i] for i in ids] == list(range(len(ids)))


@pytest.mark.parametrize("hot_rows", [10, 100, 10_000])
def test_ordered_index_with_a_hot_group(spark, hot_rows):
    rng = random.Random(3)
    rows = [("hot", f"k{rng.random():.9f}") for _ in range(1500)] + [(f"g{i % 40}", f"x{i:05d}") for i in range(600)]
    df = spark.createDataFrame(rows, "g string, k string").repartition(5)
    got = {}
    for r in K.ordered_index(df, ["g"], "k", hot_rows=hot_rows).collect():
        got.setdefault(r["g"], {})[r["k"]] = r["idx"]
    assert sum(map(len, got.values())) == len(rows)
    for members in got.values():
        assert [members[k] for k in sorted(members)] == list(range(len(members)))


def test_reserved_names_are_refused(spark):
    with pytest.raises(ValueError, match="reserved"):
        K.hash_index(spark.range(3).withColumn("_ix_key", F.lit(1)), ["id"])


def test_splitters_spread_a_hot_group(spark):
    df = spark.range(20_000).select(F.lit("all").alias("g"), F.format_string("%08d", "id").alias("k"))
    hot = K.hot_groups(df, ["g"], 1000)
    cuts = K.splitters(df, hot, ["g"], "k", hot_rows=1000).first()["_ix_splitters"]
    assert len(cuts) >= 15 and cuts == sorted(cuts)
    edges = ["", *cuts, "~"]
    keys = [f"{i:08d}" for i in range(20_000)]
    largest = max(sum(a <= k < b for k in keys) for a, b in zip(edges, edges[1:]))
    assert largest < 5000


def test_block_index_with_running_sum(spark):
    df = spark.range(1000).select((F.col("id") % 4).alias("g"), F.col("id").alias("p"), (F.col("id") % 7).alias("v"))
    out = K.block_index(df, "p", ["g"], block=16, running=F.col("v")).collect()
    for g in range(4):
        total = 0
        for i, r in enumerate(sorted((r for r in out if r["g"] == g), key=lambda r: r["p"])):
            assert (r["idx"], r["running"]) == (i, total)
            total += r["v"]


@pytest.mark.parametrize("n", [0, 1, 17, 499, 500, 900])
def test_first_by_hash(spark, n):
    got = sorted(r["id"] for r in K.first_by_hash(spark.range(500), n, ["id"], digits=1).collect())
    assert got == sorted(sorted(range(500), key=lambda i: _h(i))[:n])


def test_row_ids_are_unique_and_fixed(spark):
    df = K.with_row_id(spark.range(100).select(F.lit("copy").alias("x")).repartition(4))
    first, second = ([r["row_id"] for r in df.collect()] for _ in range(2))
    assert len(set(first)) == 100 and sorted(first) == sorted(second)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_lookup_equals_join(spark, how):
    rows = spark.range(1000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 90)).alias("k")
    )
    table = rows.where("k is not null and k <> 'k7'").groupBy("k").agg(F.max("id").alias("v"))
    got = salted_lookup(rows, table, "k", ["id"], how, hot_rows=20).select("id", "k", "v")
    want = rows.join(table, "k", how).select("id", "k", "v")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize("hot_rows", [1, 3, 10_000])
def test_hash_buckets_follow_the_row_count(spark, hot_rows):
    df = spark.range(5000)
    digits = df.limit(1).select(K.bucket_digits(df, hot_rows)).first()[0]
    assert digits == {1: 4, 3: 3, 10_000: 3}[hot_rows]
    got = {r["id"]: r["idx"] for r in K.hash_index(df, ["id"], hot_rows=hot_rows).collect()}
    assert got == {i: at for at, i in enumerate(sorted(range(5000), key=lambda i: (_h(i), i)))}
    assert spark.range(0).agg(K.bucket_digits(spark.range(0))).first()[0] == 3
    assert K.hash_index(spark.range(0), ["id"]).collect() == []


def test_more_than_256_splitters(spark):
    df = spark.range(12_000).select(F.when(F.col("id") % 4 > 0, "hot").alias("g"), F.format_string("%06d", "id").alias("k"))
    hot = K.hot_groups(df, ["g"], 20)
    cuts = {r["_ix_group"]["g"]: r["_ix_splitters"] for r in K.splitters(df, hot, ["g"], "k", hot_rows=20).collect()}
    assert set(cuts) == {None, "hot"} and len(cuts["hot"]) > 256
    steps = K._steps(K.splitters(df, hot, ["g"], "k", hot_rows=20)).where("_ix_group.g is not null")
    parts = df.where("g is not null").crossJoin(steps.drop("_ix_group")).select("k", K._part("k").alias("part"))
    assert all(r["part"] == sum(c <= r["k"] for c in cuts["hot"]) for r in parts.collect())
    got = {}
    for r in K.ordered_index(df, ["g"], "k", hot_rows=20).collect():
        got.setdefault(r["g"], {})[r["k"]] = r["idx"]
    for members in got.values():
        assert [members[k] for k in sorted(members)] == list(range(len(members)))


def test_row_ids_go_with_their_scope(spark):
    folder = Path(shared_dir(spark)) / "pairforge"
    before = set(folder.glob("row_ids-*"))
    with scratch_scope(spark):
        assert K.with_row_id(spark.range(10)).count() == 10
        assert len(set(folder.glob("row_ids-*")) - before) == 1
    assert set(folder.glob("row_ids-*")) == before
