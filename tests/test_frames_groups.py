"""Frames, thinning, components."""

import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairforge.operators import frames as V
from pairforge.operators.components import connected_components, merge_components
from pairforge.operators.thinning import on_even_grid, thin_groups
from pairforge.session import shared_dir


def _natural(name):
    return [int(p) if p.isdigit() else p.lower() for p in re.split(r"(\d+)", name)]


def _frames(spark, names, video="v"):
    return spark.createDataFrame([(video, f"{video}/{n}") for n in names], "video_id string, frame_path string")


def test_natural_order(spark):
    rng = random.Random(1)
    pool = ["a", "B", "fr", "frame", "frame_", ".", "-", "1", "01", "2", "10", "007", "0", "99999999999999999999"]
    names = {"".join(rng.choice(pool) for _ in range(rng.randint(1, 5))) + ".jpg" for _ in range(800)}
    names |= {"frame.jpg", "frame1.jpg", "frame10.jpg", "frame2.jpg", "A.jpg", "a.jpg"}
    listed = V.list_frames(_frames(spark, names).repartition(4), hot_rows=50).orderBy("frame_no").collect()
    got = [r["frame_path"][2:] for r in listed]
    kept = [n for n in names if re.match(r"\.*[^.].*\.jpg$", n)]
    assert [_natural(n) for n in got] == sorted(map(_natural, kept))
    assert [r["frame_no"] for r in listed] == list(range(len(kept)))


def test_only_images_and_predicate(spark):
    names = ["a.jpg", "b.JPEG", "c.png", "d.txt", "e.jpg.tmp", ".jpg", "f.PNG"]
    paths = [r["frame_path"] for r in V.list_frames(_frames(spark, names)).orderBy("frame_no").collect()]
    assert paths == ["v/a.jpg", "v/b.JPEG", "v/c.png", "v/f.PNG"]
    assert V.list_frames(_frames(spark, names), predicate=lambda n: n.startswith("a")).count() == 1
    assert V.list_frames(_frames(spark, ["x.txt"])).count() == 0


@pytest.mark.parametrize("n", [1, 2, 9, 100])
@pytest.mark.parametrize("segments", [1, 2, 7, 150])
def test_even_sampling(spark, n, segments):
    listing = V.list_frames(_frames(spark, [f"f{i}.jpg" for i in range(n)]))
    got = [r["frame_no"] for r in V.sample_frames(listing, segments).orderBy("slot").collect()]
    assert got == np.linspace(0, n - 1, segments, dtype=int).tolist()
    capped = [r["frame_no"] for r in V.capped_frames(listing, segments).orderBy("slot").collect()]
    assert capped == (got if segments <= n else list(range(n)))


def test_capped_limits(spark):
    listing = V.list_frames(_frames(spark, ["a1.jpg", "a2.jpg"]))
    assert V.capped_frames(listing, 0).count() == 0
    assert V.capped_frames(listing, None).count() == 2


def test_stride_and_crop(spark):
    counts = spark.createDataFrame([(f"v{n}", n) for n in (1, 5, 10, 33, 100)], "video_id string, n_frames long")
    plan = {}
    for r in V.stride_plan(counts, 10).orderBy("video_id", "slot").collect():
        plan.setdefault(r["video_id"], []).append(r["frame_no"])
    for n in (1, 5, 10, 33, 100):
        assert plan[f"v{n}"] == (list(range(n)) if n <= 10 else [int(i * (n / 10)) for i in range(10)])
    for r in V.temporal_crop_plan(counts, 8, 4).collect():
        n, size = r["n_frames"], 32
        assert 0 <= r["start_no"] <= max(0, n - size - 1)
        assert r["end_no"] == min(r["start_no"] + size, n)
        assert r["too_short"] == (r["end_no"] - r["start_no"] < 8)
        if not r["too_short"]:
            assert r["_points"] == np.linspace(r["start_no"], r["end_no"] - 1, 8, dtype=int).tolist()


def test_even_grid_without_building_it(spark):
    cases = [(n, m) for n in (2, 3, 10, 97, 300) for m in range(1, n + 1, max(1, n // 23))]
    df = spark.createDataFrame(cases, "n long, m long").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    kept = {}
    for r in df.where(on_even_grid(F.col("i"), F.col("n"), F.col("m"))).collect():
        kept.setdefault((r["n"], r["m"]), set()).add(r["i"])
    for n, m in cases:
        assert kept[n, m] == set(np.linspace(0, n - 1, m, dtype=int).tolist()), (n, m)


def _thin(groups, ratio):
    keep = [g == -1 for g in groups]
    for g in set(groups) - {-1}:
        at = [i for i, x in enumerate(groups) if x == g]
        m = max(1, len(at) - int(round(len(at) * ratio)))
        for j in np.linspace(0, len(at) - 1, m, dtype=int) if len(at) > 1 else [0]:
            keep[at[j]] = True
    return keep


@pytest.mark.parametrize("ratio", [0.0, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("hot_rows", [20, 10**6])
def test_thinning(spark, ratio, hot_rows):
    rng = random.Random(5)
    groups = [rng.choice([-1, 0, 0, 0, 1, 2]) for _ in range(300)] + [77]
    df = spark.createDataFrame(list(enumerate(groups)), "pos long, grp long")
    got = thin_groups(df, "grp", "pos", ratio, hot_rows=hot_rows).orderBy("pos").collect()
    assert [r["retained"] for r in got] == _thin(groups, ratio)
    loose = thin_groups(df, "grp", "pos", ratio, rand=True).groupBy("grp").agg(F.count_if("retained").alias("n")).collect()
    for r in loose:
        n = groups.count(r["grp"])
        assert r["n"] == (n if r["grp"] == -1 else max(1, n - int(round(n * ratio))))


def _roots(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("shape", ["path", "star", "random", "loops", "empty"])
def test_components(spark, shape):
    rng = random.Random(11)
    edges = {
        "path": [(i, i + 1) for i in range(300)],
        "star": [(500, i) for i in range(400)],
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(250)],
        "loops": [(1, 1), (2, 3), (3, 2), (2, 3), (9, 9)],
        "empty": [],
    }[shape]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == _roots(edges)


def test_components_drop_finished_rounds(spark):
    folder = Path(shared_dir(spark)) / "pairforge"
    before = set(folder.glob("stars-*"))
    found = connected_components(spark.createDataFrame([(i, i + 1) for i in range(100)], "src long, dst long"))
    assert len(set(folder.glob("stars-*")) - before) == 1
    assert found.where("component <> 0").isEmpty() and found.count() == 101


def test_components_take_new_edges(spark):
    """After each delivery the table equals a full computation over all edges so far."""
    import random

    rng = random.Random(4)
    known, so_far = spark.createDataFrame([], "node long, component long"), []
    for size in (12, 0, 15, 40):
        new = [(rng.randint(0, 60), rng.choice([None, *range(60)])) for _ in range(size)]
        so_far += new
        known = merge_components(known, spark.createDataFrame(new, "src long, dst long")).checkpoint()
        full = connected_components(spark.createDataFrame(so_far, "src long, dst long"))
        assert sorted(map(tuple, known.select("node", "component").collect())) == sorted(map(tuple, full.collect()))
