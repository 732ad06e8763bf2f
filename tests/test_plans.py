"""The end-to-end plans: training feed and evaluation."""

import json

import numpy as np
import pytest

from pairforge.plans.evaluate import evaluate
from pairforge.plans.feed import training_feed
from pairforge.sources import schemas


def _pairs(path, lo, hi):
    path.write_text("\n".join(json.dumps({
        "instruction_text": "Find", "query_text": f"q{i}", "query_image_path": None, "target_image_path": f"{i}.jpg",
        "task_category": "retrieval", "style_id": i}) for i in range(lo, hi)))
    return {"dataset_parser": "jsonl_pairs", "jsonl_path": str(path), "dataset_split": "train", "weight": 1.0}


def test_training_feed(spark, tmp_path):
    config = {"a": _pairs(tmp_path / "a.jsonl", 0, 60), "b": {**_pairs(tmp_path / "b.jsonl", 100, 130), "weight": 0.5}}
    rows = training_feed(spark, config, per_device_batch=4, world_size=3).collect()
    assert {r["style_id"] for r in rows} <= {*range(60), *range(100, 130)}
    assert {r["global_dataset_name"] for r in rows} == {"a", "b"}
    by_batch = {}
    for r in rows:
        by_batch.setdefault((r["shard"], r["batch_id"]), []).append(r)
    assert {len(b) for b in by_batch.values()} == {4}
    for batch in by_batch.values():
        batch.sort(key=lambda r: r["pos_in_batch"])
        assert [r["draw"] for r in batch] == list(range(batch[0]["draw"], batch[0]["draw"] + 4))
    assert {s for s, _ in by_batch} == {0, 1, 2}
    everything = training_feed(spark, config, 4, 3, drop_last=False).collect()
    assert sorted(r["draw"] for r in everything) == list(range(len(everything)))
    assert len(everything) - len(rows) < 3 * 4
    with pytest.raises(ValueError, match="global batch"):
        training_feed(spark, config, per_device_batch=64, world_size=2)


def test_evaluate(spark):
    rng = np.random.default_rng(2)
    targets = {f"{i}.jpg": rng.normal(size=6) for i in range(20)}
    queries = {i: targets[f"{i}.jpg"] + rng.normal(size=6) * 0.7 for i in range(12)}
    lists = {i: [f"{j}.jpg" for j in rng.permutation([i, *(range(12, 12 + i % 5))])] for i in queries}
    rows = [("Find", "q", None, [{"type": "image", "path": p} for p in lists[i]], lists[i].index(f"{i}.jpg"), "retrieval", i)
            for i in queries]
    rows.append(("Find", "q", None, [], 0, "retrieval", 99))
    records = spark.createDataFrame(rows, schemas.EVAL)
    q = spark.createDataFrame([(i, v.tolist()) for i, v in queries.items()], "style_id long, vec array<double>")
    t = spark.createDataFrame([(p, v.tolist()) for p, v in targets.items()], "passage_path string, vec array<double>")
    got = evaluate(records, q, t).first()
    best = {i: max(lists[i], key=lambda p: queries[i] @ targets[p]) for i in queries}
    correct = sum(best[i] == f"{i}.jpg" for i in queries)
    assert (got["correct"], got["total"], got["accuracy"]) == (correct, 12, correct / 12)
    assert got["expected_random_accuracy"] == pytest.approx(np.mean([1 / len(c) for c in lists.values()]))
    assert 0 <= got["guessed_accuracy"] <= 1
    assert evaluate(records, q, t, max_samples=5).first()["total"] == 5
