"""Mixing, batching and scoring against plain Python and numpy."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairforge.operators import batching as B
from pairforge.operators import mixing as M
from pairforge.operators import retrieval as R


def _h(x, seed):
    return hashlib.md5(f"{seed}|{x}".encode()).hexdigest()


def _interleave(sizes, weights, strategy):
    """Draw by draw, as a loop."""
    names = list(sizes)
    total, bounds, acc = sum(weights), [], 0.0
    for w in weights:
        acc += w / total
        bounds.append(acc)
    rows = {n: sorted(range(sizes[n]), key=lambda i: _h(i, "order42")) for n in names}
    at, done, out, draw = dict.fromkeys(names, 0), dict.fromkeys(names, False), [], 0
    stop = any if strategy == "first_exhausted" else all
    while not stop(done.values()):
        u = int(_h(draw, "mix42")[:8], 16) / 2**32
        i = next((i for i, b in enumerate(bounds[:-1]) if u < b), len(names) - 1)
        n = names[i]
        out.append((draw, n, rows[n][at[n]]))
        at[n] += 1
        if at[n] >= sizes[n]:
            done[n], at[n] = True, 0
        draw += 1
    return out


@pytest.mark.parametrize("strategy", ["first_exhausted", "all_exhausted"])
@pytest.mark.parametrize("sizes,weights", [((40, 25, 60), (3, 2, 1)), ((1, 200), (5, 1)), ((7, 7), (0.1, 0.9))])
def test_interleave_equals_the_loop(spark, strategy, sizes, weights):
    named = {f"s{i}": n for i, n in enumerate(sizes)}
    sources = [
        M.Source(name, spark.range(n).withColumnRenamed("id", "k"), w) for (name, n), w in zip(named.items(), weights)
    ]
    for hot_rows in (10, 10**6):
        got = M.interleave(sources, "k", strategy, hot_rows=hot_rows).collect()
        want = _interleave(named, weights, strategy)
        assert sorted((r["draw"], r["global_dataset_name"], r["k"]) for r in got) == want


def test_one_source_and_bad_input(spark):
    rows = spark.range(9).withColumnRenamed("id", "k")
    got = M.interleave([M.Source("only", rows)], "k").collect()
    assert sorted(r["draw"] for r in got) == list(range(9))
    with pytest.raises(ValueError):
        M.interleave([M.Source("a", rows), M.Source("b", rows.limit(0))], "k")
    with pytest.raises(ValueError):
        M.interleave([M.Source("a", rows)], "k", strategy="never")


@pytest.mark.parametrize("n,world", [(10, 3), (2, 4), (12, 4), (1, 1), (101, 8)])
def test_shards(spark, n, world):
    rows = M.shard_rows(spark.range(n).withColumnRenamed("id", "draw"), world).collect()
    want = [(i, j) for i, part in enumerate(np.array_split(np.arange(n), world)) for j in range(len(part))]
    assert [(r["shard"], r["shard_idx"]) for r in sorted(rows, key=lambda r: r["draw"])] == want


@pytest.mark.parametrize("n,size", [(10, 3), (9, 3), (2, 5)])
def test_batches_and_chunks(spark, n, size):
    df = spark.range(n).withColumnRenamed("id", "draw")
    full = B.assign_batches(df, size).collect()
    assert len(full) == n - n % size
    batched = B.assign_batches(df, size, drop_last=False)
    chunks = B.collect_chunks(B.chunk_batches(batched, 2), ["draw"])
    assert all(len(r["members"]) <= 2 for r in chunks.collect())
    back = B.combine_chunks(chunks, 2)
    assert sorted(map(tuple, back.select("batch_id", "pos_in_batch", "draw").collect())) == \
        sorted(map(tuple, batched.select("batch_id", "pos_in_batch", "draw").collect()))


@pytest.mark.parametrize("batches,accum,epochs,max_steps", [(10, 4, 2.5, 0), (3, 4, 1, 0), (10, 3, 1, 7), (10, 3, 1, 6)])
def test_step_plan(spark, batches, accum, epochs, max_steps):
    df = spark.range(batches).withColumnRenamed("id", "batch_id")
    r = B.step_plan(df, accum, epochs, max_steps).first()
    updates = max(1, batches // accum)
    assert r["updates_per_epoch"] == updates
    if max_steps:
        assert (r["max_steps"], r["num_epochs"]) == (max_steps, max_steps // updates + (max_steps % updates > 0))
    else:
        assert (r["max_steps"], r["num_epochs"]) == (math.ceil(epochs * updates), math.ceil(epochs))
    for step in (0, 1, updates, 2 * updates + 1):
        p = B.resume_point(B.step_plan(df, accum), step, accum).first()
        assert tuple(p) == (step // updates, step % updates * accum)
        assert B.resume_point(B.step_plan(df, accum), step, accum, True).first()["batches_to_skip"] == 0


def test_padding_and_packing(spark):
    rows = [(0, 0, [5, 6, 7]), (0, 1, []), (0, 2, [8]), (1, 0, [9, 9])]
    df = spark.createDataFrame(rows, "batch_id long, pos_in_batch long, ids array<int>")
    padded = B.pad_batches(df, max_length=2, pad_id=0, bos_id=1)
    got = {(r["batch_id"], r["pos_in_batch"]): (r["input_ids"], r["attention_mask"]) for r in padded.collect()}
    assert got == {(0, 0): ([5, 6], [1, 1]), (0, 1): ([1, 0], [1, 0]), (0, 2): ([8, 0], [1, 0]), (1, 0): ([9, 9], [1, 1])}
    flat = sorted((r["flat_position"], r["packed_position"]) for r in B.packed_positions(padded).where("batch_id = 0").collect())
    mask = np.array([[1, 1], [1, 0], [1, 0]])
    assert [f for f, _ in flat] == np.flatnonzero(mask).tolist()
    assert [p for _, p in flat] == list(range(4))


def _cross_entropy(logits, labels):
    top = logits.max(axis=1, keepdims=True)
    lse = top[:, 0] + np.log(np.exp(logits - top).sum(axis=1))
    return lse - logits[np.arange(len(labels)), labels]


def _vectors(spark, vecs, batch=0):
    rows = [(batch, i, [float(x) for x in v]) for i, v in enumerate(vecs)]
    return spark.createDataFrame(rows, "batch_id long, pos long, vec array<float>")


@pytest.mark.parametrize("n,t,tile", [(1, 1, 4), (5, 1, 2), (9, 3, 4), (12, 2, 100)])
def test_in_batch_loss_by_tiles(spark, n, t, tile):
    rng = np.random.default_rng(n)
    x, y = rng.normal(size=(n, 8)).astype("f4"), rng.normal(size=(n * t, 8)).astype("f4")
    logits = (x.astype("f8") @ y.astype("f8").T) * 50
    labels = np.arange(n) * t
    got = R.in_batch_loss(_vectors(spark, x), _vectors(spark, y), tile=tile).orderBy("pos").collect()
    assert [r["label"] for r in got] == labels.tolist()
    assert [r["pred"] for r in got] == logits.argmax(axis=1).tolist()
    np.testing.assert_allclose([r["loss"] for r in got], _cross_entropy(logits, labels), rtol=1e-9, atol=1e-9)
    mean = R.batch_loss(R.in_batch_loss(_vectors(spark, x), _vectors(spark, y), tile=tile)).first()["loss"]
    assert mean == pytest.approx(_cross_entropy(logits, labels).mean())


def test_equal_scores_predict_the_first(spark):
    same = _vectors(spark, np.ones((6, 3)))
    for tile in (2, 100):
        assert {r["pred"] for r in R.in_batch_loss(same, same, tile=tile).collect()} == {0}


def test_global_loss_joins_the_shards(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(7, 4)), rng.normal(size=(7, 4))
    shard_of = [0, 0, 0, 1, 1, 2, 2]
    place = [0, 1, 2, 0, 1, 0, 1]

    def sharded(vecs):
        rows = [(0, s, p, [float(a) for a in v]) for s, p, v in zip(shard_of, place, vecs)]
        return spark.createDataFrame(rows, "step_id long, shard int, pos long, vec array<double>")

    got = R.global_batch_loss(sharded(x), sharded(y), scale=1.0, world_size=3).first()
    assert got["loss"] == pytest.approx(3 * _cross_entropy(x @ y.T, np.arange(7)).mean())


def test_routed_loss_gathers_shards(spark):
    rng = np.random.default_rng(9)
    sizes, t = (3, 2, 4), 2  # queries per shard of one step; the first of each goes its own way
    x = [rng.normal(size=(n, 5)) for n in sizes]
    y = [rng.normal(size=(n, t, 5)) for n in sizes]
    name = [["inbatch_contrastive"] + [R.GATHERED] * (n - 1) for n in sizes]
    queries = spark.createDataFrame(
        [(7, s, 10 - s, i, x[s][i].tolist(), name[s][i]) for s, n in enumerate(sizes) for i in range(n)],
        "step_id long, shard int, batch_id long, pos long, vec array<double>, loss_name string",
    )
    targets = spark.createDataFrame(
        [(10 - s, i * t + k, y[s][i, k].tolist()) for s, n in enumerate(sizes) for i in range(n) for k in range(t)],
        "batch_id long, pos long, vec array<double>",
    )
    rows = R.routed_loss(queries, targets, step="step_id").collect()
    got = {(r["batch_id"], r["pos"]): r for r in rows}
    assert len(rows) == sum(sizes)
    q = np.concatenate([a[1:] for a in x])
    d = np.concatenate([a[1:].reshape(-1, 5) for a in y])
    want = _cross_entropy(q @ d.T, np.arange(len(q)) * t)
    at = [(10 - s, i) for s, n in enumerate(sizes) for i in range(1, n)]
    assert [got[k]["loss"] for k in at] == pytest.approx(list(want))
    assert [got[k]["label"] for k in at] == [i * t for i in range(len(at))]
    for s in range(3):
        alone = _cross_entropy(x[s][:1] @ y[s][0].T, np.zeros(1, int))
        assert got[(10 - s, 0)]["loss"] == pytest.approx(alone[0])


def test_routed_loss_refuses_uneven_shards(spark):
    sizes, per_query = (2, 2), (1, 2)
    queries = spark.createDataFrame(
        [(7, s, s, i, [1.0, float(i)], R.GATHERED) for s, n in enumerate(sizes) for i in range(n)],
        "step_id long, shard int, batch_id long, pos long, vec array<double>, loss_name string",
    )
    targets = spark.createDataFrame(
        [(s, i, [1.0, float(i)]) for s, n in enumerate(sizes) for i in range(n * per_query[s])], "batch_id long, pos long, vec array<double>"
    )
    with pytest.raises(Exception, match="different numbers of targets per query in step 7"):
        R.routed_loss(queries, targets, step="step_id").collect()
    assert R.routed_loss(queries, targets).count() == 4  # every batch is a step of its own


def test_routed_loss(spark):
    rng = np.random.default_rng(8)
    n, t = 8, 3
    x, y = rng.normal(size=(n, 5)), rng.normal(size=(n, t, 5))
    name = np.array(["inbatch_contrastive" if i % 3 else "inexample_contrastive" for i in range(n)])
    queries = spark.createDataFrame(
        [(0, i, [float(a) for a in x[i]], str(name[i])) for i in range(n)], "batch_id long, pos long, vec array<double>, loss_name string"
    )
    targets = _vectors(spark, y.reshape(-1, 5)).withColumn("vec", F.col("vec").cast("array<double>"))
    y = np.array([r["vec"] for r in targets.orderBy("pos").collect()]).reshape(n, t, 5)
    scored = R.routed_loss(queries, targets)
    got = {r["pos"]: r for r in scored.collect()}
    total = 0.0
    for g in set(name):
        at = np.flatnonzero(name == g)
        if g == "inbatch_contrastive":
            logits, labels = x[at] @ y[at].reshape(-1, 5).T, np.arange(len(at)) * t
        else:
            logits, labels = np.einsum("qd,qkd->qk", x[at], y[at]), np.zeros(len(at), int)
        losses = _cross_entropy(logits, labels)
        total += losses.mean()
        for j, i in enumerate(at):
            assert (got[i]["label"], got[i]["pred"]) == (labels[j], logits[j].argmax())
            assert got[i]["loss"] == pytest.approx(losses[j])
    assert R.routed_total(scored).first()["loss"] == pytest.approx(total)


def test_accuracy_edges(spark):
    schema = "query_id long, predicted_index int, ground_truth_index int, num_candidates int"
    some = spark.createDataFrame([(1, 0, 0, 3), (2, 1, 0, 3), (3, None, 0, 0)], schema)
    assert tuple(R.ranking_accuracy(some).first()) == (0.5, 1, 2)
    assert tuple(R.ranking_accuracy(some.limit(0)).first()) == (0.0, 0, 0)
    assert R.expected_random_accuracy(some).first()[0] == pytest.approx(1 / 3)
    guesses = R.random_predictions(some.drop("predicted_index")).collect()
    assert all((g["predicted_index"] is None) == (g["num_candidates"] == 0) for g in guesses)


def test_pooling_and_zero_vectors(spark):
    rows = [(1, 0, 1, [3.0, 4.0]), (1, 1, 0, [9.0, 9.0]), (2, 0, 0, [1.0, 1.0]), (2, 1, 1, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "seq_id long, pos long, mask int, vec array<double>")
    got = {r["seq_id"]: r["rep"] for r in R.last_token_pooling(df, normalize=True).collect()}
    assert got == {1: [0.6, 0.8], 2: [0.0, 0.0]}
    with pytest.raises(NotImplementedError):
        R.last_token_pooling(df, pooling="mean")


def test_judgement_maps_are_cut_into_parts(spark):
    df = spark.range(25).select(F.lit("q").alias("query_id"), F.col("id").alias("corpus_id"), (F.col("id") - 4).cast("double").alias("score"))
    maps = [r["judgements"] for r in R.judgement_maps(df.unionByName(df), parts=3).collect()]
    assert len(maps) == 3
    assert R.judgement_maps(df).count() == 1
    assert {k: v for m in maps for k, v in m.items()} == {i: i - 4.0 for i in range(5, 25)}
