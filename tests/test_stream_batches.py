"""Batches of a stream, repeated deliveries and prepared batches."""

import random

import pytest
from pyspark.sql import functions as F

from pairforge.operators.batching import assign_batches
from pairforge.sources import images
from pairforge.streaming import batches, dedupe

ROWS = "idx long, name string, shard long"


@pytest.mark.parametrize("files, per_trigger, restart", [(1, 1, False), (9, 2, False), (9, 4, True)])
def test_stream_equals_the_table_for_any_split(spark, tmp_path, files, per_trigger, restart):
    rng = random.Random(files + per_trigger)
    lengths = {0: 23, 1: 0, 2: 7, 3: 4}
    rows = [(i, rng.choice([None, "", "é", "x" * 50]), s) for s, n in lengths.items() for i in range(n)]
    cuts = sorted(rng.randint(0, 24) for _ in range(files - 1))
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", per_trigger).parquet(source)
        batches.run_stream_batches(stream, target, state, 5, "idx", "shard").awaitTermination()

    for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, 24])):
        part = [r for r in rows if a <= r[0] < b]
        rng.shuffle(part)
        spark.createDataFrame(part, ROWS).coalesce(1).write.mode("append").parquet(source)
        if restart and k % 3 == 1:
            run()
    run()
    run()  # nothing new: nothing is given out again
    got = spark.read.parquet(target)
    want = assign_batches(spark.createDataFrame(rows, ROWS), 5, "idx", True, "shard").select(got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() == 20 + 5


def test_repeated_deliveries_land_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "id long, text string, at timestamp"

    def deliver(*rows):
        spark.createDataFrame([(i, t, None) for i, t, _ in rows], "id long, text string, none string").select(
            "id", "text", F.lit(rows[0][2]).cast("timestamp").alias("at")).coalesce(1).write.mode("append").parquet(source)
        stream = dedupe.first_deliveries(spark.readStream.schema(schema).parquet(source), ["id"], "at", "1 hour")
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
        return sorted((r["id"], r["text"]) for r in spark.read.parquet(target).collect())

    assert deliver((1, "a", "2024-01-01 10:00"), (1, "a", "2024-01-01 10:00"), (2, "b", "")) == [(1, "a"), (2, "b")]
    assert deliver((1, "again", "2024-01-01 10:30"), (3, "c", "")) == [(1, "a"), (2, "b"), (3, "c")]
    # once the watermark has let a key go, its next copy is taken for new; rows older than the watermark are dropped
    assert len(deliver((4, "d", "2024-01-01 20:00"))) == 4
    assert (1, "late") in deliver((1, "late", "2024-01-01 20:10"))
    assert len(deliver((5, "too old", "2024-01-01 10:00"))) == 5
    table = spark.createDataFrame([(1, "b", "2024-01-02"), (1, "a", "2024-01-01"), (None, "n", None)], "id long, text string, arrived string")
    assert sorted(map(tuple, dedupe.first_deliveries(table, ["id"]).collect()), key=str) == [(1, "a", "2024-01-01"), (None, "n", None)]


@pytest.mark.parametrize("bound", [1, 900, 1 << 20])
def test_prepared_batches(spark, bound):
    store = spark.createDataFrame([(f"/img/{i}.png", bytes([i]) * (100 + 40 * i)) for i in range(10)] + [("/img/big.png", b"B" * 5000), ("/img/void.png", b"")], "path string, content binary")
    paths = ["", None, "https://x.org/a.png", "img/none.png", "img/void.png", "img/big.png", "img/../img/3.png"] + [f"img/{i}.png" for i in range(10)]
    rows = [(b, p, f"q{b}-{p}", paths[(7 * (b or 0) + p) % len(paths)]) for b in (0, 1, 2, None) for p in range(16)]
    df = spark.createDataFrame(rows, "batch_id long, pos_in_batch int, query_text string, target_image_path string")
    out = images.prepare_batches(df, store, text_cols=("query_text",), max_bytes=bound, hot_rows=3).collect()
    plain = {(r["query_text"]): (r["image_status"], r["passage_image"]) for r in images.attach_images(df, store, id_cols=("batch_id", "pos_in_batch")).collect()}
    for b in (0, 1, 2, None):
        parts = sorted((p for p in out if p["batch_id"] == b), key=lambda p: p["part"])
        assert [p["part"] for p in parts] == list(range(parts[0]["n_parts"]))
        flat = [r for p in parts for r in p["rows"]]
        assert [r["pos"] for r in flat] == list(range(16))
        assert all((r["image_status"], r["image"]) == plain[r["query_text"]] for r in flat)
    size = lambda p: sum(len(r["image"]["bytes"]) for r in p["rows"] if r["image"])
    assert all(size(p) <= bound or sum(bool(r["image"]) for r in p["rows"]) == 1 for p in out)
    assert (len(out) == 4) == (bound == 1 << 20)
    assert {r["image_status"] for p in out for r in p["rows"]} == {"ok", "missing", "remote", "empty"}


def test_prepared_batches_of_an_empty_table(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(images.png_bytes(1, 1))
    store = images.read_image_sizes(spark, str(tmp_path))
    df = spark.createDataFrame([(0, 0, "q", str(tmp_path / "a.png"))], "batch_id long, pos_in_batch int, query_text string, target_image_path string")
    one = images.prepare_batches(df, store, text_cols=("query_text",)).collect()
    assert one[0]["rows"][0]["image_status"] == "ok" and one[0]["n_parts"] == 1
    assert images.prepare_batches(df.limit(0), store, text_cols=("query_text",)).collect() == []
