"""Readers, writers, images, parsers and streams over real files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pairforge.operators.catalogue import row_cap
from pairforge.plans import build
from pairforge.sources import conform, files, hub, images, pairs, registry, schemas, sinks
from pairforge.streaming import ingest, throughput


def _write(path, text):
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def test_catalogue_csv(spark, tmp_path):
    csv = _write(tmp_path / "c.csv", "\n".join([
        "extra,master_category,style_id,description,default_image",
        'x,shoes,1,"two\nlines, ""quoted""",a.jpg',
        "x,NA,2,plain,b.jpg",
        "x,shoes,3.0,  spaced ,",
        'x,shoes,9007199254740993,None,"null"',
        "x,nan,,N/A,<NA>",
    ]) + "\n")
    got = sorted(map(tuple, files.read_catalogue(spark, csv).collect()), key=str)
    assert got == sorted([
        (1, 'two\nlines, "quoted"', "a.jpg", "shoes"), (2, "plain", "b.jpg", None), (3, "  spaced ", None, "shoes"),
        (9007199254740993, None, None, "shoes"), (None, None, None, None),
    ], key=str)
    assert files.read_catalogue(spark, csv, sample_size=2).count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_catalogue(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(ValueError, match="lacks"):
        files.read_catalogue(spark, _write(tmp_path / "d.csv", "a,b\n1,2\n"))


def test_catalogue_headers_quarantine_and_first_rows(spark, tmp_path):
    header = "style_id,default_image,description,master_category\n"
    one = _write(tmp_path / "one.csv", header + "1,a.jpg,x,shoes\n2,b.jpg,y,bags,more\n3,c.jpg,z\n4,d.jpg,w,hats,\n5,e.jpg,v,hats\n")
    good, bad = files.split_catalogue(spark, one)
    assert sorted(r["style_id"] for r in good.collect()) == [1, 3, 5]
    assert [r["master_category"] for r in good.where("style_id = 3").collect()] == [None]
    assert sorted(r["record"] for r in bad.collect()) == ["2,b.jpg,y,bags,more", "4,d.jpg,w,hats,"]
    assert bad.first()["file"].endswith("/one.csv")
    for multi_line in (True, False):
        good, bad = files.split_catalogue(spark, one, multi_line=multi_line)
        assert (good.count(), good.select("description").distinct().count(), bad.count()) == (3, 3, 2)
    assert [r["style_id"] for r in files.read_catalogue(spark, one, sample_size=2).collect()] == [1, 3]
    two = _write(tmp_path / "two.csv", "default_image,style_id,description,master_category\nz.jpg,9,x,shoes\n")
    assert [r["style_id"] for r in files.read_catalogue(spark, two).collect()] == [9]
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        files.read_catalogue(spark, [one, two]).collect()


def test_read_file(spark, tmp_path):
    csv = _write(tmp_path / "f.csv", "a,b\n1,x\n")
    assert [tuple(r) for r in files.read_file(spark, csv).collect()] == [(1, "x")]
    with pytest.raises(NotImplementedError):
        files.read_file(spark, "f.txt")


def _record(i, **more):
    return {"instruction_text": "Find", "query_text": f"q{i}", "query_image_path": None,
            "target_image_path": f"img/{i}.jpg", "task_category": "retrieval", "style_id": i, **more}


BAD_LINES = ["", "   ", "{", '{"style_id": 1', "123", "null", '"text"', "[1]", json.dumps(_record(1)) + " x",
             json.dumps(_record(1)) * 2, json.dumps(_record(1)) + "]", json.dumps(_record(1)) + "}",
             json.dumps(_record(1)) + "," + json.dumps(_record(2)), "{'style_id': 1}", json.dumps(_record("not a number"))]


def test_jsonl_quarantine_has_line_numbers(spark, tmp_path):
    lines, bad_at = [], {}
    for i in range(40):
        if i < len(BAD_LINES):
            bad_at[len(lines) + 1] = BAD_LINES[i]
            lines.append(BAD_LINES[i])
        lines.append(json.dumps(_record(100 + i, extra="ignored")))
    lacking = _record(5)
    del lacking["target_image_path"]
    bad_at[len(lines) + 1] = json.dumps(lacking)
    lines.append(json.dumps(lacking))
    path = _write(tmp_path / "p.jsonl", "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        good, bad = files.read_jsonl(spark, path, schemas.TRAIN, schemas.REQUIRED_TRAIN)
        assert good.count() == 40 and bad.rdd.getNumPartitions() > 0
        got = {r["line_number"]: r["line"] for r in bad.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")
    assert got == bad_at
    assert bad.where("problem = 'missing_key'").count() == 1
    first = files.read_jsonl(spark, path, schemas.TRAIN, max_rows=3)[0]
    assert sorted(r["style_id"] for r in first.collect()) == [100, 101, 102]


def test_jsonl_keeps_explicit_nulls(spark, tmp_path):
    lines = [json.dumps(_record(1, target_image_path=None)), json.dumps(_record(2))]
    good, bad = files.read_jsonl(spark, _write(tmp_path / "p.jsonl", "\n".join(lines)), schemas.TRAIN, schemas.REQUIRED_TRAIN)
    assert {r["style_id"]: r["target_image_path"] for r in good.collect()} == {1: None, 2: "img/2.jpg"}
    assert bad.count() == 0
    no_list = {**_record(3), "candidate_targets": None, "ground_truth_index": 0}
    path = _write(tmp_path / "e.jsonl", json.dumps(no_list))
    good, bad = files.read_jsonl(spark, path, schemas.EVAL, schemas.REQUIRED_EVAL, require_valid=False)
    assert good.count() == 0 and [(r["line_number"], r["problem"]) for r in bad.collect()] == [(1, "missing_key")]


def test_parser_quarantine(spark, tmp_path):
    path = _write(tmp_path / "p.jsonl", "\n".join([json.dumps(_record(1)), "{", json.dumps(_record(2)), ""]) + "\n")
    bad = registry.instantiate(spark, dataset_parser="jsonl_pairs_quarantine", jsonl_path=path, subset_name="demo")
    got = sorted((r["line_number"], r["line"], r["problem"], r["global_dataset_name"]) for r in bad.collect())
    assert got == [(2, "{", "malformed", "demo"), (4, "", "blank", "demo")]


def test_one_content_per_path(spark):
    refs = spark.createDataFrame([(1, "i/a.png"), (2, "i/b.png")], "style_id long, target_image_path string")
    store = spark.createDataFrame(
        [("/i/./a.png", bytearray(b"y")), ("/i/a.png", bytearray(b"x")), ("/i/a.png", bytearray(b"w"))], "path string, content binary"
    )
    got = {r["style_id"]: bytes(r["passage_image"]["bytes"]) for r in images.attach_images(refs, store).collect() if r["image_status"] == "ok"}
    assert got == {1: b"y"} and images.attach_images(refs, store).count() == 2


def test_jsonl_without_valid_lines(spark, tmp_path):
    path = _write(tmp_path / "bad.jsonl", "{\n\n")
    with pytest.raises(ValueError, match="no valid record"):
        files.read_jsonl(spark, path, schemas.TRAIN)
    assert files.read_jsonl(spark, path, schemas.TRAIN, require_valid=False)[1].count() == 2


def test_split_files_keep_nulls_and_restart(spark, tmp_path):
    root = str(tmp_path / "out")
    df = spark.createDataFrame([tuple(_record(i).values()) for i in range(10)], schemas.TRAIN)
    assert sinks.write_split(df, root, "train", skip_existing=True)
    line = json.loads(spark.read.text(sinks.split_path(root, "train")).first()["value"])
    assert list(line) == list(_record(0)) and line["query_image_path"] is None
    assert not sinks.write_split(df.limit(1), root, "train", skip_existing=True)
    assert sinks.read_split(spark, root, "train", schemas.TRAIN).count() == 10
    os.remove(os.path.join(sinks.split_path(root, "train"), "_SUCCESS"))
    assert sinks.write_split(df.limit(1), root, "train", skip_existing=True)
    assert sinks.read_split(spark, root, "train", schemas.TRAIN).count() == 1


def test_build_end_to_end(spark, tmp_path, monkeypatch):
    own = tmp_path / "scratch"
    monkeypatch.setattr("pairforge.session.shared_dir", lambda _: str(own))
    rows = "\n".join(f"{i},text {i},img/{i // 2}.jpg,{'abc'[i % 3]}" for i in range(600))
    csv = _write(tmp_path / "cat.csv", "style_id,description,default_image,master_category\n" + rows + "\n")
    out = str(tmp_path / "sets")
    manifest = {r["split"]: r["rows"] for r in build.build_from_csv(spark, csv, out, num_candidates=25).collect()}
    assert manifest == {"train": 480, "val": 60, "test": 60}
    val = sinks.read_split(spark, out, "val", schemas.EVAL).collect()
    assert all(len(r["candidate_targets"]) == 25 and 0 <= r["ground_truth_index"] < 25 for r in val)
    ids = [r["style_id"] for s, sc in (("train", schemas.TRAIN), ("val", schemas.EVAL), ("test", schemas.EVAL))
           for r in sinks.read_split(spark, out, s, sc).collect()]
    assert sorted(ids) == list(range(600))
    assert list((own / "pairforge").iterdir()) == []  # intermediate tables are gone
    before = os.path.getmtime(os.path.join(out, "split=train", "_SUCCESS"))
    build.build_from_csv(spark, csv, out, num_candidates=10, sampler="pooled")
    assert os.path.getmtime(os.path.join(out, "split=train", "_SUCCESS")) == before
    assert len(sinks.read_split(spark, out, "val", schemas.EVAL).first()["candidate_targets"]) == 10


def test_images_from_files(spark, tmp_path):
    for i, colour in enumerate([(255, 0, 0), (0, 255, 0)]):
        (tmp_path / f"{i}.png").write_bytes(images.png_bytes(3, 2, colour))
    (tmp_path / "empty.png").write_bytes(b"")
    store = images.read_image_store(spark, str(tmp_path), "*.png")
    rows = [(1, "0.png", None), (2, "./1.png", None), (3, "none.png", None), (4, "", None), (5, None, None),
            (6, "https://e.org/x.png", None), (7, "empty.png", None), (8, "none.png", b"own"), (9, "0.png", None)]
    df = spark.createDataFrame(rows, "style_id long, target_image_path string, given binary")
    got = {r["style_id"]: r for r in images.attach_images(df, store, bytes_col="given", base_dir=str(tmp_path), hot_rows=1).collect()}
    status = {i: r["image_status"] for i, r in got.items()}
    assert status == {1: "ok", 2: "ok", 3: "missing", 4: "empty", 5: "empty", 6: "remote", 7: "missing", 8: "ok", 9: "ok"}
    blank = images.png_bytes(224, 224)
    assert bytes(got[1]["passage_image"]["bytes"]) == bytes(got[9]["passage_image"]["bytes"]) == images.png_bytes(3, 2, (255, 0, 0))
    assert bytes(got[3]["passage_image"]["bytes"]) == bytes(got[6]["passage_image"]["bytes"]) == blank
    assert bytes(got[8]["passage_image"]["bytes"]) == b"own" and got[4]["passage_image"] is None


def test_catalogue_of_sets(spark, tmp_path):
    catalogue = hub.default_catalogue(spark, "someone")
    assert catalogue.count() == catalogue.select("name").distinct().count() == 40
    assert catalogue.where("repo like '%{%'").count() == 0
    root = str(tmp_path)
    spark.range(3).write.parquet(f"{root}/team/a/english/test")
    spark.range(2).withColumn("x", F.lit(1)).write.parquet(f"{root}/team/b/test")
    spark.range(4).write.parquet(f"{root}/team/c/deep/part")
    own = spark.createDataFrame(
        [("a", "team/a", "english", "test"), ("b", "team/b", None, "test"), ("c", "team/c", None, None)], hub.CATALOGUE_SCHEMA
    )
    stacked = hub.load_sets(spark, ["a", "b", "c"], own, root)
    assert {r["dataset"]: r["count"] for r in stacked.groupBy("dataset").count().collect()} == {"a": 3, "b": 2, "c": 4}
    with pytest.raises(KeyError):
        hub.load_sets(spark, ["a", "zzz"], own, root)


def test_conform(spark):
    df = spark.range(2).select(
        F.lit("q").alias("query_text"),
        conform.image_group(F.when(F.col("id") == 0, "p"), resolution=F.array(F.lit(3), F.lit(4))).alias("pos_image"), "id",
    )
    shaped = conform.conform(conform.tag(df))
    assert [f.dataType for f in shaped.schema] == [f.dataType for f in schemas.MULTIMODAL]
    rows = shaped.orderBy(F.size("pos_image.paths")).collect()
    assert rows[0]["pos_image"]["paths"] == [] and rows[1]["pos_image"]["resolutions"] == [[3, 4]]
    assert rows[0]["global_dataset_name"] == "None" and rows[0]["neg_image"] is None
    assert conform.resolution_violations(shaped).count() == 0


def test_registry_refuses_duplicates(spark):
    name = "test_parser"
    registry.register(name)(lambda spark, **_: spark.range(3))
    assert registry.instantiate(spark, name).count() == 3
    with pytest.raises(ValueError):
        registry.register(name)(lambda spark, **_: None)
    with pytest.raises(KeyError):
        registry.instantiate(spark, "unknown_parser")


@pytest.mark.parametrize("batch_size", [1, 7, 100])
def test_batched_map_changes_row_counts(spark, batch_size):
    def doubled(columns, times):
        assert len(columns["id"]) <= batch_size
        return {"id": [i for i in columns["id"] for _ in range(times)], "name": ["x"] * (times * len(columns["id"]))}

    out = registry.map_batches(spark.range(50), doubled, "id bigint, name string", batch_size, {"times": 3})
    assert sorted(r["id"] for r in out.collect()) == sorted(list(range(50)) * 3)


def test_pair_parser(spark, tmp_path):
    path = _write(tmp_path / "pairs.jsonl", "\n".join(json.dumps(_record(i)) for i in range(20)))
    got = registry.instantiate(spark, dataset_parser="jsonl_pairs", jsonl_path=path, num_sample_per_subset="3",
                               subset_name="demo", weight=1.0).collect()
    assert sorted(r["style_id"] for r in got) == [0, 1, 2] and got[0]["global_dataset_name"] == "demo"
    assert {r["query_text"] for r in got} == {"Find q0", "Find q1", "Find q2"}
    evals = [{"instruction_text": "Find", "query_text": "q", "query_image_path": None, "task_category": "retrieval", "style_id": i,
              "candidate_targets": [{"type": "image", "path": f"{j}.jpg"} for j in range(i)], "ground_truth_index": 0} for i in range(4)]
    path = _write(tmp_path / "eval.jsonl", "\n".join(map(json.dumps, evals)))
    rows = registry.instantiate(spark, dataset_parser="jsonl_pairs", jsonl_path=path, dataset_split="val").collect()
    assert len(rows) == 0 + 1 + 2 + 3 and sum(r["is_ground_truth"] for r in rows) == 3
    assert row_cap(spark.range(5), 2, "id", "random").count() == 2


def test_stream_ingest_equals_batch_and_resumes(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()

    def run():
        ingest.ingest_pairs(spark, str(source), target, state, name="demo", max_files_per_trigger=1).awaitTermination()
        return spark.read.parquet(f"{target}/good"), spark.read.parquet(f"{target}/quarantine")

    _write(source / "a.jsonl", "\n".join([json.dumps(_record(i)) for i in range(5)] + BAD_LINES) + "\n")
    good, bad = run()
    assert good.count() == 5 and bad.count() == len(BAD_LINES)
    assert {r["line_number"]: r["line"] for r in bad.collect()} == dict(enumerate(BAD_LINES, 6))
    _write(source / "b.jsonl", "\n".join(json.dumps(_record(i)) for i in range(5, 9)) + "\n")
    good, bad = run()
    assert sorted(r["style_id"] for r in good.collect()) == list(range(9)) and bad.count() == len(BAD_LINES)
    batch, _ = files.read_jsonl(spark, str(source), schemas.TRAIN, schemas.REQUIRED_TRAIN)
    want = pairs.prepare_pairs(batch, "train", "demo")
    assert sorted(map(tuple, good.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_stream_windows_equal_batch(spark, tmp_path, zone):
    table = spark.sql("""
        SELECT timestamp_ntz'2024-03-10 00:30:00' + make_dt_interval(0, 0, id * 7) AS ts, concat('t', id % 3) AS event_type
        FROM range(0, 400)""")
    source = str(tmp_path / "in")
    table.write.parquet(source)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        want = sorted(map(tuple, throughput.windowed_counts(table).collect()))
        for final in (True, False):
            events = spark.readStream.schema(table.schema).parquet(source)
            target = str(tmp_path / f"out{final}")
            throughput.run_windowed_counts(events, target, str(tmp_path / f"state{final}"), final).awaitTermination()
            read = throughput.read_windowed_counts if final else lambda session, path: session.read.parquet(path)
            got = sorted(map(tuple, read(spark, target).collect()))
            if final:
                assert got == want
            else:  # windows the watermark has not passed are still open
                assert got and set(got) <= set(want)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_stream_windows_over_several_batches(spark, tmp_path):
    """Counts of an open window grow from batch to batch; the latest one is read."""
    source, target, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    schema = "ts timestamp, event_type string"
    for minute in range(3):
        rows = f"SELECT timestamp'2024-01-01 00:0{minute}:00' + make_dt_interval(0, id % 2) AS ts, 'a' AS event_type FROM range(4)"
        spark.sql(rows).coalesce(1).write.mode("append").parquet(source)
        events = spark.readStream.schema(schema).parquet(source)
        throughput.run_windowed_counts(events, target, state).awaitTermination()
        got = throughput.read_windowed_counts(spark, target).orderBy("window_start").collect()
        assert [r["n"] for r in got] == [2 * minute + 2] * 2


def test_throughput_without_elapsed_time(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS ts, 'a' AS k FROM range(3)")
    row = throughput.throughput(df, by=["k"]).first()
    assert (row["n"], row["rate"]) == (3, 0.0)


@pytest.mark.parametrize("one", [True, False])
def test_a_failed_job_leaves_the_old_splits(spark, tmp_path, one):
    root = str(tmp_path / "sets")
    old = spark.createDataFrame([(i, "val" if i % 2 else "test") for i in range(10)], "style_id long, split string")
    sinks.write_splits(old, root, ["val", "test"])
    failing = old.withColumn("style_id", F.when(F.col("style_id") == 7, F.raise_error(F.lit("broken off")).cast("long")).otherwise(100))
    with pytest.raises(Exception, match="broken off"):
        if one:
            sinks.write_split(failing.drop("split"), root, "val")
        else:
            sinks.write_splits(failing, root, ["val", "test"])
    schema = old.select("style_id").schema
    for name, odd in (("val", 1), ("test", 0)):
        assert sinks.split_is_complete(spark, root, name)
        assert sorted(r["style_id"] for r in sinks.read_split(spark, root, name, schema).collect()) == list(range(odd, 10, 2))
    assert sorted(os.listdir(root)) == ["split=test", "split=val"]
    sinks.write_splits(old.where("style_id < 3"), root, ["val", "test"])
    assert sorted(r["style_id"] for r in sinks.read_split(spark, root, "val", schema).collect()) == [1]
