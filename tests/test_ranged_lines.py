"""The registered source of lines against plain reading, for any ranges and any arrival."""

import json
import random

import pytest

from pairforge.session import scratch_path
from pairforge.sources import files, ranged_lines as R, registry, schemas


def content(seed, n):
    rng = random.Random(seed)
    parts = ["x", "", "é漢", "a b", "y" * 300, "\r"]
    return [("".join(rng.choice(parts) for _ in range(rng.randint(0, 5))) + ".").encode() for _ in range(n)]


def places(lines, name):
    at, out = 0, []
    for line in lines:
        out.append((name, at, line.decode()))
        at += len(line) + 1
    return out


def rows(df):
    return sorted((r["file"].rsplit("/", 1)[-1], r["start"], r["value"]) for r in df.collect())


@pytest.mark.parametrize("size, n", [(1, 3), (7, 6), (100, 25), (1 << 20, 25)])
def test_any_ranges_give_the_lines(spark, tmp_path, size, n):
    want = []
    for k, end in enumerate((b"", b"\n")):
        lines = content(k, n)
        (tmp_path / f"{k}.jsonl").write_bytes(b"\n".join(lines) + end)
        want += places(lines, f"{k}.jsonl")
    (tmp_path / "_hidden").write_bytes(b"not a line\n")
    (tmp_path / "empty.jsonl").write_bytes(b"")
    got = R.ranged_lines(spark, str(tmp_path), size)
    assert rows(got) == sorted(want)
    assert got.rdd.getNumPartitions() > 2 or size > 10_000
    one = R.ranged_lines(spark, f"file://{tmp_path}/1.jsonl", size)
    assert rows(one) == sorted(w for w in want if w[0] == "1.jsonl")


def test_chunks_smaller_than_lines(tmp_path, monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 5)
    lines = content(3, 40)
    path = tmp_path / "a.jsonl"
    path.write_bytes(b"\n".join(lines))
    got = []
    for part in R._ranges(str(path), 0, path.stat().st_size, 64):
        for batch in R._lines(str(path), part):
            got += zip(batch.column("start").to_pylist(), batch.column("value").to_pylist())
    assert got == [(at, value) for _, at, value in places(lines, "a")]


def test_carriage_returns_and_bad_bytes(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"one\r\n\r\n\xff\xfe\nlast\r")
    assert [v for _, _, v in rows(R.ranged_lines(spark, str(tmp_path), 2))] == ["one", "", "��", "last"]


def test_empty_missing_and_packed(spark, tmp_path):
    assert R.ranged_lines(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="packed"):
        (tmp_path / "a.gz").write_bytes(b"x")
        R.ranged_lines(spark, str(tmp_path)).count()
    with pytest.raises(Exception, match="none"):
        R.ranged_lines(spark, str(tmp_path / "none")).count()
    with pytest.raises(Exception, match="positive"):
        R.ranged_lines(spark, str(tmp_path), 0).count()


def record(i):
    return json.dumps({"instruction_text": "Find", "query_text": f"q{i}", "query_image_path": None, "target_image_path": f"{i}.jpg", "task_category": "t", "style_id": i})


def test_pairs_equal_the_plain_reader(spark, tmp_path):
    lines = [record(i) if i % 5 else ("", "{", "[]", record(i) + " x", '{"style_id": 1}')[i // 5 % 5] for i in range(60)]
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n")
    good, bad = files.read_jsonl(spark, str(tmp_path), schemas.TRAIN, schemas.REQUIRED_TRAIN)
    got = registry.instantiate(spark, dataset_parser="ranged_pairs", jsonl_path=str(tmp_path), range_bytes=200)
    assert sorted(got.collect()) == sorted(good.collect())
    problems = R.parse_pairs(R.ranged_lines(spark, str(tmp_path), 200)).where("problem is not null")
    assert sorted(r["problem"] for r in problems.collect()) == sorted(r["problem"] for r in bad.collect())


def run(spark, source, target, state, size=50):
    """Read what has arrived into ``target``, going on from ``state``."""
    (
        R.ranged_lines(spark, source, size, stream=True).writeStream.format("parquet").option("path", target)
        .option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    )


def test_stream_goes_on_in_grown_and_new_files(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    target, state = scratch_path(spark, "lines"), scratch_path(spark, "lines-state")
    lines = content(5, 30)
    first, grown = b"\n".join(lines[:10]) + b"\n", b"\n".join(lines[10:20])
    (source / "a1").write_bytes(first + b"half a li")
    run(spark, str(source), target, state)
    assert spark.read.parquet(target).count() == 10
    (source / "a1").write_bytes(first + grown)  # its last line has no break
    run(spark, str(source), target, state)
    assert spark.read.parquet(target).count() == 19
    (source / "a2").write_bytes(b"\n".join(lines[20:]) + b"\n")
    run(spark, str(source), target, state)
    want = places(lines[:20], "a1") + places(lines[20:], "a2")
    assert rows(spark.read.parquet(target)) == sorted(want)
    run(spark, str(source), target, state)
    assert spark.read.parquet(target).count() == 30


def test_a_file_before_those_read_is_an_error(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    target, state = scratch_path(spark, "lines"), scratch_path(spark, "lines-state")
    (source / "b").write_bytes(b"one\n")
    run(spark, str(source), target, state)
    (source / "a").write_bytes(b"late\n")
    (source / "c").write_bytes(b"two\n")
    with pytest.raises(Exception, match="names must ascend"):
        run(spark, str(source), target, state)
