"""Catalogue files with quoted line breaks, read by byte ranges."""

import csv
import random

import pytest

from pairforge.plans import source_queries
from pairforge.sources import files

HEADER = ["style_id", "description", "default_image", "master_category"]


@pytest.fixture
def ranges(spark):
    """Sets the size of byte ranges."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, size)
    spark.conf.set(name, before)


def write(path, rows, header=HEADER, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator=end).writerows([header, *rows])
    return str(path)


def odd_rows(seed, n):
    rng = random.Random(seed)
    parts = ["plain", 'a "quoted" word', "line\nbreak", "\n\n", '"', '",\n"', "é漢", "x" * 500 + "\n" + "y" * 900, ""]
    return [[i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) + ".", f"img/{i}.jpg", "cat\negory"] for i in range(n)]


@pytest.mark.parametrize("size, end", [(400, "\r\n"), (5000, "\n"), (1 << 27, "\n")])
def test_ranges_give_the_records(spark, ranges, tmp_path, size, end):
    rows = odd_rows(size, 60)
    path = write(tmp_path / "catalogue.csv", rows, end=end)
    ranges(size)
    good, bad = files.split_catalogue_ranges(spark, path)
    got = sorted((r["style_id"], r["description"], r["default_image"], r["master_category"]) for r in good.collect())
    assert got == [tuple(r) for r in rows]
    assert bad.count() == 0
    blocks = files.read_records(spark, path).select("block").distinct().count()
    assert blocks > 1 or size > 100_000
    first = files.split_catalogue_ranges(spark, path, sample_size=7)[0]
    assert sorted(r["style_id"] for r in first.collect()) == list(range(7))


def test_ranges_equal_the_plain_reader(spark, ranges, tmp_path):
    rows = odd_rows(1, 60)
    for r in rows[::5]:
        r.append("")  # a field too many
    for r in rows[1::7]:
        del r[3:]
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(3):
        write(folder / f"{k}.csv", rows[k::3])
    whole = files.split_catalogue(spark, str(folder))
    ranges(1500)
    cut = files.split_catalogue_ranges(spark, str(folder))
    rows_of = lambda df: sorted(map(str, df.collect()))
    assert rows_of(whole[0]) == rows_of(cut[0])
    assert rows_of(whole[1].select("record")) == rows_of(cut[1].select("record")) and cut[1].count() == 12 - 2


def test_records_of_a_file_stay_in_their_ranges(spark, ranges, tmp_path):
    """Also where Spark takes the first records of all files for a large table, no task gets a whole file."""
    rows = odd_rows(4, 200)
    path = write(tmp_path / "catalogue.csv", rows)
    ranges(2000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        good = files.split_catalogue_ranges(spark, path)[0]
        plan = good._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["style_id"] for r in good.collect()) == list(range(200))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [file" in plan and "SortMergeJoin" not in plan


def test_large_fixtures_have_several_files(spark, ranges, monkeypatch, tmp_path):
    """The file that a query reads by ranges is not written by one task, whatever its size."""
    monkeypatch.setattr(source_queries, "scratch_path", lambda spark, label: str(tmp_path / label))
    monkeypatch.setattr(source_queries, "FILE_BYTES", 3000, raising=False)
    rows = spark.createDataFrame(odd_rows(5, 200), "style_id long, description string, default_image string, master_category string")
    got = source_queries._ranged(spark, None, "odd", rows.repartition(9)).collect()
    assert sorted((r["style_id"], r["description"]) for r in got) == sorted((r["style_id"], r["description"]) for r in rows.collect())
    assert all(r["in_many_ranges"] for r in got)
    assert len(list((tmp_path / "odd-ranges-csv").glob("*.csv"))) == 9


def test_ranges_report_bad_files(spark, ranges, tmp_path):
    ranges(200)
    with pytest.raises(ValueError, match="odd number of quotes"):
        path = write(tmp_path / "odd.csv", odd_rows(2, 5))
        with open(path, "a") as out:
            out.write('9,"never closed\n')
        files.split_catalogue_ranges(spark, path)
    with pytest.raises(ValueError, match="lacks the columns"):
        files.split_catalogue_ranges(spark, write(tmp_path / "short.csv", [], HEADER[:2]))
    folder = tmp_path / "two"
    folder.mkdir()
    write(folder / "a.csv", odd_rows(3, 3))
    write(folder / "b.csv", odd_rows(3, 3), HEADER[::-1])
    with pytest.raises(ValueError, match="another header"):
        files.split_catalogue_ranges(spark, str(folder))
    assert files.split_catalogue_ranges(spark, write(tmp_path / "none.csv", []))[0].collect() == []
