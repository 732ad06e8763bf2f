"""Split files: writing, skipping what is done, and their manifest."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def split_path(root: str, split: str) -> str:
    return f"{root.rstrip('/')}/split={split}"


def _marker(spark: SparkSession, root: str, split: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(split_path(root, split) + "/_SUCCESS")
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def split_is_complete(spark: SparkSession, root: str, split: str) -> bool:
    """Whether the job that wrote the split committed it."""
    path, fs = _marker(spark, root, split)
    return fs.exists(path)


@contextmanager
def _staged(spark: SparkSession, root: str, splits: list[str]):
    """A folder to write ``splits`` to. When the block ends well, each of them takes the place of its predecessor, also an
    empty one, and is marked last; when it fails, the predecessors are as they were.

    A split is replaced by a rename inside ``root``. If that is interrupted, the split has no marker and counts as incomplete.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = f"{root.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    fs = hadoop(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        yield folder
        for name in splits:
            fresh, (marker, _) = hadoop(split_path(folder, name)), _marker(spark, root, name)
            fs.delete(marker, False)
            fs.delete(marker.getParent(), True)
            if fs.exists(fresh):
                fs.delete(hadoop(fresh, "_SUCCESS"), False)
                if not fs.rename(fresh, marker.getParent()):
                    raise OSError(f"cannot move {fresh.toString()} to its place")
            fs.create(marker, True).close()
    finally:
        fs.delete(hadoop(folder), True)


def write_split(records: DataFrame, root: str, split: str, skip_existing: bool = False) -> bool:
    """Write one split as JSON lines, keeping nulls; False when a committed split was left alone.

    Tasks write in parallel to a staging folder, which takes the split's place when all have ended; until then the
    former split stays. An interrupted write is repeated.
    """
    spark = records.sparkSession
    if skip_existing and split_is_complete(spark, root, split):
        return False
    with _staged(spark, root, [split]) as folder:
        records.write.option("ignoreNullFields", "false").json(split_path(folder, split))
    return True


def write_splits(records: DataFrame, root: str, splits: list[str], split: str = "split") -> None:
    """Several splits of one record type in a single pass; replaces only these splits, also by nothing, once the job that
    writes them has ended."""
    with _staged(records.sparkSession, root, splits) as folder:
        records.where(F.col(split).isin(*splits)).write.option("ignoreNullFields", "false").partitionBy(split).json(folder)


def read_split(spark: SparkSession, root: str, split: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(split_path(root, split))


def split_manifest(
    spark: SparkSession, root: str, splits=("train", "val", "test"), rows: dict[str, int] | None = None
) -> DataFrame:
    """Files, megabytes and rows per written split, zeros for one without rows.

    Sizes come from the file listing. Rows counted while a split was written are passed in ``rows``; only
    the other splits are read to count their lines.
    """
    known = {s: n for s, n in (rows or {}).items() if s in splits}
    name = F.regexp_extract("path", r"/split=([^/]+)/", 1).alias("split")
    files = (
        spark.read.format("binaryFile").load([split_path(root, s) for s in splits])
        .select(name, "length")
        .groupBy("split")
        .agg(F.count(F.lit(1)).alias("files"), (F.sum("length") / 1048576).alias("megabytes"))
    )
    counts = spark.createDataFrame(list(known.items()), "split STRING, rows BIGINT")
    unknown = [split_path(root, s) for s in splits if s not in known]
    if unknown:
        place = F.regexp_extract(F.col("_metadata.file_path"), r"/split=([^/]+)/", 1).alias("split")
        lines = spark.read.text(unknown).select(place).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
        counts = counts.unionByName(lines)
    named = spark.createDataFrame([(s,) for s in splits], "split STRING")
    found = named.join(files, "split", "left").join(counts, "split", "left")
    return found.fillna(0, ["files", "megabytes", "rows"])
