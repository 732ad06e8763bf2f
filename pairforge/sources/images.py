"""Attach image bytes to paths. Bytes are carried as they are, never decoded."""

from __future__ import annotations

import struct
import zlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairforge.functions.joins import salted_lookup
from pairforge.functions.keys import HOT_ROWS
from pairforge.functions.text import is_remote, normalize_path

PLACEHOLDER_SIZE = (224, 224)  # fixed value: the white stand-in for an image that cannot be had


def png_bytes(width: int, height: int, rgb: tuple[int, int, int] = (255, 255, 255)) -> bytes:
    """A one-colour PNG."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    rows = (b"\0" + bytes(rgb) * width) * height
    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def read_image_store(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``(path, content)`` of the files below a folder, with plain absolute paths."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return files.select(F.regexp_replace("path", r"^file:/+", "/").alias("path"), "content")


def attach_images(
    df: DataFrame,
    store: DataFrame,
    path_col: str = "target_image_path",
    id_cols: tuple[str, ...] = ("style_id",),
    bytes_col: str | None = None,
    base_dir: str = "/",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``passage_image STRUCT<bytes, path>`` and ``image_status``.

    Status is ok, missing (placeholder bytes), remote (placeholder bytes, the path would have to be
    downloaded) or empty (NULL image). Given bytes win over the path. ``store`` is any ``(path,
    content)`` table; content that no row asks for is dropped before the join, and a picture that very
    many rows share is salted. Of several contents for one path, the one with the first spelling of the
    path counts, then the smallest.
    """
    own = F.col(bytes_col) if bytes_col else F.lit(None).cast("binary")
    empty = F.col(path_col).isNull() | (F.col(path_col) == "")
    remote = is_remote(path_col)
    lookup = F.when(~empty & ~remote & own.isNull(), normalize_path(path_col, base_dir))
    asked = df.withColumn("_path", lookup)
    needed = asked.where("_path is not null").select("_path").distinct()
    content = (
        store.select(
            normalize_path("path", base_dir).alias("_path"), F.col("path").alias("_raw"), F.col("content").alias("_content")
        )
        .where(F.length("_content") > 0)
        .join(needed, "_path", "left_semi")
        .withColumn("_nth", F.row_number().over(Window.partitionBy("_path").orderBy("_raw", "_content")))
        .where("_nth = 1")
        .drop("_raw", "_nth")
    )
    found = salted_lookup(asked, content, "_path", list(id_cols), "left", hot_rows)
    placeholder = F.lit(png_bytes(*PLACEHOLDER_SIZE))
    status = (
        F.when(own.isNotNull(), F.lit("ok"))
        .when(empty, F.lit("empty"))
        .when(remote, F.lit("remote"))
        .when(F.col("_content").isNull(), F.lit("missing"))
        .otherwise(F.lit("ok"))
    )
    image = F.when(
        F.col("image_status") != "empty",
        F.struct(F.coalesce(own, F.col("_content"), placeholder).alias("bytes"), F.col(path_col).alias("path")),
    )
    return (
        found.withColumn("image_status", status)
        .withColumn("passage_image", image)
        .select(*df.columns, "passage_image", "image_status")
    )


BATCH_BYTES = 64 << 20  # of image content in one row of prepared batches


def prepare_batches(
    batches: DataFrame,
    store: DataFrame,
    path_col: str = "target_image_path",
    text_cols: tuple[str, ...] = ("query_text", "passage_text"),
    batch_cols: tuple[str, ...] = ("batch_id",),
    pos: str = "pos_in_batch",
    base_dir: str = "/",
    max_bytes: int = BATCH_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Batches with their image bytes, as a loader hands them out: ``(*batch_cols, part, n_parts, rows)``.

    ``rows`` is the part's list of ``struct<pos, *text_cols, image, image_status>`` in order; ``image`` and the statuses are
    those of :func:`attach_images`. Content is fetched after mixing and batching: only places and paths are joined with
    the store's sizes first, and a batch is cut into parts by the running sum of its sizes, so that no row holds
    more than ``max_bytes`` of images, or one image that is larger. Then every image moves twice, to the places that ask for
    it and with them to their part, and never through the shuffles of the mix. ``store`` is a ``(path, content[, length])``
    table; with ``length``, as :func:`read_image_sizes` adds it, the sizes are known without reading contents. ``(batch_cols, pos)``
    must be unique. Null batch numbers form a batch of their own.
    """
    keys = [*batch_cols, pos]
    places = batches.select(*keys, F.col(path_col).alias("_image_path"))
    length = F.col("length") if "length" in store.columns else F.length("content").cast("long")
    sizes = (
        store.select(normalize_path("path", base_dir).alias("_path"), length.alias("_size")).where("_size > 0")
        .groupBy("_path").agg(F.max("_size").alias("_size"))  # of several contents for a path, the largest bounds
    )
    lookup = F.when(~is_remote("_image_path") & (F.col("_image_path") != ""), normalize_path("_image_path", base_dir))
    sized = salted_lookup(places.withColumn("_path", lookup), sizes, "_path", keys, "left", hot_rows)
    size = F.when(F.coalesce(F.col("_image_path"), F.lit("")) == "", 0).otherwise(F.coalesce("_size", F.lit(len(png_bytes(*PLACEHOLDER_SIZE)))))
    before = F.sum(size).over(Window.partitionBy(*batch_cols).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1))
    # a part begins where the sum reaches the next half of the bound, so its own rows stay below the whole
    half = max(1, max_bytes // 2)
    step = F.when(size > half, F.lit(1)).otherwise(F.lit(0))
    crossed = F.floor(F.coalesce(before, F.lit(0)) / half) + F.sum(step).over(Window.partitionBy(*batch_cols).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0))
    cut = sized.withColumn("_cut", crossed).select(*keys, "_image_path", "_cut")
    part = F.dense_rank().over(Window.partitionBy(*batch_cols).orderBy("_cut")) - 1
    cut = cut.withColumn("part", part.cast("int")).withColumn("n_parts", (F.max("part").over(Window.partitionBy(*batch_cols)) + 1).cast("int"))
    texts = batches.select(*keys, *text_cols)
    same = [cut[k].eqNullSafe(texts[k]) for k in keys]
    named = cut.join(texts, [*same], "inner").select(*[cut[k] for k in keys], "part", "n_parts", "_image_path", *text_cols)
    attached = attach_images(named, store.select("path", "content"), "_image_path", tuple(keys), base_dir=base_dir, hot_rows=hot_rows)
    row = F.struct(F.col(pos).alias("pos"), *text_cols, F.col("passage_image").alias("image"), "image_status")
    return attached.groupBy(*batch_cols, "part", "n_parts").agg(F.sort_array(F.collect_list(row)).alias("rows"))


def read_image_sizes(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """:func:`read_image_store` with ``length``, which the file listing knows without opening a file."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    )
    return files.select(F.regexp_replace("path", r"^file:/+", "/").alias("path"), "content", "length")
