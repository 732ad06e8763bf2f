"""Ordering and sampling of video frames given as file paths."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.functions.keys import HOT_ROWS, SEED, hash_long, ordered_index

# Fixed value: the file types that count as frames.
FRAME_PATTERN = r"(?is)^\.*[^.].*\.(jpg|jpeg|png)\z"


def natural_key(name: Column) -> Column:
    """A string whose plain order is the digit-aware order of file names.

    Text runs end in NUL, numbers are written as a four-digit length and their digits without leading
    zeros. The name itself is appended to tell equal keys such as ``a1`` and ``a01`` apart.
    """
    lower = F.lower(name)
    texts = F.regexp_extract_all(lower, F.lit(r"(\D*)(\d*)"), F.lit(1))
    numbers = F.regexp_extract_all(lower, F.lit(r"(\D*)(\d*)"), F.lit(2))

    def piece(text: Column, number: Column) -> Column:
        digits = F.ltrim(number, F.lit("0"))
        coded = F.concat(F.lpad(F.length(digits).cast("string"), 4, "0"), digits)
        return F.concat(text, F.lit("\0"), F.when(number == "", F.lit("")).otherwise(coded))

    return F.concat(F.array_join(F.zip_with(texts, numbers, piece), ""), name)


def list_frames(
    frames: DataFrame,
    video: str = "video_id",
    path: str = "frame_path",
    predicate: Callable[[Column], Column] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Image files in natural order of their names, numbered from 0 within each video."""
    name = F.element_at(F.split(F.col(path), "/"), -1)
    images = frames.select(video, path).where(name.rlike(FRAME_PATTERN))
    if predicate is not None:
        images = images.where(predicate(name))
    keyed = images.withColumn("_key", natural_key(name))
    return ordered_index(keyed, [video], "_key", "frame_no", hot_rows).drop("_key")


def frame_counts(listing: DataFrame, video: str = "video_id") -> DataFrame:
    return listing.groupBy(video).agg(F.count(F.lit(1)).alias("n_frames"))


def even_points(start: Column, stop: Column, n: int) -> Column:
    """trunc(linspace(start, stop, n)) as an array; the last point is exactly ``stop``."""
    if n == 1:
        return F.array(start.cast("long"))
    step = (stop - start).cast("double") / (n - 1)
    ks = F.sequence(F.lit(0), F.lit(n - 1))
    return F.transform(
        ks,
        lambda k: F.when(k == n - 1, stop.cast("long")).otherwise(F.floor(k * step + start).cast("long")),
    )


def _pick(listing: DataFrame, plan: DataFrame, video: str) -> DataFrame:
    """Frames at the planned indexes; the key is (video, index), so a long video is no hot key."""
    wanted = plan.select(video, F.posexplode("_points").alias("slot", "frame_no"))
    return wanted.join(listing, [video, "frame_no"])


def sample_frames(listing: DataFrame, num_segments: int, video: str = "video_id") -> DataFrame:
    """``num_segments`` evenly spaced frames per video; frames repeat when there are fewer."""
    zero = F.lit(0).cast("long")
    plan = frame_counts(listing, video).withColumn(
        "_points", even_points(zero, F.col("n_frames") - 1, num_segments)
    )
    return _pick(listing, plan, video)


def capped_frames(listing: DataFrame, num_frames: int | None = None, video: str = "video_id") -> DataFrame:
    """None: all frames; 0: none; otherwise sampled down when a video has at least that many."""
    everything = listing.withColumn("slot", F.col("frame_no").cast("int"))
    columns = [video, "frame_no", "slot", *[c for c in listing.columns if c not in (video, "frame_no")]]
    if num_frames is None:
        return everything.select(*columns)
    if num_frames == 0:
        return everything.select(*columns).limit(0)
    counts = frame_counts(listing, video)
    zero = F.lit(0).cast("long")
    long_ones = counts.where(F.col("n_frames") >= num_frames).withColumn(
        "_points", even_points(zero, F.col("n_frames") - 1, num_frames)
    )
    short = everything.where(F.col("frame_no") < num_frames - 1).join(
        counts.where(F.col("n_frames") < num_frames).select(video), video, "left_semi"
    )
    return _pick(listing, long_ones, video).select(*columns).unionByName(short.select(*columns))


def stride_plan(counts: DataFrame, max_frames: int, video: str = "video_id") -> DataFrame:
    """Frame indexes to save from a video of ``n_frames``: all, or floor(i * n / max)."""
    n = F.col("n_frames")
    step = n.cast("double") / max_frames
    slots = F.sequence(F.lit(0).cast("long"), F.least(n, F.lit(max_frames).cast("long")) - 1)
    at = F.when(n <= max_frames, F.col("slot")).otherwise(F.floor(F.col("slot") * step).cast("long"))
    return counts.where(n > 0).select(video, "n_frames", F.explode(slots).alias("slot")).select(
        video, F.col("slot").cast("int").alias("slot"), at.alias("frame_no")
    )


def temporal_crop_plan(
    counts: DataFrame, num_frames: int, frame_interval: int, video: str = "video_id", seed: int = SEED
) -> DataFrame:
    """A window of ``num_frames * frame_interval`` frames at a hashed start, and its even points.

    ``too_short`` marks windows with fewer frames than wanted; they get no points.
    """
    size = num_frames * frame_interval
    n = F.col("n_frames")
    start = F.pmod(hash_long(video, seed=f"crop{seed}"), F.greatest(F.lit(0).cast("long"), n - size - 1) + 1)
    windowed = counts.withColumn("start_no", start).withColumn(
        "end_no", F.least(F.col("start_no") + size, n)
    )
    short = (F.col("end_no") - F.col("start_no")) < num_frames
    return windowed.withColumn("too_short", short).withColumn(
        "_points",
        F.when(~short, even_points(F.col("start_no"), F.col("end_no") - 1, num_frames)),
    )


def temporal_crop(
    listing: DataFrame, num_frames: int, frame_interval: int, video: str = "video_id", seed: int = SEED
) -> DataFrame:
    plan = temporal_crop_plan(frame_counts(listing, video), num_frames, frame_interval, video, seed)
    return _pick(listing, plan.where("not too_short"), video)
