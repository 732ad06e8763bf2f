"""Sizes of PNG and JPEG files from their headers; pixels are neither read nor decoded."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.sources.locations import open_location

FIRST = 4096  # bytes of a file that are read at once; most headers end before

# Fixed values of the two formats: signatures, markers without a length, markers of frames.
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
JPEG_SIGNATURE = b"\xff\xd8"
BARE_MARKERS = {0x01, *range(0xD0, 0xD9)}
FRAME_MARKERS = set(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
LAST_MARKERS = {0xD9, 0xDA}  # end of image, start of scan: no frame can follow

SCHEMA = "path string, format string, status string, width int, height int"
Read = Callable[[int, int], bytes]


def _png_size(read: Read) -> tuple[int, int] | None:
    head = read(8, 16)
    if len(head) < 16 or head[4:8] != b"IHDR":
        return None
    return int.from_bytes(head[8:12]), int.from_bytes(head[12:16])


def _jpeg_size(read: Read) -> tuple[int, int] | None:
    """Goes from segment to segment by their lengths, so what a segment holds is never taken for a frame."""
    at = 2
    while True:
        mark = read(at, 2)
        if len(mark) < 2 or mark[0] != 0xFF:
            return None
        if mark[1] == 0xFF:  # a fill byte
            at += 1
        elif mark[1] in BARE_MARKERS:
            at += 2
        elif mark[1] in LAST_MARKERS:
            return None
        elif mark[1] in FRAME_MARKERS:
            frame = read(at + 4, 5)
            return (int.from_bytes(frame[3:5]), int.from_bytes(frame[1:3])) if len(frame) == 5 else None
        else:
            length = int.from_bytes(read(at + 2, 2))
            if length < 2:
                return None
            at += 2 + length


def header_size(read: Read) -> tuple[str | None, str, int | None, int | None]:
    """``(format, status, width, height)`` from ``read(start, length)``, which gives fewer bytes at the end."""
    if read(0, len(PNG_SIGNATURE)) == PNG_SIGNATURE:
        name, size = "png", _png_size(read)
    elif read(0, len(JPEG_SIGNATURE)) == JPEG_SIGNATURE:
        name, size = "jpeg", _jpeg_size(read)
    else:
        return None, "unknown", None, None
    # A PNG holds up to 2**31 - 1 a side; no side may be zero.
    if size is None or not all(0 < side < 1 << 31 for side in size):
        return name, "damaged", None, None
    return name, "ok", *size


def _of_file(location: str) -> tuple[str | None, str, int | None, int | None]:
    try:
        system, path = open_location(location)
        with system.open_input_file(path) as source:
            first = source.read_at(FIRST, 0)

            def read(start: int, length: int) -> bytes:
                if start + length <= len(first) or len(first) < FIRST:
                    return first[start : start + length]
                return source.read_at(length, start) if start < source.size() else b""

            return header_size(read)
    except OSError:
        return None, "unreadable", None, None


def read_image_headers(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``path, format, status, width, height`` of every file below ``root``, as stored (no turn by its metadata).

    ``status`` is ``ok``, ``damaged`` (a header that ends early or is wrong), ``unknown`` (another format) or
    ``unreadable`` (gone or forbidden since it was listed); sizes are NULL unless it is ``ok``. Files of no bytes have no
    row, because Spark's listing leaves them out. The listing gives paths alone; of each file 4 kB are read, and of a JPEG with
    longer segments some bytes at each of them.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    ).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            found = [_of_file(p) for p in paths]
            formats, statuses, widths, heights = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(formats, pa.string()), pa.array(statuses, pa.string()),
                 pa.array(widths, pa.int32()), pa.array(heights, pa.int32())],
                names=["path", "format", "status", "width", "height"],
            )

    return files.mapInArrow(run, SCHEMA).withColumn("path", F.regexp_replace("path", r"^file:/+", "/"))
