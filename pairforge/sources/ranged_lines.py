"""A registered source of text lines: planned by byte range in a batch, by name and byte in a stream.

``spark.read.format("ranged_lines").load(folder)`` and ``spark.readStream.format("ranged_lines")`` give ``file, start, value``:
each line with the byte it starts at. The Python side only cuts ranges into lines, a chunk of bytes at a time; records are
parsed by Spark (:func:`parse_pairs`), with the rules of :mod:`pairforge.sources.files`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from pairforge.sources.files import parse_records
from pairforge.sources.locations import open_location
from pairforge.sources.registry import register
from pairforge.sources.schemas import record_schema

NAME = "ranged_lines"
SCHEMA = "file string, start bigint, value string"
RANGE_BYTES = 128 << 20
CHUNK = 1 << 20
PACKED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".xz", ".deflate")  # endings of files that have no byte ranges


@dataclass
class Range(InputPartition):
    """The lines of ``path`` whose first byte lies in ``[start, end)``."""

    path: str
    start: int
    end: int


def _listed(location: str) -> list[tuple[str, int]]:
    """``(path, bytes)`` of a file or of a folder's files by name, without hidden ones; an error for packed files."""
    system, path = open_location(location)
    found = system.get_file_info(path)
    if found.type == fs.FileType.NotFound:
        raise FileNotFoundError(location)
    infos = [found] if found.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path))
    files = sorted((i.path, i.size) for i in infos if i.type == fs.FileType.File and i.base_name[:1] not in ("_", "."))
    packed = [p for p, _ in files if p.endswith(PACKED)]
    if packed:
        raise ValueError(f"packed files cannot be read by byte range: {packed[:3]}")
    return files


def _ranges(path: str, start: int, end: int, size: int) -> list[Range]:
    return [Range(path, at, min(at + size, end)) for at in range(start, end, size)]


def _lines(location: str, part: Range) -> Iterator[pa.RecordBatch]:
    """Lines that start in the range, the last one to its end beyond it; a chunk and one line are in memory."""
    system, _ = open_location(location)
    with system.open_input_file(part.path) as source:
        size = source.size()
        # A line starts after a break, so the byte before the range tells whether one starts at its first byte.
        at = max(part.start - 1, 0)
        source.seek(at)
        skipping, rest, first = part.start > 0, [], at
        starts: list[int] = []
        values: list[str] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part.path] * len(starts), pa.string()), pa.array(starts, pa.int64()), pa.array(values, pa.string())],
                names=["file", "start", "value"],
            )

        def text(line: bytes) -> str:
            return line.removesuffix(b"\r").decode("utf-8", "replace")

        while at < size and first < part.end:
            chunk = source.read(min(CHUNK, size - at))
            if not chunk:
                break
            at += len(chunk)
            *whole, tail = chunk.split(b"\n")
            for piece in whole:
                rest.append(piece)
                line = b"".join(rest)
                rest = []
                if not skipping and first < part.end:
                    starts.append(first)
                    values.append(text(line))
                skipping = False
                first += len(line) + 1
            if tail:
                rest.append(tail)
            if starts:
                yield batch()
                starts, values = [], []
        if rest and not skipping and first < part.end:
            starts.append(first)
            values.append(text(b"".join(rest)))
            yield batch()


class _BatchReader(DataSourceReader):
    def __init__(self, location: str, range_bytes: int) -> None:
        self.location, self.range_bytes = location, range_bytes

    def partitions(self) -> list[Range]:
        parts = [r for path, size in _listed(self.location) for r in _ranges(path, 0, size, self.range_bytes)]
        return parts or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _lines(self.location, partition) if partition.path else iter(())


class _StreamReader(DataSourceStreamReader):
    """An offset is the last file by name, the bytes of it that are read, and how many files are up to it.

    It stays that small whatever has been read. New files must sort after those that were read, as files named by time or
    number do; one that appears before them is an error, not a silent loss. The last file may grow: its last line is
    read when its line break is there, or when a later file is.
    """

    def __init__(self, location: str, range_bytes: int) -> None:
        self.location, self.range_bytes = location, range_bytes

    def initialOffset(self) -> dict:
        return {"file": "", "bytes": 0, "files": 0}

    def latestOffset(self) -> dict:
        files = _listed(self.location)
        if not files:
            return self.initialOffset()
        path, size = files[-1]
        return {"file": path, "bytes": self._whole_lines(path, size), "files": len(files)}

    def _whole_lines(self, path: str, size: int) -> int:
        """Bytes up to and with the last line break."""
        system, _ = open_location(self.location)
        with system.open_input_file(path) as source:
            end = size
            while end > 0:
                at = max(end - CHUNK, 0)
                source.seek(at)
                found = source.read(end - at).rfind(b"\n")
                if found >= 0:
                    return at + found + 1
                end = at
        return 0

    def partitions(self, start: dict, end: dict) -> list[Range]:
        files = _listed(self.location)
        for offset in (start, end):
            known = sum(path <= offset["file"] for path, _ in files)
            if known != offset["files"]:
                raise ValueError(f"{known} files up to {offset['file']}, but {offset['files']} when it was read; names must ascend")
        parts = []
        for path, size in files:
            if start["file"] <= path <= end["file"]:
                first = start["bytes"] if path == start["file"] else 0
                last = end["bytes"] if path == end["file"] else size
                parts += _ranges(path, first, last, self.range_bytes)
        return parts

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _lines(self.location, partition)


class RangedLines(DataSource):
    """Lines of the plain files of ``path`` (a file or folder), as ``file, start, value``.

    A line ends with a line feed, with or without a carriage return before it. Option ``rangeBytes`` is the size of a
    partition (128 MB); a line belongs to the range that its first byte is in. Hidden files are left out.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def _settings(self) -> tuple[str, int]:
        if not self.options.get("path"):
            raise ValueError(f"{NAME} needs a path")
        size = int(self.options.get("rangeBytes", RANGE_BYTES))
        if size < 1:
            raise ValueError("rangeBytes must be positive")
        return self.options["path"], size

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(*self._settings())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(*self._settings())


def ranged_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, stream: bool = False) -> DataFrame:
    """The source's lines as a table or as a stream."""
    spark.dataSource.register(RangedLines)
    reader = spark.readStream if stream else spark.read
    return reader.format(NAME).option("rangeBytes", range_bytes).load(path)


def parse_pairs(lines: DataFrame, split: str = "train") -> DataFrame:
    """Records of a split with ``file``, ``start`` and ``problem``, NULL where the line is good. Map-side only."""
    schema, required = record_schema(split)
    return parse_records(lines, schema, required).withColumnRenamed("_problem", "problem")


@register("ranged_pairs")
def ranged_pairs(
    spark: SparkSession, jsonl_path: str, dataset_split: str = "train", range_bytes: int = RANGE_BYTES, **_
) -> DataFrame:
    """Good records of JSON-lines files, read by byte ranges through the registered source."""
    parsed = parse_pairs(ranged_lines(spark, jsonl_path, range_bytes), dataset_split)
    return parsed.where("problem is null").select(*record_schema(dataset_split)[0].fieldNames())
