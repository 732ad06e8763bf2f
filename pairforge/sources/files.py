"""Readers for catalogue files and pair files."""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.session import written
from pairforge.sources.schemas import CATALOGUE

# Fixed value: texts that a catalogue file uses for a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def missing_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NA_TOKENS), c)


def _typed(name: str, kind: T.DataType) -> Column:
    value = missing_to_null(F.col(name))
    if isinstance(kind, T.LongType):
        # "12" and "12.0" are both 12; whole numbers keep all their digits.
        return F.coalesce(value.try_cast("long"), value.try_cast("double").try_cast("long"))
    return value.cast(kind)


QUOTE = '"'


def _ranged_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def _piece_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of byte ranges in order to records. A record that no range holds whole leaves as pieces, the last of which
    closes it."""
    kinds = [("file", pa.string()), ("block", pa.int64()), ("line", pa.int64()), ("piece", pa.bool_()), ("closes", pa.bool_()), ("record", pa.string())]
    schema = pa.schema(kinds)
    place, at, odd, first, pending, piece = None, 0, 0, 0, [], False

    def rest():
        if pending:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*place, first, True, False, "\n".join(pending))))], schema)

    for batch in batches:
        value, file, block, inside = (batch.column(batch.schema.get_field_index(c)) for c in ("value", "file", "block", "inside"))
        files, blocks = file.to_pylist(), block.to_numpy()
        cuts = [i for i in range(1, len(files)) if blocks[i] != blocks[i - 1] or files[i] != files[i - 1]]
        quotes = pc.count_substring(value, QUOTE).to_numpy(zero_copy_only=False)
        for a, b in zip([0, *cuts], [*cuts, len(files)]):
            if a == b:
                continue
            if (files[a], int(blocks[a])) != place:
                yield from rest()
                place, at, pending = (files[a], int(blocks[a])), 0, []
                odd = int(inside[a].as_py())
                piece = bool(odd)
            parity = (odd + np.cumsum(quotes[a:b])) % 2
            lines, ends = value.slice(a, b - a).to_pylist(), np.flatnonzero(parity == 0).tolist()
            records, done = [], 0
            for end in ends:  # the record that ends in this line
                if not pending:
                    first = at + done
                pending.extend(lines[done : end + 1])
                records.append((*place, first, piece, piece, "\n".join(pending)))
                done, pending, piece = end + 1, [], False
            if done < len(lines):
                if not pending:
                    first = at + done
                pending.extend(lines[done:])
            odd, at = int(parity[-1]), at + len(lines)
            if records:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*records), schema)], schema=schema)
    yield from rest()


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, block, line, record)``: the records of CSV files whose quoted fields may hold line breaks, with as many
    tasks per file as it has byte ranges.

    Whether a range begins inside a quoted field follows from the number of quotes before it: ranges are counted in one pass,
    their parities summed up per file. Then every task cuts its own lines, and only records that cross the end
    of a range are put together from their pieces. Quotes stand only around fields and, doubled, in them; a file
    with an odd number of quotes is an error that names it. Line breaks become newlines; empty lines are left out.
    """
    lines = _ranged_lines(spark, path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE)))
    odd = written(lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd")), "csv_ranges")
    broken = odd.groupBy("file").agg(F.sum("odd").alias("odd")).where("odd % 2 = 1").select(F.min("file").alias("file")).first()["file"]
    if broken:
        raise ValueError(f"{broken} has an odd number of quotes")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = odd.withColumn("inside", F.sum("odd").over(before) % 2 == 1).where("inside")
    # one short row per byte range that begins inside a field: less than a millionth of the files
    marked = lines.join(F.broadcast(starts.select("file", "block", "inside")), ["file", "block"], "left")
    cut = marked.select("value", "file", "block", F.coalesce("inside", F.lit(False)).alias("inside")).mapInArrow(
        _piece_rows, "file string, block long, line long, piece boolean, closes boolean, record string"
    )
    cut = written(cut, "csv_records")
    pieces = cut.where("piece")
    nth = Window.partitionBy("file").orderBy("block", "line")
    closed = F.sum(F.col("closes").cast("long")).over(nth.rowsBetween(Window.unboundedPreceding, -1))
    joined = (
        pieces.withColumn("nth", F.coalesce(closed, F.lit(0)))
        .groupBy("file", "nth")
        .agg(F.sort_array(F.collect_list(F.struct("block", "line", "record"))).alias("parts"))
        .select("file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["line"].alias("line"),
                F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    )
    whole = cut.where("not piece").select("file", "block", "line", "record")
    return whole.unionByName(joined).where("record <> ''")


def split_catalogue_ranges(
    spark: SparkSession, path: str | list[str], sample_size: int | None = None, schema: T.StructType = CATALOGUE
) -> tuple[DataFrame, DataFrame]:
    """:func:`split_catalogue` for large files with quoted line breaks: the same rows and quarantine, read by byte ranges
    (:func:`read_records`). Spark's CSV functions parse the records."""
    records = written(read_records(spark, path), "csv_catalogue")
    heads = records.groupBy("file").agg(F.min(F.struct("block", "line")).alias("place"))
    # one short row per file, of which the driver's listing holds more; a join by file would put all of a file into one task
    named = records.join(F.broadcast(heads), "file").withColumn("_head", F.struct("block", "line") == F.col("place"))
    headers = named.where("_head").groupBy("record").agg(F.min("file").alias("file")).orderBy("file").limit(2).collect()
    if not headers:
        raise ValueError(f"{path} has no header")
    if len(headers) > 1:
        raise ValueError(f"{headers[1]['file']} has another header than {headers[0]['file']}")
    names = next(csv.reader([headers[0]["record"]]))
    absent = [f.name for f in schema if f.name not in names]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}")
    at_any = [f"c{i}" for i in range(len(names) + 1)]
    fields = F.from_csv(
        F.concat("record", F.lit("," + LAST_FIELD)), ", ".join(f"{c} string" for c in at_any),
        {"escape": QUOTE, "quote": QUOTE, "multiLine": "true"},
    )
    parsed = named.where("not _head").select(
        F.col("file").alias("_file"), F.col("block").alias("_block"), F.col("line").alias("_row"), "record", fields.alias("f"))
    # the mark follows the last field: one beyond the header's fields where all are there, further on where there are too many
    fits = F.exists(F.array(*[F.col("f")[c] for c in at_any]), lambda c: F.coalesce(c == LAST_FIELD, F.lit(False)))
    columns = [F.when(F.col("f")[c] != LAST_FIELD, F.col("f")[c]).alias(n) for c, n in zip(at_any, names)]
    bad = parsed.where(~fits).select(F.col("_file").alias("file"), "record")
    good = parsed.where(fits).select(*FIRST_ROWS, *columns)
    typed = [_typed(f.name, f.dataType).alias(f.name) for f in schema]
    if sample_size is None:
        return good.select(*typed), bad
    return good.select(*typed, *FIRST_ROWS).orderBy(*FIRST_ROWS).limit(sample_size).drop(*FIRST_ROWS), bad


CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"'}
LAST_FIELD = "\u0002"
FIRST_ROWS = ("_file", "_block", "_row")


def split_catalogue(
    spark: SparkSession,
    path: str | list[str],
    sample_size: int | None = None,
    schema: T.StructType = CATALOGUE,
    multi_line: bool | str = True,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, quarantine)`` of catalogue CSV files with a header, in any column order, with any extra columns.

    All files of one call have the same header: a file with another one is an error that names it. Rows with
    more fields than the header go to the quarantine as ``(file, record)``; missing fields at the end of a row are
    NULL. ``sample_size`` takes the first good rows in the order of the files. Quoted line breaks need
    ``multi_line``: True gives every file to one task, "ranges" splits large files too (:func:`split_catalogue_ranges`).
    Files without such breaks are also split with False.
    """
    if multi_line == "ranges":
        return split_catalogue_ranges(spark, path, sample_size, schema)
    names = spark.read.options(**CSV_OPTIONS).csv(path).columns
    absent = [f.name for f in schema if f.name not in names]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}")
    fields = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = (
        spark.read.options(**CSV_OPTIONS)
        .option("multiLine", multi_line)
        .option("enforceSchema", False)  # compares the header of every file
        .option("columnNameOfCorruptRecord", "_corrupt")
        .schema(T.StructType([*fields, T.StructField("_corrupt", T.StringType())]))
        .csv(path)
    )
    # A record is also marked when it is too short. One more field is put behind the marked ones: it lies beyond the
    # header's fields and its own only where there are too many. Records are marked only when
    # all fields are read, hence the fields behind the marked record.
    marked_record = F.coalesce("_corrupt", *[F.col(f"`{n}`") for n in names])
    positions = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    parts = F.from_csv(
        F.concat(marked_record, F.lit("," + LAST_FIELD)), positions, {"escape": '"', "quote": '"', "multiLine": "true"}
    )
    at_any = [f"c{i}" for i in range(len(names) + 1)]
    fits = F.exists(F.array(parts), lambda p: F.array_contains(F.array(*[F.coalesce(p[c], F.lit("")) for c in at_any]), LAST_FIELD))
    # Not IS NOT NULL: the CSV reader would take that for a filter on the parsed fields and drop every row.
    too_long = (F.length(F.coalesce("_corrupt", F.lit(""))) > 0) & ~fits
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    marked = raw.select("*", *place).withColumn("_long", too_long)
    bad = marked.where("_long").select(F.col("_file").alias("file"), F.col("_corrupt").alias("record"))
    typed = [_typed(f.name, f.dataType).alias(f.name) for f in schema]
    if sample_size is None:
        return marked.where("not _long").select(*typed), bad
    numbered = marked.withColumn("_row", F.monotonically_increasing_id()).where("not _long")
    first = numbered.select(*typed, *FIRST_ROWS).orderBy(*FIRST_ROWS).limit(sample_size)
    return first.drop(*FIRST_ROWS), bad


def read_catalogue(
    spark: SparkSession,
    path: str | list[str],
    sample_size: int | None = None,
    schema: T.StructType = CATALOGUE,
    multi_line: bool | str = True,
) -> DataFrame:
    """The rows of :func:`split_catalogue`, which also gives the records that are left out."""
    return split_catalogue(spark, path, sample_size, schema, multi_line)[0]


def _read_csv(spark: SparkSession, path: str, schema: T.StructType | None, multi_line: bool) -> DataFrame:
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line)
    # A given schema saves the pass that infers one, and every file's header is compared with it.
    return reader.schema(schema).option("enforceSchema", False).csv(path) if schema else reader.option(
        "inferSchema", True).csv(path)


def _read_parquet(spark: SparkSession, path: str, schema: T.StructType | None, multi_line: bool) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


READERS = {"csv": _read_csv, "parquet": _read_parquet}


def read_file(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """Read by extension, with ``schema`` if given. ``multi_line`` is for CSV, as in :func:`split_catalogue`."""
    reader = READERS.get(path.rsplit(".", 1)[-1])
    if reader is None:
        raise NotImplementedError(f"no reader for {path}; known endings are {sorted(READERS)}")
    return reader(spark, path, schema, multi_line)


JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt",
    "allowSingleQuotes": "false",
}


def parse_records(lines: DataFrame, schema: T.StructType, required=(), value: str = "value") -> DataFrame:
    """Parse one JSON object per line; adds the fields and ``_problem`` (NULL when the line is good).

    The parser stops at the end of the first object, so each line is also read as the only element of
    an array and as the only field of an object, which fails when anything follows it. A required key
    must be there, but may be null unless it holds a list.
    """
    line = F.col(value)
    with_corrupt = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    alone = F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<string>", JSON_OPTIONS)
    closed = F.from_json(
        F.concat(F.lit('{"v":'), line, F.lit("}")), "v string, _corrupt string", JSON_OPTIONS
    )
    parsed = lines.withColumn("_r", F.from_json(line, with_corrupt, JSON_OPTIONS)).withColumn(
        "_whole", (F.size(alone) == 1) & closed["_corrupt"].isNull()
    )
    keys = F.json_object_keys(line)
    lacking = F.lit(False)
    for name in required:
        lacking = lacking | ~F.array_contains(keys, name)
        if isinstance(schema[name].dataType, T.ArrayType):
            lacking = lacking | F.col(f"_r.{name}").isNull()
    problem = (
        F.when(F.trim(line) == "", F.lit("blank"))
        .when(F.col("_r").isNull() | F.col("_r._corrupt").isNotNull(), F.lit("malformed"))
        .when(~F.coalesce(F.col("_whole"), F.lit(False)), F.lit("malformed"))
        .when(lacking, F.lit("missing_key"))
    )
    return parsed.withColumn("_problem", problem).select(
        *lines.columns, *[F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields], "_problem"
    )


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def split_lines(
    lines: DataFrame, schema: T.StructType, required=(), max_rows: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)`` of ``lines(value, _file, _block)``, parsed once into a table that gives both.

    Line numbers come from the lines of that table counted per file block, so files stay splittable. Keeps
    the first ``max_rows`` good rows, by file and line, when given.
    """
    parsed = parse_records(lines.withColumn("_seq", F.monotonically_increasing_id()), schema, required)
    bad = F.col("_problem").isNotNull()
    parsed = written(parsed.withColumn("value", F.when(bad, F.col("value"))), "json_lines")
    good = parsed.where(~bad)
    if max_rows is not None:
        good = good.orderBy("_file", "_block", "_seq").limit(max_rows)

    blocks = parsed.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "_file", "_block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    quarantine = (
        parsed.where(bad)
        .select("_file", "_block", "_seq", "value", "_problem")
        .join(starts, ["_file", "_block"])
        .select(
            F.col("_file").alias("file"),
            (F.col("_before") + F.col("_seq") - F.col("_first") + 1).alias("line_number"),
            F.col("value").alias("line"),
            F.col("_problem").alias("problem"),
        )
    )
    return good.select(*schema.fieldNames()), quarantine


def read_jsonl(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    required=(),
    max_rows: int | None = None,
    require_valid: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)`` of a JSON-lines path.

    Bad lines are not dropped: the quarantine has their file, 1-based line number, text and problem.
    Keeps the first ``max_rows`` good rows when given.
    """
    good, quarantine = split_lines(_lines(spark, path), schema, required, max_rows)
    if require_valid and good.isEmpty():
        raise ValueError(f"no valid record in {path}")
    return good, quarantine
