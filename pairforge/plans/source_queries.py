"""Queries over readers, writers, streams and parsers. Files are derived from the given tables."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import functions as F

from pairforge.functions.images import resize_plan
from pairforge.functions.text import WHITESPACE
from pairforge.operators import catalogue as C
from pairforge.plans import build
from pairforge.plans import catalogue_queries as CQ
from pairforge.plans import fixtures as X
from pairforge.session import scratch_path, written
from pairforge.sources import conform as S
from pairforge.sources import files, hub, image_headers, images, locations, ranged_lines, registry, schemas, sinks
from pairforge.streaming import dedupe, ingest, throughput


def _write_csv(df, path):
    """CSV with a header, quoted texts and missing values spelled NA."""
    (
        df.write.option("header", True).option("quoteAll", True).option("escape", '"').option("nullValue", "NA")
        .option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def a1(spark, sf):
    path = scratch_path(spark, "catalogue-csv")
    _write_csv(X.big_catalogue(spark, sf).select(
        "master_category", "description", "style_id",
        F.when(F.col("style_id") % 11 != 0, F.col("default_image")).alias("default_image"),
        F.lit("unused").alias("extra"),
    ), path)
    return files.read_catalogue(spark, path)


def a1_texts(spark, sf):
    """Texts with quotes and line breaks; the reader turns each line break into a newline."""
    path = scratch_path(spark, "texts-csv")
    _write_csv(X.catalogue(spark, sf), path)
    return files.read_catalogue(spark, path)


FILE_BYTES, RANGE_BYTES = 256 << 20, 64 << 20


def _ranged(spark, sf, table, rows):
    """``rows`` as one CSV file per ``FILE_BYTES`` of fields, read by byte ranges of a fortieth of all, ``RANGE_BYTES`` at most,
    and whether these are many."""
    path = scratch_path(spark, f"{table}-ranges-csv")
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("long") for c in rows.columns), F.lit(0).cast("long"))
    length = rows.agg(F.sum(width)).first()[0] or 0
    _write_csv(rows.coalesce(length // FILE_BYTES + 1), path)
    size = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).agg(F.sum("length")).first()[0]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", min(size // 40 + 1, RANGE_BYTES))
    try:
        rows = written(files.split_catalogue_ranges(spark, path)[0], "ranged")
        ranges = files.read_records(spark, path).agg(F.count_distinct("file", "block")).first()[0]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return rows.withColumn("in_many_ranges", F.lit(ranges > 20))


def a1_split(spark, sf):
    """One file of all parts, whose names have a quote and line breaks."""
    name = F.concat(F.regexp_replace("description", " ", "\n"), F.lit('\n"'), F.col("style_id").cast("string"), F.lit('",\n'))
    parts = X.big_catalogue(spark, sf).withColumn("description", name)
    return _ranged(spark, sf, "parts", parts)


def a1_split_texts(spark, sf):
    """All documents, in one file as long as they are few; then many texts are longer than a byte range."""
    return _ranged(spark, sf, "texts", X.catalogue(spark, sf))


def _long_rows(spark, sf):
    """Every fifth row has one field more than the header, every seventh of the others one less."""
    cat = X.big_catalogue(spark, sf).where("description is not null and default_image is not null")
    sid = F.col("style_id").cast("string")
    full = F.concat_ws(",", sid, F.col("default_image"), F.concat(F.lit("p"), sid), F.lit("kept"))
    line = F.when(F.col("style_id") % 5 == 0, F.concat(full, F.lit(","))).when(
        F.col("style_id") % 7 == 0, F.concat_ws(",", sid, F.col("default_image"), F.concat(F.lit("p"), sid))
    ).otherwise(full)
    path = scratch_path(spark, "long-rows-csv")
    header = "style_id,default_image,description,master_category"
    cat.select(line.alias(header)).write.option("header", True).option("quote", "").csv(path, sep="\u0001")
    return files.split_catalogue(spark, path, multi_line=False)


def a1_short(spark, sf):
    """Rows with a missing last field stay, with NULL."""
    return _long_rows(spark, sf)[0]


def a1_quarantine(spark, sf):
    return _long_rows(spark, sf)[1].select("record")


def a2_csv(spark, sf):
    path = scratch_path(spark, "documents") + ".csv"
    docs = X.table(spark, sf, "documents").select("doc_id", "lang", "n_chars", "text")
    _write_csv(docs, path)
    return files.read_file(spark, path, docs.schema).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"), F.sum(F.length("text")).alias("characters")
    )


def a2(spark, sf):
    return files.read_file(spark, f"{sf}/documents.parquet").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")
    )


def _pair_lines(spark, sf):
    """Train pairs of the whole catalogue as JSON lines, some of them spoilt."""
    cat = X.catalogue(spark, sf)
    record = F.to_json(
        F.struct(
            F.concat(F.lit("Find "), "master_category").alias("instruction_text"),
            F.col("description").alias("query_text"),
            F.lit(None).cast("string").alias("query_image_path"),
            F.col("default_image").alias("target_image_path"),
            F.lit("retrieval").alias("task_category"),
            F.col("style_id"),
        ),
        {"ignoreNullFields": "false"},
    )
    sid = F.col("style_id")
    no_image = F.to_json(F.struct(F.lit("Find").alias("instruction_text"), F.col("description").alias("query_text"), "style_id"))
    line = (
        F.when(sid % 10 == 3, F.concat(F.lit('{"style_id": '), sid.cast("string")))
        .when(sid % 17 == 5, F.lit(""))
        .when(sid % 13 == 7, F.concat(record, F.lit(" trailing")))
        .when(sid % 19 == 11, sid.cast("string"))
        .when(sid % 23 == 13, no_image)
        .otherwise(record)
    )
    return cat.select(line.alias("value"))


def _write_lines(spark, sf):
    path = scratch_path(spark, "pairs-jsonl")
    _pair_lines(spark, sf).write.text(path)
    return path


def a3(spark, sf):
    good, _ = files.read_jsonl(spark, _write_lines(spark, sf), schemas.TRAIN, schemas.REQUIRED_TRAIN)
    return good


def a3_null(spark, sf):
    """Records whose image is an explicit null are kept."""
    return a3(spark, sf).where("target_image_path is null").select("style_id", "query_text")


def a3_quarantine(spark, sf):
    _, bad = files.read_jsonl(spark, _write_lines(spark, sf), schemas.TRAIN, schemas.REQUIRED_TRAIN)
    return bad.groupBy("problem").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("file", "line_number").alias("places")
    )


def a4(spark, sf):
    root = scratch_path(spark, "splits")
    records = C.train_records(X.big_catalogue(spark, sf)).withColumn(
        "split", F.when(F.col("style_id") % 10 == 0, "val").when(F.col("style_id") % 10 == 1, "test").otherwise("train")
    )
    sinks.write_splits(records, root, ["train", "val", "test"])
    back = None
    for split in ("train", "val", "test"):
        part = sinks.read_split(spark, root, split, schemas.TRAIN).withColumn("split", F.lit(split))
        back = part if back is None else back.unionByName(part)
    return back


def a4_rerun(spark, sf):
    """The second run has no test rows; the first one's must not stay. With the manifest of what is there."""
    root = scratch_path(spark, "splits")
    parts = C.train_records(X.big_catalogue(spark, sf)).withColumn("split", F.when(F.col("style_id") % 10 == 0, "val").otherwise("test"))
    sinks.write_splits(parts, root, ["val", "test"])
    sinks.write_splits(parts.where("split = 'val'"), root, ["val", "test"])
    return sinks.split_manifest(spark, root, ("val", "test")).select("split", "rows", (F.col("megabytes") > 0).alias("has_bytes"))


def a5(spark, sf):
    """A second run leaves the committed train split alone and repeats an uncommitted one."""
    root = scratch_path(spark, "restart")
    cat = X.big_catalogue(spark, sf)
    first = sinks.write_split(C.train_records(cat.where("style_id % 2 = 0")), root, "train", skip_existing=True)
    second = sinks.write_split(C.train_records(cat), root, "train", skip_existing=True)
    third = sinks.write_split(C.train_records(cat), root, "val", skip_existing=True)
    out = None
    for split, wrote in (("train", second), ("val", third)):
        rows = sinks.read_split(spark, root, split, schemas.TRAIN).agg(F.count(F.lit(1)).alias("n"))
        part = rows.select(F.lit(split).alias("split"), "n", F.lit(first and wrote).alias("written_by_second_run"))
        out = part if out is None else out.unionByName(part)
    return out


def a6(spark, sf):
    """Pages are the stored pictures; a reference is present, missing, remote or empty by its id."""
    pages = X.table(spark, sf, "pages")
    store = pages.select(
        F.concat(F.lit("/img/"), F.col("page_id").cast("string"), F.lit(".png")).alias("path"),
        F.encode("html", "UTF-8").alias("content"),
    )
    count = pages.agg(F.count(F.lit(1))).scalar()
    refs = X.table(spark, sf, "documents").select("doc_id", count.alias("_n")).select(
        F.col("doc_id").alias("style_id"),
        F.when(F.col("doc_id") % 10 == 0, F.lit(""))
        .when(F.col("doc_id") % 10 == 1, F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string")))
        .when(F.col("doc_id") % 10 == 2, F.concat(F.lit("img/none"), F.col("doc_id").cast("string")))
        .when(F.col("doc_id") % 10 == 3, F.lit("img/../img/0.png"))
        .otherwise(F.concat(F.lit("img/"), (F.col("doc_id") % F.col("_n")).cast("string"), F.lit(".png")))
        .alias("target_image_path"),
    )
    attached = images.attach_images(refs, store, hot_rows=50)
    return attached.select(
        "style_id", "image_status", F.col("passage_image.path").alias("path"),
        F.when(F.col("image_status") == "ok", F.md5("passage_image.bytes")).alias("content_md5"),
        (F.length("passage_image.bytes") > 0).alias("has_bytes"),
    )


def a7(spark, sf):
    """Sources of the documents as a catalogue of sets; requested are the sources and one unknown name each."""
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    sets = X.table(spark, sf, "documents").select("source").distinct().select(
        F.col("source").alias("name"),
        F.concat(F.lit("team/"), "source").alias("repo"),
        F.when(number % 2 == 0, F.lit("english")).alias("subset"),
        F.when(number % 3 == 0, F.lit("test")).alias("split"),
    )
    wanted = sets.select("name").unionByName(sets.select(F.concat("name", F.lit("-x")).alias("name")))
    return hub.resolve(wanted, sets, "/data").select("name", "rule", "location")


def a8(spark, sf):
    """Manifest of the complete build of the parts."""
    root = scratch_path(spark, "build")
    manifest = build.build_splits(X.big_catalogue(spark, sf), root, CQ.FAST, "pooled")
    return manifest.select("split", "rows", (F.col("megabytes") > 0).alias("has_bytes"))


def a9(spark, sf):
    cat = X.catalogue(spark, sf)
    pairs = cat.select(
        F.col("description").alias("query_text"),
        S.image_group().alias("query_image"),
        F.lit("").alias("pos_text"),
        S.image_group(
            F.col("default_image"), resolution=F.array(F.col("style_id") % 100 + 1, F.lit(672).cast("long"))
        ).alias("pos_image"),
        F.col("style_id").alias("dropped"),
    )
    shaped = S.conform(S.tag(pairs, "products"))
    return shaped.select(
        "query_text", F.col("query_image").isNull().alias("no_query_image"), "pos_text",
        F.array_join("pos_image.paths", ",").alias("pos_paths"),
        F.size("pos_image.bytes").alias("pos_images"),
        F.get("pos_image.resolutions", F.lit(0))[0].alias("pos_width"),
        "neg_text", F.col("neg_image").isNull().alias("no_neg_image"), "global_dataset_name",
    )


def a9_violations(spark, sf):
    """Every seventh resolution has three numbers."""
    cat = X.catalogue(spark, sf).where("default_image is not null")
    size = F.col("style_id").cast("int")
    pairs = cat.select(
        "style_id",
        S.image_group(
            F.col("default_image"),
            resolution=F.when(size % 7 == 0, F.array(size, size, size)).otherwise(F.array(size, size)),
        ).alias("pos_image"),
        S.image_group().alias("query_image"), S.image_group().alias("neg_image"),
    )
    return S.resolution_violations(pairs).select("style_id", "violation")


def _from_table(lang):
    def parser(spark, sf_dir, subset_name, **_):
        rows = X.catalogue(spark, sf_dir).where(F.col("master_category") == lang)
        return S.tag(rows.select("style_id"), subset_name)

    return parser


for _lang in ("en", "fr"):
    registry.register(f"table_{_lang}")(_from_table(_lang))


def k2(spark, sf):
    """Parsers by name from a configuration, one of them over a JSON-lines file."""
    config = {
        "English": {"dataset_parser": "table_en", "sf_dir": sf, "subset_name": "english"},
        "French": {"dataset_parser": "table_fr", "sf_dir": sf, "subset_name": "french"},
        "Pairs": {"dataset_parser": "jsonl_pairs", "jsonl_path": _write_lines(spark, sf), "subset_name": "pairs"},
    }
    out = None
    for entry in config.values():
        part = registry.instantiate(spark, **entry).select("style_id", "global_dataset_name")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("global_dataset_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("style_id").alias("ids"), F.max("style_id").alias("last_id")
    )


def k2_quarantine(spark, sf):
    bad = registry.instantiate(
        spark, dataset_parser="jsonl_pairs_quarantine", jsonl_path=_write_lines(spark, sf), subset_name="pairs"
    )
    return bad.groupBy("global_dataset_name", "problem").agg(F.count_distinct("file", "line_number").alias("n"))


def k2_source(spark, sf):
    """The lines through the registered source, in ranges of a fortieth of their bytes."""
    path = _write_lines(spark, sf)
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    parsed = ranged_lines.parse_pairs(ranged_lines.ranged_lines(spark, path, size // 40 + 1))
    read = written(parsed.withColumn("range", F.spark_partition_id()), "ranged_pairs")
    many = read.agg(F.count_distinct("range") > 10).scalar()
    return read.where("problem is null").select(*schemas.TRAIN.fieldNames(), many.alias("in_many_ranges"))


def k2_stream(spark, sf):
    """The same lines as a stream, good and bad, with the number of places they start at."""
    target = scratch_path(spark, "ranged-stream")
    lines = ranged_lines.ranged_lines(spark, _write_lines(spark, sf), 1 << 20, stream=True)
    (
        ranged_lines.parse_pairs(lines).writeStream.format("parquet").option("path", target)
        .option("checkpointLocation", scratch_path(spark, "ranged-state")).trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.parquet(target).groupBy(F.coalesce("problem", F.lit("good")).alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("file", "start").alias("places"),
        F.coalesce(F.sum(F.when(F.col("problem").isNull(), F.col("style_id"))), F.lit(0)).alias("ids"),
    )


def _header(kind: str, width: int, height: int) -> bytes:
    """The first bytes of an image file, as far as its size; without pixels."""
    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    frame = struct.pack(">HBHHB", 11, 8, height, width, 1) + b"\x01\x11\x00"
    app = b"\xff\xe1" + struct.pack(">H", 60_002) + b"\xff\xc0" * 30_000  # looks like frames inside
    return {
        "png": png + b"\0" * 4,
        "jpg": b"\xff\xd8\xff\xc0" + frame + b"\xff\xd9",
        "long": b"\xff\xd8" + app * 2 + b"\xff\xff\xff\xc2" + frame,
        "cut": png[:20],
        "text": b"not an image",
    }[kind]


def b14_files(spark, sf):
    """Sizes of image files, read from their headers, and the plan for them. Parts of equal size share a file."""
    root = scratch_path(spark, "image-files")
    kind = F.get(F.array(*[F.lit(k) for k in ("png", "jpg", "long", "cut", "text")]), (F.col("p_partkey") % 5).cast("int"))
    parts = X.image_sizes(spark, sf).select(
        "p_partkey", kind.alias("kind"), "width", "height",
        F.format_string("%s %dx%d.img", kind, F.col("width").cast("int"), F.col("height").cast("int")).alias("name"),
    )

    def write(batches):
        system, folder = locations.open_location(root)
        system.create_dir(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_output_stream(f"{folder}/{row['name']}") as out:
                    out.write(_header(row["kind"], row["width"], row["height"]))
            yield pa.RecordBatch.from_arrays([batch.column("name")], names=["name"])

    shapes = parts.select("name", "kind", "width", "height").distinct()
    shapes.mapInArrow(write, "name string").agg(F.count(F.lit(1))).collect()
    sizes = image_headers.read_image_headers(spark, root).withColumn("name", F.element_at(F.split("path", "/"), -1))
    found = parts.select("p_partkey", "name").join(written(sizes.drop("path"), "image_sizes"), "name")
    return found.select("p_partkey", "format", "status", "width", "height", *resize_plan("width", "height"))


def c7(spark, sf):
    events = X.table(spark, sf, "events")
    rate = throughput.throughput(events, by=["event_type"])
    return rate.select("event_type", "n", F.round("elapsed", 6).alias("elapsed"), F.round("rate", 9).alias("rate"))


def c7_stream(spark, sf):
    """The running rate when the stream of events, in eight files, has ended."""
    source, target = scratch_path(spark, "events"), scratch_path(spark, "rates")
    events = X.table(spark, sf, "events")
    events.repartition(8, "event_id").write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 3).parquet(source)
    throughput.run_throughput(stream, target, scratch_path(spark, "rates-state"), ["event_type"]).awaitTermination()
    rate = throughput.read_throughput(spark, target, ["event_type"])
    return rate.select("event_type", "n", F.round("elapsed", 6).alias("elapsed"), F.round("rate", 9).alias("rate"))


def j1(spark, sf):
    """The stream's good and quarantined rows, counted with their ids."""
    source = _write_lines(spark, sf)
    target = scratch_path(spark, "ingest")
    ingest.ingest_pairs(
        spark, source, target, scratch_path(spark, "ingest-state"), name="products", max_files_per_trigger=1
    ).awaitTermination()
    good = spark.read.parquet(f"{target}/good").select(
        F.lit("good").alias("kind"), F.col("style_id").alias("id"), "query_text", F.col("passage_path").alias("path")
    )
    bad = spark.read.parquet(f"{target}/quarantine").groupBy("problem").agg(
        F.count_distinct("file", "line_number").alias("n")
    )
    return good.unionByName(
        bad.select(
            F.col("problem").alias("kind"), F.col("n").alias("id"),
            F.lit(None).cast("string").alias("query_text"), F.lit(None).cast("string").alias("path"),
        )
    )


def j1_dedupe(spark, sf):
    """Every line is delivered in one file, and two thirds of them again in a second one; each record lands once."""
    source, target, state = _write_lines(spark, sf), scratch_path(spark, "ingest"), scratch_path(spark, "ingest-state")
    again = spark.read.text(source).where(F.xxhash64("value") % 3 != 0)
    ingest.ingest_pairs(spark, source, target, state, name="products").awaitTermination()
    again.write.mode("append").text(source)
    ingest.ingest_pairs(spark, source, target, state, name="products").awaitTermination()
    good = spark.read.parquet(f"{target}/good")
    once = scratch_path(spark, "once")
    dedupe.store_first_deliveries(
        spark, f"{target}/good", good.schema, once, scratch_path(spark, "once-state"), ["style_id"], max_files_per_trigger=2
    ).awaitTermination()
    landed = spark.read.parquet(once)
    return landed.select(F.col("style_id").alias("id"), "query_text", F.col("passage_path").alias("path")).withColumn(
        "delivered", good.agg(F.count(F.lit(1))).scalar() > landed.agg(F.count(F.lit(1))).scalar())


def j2(spark, sf):
    counts = throughput.windowed_counts(X.table(spark, sf, "events"))
    return _plain(counts)


def _plain(counts):
    return counts.select(
        F.col("window_start").cast("string").alias("window_start"), F.col("window_end").cast("string").alias("window_end"),
        "event_type", "n",
    )


def j2_stream(spark, sf):
    """The same counts from a stream over the table's files."""
    schema = X.table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    target = scratch_path(spark, "windows")
    throughput.run_windowed_counts(events, target, scratch_path(spark, "windows-state")).awaitTermination()
    return _plain(throughput.read_windowed_counts(spark, target))


QUERIES = {
    "a1_catalogue_scan": a1,
    "a1_catalogue_texts": a1_texts,
    "a1_split_multiline": a1_split,
    "a1_split_texts": a1_split_texts,
    "a1_short_rows": a1_short,
    "a1_quarantine": a1_quarantine,
    "a2_read_csv": a2_csv,
    "a2_read_file": a2,
    "a3_jsonl_scan": a3,
    "a3_jsonl_quarantine": a3_quarantine,
    "a3_explicit_null": a3_null,
    "a4_split_sink": a4,
    "a4_rerun_with_empty_split": a4_rerun,
    "a5_skip_existing": a5,
    "a6_attach_images": a6,
    "a7_resolve_sets": a7,
    "a8_split_manifest": a8,
    "a9_conform": a9,
    "a9_resolution_violations": a9_violations,
    "k2_parser_registry": k2,
    "k2_parser_quarantine": k2_quarantine,
    "k2_ranged_source": k2_source,
    "k2_ranged_stream": k2_stream,
    "b14_file_sizes": b14_files,
    "c7_throughput": c7,
    "c7_stream_throughput": c7_stream,
    "j1_stream_ingest": j1,
    "j1_stream_dedupe": j1_dedupe,
    "j2_windowed_counts": j2,
    "j2_stream_windows": j2_stream,
}

_LINES = f"""{X.CATALOGUE},
kinds AS (
  SELECT *, CASE WHEN style_id % 10 = 3 THEN 'malformed' WHEN style_id % 17 = 5 THEN 'blank'
                 WHEN style_id % 13 = 7 THEN 'malformed' WHEN style_id % 19 = 11 THEN 'malformed'
                 WHEN style_id % 23 = 13 THEN 'missing_key' ELSE 'good' END AS kind
  FROM catalogue)"""

_WINDOWS = """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, event_type, count(*) AS n
FROM events GROUP BY ALL"""

SQL = {
    "a1_catalogue_scan": """
SELECT p_partkey AS style_id, p_name AS description,
       CASE WHEN p_partkey % 11 <> 0 THEN 'img/' || p_partkey || '.jpg' END AS default_image, p_type AS master_category
FROM part""",
    "a1_catalogue_texts": f"""WITH {X.CATALOGUE}
SELECT style_id, replace(replace(description, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS description,
       default_image, master_category FROM catalogue""",
    "a1_split_multiline": """
SELECT p_partkey AS style_id, replace(p_name, ' ', chr(10)) || chr(10) || '"' || p_partkey || '",' || chr(10) AS description,
       'img/' || p_partkey || '.jpg' AS default_image, p_type AS master_category, true AS in_many_ranges FROM part""",
    "a1_split_texts": f"""WITH {X.CATALOGUE}
SELECT style_id, replace(replace(description, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS description,
       default_image, master_category, true AS in_many_ranges FROM catalogue""",
    "a1_short_rows": """
SELECT p_partkey AS style_id, 'p' || p_partkey AS description, 'img/' || p_partkey || '.jpg' AS default_image,
       CASE WHEN p_partkey % 7 <> 0 THEN 'kept' END AS master_category
FROM part WHERE p_partkey % 5 <> 0""",
    "a1_quarantine": """
SELECT concat_ws(',', p_partkey, 'img/' || p_partkey || '.jpg', 'p' || p_partkey, 'kept', '') AS record
FROM part WHERE p_partkey % 5 = 0""",
    "a2_read_csv": """
SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, CAST(sum(length(replace(text, chr(13) || chr(10), chr(10)))) AS BIGINT) AS characters
FROM documents GROUP BY lang""",
    "a2_read_file": "SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang",
    "a3_jsonl_scan": f"""WITH {_LINES}
SELECT 'Find ' || master_category AS instruction_text, description AS query_text, CAST(NULL AS VARCHAR) AS query_image_path,
       default_image AS target_image_path, 'retrieval' AS task_category, style_id FROM kinds WHERE kind = 'good'""",
    "a3_jsonl_quarantine": f"""WITH {_LINES}
SELECT kind AS problem, count(*) AS n, count(*) AS places FROM kinds WHERE kind <> 'good' GROUP BY kind""",
    "a3_explicit_null": f"""WITH {_LINES}
SELECT style_id, description AS query_text FROM kinds WHERE kind = 'good' AND default_image IS NULL""",
    "a4_split_sink": f"""WITH {X.BIG_CATALOGUE}
SELECT {CQ.INSTRUCTION} AS instruction_text, description AS query_text, CAST(NULL AS VARCHAR) AS query_image_path,
       default_image AS target_image_path, 'retrieval' AS task_category, style_id,
       CASE style_id % 10 WHEN 0 THEN 'val' WHEN 1 THEN 'test' ELSE 'train' END AS split FROM catalogue""",
    "a4_rerun_with_empty_split": """
SELECT 'val' AS split, count(*) AS rows, true AS has_bytes FROM part WHERE p_partkey % 10 = 0 UNION ALL SELECT 'test', 0, false""",
    "a5_skip_existing": """
SELECT 'train' AS split, count(*) FILTER (WHERE p_partkey % 2 = 0) AS n, false AS written_by_second_run FROM part
UNION ALL SELECT 'val', count(*), true FROM part""",
    "a6_attach_images": """
WITH n AS (SELECT count(*) AS n FROM pages),
refs AS (
  SELECT doc_id, CASE doc_id % 10 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN -1 WHEN 3 THEN 0 ELSE doc_id % n END AS page_id,
         CASE doc_id % 10 WHEN 0 THEN NULL WHEN 1 THEN 'https://example.org/' || doc_id WHEN 2 THEN 'img/none' || doc_id
              WHEN 3 THEN 'img/../img/0.png' ELSE 'img/' || (doc_id % n) || '.png' END AS path
  FROM documents, n)
SELECT doc_id AS style_id,
       CASE WHEN doc_id % 10 = 0 THEN 'empty' WHEN doc_id % 10 = 1 THEN 'remote'
            WHEN p.page_id IS NULL OR html = '' THEN 'missing' ELSE 'ok' END AS image_status,
       path, CASE WHEN html <> '' THEN md5(html) END AS content_md5, CASE WHEN doc_id % 10 <> 0 THEN true END AS has_bytes
FROM refs r LEFT JOIN pages p ON p.page_id = r.page_id""",
    "a7_resolve_sets": r"""WITH sets AS (
  SELECT name, 'team/' || name AS repo, CASE WHEN k % 2 = 0 THEN 'english' END AS subset, CASE WHEN k % 3 = 0 THEN 'test' END AS split
  FROM (SELECT DISTINCT source AS name, CAST(regexp_extract(source, '(\d+)$', 1) AS INTEGER) AS k FROM documents))
SELECT name, CASE WHEN subset IS NOT NULL AND split IS NOT NULL THEN 'subset_and_split' WHEN subset IS NOT NULL THEN 'subset'
                  WHEN split IS NOT NULL THEN 'split' ELSE 'whole' END AS rule,
       concat_ws('/', '/data', repo, subset, split) AS location FROM sets
UNION ALL SELECT name || '-x', 'unknown', NULL FROM sets""",
    "a8_split_manifest": f"""WITH {X.splits_sql(100, X.BIG_CATALOGUE)}
SELECT n.split, count(s.split) AS rows, count(s.split) > 0 AS has_bytes
FROM (VALUES ('train'), ('val'), ('test')) n(split) LEFT JOIN splits s ON s.split = n.split GROUP BY n.split""",
    "a9_conform": f"""WITH {X.CATALOGUE}
SELECT description AS query_text, true AS no_query_image, '' AS pos_text, coalesce(default_image, '') AS pos_paths,
       CASE WHEN default_image IS NULL THEN 0 ELSE 1 END AS pos_images,
       CASE WHEN default_image IS NOT NULL THEN CAST(style_id % 100 + 1 AS INTEGER) END AS pos_width,
       CAST(NULL AS VARCHAR) AS neg_text, true AS no_neg_image, 'products' AS global_dataset_name FROM catalogue""",
    "a9_resolution_violations": f"""WITH {X.CATALOGUE}
SELECT style_id, 'pos_image' AS violation FROM catalogue WHERE default_image IS NOT NULL AND style_id % 7 = 0""",
    "k2_parser_registry": f"""WITH {_LINES},
parts AS (
  SELECT 'english' AS global_dataset_name, style_id FROM catalogue WHERE master_category = 'en'
  UNION ALL SELECT 'french', style_id FROM catalogue WHERE master_category = 'fr'
  UNION ALL SELECT 'pairs', style_id FROM kinds WHERE kind = 'good')
SELECT global_dataset_name, count(*) AS n, CAST(sum(style_id) AS BIGINT) AS ids, max(style_id) AS last_id FROM parts GROUP BY 1""",
    "k2_parser_quarantine": f"""WITH {_LINES}
SELECT 'pairs' AS global_dataset_name, kind AS problem, count(*) AS n FROM kinds WHERE kind <> 'good' GROUP BY kind""",
    "k2_ranged_source": f"""WITH {_LINES}
SELECT 'Find ' || master_category AS instruction_text, description AS query_text, CAST(NULL AS VARCHAR) AS query_image_path,
       default_image AS target_image_path, 'retrieval' AS task_category, style_id, true AS in_many_ranges FROM kinds WHERE kind = 'good'""",
    "k2_ranged_stream": f"""WITH {_LINES}
SELECT kind, count(*) AS n, count(*) AS places, CAST(coalesce(sum(style_id) FILTER (WHERE kind = 'good'), 0) AS BIGINT) AS ids
FROM kinds GROUP BY kind""",
    "b14_file_sizes": """WITH files AS (
  SELECT p_partkey, p_partkey % 5 AS kind, CAST(64 + p_size * 37 AS INTEGER) AS w, CAST(64 + (p_partkey % 50) * 29 AS INTEGER) AS h FROM part),
sizes AS (
  SELECT p_partkey, CASE kind WHEN 0 THEN 'png' WHEN 3 THEN 'png' WHEN 4 THEN NULL ELSE 'jpeg' END AS format,
         CASE kind WHEN 3 THEN 'damaged' WHEN 4 THEN 'unknown' ELSE 'ok' END AS status,
         CASE WHEN kind < 3 THEN w END AS width, CASE WHEN kind < 3 THEN h END AS height FROM files)
SELECT *, CAST(CASE WHEN greatest(width, height) <= 1344 THEN width WHEN width > height THEN 1344
                    ELSE floor(width * 1344 / height) END AS INTEGER) AS new_width,
       CAST(CASE WHEN greatest(width, height) <= 1344 THEN height WHEN width > height THEN floor(height * 1344 / width)
                 WHEN width IS NOT NULL THEN 1344 END AS INTEGER) AS new_height
FROM sizes""",
    "c7_throughput": """
SELECT event_type, count(*) AS n, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS elapsed,
       round(CASE WHEN max(ts) > min(ts) THEN count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) ELSE 0 END, 9) AS rate
FROM events GROUP BY event_type""",
    "c7_stream_throughput": """
SELECT event_type, count(*) AS n, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 6) AS elapsed,
       round(CASE WHEN max(ts) > min(ts) THEN count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) ELSE 0 END, 9) AS rate
FROM events GROUP BY event_type""",
    "j1_stream_ingest": f"""WITH {_LINES}
SELECT 'good' AS kind, style_id AS id, trim('Find ' || master_category || ' ' || description, '{WHITESPACE}') AS query_text,
       default_image AS path
FROM kinds WHERE kind = 'good'
UNION ALL SELECT kind, count(*), NULL, NULL FROM kinds WHERE kind <> 'good' GROUP BY kind""",
    "j1_stream_dedupe": f"""WITH {_LINES}
SELECT style_id AS id, trim('Find ' || master_category || ' ' || description, '{WHITESPACE}') AS query_text, default_image AS path, true AS delivered
FROM kinds WHERE kind = 'good'""",
    "j2_windowed_counts": _WINDOWS,
    "j2_stream_windows": _WINDOWS,
}
