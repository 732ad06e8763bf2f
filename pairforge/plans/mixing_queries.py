"""Queries that mix, shard, batch, pad and pack."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairforge.operators import batching as B
from pairforge.operators import mixing as M
from pairforge.operators.catalogue import drop_incomplete
from pairforge.operators.thinning import thin_groups
from pairforge.plans import fixtures as X
from pairforge.session import scratch_path, written
from pairforge.sources import images
from pairforge.streaming import batches as SB

WEIGHTS = (("pairs_a", "en", 3.0), ("pairs_b", "fr", 2.0), ("pairs_c", "de", 1.0), ("pairs_d", "es", 1.0))
WORLD = 3
BATCH = 32
ACCUM = 4
STEP = 7


def _sources(spark, sf):
    rows = drop_incomplete(X.catalogue(spark, sf)).select("style_id", "default_image", "master_category")
    return [M.Source(name, rows.where(F.col("master_category") == lang), w) for name, lang, w in WEIGHTS]


def _mixed(spark, sf, strategy="all_exhausted"):
    return M.interleave(_sources(spark, sf), "style_id", strategy)


def _feed(spark, sf):
    """The mix, written once: sharding and batching need its size as well as its rows."""
    return written(_mixed(spark, sf).select("draw", "global_dataset_name", "style_id"), "mixed")


def _batched(spark, sf, drop_last=True):
    return B.assign_batches(_feed(spark, sf), BATCH, drop_last=drop_last)


def e1(spark, sf):
    config = X.table(spark, sf, "documents").groupBy(F.col("source").alias("name")).agg(
        F.sum("n_chars").cast("double").alias("weight")
    )
    return M.mix_probabilities(config)


def e2(strategy):
    def run(spark, sf):
        return _mixed(spark, sf, strategy).select("draw", "global_dataset_name", "style_id")

    return run


def e3(spark, sf):
    docs = drop_incomplete(X.catalogue(spark, sf))
    return M.mix_plan(docs, per_device_batch=BATCH, world_size=WORLD, interleave_batch_size=0.5)


def e4(spark, sf):
    return M.shard_rows(_feed(spark, sf), WORLD).select("draw", "style_id", "shard", "shard_idx")


def e4_written(spark, sf):
    """The shards read back from their folders."""
    path = scratch_path(spark, "shards")
    M.write_shards(e4(spark, sf), path)
    return spark.read.parquet(path).select("draw", "style_id", "shard", "shard_idx")


def e5(drop_last):
    def run(spark, sf):
        return _batched(spark, sf, drop_last).select("draw", "style_id", "batch_id", "pos_in_batch")

    return run


def e5_stream(spark, sf):
    """The shards as a stream of files, three at a time, batched in two runs: the second goes on where the first stopped."""
    source, target, checkpoint = (scratch_path(spark, f"stream-{n}") for n in ("feed", "batches", "checkpoint"))
    feed = written(M.shard_rows(_feed(spark, sf), WORLD).select("shard_idx", "style_id", "shard"), "sharded")
    rows = feed.agg(F.max("shard_idx")).first()[0] + 1
    for k in range(8):  # one file of each shard's next rows after the other
        if k % 4 == 0 and k:
            _run_batches(spark, source, target, checkpoint)
        part = feed.where((F.col("shard_idx") >= rows * k // 8) & (F.col("shard_idx") < rows * (k + 1) // 8))
        part.coalesce(1).write.mode("append").parquet(source)
    _run_batches(spark, source, target, checkpoint)
    return spark.read.parquet(target).select("shard", "shard_idx", "style_id", "batch_id", "pos_in_batch")


PART_BYTES = 20_000


def a6_prepared(spark, sf):
    """Batches of the mix with their pictures, which are the pages; a reference is present, missing, remote or empty by its
    id. Rows are given one by one, with whether their part of the batch stays in the bound."""
    pages = X.table(spark, sf, "pages")
    store = pages.select(
        F.concat(F.lit("/img/"), F.col("page_id").cast("string"), F.lit(".png")).alias("path"),
        F.encode("html", "UTF-8").alias("content"),
    )
    count = pages.agg(F.count(F.lit(1))).scalar()
    sid = F.col("style_id")
    path = (
        F.when(sid % 7 == 0, F.lit("")).when(sid % 7 == 1, F.concat(F.lit("https://example.org/"), sid.cast("string")))
        .when(sid % 7 == 2, F.concat(F.lit("img/none"), sid.cast("string"))).when(sid % 7 == 3, F.lit("img/../img/0.png"))
        .otherwise(F.concat(F.lit("img/"), (sid % F.col("_n")).cast("string"), F.lit(".png")))
    )
    mixed = written(_mixed(spark, sf).select("draw", "global_dataset_name", "style_id", F.col("default_image").alias("query_text")), "mixed")
    batches = B.assign_batches(mixed, BATCH).withColumn("_n", count).withColumn("target_image_path", path)
    ready = images.prepare_batches(batches, store, text_cols=("query_text", "style_id"), max_bytes=PART_BYTES, hot_rows=50)
    size = F.aggregate("rows", F.lit(0), lambda n, r: n + F.coalesce(F.length(r["image"]["bytes"]), F.lit(0)))
    rows = ready.withColumn("in_bound", (size <= PART_BYTES) | (F.size("rows") == 1)).select("batch_id", "n_parts", "in_bound", F.inline("rows"))
    return rows.select(
        "batch_id", F.col("pos").alias("pos_in_batch"), "style_id", "query_text", "image_status",
        F.when(F.col("image_status") == "ok", F.md5("image.bytes")).alias("content_md5"), "in_bound", (F.col("n_parts") > 1).alias("in_parts"),
    )


def _run_batches(spark, source, target, checkpoint):
    stream = spark.readStream.schema("shard_idx long, style_id long, shard int").option("maxFilesPerTrigger", 3).parquet(source)
    SB.run_stream_batches(stream.withColumn("shard", F.col("shard").cast("long")), target, checkpoint, BATCH, "shard_idx", "shard").awaitTermination()


def c4(spark, sf):
    return B.batch_composition(_batched(spark, sf, False))


def e6(spark, sf):
    chunks = B.collect_chunks(B.chunk_batches(_batched(spark, sf, False), 5), ["style_id"])
    return chunks.select(
        "batch_id", "chunk_id", F.size("members").alias("n"),
        F.array_join(F.transform("members", lambda m: m["style_id"].cast("string")), ",").alias("ids"),
    )


def e6_back(spark, sf):
    chunks = B.collect_chunks(B.chunk_batches(_batched(spark, sf, False), 5), ["style_id", "draw"])
    return B.combine_chunks(chunks, 5)


def e7(spark, sf):
    left = B.skip_batches(_batched(spark, sf), STEP, ACCUM)
    return left.select("draw", "style_id", "batch_id")


def e8(spark, sf):
    batched = _batched(spark, sf, False)
    by_epochs = B.step_plan(batched, ACCUM, num_epochs=2.5).withColumn("mode", F.lit("epochs"))
    by_steps = B.step_plan(batched, ACCUM, max_steps=100).withColumn("mode", F.lit("max_steps"))
    return by_epochs.unionByName(by_steps)


def e8_groups(spark, sf):
    return B.accumulation_groups(_batched(spark, sf), ACCUM).groupBy("update_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("batch_id").alias("batches")
    )


def _padded(spark, sf, max_length=None):
    """Token rows, some of them empty, cut to ``max_length`` and padded per conversation."""
    rows = X.tokens(spark, sf).withColumn(
        "ids", F.when((F.col("batch_id") + F.col("pos_in_batch")) % 13 == 0, F.array().cast("array<int>")).otherwise(F.col("ids"))
    )
    return B.pad_batches(rows, max_length=max_length)


def e9(spark, sf):
    def joined(c):
        return F.array_join(F.transform(c, lambda x: x.cast("string")), " ")

    return _padded(spark, sf, 48).select(
        "batch_id", "pos_in_batch", joined("input_ids").alias("input_ids"), joined("attention_mask").alias("attention_mask")
    )


def e10(spark, sf):
    return B.packing_offsets(written(_padded(spark, sf), "padded")).select("batch_id", "pos_in_batch", "seqlen", "cu_seqlen", "max_seqlen")


def e10_positions(spark, sf):
    return B.packed_positions(written(_padded(spark, sf), "padded"))


def c6(spark, sf):
    """Labels are the tokens of assistant turns; all others are ignored."""
    labelled = X.tokens(spark, sf).withColumn(
        "labels",
        F.when(F.col("role") == "assistant", F.col("ids")).otherwise(F.transform("ids", lambda _: F.lit(B.IGNORED_LABEL))),
    )
    return B.label_counts(B.accumulation_groups(labelled, ACCUM))


def d7_even(spark, sf):
    return thin_groups(X.members(spark, sf), "grp", "event_id", skip_ratio=0.35)


def d7_rand(spark, sf):
    return thin_groups(X.members(spark, sf), "grp", "event_id", skip_ratio=0.5, rand=True)


QUERIES = {
    "e1_mix_probabilities": e1,
    "e2_interleave_all": e2("all_exhausted"),
    "e2_interleave_first": e2("first_exhausted"),
    "e3_mix_plan": e3,
    "e4_shards": e4,
    "e4_written_shards": e4_written,
    "e5_batches": e5(False),
    "e5_batches_drop_last": e5(True),
    "e5_stream_batches": e5_stream,
    "a6_prepared_batch": a6_prepared,
    "c4_batch_composition": c4,
    "e6_chunks": e6,
    "e6_combine_chunks": e6_back,
    "e7_resume_skip": e7,
    "e8_step_plan": e8,
    "e8_accumulation_groups": e8_groups,
    "e9_pad_batches": e9,
    "e10_packing_offsets": e10,
    "e10_packed_positions": e10_positions,
    "c6_label_counts": c6,
    "d7_thin_groups": d7_even,
    "d7_thin_groups_random": d7_rand,
}


def _mix_sql(stop: str) -> str:
    bounds = M._upper_bounds([w for _, _, w in WEIGHTS])
    names = "CASE source_no WHEN 0 THEN 'pairs_a' WHEN 1 THEN 'pairs_b' WHEN 2 THEN 'pairs_c' ELSE 'pairs_d' END"
    return f"""{X.CATALOGUE},
complete AS (
  SELECT style_id, default_image, CASE master_category WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 WHEN 'es' THEN 3 END AS source_no
  FROM catalogue WHERE default_image IS NOT NULL AND master_category IN ('en', 'fr', 'de', 'es')),
source_rows AS (
  SELECT *, row_number() OVER (PARTITION BY source_no ORDER BY md5('order42|' || style_id), style_id) - 1 AS pos FROM complete),
source_sizes AS (SELECT source_no, count(*) AS n FROM complete GROUP BY 1),
draws AS (
  SELECT draw, CASE WHEN u < {bounds[0]!r}::DOUBLE THEN 0 WHEN u < {bounds[1]!r}::DOUBLE THEN 1
         WHEN u < {bounds[2]!r}::DOUBLE THEN 2 ELSE 3 END AS source_no
  FROM (SELECT draw, ('0x' || substr(md5('mix42|' || draw), 1, 8))::BIGINT / 4294967296::DOUBLE AS u
        FROM (SELECT unnest(range(0, (SELECT count(*) * 20 + 1000 FROM documents))) AS draw))),
counted AS (SELECT *, row_number() OVER (PARTITION BY source_no ORDER BY draw) - 1 AS k FROM draws),
stops AS (SELECT {stop}(draw) AS stop FROM counted JOIN source_sizes USING (source_no) WHERE k = n - 1),
mixed AS (
  SELECT draw, {names} AS global_dataset_name, style_id
  FROM counted c JOIN source_sizes z USING (source_no)
  JOIN source_rows r ON r.source_no = c.source_no AND r.pos = c.k % z.n
  WHERE draw <= (SELECT stop FROM stops)),
batched AS (
  SELECT *, draw // {BATCH} AS batch_id, CAST(draw % {BATCH} AS INTEGER) AS pos_in_batch FROM mixed),
full_batches AS (SELECT * FROM batched WHERE draw < (SELECT count(*) - count(*) % {BATCH} FROM mixed))"""


_MIX = _mix_sql("max")
_PADDED = f"""{X.TOKENS},
filled AS (
  SELECT batch_id, pos_in_batch,
         CASE WHEN (batch_id + pos_in_batch) % 13 = 0 OR len(ids) = 0 THEN [1] ELSE ids END AS seq FROM tokens),
widths AS (SELECT *, max(len(seq)) OVER (PARTITION BY batch_id) AS width FROM filled)"""
_CUT = _PADDED.replace("ELSE ids END", "ELSE list_slice(ids, 1, 48) END")

SQL = {
    "e1_mix_probabilities": """
SELECT source AS name, CAST(sum(n_chars) AS DOUBLE) AS weight,
       CAST(sum(n_chars) AS DOUBLE) / (SELECT CAST(sum(n_chars) AS DOUBLE) FROM documents) AS probability
FROM documents GROUP BY source""",
    "e2_interleave_all": f"WITH {_MIX} SELECT * FROM mixed",
    "e2_interleave_first": f"WITH {_mix_sql('min')} SELECT * FROM mixed",
    "e3_mix_plan": f"""WITH {X.CATALOGUE}
SELECT count(*) AS total_rows, CAST({BATCH * WORLD} AS BIGINT) AS global_batch_size, count(*) / {BATCH * WORLD} AS steps_per_epoch,
       CAST({BATCH * WORLD * 0.5} AS DOUBLE) AS interleave_batch_size, count(*) >= {BATCH * WORLD} AS enough_rows
FROM catalogue WHERE default_image IS NOT NULL AND description IS NOT NULL AND master_category IS NOT NULL""",
    "e4_shards": f"""WITH {_MIX},
sized AS (SELECT *, (SELECT count(*) FROM mixed) AS n FROM mixed),
shards AS (
  SELECT shard, sum(len) OVER (ORDER BY shard) - len AS lo, sum(len) OVER (ORDER BY shard) AS hi FROM (
    SELECT shard, n // {WORLD} + CASE WHEN shard < n % {WORLD} THEN 1 ELSE 0 END AS len
    FROM (SELECT unnest(range(0, {WORLD})) AS shard, (SELECT count(*) FROM mixed) AS n)))
SELECT draw, style_id, CAST(shard AS INTEGER) AS shard, CAST(draw - lo AS BIGINT) AS shard_idx
FROM mixed JOIN shards ON draw >= lo AND draw < hi""",
    "e5_batches": f"WITH {_MIX} SELECT draw, style_id, batch_id, pos_in_batch FROM batched",
    "e5_batches_drop_last": f"WITH {_MIX} SELECT draw, style_id, batch_id, pos_in_batch FROM full_batches",
    "c4_batch_composition": f"WITH {_MIX} SELECT batch_id, global_dataset_name, count(*) AS n FROM batched GROUP BY ALL",
    "e6_chunks": f"""WITH {_MIX}
SELECT batch_id, CAST(pos_in_batch // 5 AS INTEGER) AS chunk_id, CAST(count(*) AS INTEGER) AS n,
       string_agg(CAST(style_id AS VARCHAR), ',' ORDER BY draw) AS ids
FROM batched GROUP BY batch_id, pos_in_batch // 5""",
    "e6_combine_chunks": f"WITH {_MIX} SELECT batch_id, pos_in_batch, style_id, draw FROM batched",
    "e7_resume_skip": f"""WITH {_MIX},
n AS (SELECT greatest(1, count(DISTINCT batch_id) // {ACCUM}) AS updates FROM full_batches)
SELECT draw, style_id, batch_id FROM full_batches WHERE batch_id >= (SELECT {STEP} % updates * {ACCUM} FROM n)""",
    "e8_step_plan": f"""WITH {_MIX},
n AS (SELECT count(DISTINCT batch_id) AS batches, greatest(1, count(DISTINCT batch_id) // {ACCUM}) AS updates_per_epoch FROM batched)
SELECT batches, updates_per_epoch, CAST(ceil(2.5 * updates_per_epoch) AS BIGINT) AS max_steps, CAST(3 AS BIGINT) AS num_epochs,
       'epochs' AS mode FROM n
UNION ALL SELECT batches, updates_per_epoch, 100, (100 + updates_per_epoch - 1) // updates_per_epoch, 'max_steps' FROM n""",
    "e8_accumulation_groups": f"""WITH {_MIX}
SELECT batch_id // {ACCUM} AS update_id, count(*) AS n, count(DISTINCT batch_id) AS batches FROM full_batches GROUP BY 1""",
    "e9_pad_batches": f"""WITH {_CUT}
SELECT batch_id, pos_in_batch,
       array_to_string(list_concat(seq, list_transform(range(0, width - len(seq)), lambda x: 0)), ' ') AS input_ids,
       array_to_string(list_transform(range(0, width), lambda i: CASE WHEN i < len(seq) THEN 1 ELSE 0 END), ' ') AS attention_mask
FROM widths""",
    "e10_packing_offsets": f"""WITH {_PADDED}
SELECT batch_id, pos_in_batch, len(seq) AS seqlen,
       CAST(sum(len(seq)) OVER (PARTITION BY batch_id ORDER BY pos_in_batch) - len(seq) AS BIGINT) AS cu_seqlen, width AS max_seqlen
FROM widths""",
    "e10_packed_positions": f"""WITH {_PADDED},
starts AS (
  SELECT *, CAST(sum(len(seq)) OVER (PARTITION BY batch_id ORDER BY pos_in_batch) - len(seq) AS BIGINT) AS cu FROM widths)
SELECT batch_id, pos_in_batch * width + i AS flat_position, cu + i AS packed_position
FROM (SELECT *, unnest(range(0, len(seq))) AS i FROM starts)""",
    "c6_label_counts": f"""WITH {X.TOKENS}
SELECT batch_id // {ACCUM} AS update_id,
       CAST(sum(CASE WHEN role = 'assistant' THEN len(ids) ELSE 0 END) AS BIGINT) AS num_items
FROM tokens GROUP BY 1""",
}

_MEMBERS = """members AS (
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 - 1 AS grp FROM events),
sized AS (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM members)"""

SQL["d7_thin_groups"] = f"""WITH {_MEMBERS},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY event_id) - 1 AS ord,
         greatest(1, n - CAST(round_even(n * 0.35::DOUBLE, 0) AS BIGINT)) AS keep FROM sized),
grids AS (
  SELECT DISTINCT grp, list_transform(range(0, keep), lambda k: CASE WHEN k = 0 THEN 0 WHEN k = keep - 1 THEN n - 1
           ELSE CAST(floor(k * ((n - 1)::DOUBLE / (keep - 1))) AS BIGINT) END) AS grid FROM placed)
SELECT event_id, p.grp, p.grp = -1 OR n = 1 OR list_contains(grid, ord) AS retained FROM placed p JOIN grids g ON g.grp = p.grp"""
SQL["d7_thin_groups_random"] = f"""WITH {_MEMBERS},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY md5('thin42|' || event_id), event_id) - 1 AS ord FROM sized)
SELECT event_id, grp, grp = -1 OR n = 1 OR ord < greatest(1, n - CAST(round_even(n * 0.5::DOUBLE, 0) AS BIGINT)) AS retained FROM placed"""
SQL["e4_written_shards"] = SQL["e4_shards"]
SQL["e5_stream_batches"] = f"""SELECT CAST(shard AS BIGINT) AS shard, shard_idx, style_id, shard_idx // {BATCH} AS batch_id, CAST(shard_idx % {BATCH} AS INTEGER) AS pos_in_batch
FROM (SELECT *, count(*) OVER (PARTITION BY shard) AS len FROM ({SQL["e4_shards"]})) WHERE shard_idx < len - len % {BATCH}"""
SQL["a6_prepared_batch"] = f"""WITH {_MIX},
refs AS (
  SELECT b.*, CASE WHEN style_id % 7 < 3 THEN NULL WHEN style_id % 7 = 3 THEN 0 ELSE style_id % (SELECT count(*) FROM pages) END AS page_id
  FROM full_batches b)
SELECT batch_id, pos_in_batch, style_id, c.default_image AS query_text,
       CASE style_id % 7 WHEN 0 THEN 'empty' WHEN 1 THEN 'remote' ELSE CASE WHEN html <> '' THEN 'ok' ELSE 'missing' END END AS image_status,
       CASE WHEN html <> '' THEN md5(html) END AS content_md5, true AS in_bound, true AS in_parts
FROM refs JOIN catalogue c USING (style_id) LEFT JOIN pages USING (page_id)"""
