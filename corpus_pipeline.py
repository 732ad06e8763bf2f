"""From raw documents to a mixed training set: five stages, each one operator of ``pairforge.llm``.

A stage takes the documents that its predecessor kept and returns those it keeps; all but the last return the columns
of ``documents``. Each stage's result is written as Parquet to the shared folder and read again, by the stage itself where
whole documents pass through Python, else by ``run``.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.functions.keys import hash_index
from pairforge.llm import decontaminate, fair_mix, line_chunks, tensor_minhash, toxicity_nb
from pairforge.session import written

NEAR_SHINGLE = 5  # words, with a similarity of 0.8
ARROW_ROWS = 512  # whole documents handed to Python at a time


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def _few_at_a_time(spark: SparkSession):
    """Whole documents go to Python and back in batches, so a batch holds few. What is computed inside the block follows
    the setting, which the session gets back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, ARROW_ROWS)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of these documents, scores below 0.5."""
    with _few_at_a_time(spark):
        return written(toxicity_nb.remove_toxic(docs, toxicity_nb.train(docs, _read(spark, sf_dir, "labels"))), "corpus-toxicity")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the multi-line chunks that an earlier document has; ``n_chars`` follows the text."""
    out = line_chunks.dedup_lines(docs)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(*docs.columns)


def _one_of_equal_rows(docs: DataFrame) -> DataFrame:
    """One row of those with the same id and text; only rows whose id and text hash repeat are moved."""
    hashed = docs.withColumn("_hash", F.xxhash64("text"))
    many = hashed.groupBy("doc_id", "_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    many = written(many.select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_many")), "near_repeats")
    if many.isEmpty():
        return docs
    same = hashed["doc_id"].eqNullSafe(many["_id"]) & (hashed["_hash"] == many["_many"])
    once = hashed.join(many, same, "left_anti").select(*docs.columns)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    repeated = hashed.join(many, same, "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0).alias("_"), *others)).alias("_rest"))
    return once.unionByName(repeated.select("doc_id", "text", *[F.col("_rest")[c].alias(c) for c in others]))


def _with_key(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_key``: the id, or for rows without id a number above all ids, by the hash of the text."""
    key = F.col("doc_id").cast("long")
    nameless = docs.where("doc_id is null")
    if nameless.isEmpty():
        return docs.withColumn("_key", key)
    top = docs.agg(F.max(key).alias("top")).first()["top"] or 0
    text = F.coalesce("text", F.lit(""))
    hashes = nameless.select(F.xxhash64(text).alias("_h1"), F.md5(text).alias("_h2"))
    places = written(hash_index(hashes.distinct(), ["_h1", "_h2"], out="_place"), "near_nameless")
    own = nameless.withColumn("_h1", F.xxhash64(text)).withColumn("_h2", F.md5(text)).join(places, ["_h1", "_h2"])
    own = own.withColumn("_key", F.col("_place") + F.lit(top) + 1).select(*docs.columns, "_key")
    return docs.where("doc_id is not null").withColumn("_key", key).unionByName(own)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id; documents without words stay.

    Rows with the same id and text are one, also without words. A row without id counts as larger than every id. Rows
    that share an id but not the text are one document: they stay or go together."""
    keyed = _with_key(_one_of_equal_rows(docs))
    with _few_at_a_time(spark):
        found = tensor_minhash.near_components(keyed.select(F.col("_key").alias("doc_id"), "text"), size=NEAR_SHINGLE)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return keyed.join(gone, keyed["_key"] == gone["_gone"], "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    with _few_at_a_time(spark):
        return written(decontaminate.remove_contaminated(docs, _read(spark, sf_dir, "benchmark")), "corpus-decontamination")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their size, their source's size and target, and the words taken:
    ``taken / size`` is how often a document is repeated."""
    return fair_mix.mix(docs).where("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: Stages that write their result themselves.
STORED = {"toxicity", "decontamination"}

#: The classifier is trained, which SQL cannot express; tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name not in STORED:
            docs = written(docs, f"corpus-{name}")
    return docs
