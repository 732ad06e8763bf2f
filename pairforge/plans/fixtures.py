"""Views over the given tables that feed the operators, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalogue(spark, sf_dir) -> DataFrame:
    image = F.concat(F.lit("img/"), F.expr("cast(doc_id div 2 as string)"), F.lit(".jpg"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("style_id"),
        F.col("text").alias("description"),
        F.when(F.col("doc_id") % 50 != 0, image).alias("default_image"),
        F.col("lang").alias("master_category"),
    )


def big_catalogue(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("style_id"),
        F.col("p_name").alias("description"),
        F.concat(F.lit("img/"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("default_image"),
        F.col("p_type").alias("master_category"),
    )


def frames(spark, sf_dir) -> DataFrame:
    ext = F.when(F.col("event_id") % 11 == 0, F.lit(".txt")).otherwise(F.lit(".jpg"))
    path = F.concat(
        F.lit("v"), F.col("user_id").cast("string"), F.lit("/frame_"), F.col("event_id").cast("string"), ext
    )
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("video_id"), path.alias("frame_path"))


def qrels(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("query_id"),
        F.get_json_object("props", "$.k").cast("long").alias("corpus_id"),
        (F.col("value") - 50).alias("score"),
    )


def tokens(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("batch_id"),
        F.col("turn").alias("pos_in_batch"),
        "role",
        F.transform(F.split("text", " "), lambda w: F.length(w)).alias("ids"),
    )


def image_sizes(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_type").alias("category"),
        (64 + F.col("p_size") * 37).cast("int").alias("width"),
        (64 + (F.col("p_partkey") % 50) * 29).cast("int").alias("height"),
    )


def members(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        (F.get_json_object("props", "$.k").cast("long") % 20 - 1).alias("grp"),
    )


def edges(spark, sf_dir) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .where("c_custkey % 5 <> 0")
        .select(F.col("c_custkey").alias("src"), (F.col("c_custkey") + 7).alias("dst"))
    )


def reps(spark, sf_dir) -> DataFrame:
    """Vectors with their batch and place: even ids are queries, odd ids the matching targets."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.col("embedding").alias("vec"),
        "label",
        F.expr("vec_id div 64").alias("batch_id"),
        F.expr("vec_id div 64 % 4").alias("shard"),
        F.expr("vec_id div 256").alias("step_id"),
        F.expr("vec_id % 64 div 2").alias("pos"),
        (F.col("vec_id") % 2 == 0).alias("is_query"),
    )


def candidates(spark, sf_dir) -> DataFrame:
    """Per query its positive and nine other targets by hash, in hash order."""
    from pairforge.functions.keys import hash_hex, hash_long

    targets = table(spark, sf_dir, "embeddings").agg(F.expr("count(*) div 2")).scalar()
    queries = table(spark, sf_dir, "embeddings").where("vec_id % 2 = 0").select(
        F.col("vec_id").alias("query_id"), targets.alias("_n")
    )
    # Odd steps of 9 places from a hashed start: distinct, and never the positive.
    others = F.transform(
        F.sequence(F.lit(1), F.lit(9)),
        lambda k: F.pmod(
            F.expr("query_id div 2") + 1 + F.pmod(hash_long("query_id", seed="cand", digits=8) + k, F.col("_n") - 1),
            F.col("_n"),
        ) * 2 + 1,
    )
    listed = queries.select("query_id", F.explode(F.concat(F.array(F.col("query_id") + 1), others)).alias("target_id"))
    shuffled = listed.groupBy("query_id").agg(
        F.array_sort(
            F.collect_list(F.struct(hash_hex("query_id", "target_id", seed="order").alias("h"), "target_id"))
        ).alias("_c")  # ten entries
    )
    return shuffled.select("query_id", F.posexplode("_c").alias("cand_pos", "_s")).select(
        "query_id", "cand_pos", F.col("_s.target_id").alias("target_id")
    )


# -- the same views for the SQL checks ----------------------------------------------------------------

CATALOGUE = """catalogue AS (
  SELECT doc_id AS style_id, text AS description,
         CASE WHEN doc_id % 50 <> 0 THEN 'img/' || CAST(doc_id // 2 AS VARCHAR) || '.jpg' END AS default_image,
         lang AS master_category
  FROM documents)"""

BIG_CATALOGUE = """catalogue AS (
  SELECT p_partkey AS style_id, p_name AS description, 'img/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS default_image,
         p_type AS master_category
  FROM part)"""


def clean_sql(min_support: int = 100, base: str = CATALOGUE) -> str:
    return f"""{base},
complete AS (
  SELECT * FROM catalogue
  WHERE description IS NOT NULL AND default_image IS NOT NULL AND master_category IS NOT NULL),
clean AS (
  SELECT * FROM complete WHERE master_category IN (
    SELECT master_category FROM complete GROUP BY master_category HAVING count(*) >= {min_support}))"""


def splits_sql(min_support: int = 100, base: str = CATALOGUE) -> str:
    return f"""{clean_sql(min_support, base)},
class_sizes AS (SELECT master_category AS category, CAST(count(*) AS HUGEINT) AS n FROM clean GROUP BY 1),
sizes AS (
  SELECT *, total - n_hold AS n_train, (n_hold + 1) // 2 AS n_test, n_hold - (n_hold + 1) // 2 AS n_val
  FROM (SELECT *, (total + 4) // 5 AS n_hold FROM (
    SELECT *, CAST(sum(n) OVER () AS HUGEINT) AS total FROM class_sizes))),
train_share AS (
  SELECT *, (n * n_train) // total + CASE WHEN
      row_number() OVER (ORDER BY (n * n_train) % total DESC, category)
      <= n_train - sum((n * n_train) // total) OVER () THEN 1 ELSE 0 END AS train
  FROM sizes),
held AS (SELECT *, n - train AS hold FROM train_share),
quotas AS (
  SELECT *, (hold * n_val) // n_hold + CASE WHEN
      row_number() OVER (ORDER BY (hold * n_val) % n_hold DESC, category)
      <= n_val - sum((hold * n_val) // n_hold) OVER () THEN 1 ELSE 0 END AS val
  FROM held),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY master_category ORDER BY md5('42|' || style_id), style_id) AS rk
  FROM clean),
splits AS (
  SELECT style_id, description, default_image, r.master_category,
         CASE WHEN rk <= train THEN 'train' WHEN rk <= train + val THEN 'val' ELSE 'test' END AS split
  FROM ranked r JOIN quotas q ON q.category = r.master_category)"""


def universe_sql(min_support: int = 100, base: str = CATALOGUE) -> str:
    return f"""{splits_sql(min_support, base)},
universe AS (
  SELECT path, row_number() OVER (ORDER BY md5('universe42|' || path), path) - 1 AS idx
  FROM (SELECT DISTINCT default_image AS path FROM clean)),
queries AS (SELECT * FROM splits WHERE split IN ('val', 'test'))"""


FRAMES = """frames AS (
  SELECT user_id AS video_id, event_id,
         'v' || user_id || '/frame_' || event_id || '.jpg' AS frame_path
  FROM events WHERE event_id % 11 <> 0),
listing AS (
  SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY event_id) - 1 AS frame_no FROM frames),
counts AS (SELECT video_id, count(*) AS n_frames FROM listing GROUP BY video_id)"""

TOKENS = """tokens AS (
  SELECT conv_id AS batch_id, turn AS pos_in_batch, role,
         list_transform(string_split(text, ' '), lambda w: length(w)) AS ids
  FROM conversations)"""

QRELS = """qrels AS (
  SELECT user_id AS query_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS corpus_id, value - 50 AS score
  FROM events)"""

REPS = """reps AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vec, label, vec_id // 64 AS batch_id, vec_id // 64 % 4 AS shard,
         vec_id // 256 AS step_id, vec_id % 64 // 2 AS pos, vec_id % 2 = 0 AS is_query
  FROM embeddings)"""

CANDIDATES = """cand_draws AS (
  SELECT vec_id AS query_id, unnest(list_concat([vec_id + 1], list_transform(range(1, 10), lambda k:
    (vec_id // 2 + 1 + (('0x' || substr(md5('cand|' || vec_id), 1, 8))::BIGINT + k) % (n - 1)) % n * 2 + 1))) AS target_id
  FROM embeddings, (SELECT count(*) // 2 AS n FROM embeddings) WHERE vec_id % 2 = 0),
cands AS (
  SELECT query_id, target_id,
         row_number() OVER (PARTITION BY query_id ORDER BY md5('order|' || query_id || '|' || target_id)) - 1 AS cand_pos
  FROM cand_draws)"""
