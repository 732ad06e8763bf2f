"""Queries over texts, prompts, paths and image sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairforge.functions import images as I
from pairforge.functions import text as T
from pairforge.operators.negatives import mine_candidates
from pairforge.operators.retrieval import expand_candidates
from pairforge.operators.negatives import eval_records
from pairforge.plans import catalogue_queries as CQ
from pairforge.plans import fixtures as X
from pairforge.sources.conform import tag
from pairforge.sources.registry import map_batches

_WS = T.WHITESPACE.replace("'", "''")


def _spaced(spark, sf):
    """Catalogue texts with every kind of outer whitespace around some of them, and some absent."""
    return X.table(spark, sf, "documents").select(
        "doc_id", "lang",
        F.when(F.col("doc_id") % 9 == 4, F.lit(None)).otherwise(T.instruction_text("lang")).alias("instruction"),
        F.when(F.col("doc_id") % 7 == 3, F.lit(None))
        .when(F.col("doc_id") % 5 == 0, F.concat(F.lit(T.WHITESPACE), "text", F.lit(T.WHITESPACE)))
        .otherwise(F.col("text")).alias("query"),
    )


def b6(spark, sf):
    return _spaced(spark, sf).select("doc_id", T.full_query_text("instruction", "query").alias("query_text"))


def b7(spark, sf):
    docs = X.table(spark, sf, "documents").withColumn(
        "body", F.when(F.col("doc_id") % 6 == 0, F.lit("")).when(F.col("doc_id") % 6 != 1, F.col("text"))
    )
    instruction = T.instruction_text("lang")
    return docs.select(
        "doc_id",
        T.prompt(instruction, "body").alias("plain"),
        T.prompt(instruction, "body", add_image_token=True).alias("with_image"),
        T.prompt(instruction, add_image_token=True).alias("image_only"),
    )


def b8(spark, sf):
    cat = X.catalogue(spark, sf)
    status = F.when(F.col("default_image").isNull(), "empty").when(F.col("style_id") % 4 == 0, "missing").otherwise("ok")
    return cat.select("style_id", T.target_prompt(status).alias("target_text"))


def b9(spark, sf):
    cat = X.catalogue(spark, sf).select("style_id")
    named = tag(cat.where("style_id % 2 = 0"), "products")
    return named.unionByName(tag(cat.where("style_id % 2 = 1")))


def b10(spark, sf):
    urls = X.table(spark, sf, "pages").select("url")
    local = X.catalogue(spark, sf).select(F.col("default_image").alias("url"))
    kept = X.catalogue(spark, sf).select(F.concat(F.lit("/dbfs/"), "default_image").alias("url"))
    up = X.catalogue(spark, sf).select(F.concat(F.lit("./a/../"), "default_image").alias("url"))
    return urls.unionByName(local).unionByName(kept).unionByName(up).select(
        "url",
        T.path_kind("url").alias("kind"),
        T.is_url("url").alias("is_url"),
        T.normalize_path("url", "/data").alias("location"),
    )


def b12(spark, sf):
    """Four texts in id order are the options of one question; the answer is the first of them, the last
    option repeats it in some groups, and in others nothing matches."""
    docs = X.table(spark, sf, "documents").withColumn("question_id", F.expr("doc_id div 4"))
    grouped = docs.groupBy("question_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda d: d["text"]
        ).alias("opts")  # four rows
    )
    first = F.element_at("opts", 1)
    shaped = grouped.select(
        "question_id",
        F.concat(F.lit("Which text has number "), F.col("question_id").cast("string"), F.lit("?")).alias("q"),
        F.when(F.col("question_id") % 3 == 0, F.concat("opts", F.array(first))).otherwise(F.col("opts")).alias("opts"),
        F.when(F.col("question_id") % 5 == 0, F.lit("none of them")).otherwise(first).alias("a"),
    )
    cols = T.multiple_choice("q", "opts", "a")
    return shaped.select("question_id", *cols).withColumn("options", F.array_join("options", "|"))


def b13(spark, sf):
    """Each turn carries as many tags as it has predecessors; some start at 2, repeat a tag or lack an image."""
    kind, turn = F.col("conv_id") % 4, F.col("turn")
    numbers = F.sequence(F.when(kind == 1, F.lit(2)).otherwise(F.lit(1)).cast("long"), turn + 2)
    numbers = F.when(kind == 2, F.concat(numbers, F.array(F.lit(1).cast("long")))).otherwise(numbers)
    tags = F.array_join(F.transform(numbers, lambda i: F.concat(F.lit("<|image_"), i.cast("string"), F.lit("|>"))), " ")
    prompts = X.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.concat(tags, F.lit(" "), "text").alias("prompt"),
        (turn + 2 + F.when(kind == 3, 1).otherwise(0)).alias("num_images"),
    )
    return prompts.select("conv_id", "turn", *T.image_tag_check("prompt", "num_images"))


def b14(spark, sf):
    sizes = X.image_sizes(spark, sf).withColumn(
        "resolution",
        F.when(F.col("p_partkey") % 5 == 0, "high").when(F.col("p_partkey") % 5 == 1, "mid")
        .when(F.col("p_partkey") % 5 == 2, "low").otherwise(""),
    )
    return sizes.select("p_partkey", *I.resize_plan("width", "height", "resolution"))


def b15(spark, sf):
    return (
        X.image_sizes(spark, sf)
        .select("p_partkey", *I.padded_size("width", "height", 16))
        .withColumn("image_tokens", I.image_tokens("padded_width", "padded_height"))
    )


def b15_budget(spark, sf):
    """Token cost of the training images per category."""
    sized = X.image_sizes(spark, sf).select("category", *I.padded_size("width", "height", 4))
    return sized.groupBy("category").agg(
        F.sum(I.image_tokens("padded_width", "padded_height")).alias("tokens"), F.count(F.lit(1)).alias("images")
    )


def f1(spark, sf):
    mined = mine_candidates(CQ._queries(spark, sf), CQ._universe(spark, sf), CQ.FAST, "uniform")
    return expand_candidates(eval_records(mined))


def k1(spark, sf):
    """One row per line of each text, by a function over batches of rows."""

    def line_rows(columns: dict) -> dict:
        out = {"doc_id": [], "line_no": [], "line": []}
        for doc, text in zip(columns["doc_id"], columns["text"]):
            for i, line in enumerate(text.split("\n")):
                out["doc_id"].append(doc)
                out["line_no"].append(i)
                out["line"].append(line)
        return out

    docs = X.table(spark, sf, "documents").select("doc_id", "text")
    return map_batches(docs, line_rows, "doc_id bigint, line_no bigint, line string")


QUERIES = {
    "b6_full_query_text": b6,
    "b7_prompt": b7,
    "b8_target_prompt": b8,
    "b9_dataset_tag": b9,
    "b10_paths": b10,
    "b12_multiple_choice": b12,
    "b13_image_tags": b13,
    "b14_resize_plan": b14,
    "b15_image_tokens": b15,
    "b15_token_budget": b15_budget,
    "f1_expand_candidates": f1,
    "k1_batched_map": k1,
}

_I = CQ.INSTRUCTION.replace("master_category", "lang")
_URL = T.URL_PATTERN.replace("'", "''")

_SIZES = """sizes AS (
  SELECT p_partkey, p_type AS category, 64 + p_size * 37 AS width, CAST(64 + (p_partkey % 50) * 29 AS INTEGER) AS height
  FROM part)"""


def _padded(crops: int) -> str:
    return f"""{_SIZES},
ratios AS (SELECT *, greatest(width, height) / least(width, height) AS ratio FROM sizes),
scaled AS (
  SELECT *, list_max(list_filter(range(1, {crops} + 1), lambda s: s * ceil(s / ratio) <= {crops})) * 336 AS long_side FROM ratios),
padded AS (
  SELECT *, ceil(floor(long_side / ratio) / 336) * 336 AS short_side FROM scaled),
placed AS (
  SELECT p_partkey, category, CAST(CASE WHEN width < height THEN short_side ELSE long_side END AS INTEGER) AS padded_width,
         CAST(CASE WHEN width < height THEN long_side ELSE short_side END AS INTEGER) AS padded_height FROM padded),
costed AS (
  SELECT *, ((padded_height // 336) * (padded_width // 336) + 1) * 144 + 1 + (padded_height // 336 + 1) * 12 AS image_tokens
  FROM placed)"""


SQL = {
    "b6_full_query_text": f"""
SELECT doc_id, trim(coalesce(instruction, '') || ' ' || coalesce(query, ''), '{_WS}') AS query_text FROM (
  SELECT doc_id, CASE WHEN doc_id % 9 <> 4 THEN {_I} END AS instruction,
         CASE WHEN doc_id % 7 = 3 THEN NULL WHEN doc_id % 5 = 0 THEN '{_WS}' || text || '{_WS}' ELSE text END AS query
  FROM documents)""",
    "b7_prompt": f"""
SELECT doc_id, i || tail AS plain, '<|image_1|> ' || i || tail AS with_image, '<|image_1|> ' || i AS image_only FROM (
  SELECT doc_id, {_I} AS i,
         CASE WHEN doc_id % 6 IN (0, 1) OR text = '' THEN '' ELSE ' ' || text END AS tail FROM documents)""",
    "b8_target_prompt": f"""WITH {X.CATALOGUE}
SELECT style_id, CASE WHEN default_image IS NOT NULL AND style_id % 4 <> 0 THEN '<|image_1|>' ELSE '' END AS target_text
FROM catalogue""",
    "b9_dataset_tag": """
SELECT doc_id AS style_id, CASE WHEN doc_id % 2 = 0 THEN 'products' ELSE 'None' END AS global_dataset_name FROM documents""",
    "b10_paths": f"""WITH {X.CATALOGUE},
urls AS (
  SELECT url, url AS location FROM pages
  UNION ALL SELECT default_image, '/data/' || default_image FROM catalogue
  UNION ALL SELECT '/dbfs/' || default_image, '/dbfs/' || default_image FROM catalogue
  UNION ALL SELECT './a/../' || default_image, '/data/' || default_image FROM catalogue)
SELECT url, CASE WHEN url IS NULL OR url = '' THEN 'empty'
                 WHEN starts_with(url, 'http://') OR starts_with(url, 'https://') THEN 'remote'
                 WHEN starts_with(url, '/dbfs/') THEN 'dbfs' ELSE 'local' END AS kind,
       coalesce(regexp_matches(url, '(?i){_URL}'), false) AS is_url, location
FROM urls""",
    "b12_multiple_choice": f"""WITH grouped AS (
  SELECT doc_id // 4 AS question_id, list(text ORDER BY doc_id) AS four FROM documents GROUP BY 1),
shaped AS (
  SELECT question_id, CASE WHEN question_id % 3 = 0 THEN list_append(four, four[1]) ELSE four END AS opts,
         CASE WHEN question_id % 5 = 0 THEN 'none of them' ELSE four[1] END AS a FROM grouped),
indexed AS (
  SELECT *, coalesce(list_max(list_filter(range(1, len(opts) + 1), lambda i: opts[i] = a)), 0) - 1 AS ord,
         list_transform(range(1, len(opts) + 1), lambda i: '(' || chr(CAST(64 + i AS INTEGER)) || ') ' || opts[i]) AS lettered FROM shaped)
SELECT question_id,
       rtrim('Which text has number ' || question_id || '?' || chr(10) || 'Options:' || chr(10)
             || array_to_string(lettered, chr(10)), '{_WS}') AS question,
       array_to_string(lettered, '|') AS options,
       '(' || chr(CAST(65 + ord AS INTEGER)) || ') ' || a AS answer, CAST(ord AS INTEGER) AS answer_index
FROM indexed""",
    "b13_image_tags": r"""WITH found AS (
  SELECT conv_id, turn, unnest(range(CASE WHEN conv_id % 4 = 1 THEN 2 ELSE 1 END, turn + 3)) AS tag FROM conversations
  UNION ALL
  SELECT conv_id, turn, CAST(unnest(regexp_extract_all(text, '<\|image_(\d+)\|>', 1)) AS BIGINT) FROM conversations),
counted AS (SELECT conv_id, turn, count(DISTINCT tag) AS m, min(tag) AS lo, max(tag) AS hi FROM found GROUP BY ALL),
wanted AS (SELECT *, turn + 2 + CASE WHEN conv_id % 4 = 3 THEN 1 ELSE 0 END AS num_images FROM counted)
SELECT conv_id, turn, CAST(m AS INTEGER) AS num_tags, lo = 1 AND hi = m AS consecutive, m = num_images AS count_matches,
       lo = 1 AND hi = m AND m = num_images AS valid
FROM wanted""",
    "b14_resize_plan": f"""WITH {_SIZES}
SELECT p_partkey, CAST(CASE p_partkey % 5 WHEN 0 THEN 1344 WHEN 1 THEN 672 WHEN 2 THEN 128 ELSE
         CASE WHEN greatest(width, height) <= 1344 THEN width WHEN width > height THEN 1344
              ELSE floor(width * 1344 / height) END END AS INTEGER) AS new_width,
       CAST(CASE p_partkey % 5 WHEN 0 THEN 1344 WHEN 1 THEN 672 WHEN 2 THEN 128 ELSE
         CASE WHEN greatest(width, height) <= 1344 THEN height WHEN width > height THEN floor(height * 1344 / width)
              ELSE 1344 END END AS INTEGER) AS new_height
FROM sizes""",
    "b15_image_tokens": f"WITH {_padded(16)} SELECT p_partkey, padded_width, padded_height, image_tokens FROM costed",
    "b15_token_budget": f"""WITH {_padded(4)}
SELECT category, CAST(sum(image_tokens) AS BIGINT) AS tokens, count(*) AS images FROM costed GROUP BY category""",
    "f1_expand_candidates": f"""WITH {CQ._fast['uniform']} {CQ.LISTS}
SELECT l.style_id, trim({CQ.INSTRUCTION} || ' ' || description, '{_WS}') AS query_text, '' AS passage_text,
       CAST(cand_pos AS INTEGER) AS cand_pos, path AS passage_path, is_truth AS is_ground_truth
FROM lists l JOIN queries q ON q.style_id = l.style_id""",
    "k1_batched_map": """
SELECT doc_id, CAST(generate_subscripts(lines, 1) - 1 AS BIGINT) AS line_no, unnest(lines) AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)""",
}
