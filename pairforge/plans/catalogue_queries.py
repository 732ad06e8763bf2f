"""Queries over the catalogue: cleaning, counting, splitting, negatives and evaluation records."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairforge.functions.text import instruction_text
from pairforge.operators import catalogue as C
from pairforge.operators import negatives as N
from pairforge.operators.splits import assign_splits
from pairforge.plans import fixtures as X

FAST = N.NUM_CANDIDATES_FAST
B2_SUPPORT = 110  # drops the smallest language at sf 0.01


def _clean(spark, sf):
    return C.clean(X.catalogue(spark, sf))


def _split(spark, sf):
    return assign_splits(_clean(spark, sf))


def _queries(spark, sf):
    return _split(spark, sf).where("split in ('val', 'test')")


def _universe(spark, sf):
    return N.index_universe(C.image_universe(_clean(spark, sf)))


def _mined(spark, sf, sampler, num_candidates=FAST):
    return N.mine_candidates(_queries(spark, sf), _universe(spark, sf), num_candidates, sampler)


def flagship(spark, sf, min_support=15):
    """Clean, split, project the train pairs and count them per split and category."""
    split = assign_splits(C.clean(X.catalogue(spark, sf), min_support))
    return split.groupBy("split", "master_category").agg(F.count(F.lit(1)).alias("n"))


def b1(spark, sf):
    return C.drop_incomplete(X.catalogue(spark, sf))


def b2(spark, sf):
    return C.clean(X.catalogue(spark, sf), B2_SUPPORT).select("style_id", "master_category")


def b3(spark, sf):
    return X.catalogue(spark, sf).select(
        "style_id", instruction_text("master_category").alias("instruction_text")
    )


def b4(spark, sf):
    return C.train_records(_split(spark, sf).where("split = 'train'"))


def b11_head(spark, sf):
    return C.row_cap(X.big_catalogue(spark, sf), "500", "style_id").select("style_id", "description")


def b11_random(spark, sf):
    return C.row_cap(X.big_catalogue(spark, sf), 700, "style_id", mode="random").select("style_id", "description")


def c1(spark, sf):
    return C.category_distribution(C.drop_incomplete(X.catalogue(spark, sf)))


def c2(spark, sf):
    return C.image_universe(_clean(spark, sf))


def c3(spark, sf):
    return C.split_summary(_split(spark, sf))


def d1(spark, sf):
    return _split(spark, sf).select("style_id", "master_category", "split")


def d2(spark, sf):
    cat = X.big_catalogue(spark, sf).withColumn("master_category", F.col("style_id").cast("string"))
    return assign_splits(cat).select("style_id", "split")


def _negatives(sampler):
    def run(spark, sf):
        mined = N.SAMPLERS[sampler](_queries(spark, sf), _universe(spark, sf), FAST - 1)
        return mined.select("style_id", F.explode("negatives").alias("path"))

    return run


def _lists(sampler):
    def run(spark, sf):
        return _mined(spark, sf, sampler).select(
            "style_id", "ground_truth_index", F.posexplode("candidate_targets").alias("cand_pos", "c")
        ).select("style_id", "ground_truth_index", "cand_pos", F.col("c.type").alias("type"), F.col("c.path").alias("path"))

    return run


def _big_negatives(sampler):
    def run(spark, sf):
        split = assign_splits(X.big_catalogue(spark, sf))
        universe = N.index_universe(C.image_universe(X.big_catalogue(spark, sf)))
        found = N.SAMPLERS[sampler](split.where("split <> 'train'"), universe, N.NUM_CANDIDATES - 1)
        return found.select("style_id", F.explode("negatives").alias("path"))

    return run


def b5(spark, sf):
    records = N.eval_records(_mined(spark, sf, "uniform", N.NUM_CANDIDATES))
    return records.select(
        "instruction_text", "query_text", "query_image_path",
        F.array_join(F.transform("candidate_targets", lambda c: c["path"]), ",").alias("candidates"),
        "ground_truth_index", "task_category", "style_id",
    )


def i1(spark, sf):
    """Audit of lists with planted faults: every rule must report exactly the rows that break it."""
    mined = _mined(spark, sf, "uniform")
    targets = F.col("candidate_targets")
    broken = mined.withColumn(
        "candidate_targets",
        F.when(F.col("style_id") % 7 == 0, F.slice(targets, 1, FAST - 1))
        .when(F.col("style_id") % 7 == 1, F.concat(F.slice(targets, 1, FAST - 1), F.slice(targets, 1, 1)))
        .otherwise(targets),
    ).withColumn(
        "ground_truth_index",
        F.when(F.col("style_id") % 7 == 2, F.lit(FAST)).otherwise(F.col("ground_truth_index")),
    )
    rows = N.audit_candidates(broken, FAST)
    return rows.groupBy("violation").agg(F.count(F.lit(1)).alias("n"), F.min("style_id").alias("first_id"))


def i1_clean(spark, sf):
    """Audit of what the samplers really produce, and of the splits: no violation."""
    found = None
    for sampler in N.SAMPLERS:
        rows = N.audit_candidates(_mined(spark, sf, sampler), FAST)
        found = rows if found is None else found.unionByName(rows)
    found = found.unionByName(N.audit_split_overlap(_split(spark, sf)))
    return found.agg(F.count(F.lit(1)).alias("violations"))


QUERIES = {
    "flagship_split_counts": flagship,
    "b1_drop_incomplete": b1,
    "b2_min_support": b2,
    "b3_instruction": b3,
    "b4_train_records": b4,
    "b5_eval_records": b5,
    "b11_row_cap_head": b11_head,
    "b11_row_cap_random": b11_random,
    "c1_category_distribution": c1,
    "c2_image_universe": c2,
    "c3_split_summary": c3,
    "d1_stratified_split": d1,
    "d2_random_split": d2,
    "d3_uniform_negatives": _negatives("uniform"),
    "d3_uniform_negatives_100": _big_negatives("uniform"),
    "d3_uniform_subsets": _negatives("subset"),
    "d3_uniform_subsets_100": _big_negatives("subset"),
    "d4_pooled_negatives": _negatives("pooled"),
    "d5_rolling_negatives": _negatives("rolling"),
    "d6_candidate_lists": _lists("uniform"),
    "d6_candidate_lists_pooled": _lists("pooled"),
    "d6_candidate_lists_rolling": _lists("rolling"),
    "i1_audit": i1,
    "i1_audit_clean": i1_clean,
}


def _uniform_sql(n: int, prefix: str, queries: str = "queries", universe: str = "universe") -> str:
    primes = ", ".join(map(str, N.STEP_PRIMES))
    return f"""{prefix},
size AS (SELECT count(*) AS u FROM {universe}),
steps AS (SELECT u, list_filter([{primes}]::BIGINT[], lambda p: u % p <> 0) AS ps FROM size),
starts AS (
  SELECT style_id, default_image, u, ('0x' || substr(md5('start42|' || style_id), 1, 15))::BIGINT % u AS a,
         ps[(('0x' || substr(md5('step42|' || style_id), 1, 15))::BIGINT % len(ps)) + 1] AS b
  FROM {queries}, steps),
draws AS (SELECT *, unnest(range(0, least({n + 1}, u))) AS k FROM starts),
found AS (
  SELECT d.style_id, d.default_image, d.k, v.path,
         row_number() OVER (PARTITION BY d.style_id ORDER BY d.k) AS place
  FROM draws d JOIN {universe} v ON v.idx = (d.a + d.k * d.b) % d.u
  WHERE v.path <> d.default_image),
negatives AS (SELECT style_id, default_image, path FROM found WHERE place <= {n})"""


def _subset_sql(n: int, prefix: str) -> str:
    """Each step of the walk adds one position to every query's list."""
    return f"""{prefix},
size AS (SELECT count(*) AS u, least(count(*), {n + 1}) AS m FROM universe),
walk AS (
  SELECT style_id, default_image, u, m, 0 AS k, []::BIGINT[] AS chosen FROM queries, size
  UNION ALL
  SELECT style_id, default_image, u, m, k + 1,
         list_append(chosen, CASE WHEN list_contains(chosen, t) THEN u - m + k ELSE t END)
  FROM (SELECT *, ('0x' || substr(md5('floyd42|' || style_id || '|' || k), 1, 15))::BIGINT % (u - m + k + 1) AS t FROM walk WHERE k < m)),
draws AS (SELECT style_id, default_image, unnest(chosen) AS idx FROM walk WHERE k = m),
found AS (
  SELECT d.style_id, d.default_image, v.path,
         row_number() OVER (PARTITION BY d.style_id ORDER BY md5('order42|' || d.style_id || '|' || d.idx)) AS place
  FROM draws d JOIN universe v USING (idx) WHERE v.path <> d.default_image),
negatives AS (SELECT style_id, default_image, path FROM found WHERE place <= {n})"""


def _pooled_sql(n: int, prefix: str) -> str:
    return f"""{prefix},
size AS (SELECT count(*) AS u FROM universe),
pools AS (
  SELECT pool, path, row_number() OVER (PARTITION BY pool ORDER BY md5('pool42|' || pool || '|' || path), path) AS rk
  FROM universe, (SELECT unnest(range(0, {N.NUM_POOLS})) AS pool)),
picks AS (
  SELECT style_id, default_image,
         ('0x' || substr(md5('pick42|' || style_id), 1, 15))::BIGINT % {N.NUM_POOLS} AS pool
  FROM queries, size),
found AS (
  SELECT style_id, default_image, path, row_number() OVER (PARTITION BY style_id ORDER BY rk) AS place
  FROM picks JOIN pools USING (pool) WHERE path <> default_image),
negatives AS (SELECT style_id, default_image, path FROM found WHERE place <= {n})"""


def _rolling_sql(n: int, prefix: str) -> str:
    w = n + N.WINDOW_MARGIN
    return f"""{prefix},
size AS (SELECT count(*) AS u FROM universe),
turns AS (
  SELECT style_id, default_image,
         row_number() OVER (ORDER BY split DESC, md5('roll42|' || style_id), style_id) - 1 AS r
  FROM queries),
found AS (
  SELECT style_id, default_image, path, row_number() OVER (PARTITION BY style_id ORDER BY idx) AS place
  FROM turns, size, universe
  WHERE idx // {w} = r % greatest(1, (u + {w - 1}) // {w} - 1) AND path <> default_image),
negatives AS (SELECT style_id, default_image, path FROM found WHERE place <= {n})"""


LISTS = """,
members AS (
  SELECT style_id, default_image, path FROM negatives
  UNION ALL SELECT style_id, default_image, default_image FROM queries),
lists AS (
  SELECT style_id, path, path = default_image AS is_truth,
         row_number() OVER (PARTITION BY style_id ORDER BY md5('shuffle42|' || style_id || '|' || path)) - 1 AS cand_pos
  FROM members),
truths AS (SELECT style_id, CAST(cand_pos AS INTEGER) AS ground_truth_index FROM lists WHERE is_truth)"""

LIST_ROWS = """
SELECT style_id, ground_truth_index, CAST(cand_pos AS INTEGER) AS cand_pos, 'image' AS type, path
FROM lists JOIN truths USING (style_id)"""

INSTRUCTION = "'Represent the given ' || lower(master_category) || ' product description for image retrieval task.'"
NEGATIVE_ROWS = "SELECT style_id, path FROM negatives"

_fast = {
    "uniform": _uniform_sql(FAST - 1, X.universe_sql()),
    "pooled": _pooled_sql(FAST - 1, X.universe_sql()),
    "rolling": _rolling_sql(FAST - 1, X.universe_sql()),
}
_big_universe = f"""{X.splits_sql(0, X.BIG_CATALOGUE)},
queries AS (SELECT * FROM splits WHERE split <> 'train'),
universe AS (
  SELECT path, row_number() OVER (ORDER BY md5('universe42|' || path), path) - 1 AS idx
  FROM (SELECT DISTINCT default_image AS path FROM catalogue))"""

SQL = {
    "flagship_split_counts": f"WITH {X.splits_sql(15)} SELECT split, master_category, count(*) AS n FROM splits GROUP BY ALL",
    "b1_drop_incomplete": f"WITH {X.clean_sql()} SELECT * FROM complete",
    "b2_min_support": f"WITH {X.clean_sql(B2_SUPPORT)} SELECT style_id, master_category FROM clean",
    "b3_instruction": f"WITH {X.CATALOGUE} SELECT style_id, {INSTRUCTION} AS instruction_text FROM catalogue",
    "b4_train_records": f"""WITH {X.splits_sql()}
SELECT {INSTRUCTION} AS instruction_text, description AS query_text, CAST(NULL AS VARCHAR) AS query_image_path,
       default_image AS target_image_path, 'retrieval' AS task_category, style_id
FROM splits WHERE split = 'train'""",
    "b5_eval_records": f"""WITH {_uniform_sql(N.NUM_CANDIDATES - 1, X.universe_sql())} {LISTS},
joined AS (SELECT style_id, string_agg(path, ',' ORDER BY cand_pos) AS candidates FROM lists GROUP BY style_id)
SELECT {INSTRUCTION} AS instruction_text, description AS query_text, CAST(NULL AS VARCHAR) AS query_image_path,
       candidates, ground_truth_index, 'retrieval' AS task_category, style_id
FROM queries JOIN joined USING (style_id) JOIN truths USING (style_id)""",
    "b11_row_cap_head": f"WITH {X.BIG_CATALOGUE} SELECT style_id, description FROM catalogue ORDER BY style_id LIMIT 500",
    "b11_row_cap_random": f"""WITH {X.BIG_CATALOGUE}
SELECT style_id, description FROM catalogue ORDER BY md5('42|' || style_id), style_id LIMIT 700""",
    "c1_category_distribution": f"WITH {X.clean_sql()} SELECT master_category, count(*) AS n FROM complete GROUP BY 1 ORDER BY n DESC, 1",
    "c2_image_universe": f"WITH {X.clean_sql()} SELECT default_image AS path, min(style_id) AS first_id FROM clean GROUP BY 1",
    "c3_split_summary": f"""WITH {X.splits_sql()}
SELECT split, master_category, count(*) AS n, CAST(GROUPING(split, master_category) AS BIGINT) AS level,
       count(*) / (SELECT count(*) FROM splits) AS fraction
FROM splits GROUP BY ROLLUP (split, master_category)""",
    "d1_stratified_split": f"WITH {X.splits_sql()} SELECT style_id, master_category, split FROM splits",
    "d2_random_split": """WITH n AS (SELECT count(*) AS total, (count(*) + 4) // 5 AS hold FROM part),
ranked AS (SELECT p_partkey AS style_id, row_number() OVER (ORDER BY md5('42|' || p_partkey), p_partkey) AS rk FROM part)
SELECT style_id, CASE WHEN rk <= total - hold THEN 'train'
                      WHEN rk <= total - hold + (hold - (hold + 1) // 2) THEN 'val' ELSE 'test' END AS split
FROM ranked, n""",
    "d3_uniform_negatives": f"WITH {_fast['uniform']} {NEGATIVE_ROWS}",
    "d3_uniform_negatives_100": f"WITH {_uniform_sql(N.NUM_CANDIDATES - 1, _big_universe)} {NEGATIVE_ROWS}",
    "d3_uniform_subsets": f"WITH RECURSIVE {_subset_sql(FAST - 1, X.universe_sql())} {NEGATIVE_ROWS}",
    "d3_uniform_subsets_100": f"WITH RECURSIVE {_subset_sql(N.NUM_CANDIDATES - 1, _big_universe)} {NEGATIVE_ROWS}",
    "d4_pooled_negatives": f"WITH {_fast['pooled']} {NEGATIVE_ROWS}",
    "d5_rolling_negatives": f"WITH {_fast['rolling']} {NEGATIVE_ROWS}",
    "d6_candidate_lists": f"WITH {_fast['uniform']} {LISTS} {LIST_ROWS}",
    "d6_candidate_lists_pooled": f"WITH {_fast['pooled']} {LISTS} {LIST_ROWS}",
    "d6_candidate_lists_rolling": f"WITH {_fast['rolling']} {LISTS} {LIST_ROWS}",
    "i1_audit": f"""WITH {_fast['uniform']} {LISTS},
faults AS (
  SELECT style_id, 'size' AS violation FROM queries WHERE style_id % 7 = 0
  UNION ALL SELECT style_id, 'index_range' FROM truths WHERE style_id % 7 = 0 AND ground_truth_index = {FAST - 1}
  UNION ALL SELECT style_id, 'duplicate_path' FROM queries WHERE style_id % 7 = 1
  UNION ALL SELECT style_id, 'wrong_truth' FROM truths WHERE style_id % 7 = 1 AND ground_truth_index = {FAST - 1}
  UNION ALL SELECT style_id, 'index_range' FROM queries WHERE style_id % 7 = 2)
SELECT violation, count(*) AS n, min(style_id) AS first_id FROM faults GROUP BY violation""",
    "i1_audit_clean": "SELECT CAST(" + " + ".join(
        f"""(WITH {prefix} {LISTS} SELECT count(*) FROM (
  SELECT style_id FROM lists GROUP BY style_id
  HAVING count(*) <> {FAST} OR count(DISTINCT path) <> {FAST} OR count(*) FILTER (WHERE is_truth) <> 1))"""
        for prefix in _fast.values()
    ) + " AS BIGINT) AS violations",
}
