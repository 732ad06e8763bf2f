"""Queries that pool, score and rank precomputed vectors; real numbers are rounded for comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairforge.functions.vectors import as_double, l2_normalize
from pairforge.operators import retrieval as R
from pairforge.operators.components import connected_components, merge_components
from pairforge.plans import fixtures as X
from pairforge.session import written

NDIM = 16
SHARDS = 4
BIG_BATCH = 10_000
NAMES = ("inbatch_contrastive", "inexample_contrastive", "distributed_inbatch_contrastive")


def _side(spark, sf, query: bool, *columns, repeat: bool = False):
    reps = X.reps(spark, sf)
    chosen = reps.where("is_query" if query else "not is_query")
    return chosen.select(*columns, F.col("vec"))


def _rounded(df, digits=4):
    return df.withColumn("loss", F.round("loss", digits))


def c5(spark, sf):
    best = R.positive_judgements(X.qrels(spark, sf))
    return best.withColumn("score", F.round("score", 6))


def c5_maps(spark, sf):
    maps = R.judgement_maps(X.qrels(spark, sf), parts=3)
    return maps.groupBy("query_id").agg(
        F.sum(F.size("judgements")).alias("documents"), F.count(F.lit(1)).alias("maps"),
        F.max(F.size("judgements")).alias("largest_map"),
        F.round(F.sum(F.aggregate(F.map_values("judgements"), F.lit(0.0), lambda s, x: s + x)), 4).alias("total"),
    )


def f4_violations(spark, sf):
    """Every third target of the batches with an even number is taken away."""
    targets = _side(spark, sf, False, "batch_id", "pos").where("batch_id % 2 = 1 or pos % 3 <> 0")
    return R.batch_violations(_side(spark, sf, True, "batch_id", "pos"), targets)


def f7_unknown(spark, sf):
    name = F.when(F.col("label") % 3 == 0, F.lit("inbatch_contrastive")).when(F.col("label") % 3 == 1, F.lit("other"))
    return R.unknown_losses(X.reps(spark, sf).where("is_query").select("batch_id", "pos", name.alias("loss_name")))


def f8_missing(spark, sf):
    vectors = X.table(spark, sf, "embeddings").where("vec_id % 7 <> 0")
    queries = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vec"))
    targets = vectors.select(F.col("vec_id").alias("target_id"), F.col("embedding").alias("vec"))
    return R.missing_vectors(X.candidates(spark, sf), queries, targets)


def c8(spark, sf):
    count = X.table(spark, sf, "embeddings").agg(F.count(F.lit(1))).scalar()
    turns = X.table(spark, sf, "conversations").select(
        F.col("conv_id").alias("seq_id"), F.col("turn").alias("pos"),
        F.when(F.col("role") != "system", 1).otherwise(0).alias("mask"), count.alias("_n"),
    ).withColumn("vec_id", F.expr("(seq_id * 7 + pos) % _n"))
    states = turns.join(
        X.table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vec")), "vec_id"
    )
    pooled = R.last_token_pooling(states, normalize=True)
    return pooled.select("seq_id", F.posexplode("rep").alias("dim", "value")).withColumn("value", F.round("value", 6))


def f2(spark, sf):
    vectors = X.table(spark, sf, "embeddings").select("vec_id", l2_normalize(as_double("embedding")).alias("v"))
    return vectors.select("vec_id", F.posexplode("v").alias("dim", "value")).withColumn("value", F.round("value", 6))


def _logits(spark, sf, ndim=None, scale=1 / R.TEMPERATURE):
    vectors = X.table(spark, sf, "embeddings")
    queries = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vec"))
    targets = vectors.select(F.col("vec_id").alias("target_id"), F.col("embedding").alias("vec"))
    return R.candidate_logits(X.candidates(spark, sf), queries, targets, scale=scale, ndim=ndim)


def f3(spark, sf):
    return _logits(spark, sf).select(
        "query_id", "cand_pos", "target_id", F.round("logit", 6).alias("logit")
    )


def f4_queries(spark, sf):
    scored = R.in_batch_loss(_side(spark, sf, True, "batch_id", "pos"), _side(spark, sf, False, "batch_id", "pos"))
    return _rounded(scored)


def f4(spark, sf):
    scored = R.in_batch_loss(_side(spark, sf, True, "batch_id", "pos"), _side(spark, sf, False, "batch_id", "pos"))
    return _rounded(R.batch_loss(scored)).select("batch_id", "loss", "n")


def f4_unit_tiled(spark, sf):
    """Batches of 10,000 vectors with two targets per query, in tiles of 100, unit scale."""
    reps = X.reps(spark, sf).withColumn("batch_id", F.expr(f"vec_id div {BIG_BATCH}"))
    queries = reps.where("is_query").select("batch_id", F.expr(f"vec_id % {BIG_BATCH} div 2").alias("pos"), "vec")
    targets = reps.select("batch_id", F.expr(f"vec_id % {BIG_BATCH}").alias("pos"), "vec")
    scored = R.in_batch_loss(queries, targets, scale=R.UNIT_SCALE, tile=100)
    return _rounded(R.batch_loss(scored))


def f5(spark, sf):
    scored = R.global_batch_loss(
        _side(spark, sf, True, "step_id", "shard", "pos"), _side(spark, sf, False, "step_id", "shard", "pos"),
        world_size=SHARDS,
    )
    return _rounded(scored).select("step_id", "loss", "n")


def f6(spark, sf):
    """The positive is moved to place 0 of its list; first 16 dimensions only."""
    logits = _logits(spark, sf, NDIM, R.UNIT_SCALE)
    first = F.when(F.col("target_id") == F.col("query_id") + 1, F.lit(0)).otherwise(F.col("cand_pos") + 1)
    return _rounded(R.in_example_loss(logits.withColumn("cand_pos", first)), 6)


def _routed(spark, sf):
    reps = X.reps(spark, sf)
    name = F.when(F.col("label") % 2 == 0, F.lit("inbatch_contrastive")).otherwise(F.lit("inexample_contrastive"))
    queries = reps.where("is_query").select("batch_id", "pos", "vec", name.alias("loss_name"))
    both = reps.select(
        "batch_id", (F.expr("pos * 2 + vec_id % 2")).alias("pos"), "vec"
    )  # two targets per query: itself and its partner
    return R.routed_loss(queries, both)


def f7_queries(spark, sf):
    return _rounded(_routed(spark, sf), 6)


def f7(spark, sf):
    return _rounded(R.routed_total(_routed(spark, sf)))


def f7_distributed(spark, sf):
    """Three names; the distributed one is scored over the four shards of a step."""
    reps = X.reps(spark, sf)
    name = F.element_at(F.array(*map(F.lit, NAMES)), F.expr("cast(label % 3 as int) + 1"))
    queries = reps.where("is_query").select("step_id", "shard", "batch_id", "pos", "vec", name.alias("loss_name"))
    both = reps.select("batch_id", (F.expr("pos * 2 + vec_id % 2")).alias("pos"), "vec")
    return _rounded(R.routed_loss(queries, both, step="step_id"), 6)


def _predictions(spark, sf):
    ranked = R.rank_candidates(_logits(spark, sf))
    truth = X.candidates(spark, sf).where("target_id = query_id + 1").select(
        "query_id", F.col("cand_pos").alias("ground_truth_index")
    )
    return ranked.join(truth, "query_id")


def f8_predictions(spark, sf):
    return _predictions(spark, sf)


def f8(spark, sf):
    scored = R.ranking_accuracy(_predictions(spark, sf))
    return scored.withColumn("accuracy", F.round("accuracy", 6))


def f9(spark, sf):
    """The control needs the lists only, no vectors."""
    samples = X.candidates(spark, sf).groupBy("query_id").agg(
        F.count(F.lit(1)).alias("num_candidates"),
        F.max(F.when(F.col("target_id") == F.col("query_id") + 1, F.col("cand_pos"))).alias("ground_truth_index"),
    )
    guessed = R.ranking_accuracy(R.random_predictions(samples))
    expected = R.expected_random_accuracy(samples).scalar()
    return guessed.select(
        F.round("accuracy", 6).alias("accuracy"), "correct", "total", F.round(expected, 6).alias("expected_accuracy")
    )


def h1(spark, sf):
    return connected_components(X.edges(spark, sf))


def h1_incremental(spark, sf):
    """The customers' edges in four deliveries, merged one after the other into the table of components."""
    edges = X.edges(spark, sf)
    known = spark.createDataFrame([], "node long, component long")
    for k in range(4):
        known = written(merge_components(known, edges.where(F.pmod(F.xxhash64("src"), F.lit(4)) == k)), "components")
    return known.select("node", "component")


def h1_uncut(spark, sf):
    """Seven long paths over all customers, whose keys have no gaps."""
    customers = X.table(spark, sf, "customer")
    return connected_components(customers.select(F.col("c_custkey").alias("src"), (F.col("c_custkey") + 7).alias("dst")))


QUERIES = {
    "c5_qrels": c5,
    "c5_qrels_maps": c5_maps,
    "c8_last_token_pooling": c8,
    "f2_l2_normalize": f2,
    "f3_similarity_logits": f3,
    "f4_batch_violations": f4_violations,
    "f7_unknown_names": f7_unknown,
    "f8_missing_vectors": f8_missing,
    "f4_in_batch_loss": f4,
    "f4_in_batch_queries": f4_queries,
    "f4_single_batch_tiled": f4_unit_tiled,
    "f5_global_batch_loss": f5,
    "f6_in_example_loss": f6,
    "f7_routed_loss": f7,
    "f7_routed_queries": f7_queries,
    "f7_routed_distributed": f7_distributed,
    "f8_ranking_accuracy": f8,
    "f8_predictions": f8_predictions,
    "f9_random_baseline": f9,
    "h1_connected_components": h1,
    "h1_all_customers": h1_uncut,
    "h1_incremental": h1_incremental,
}

_DOT = "list_dot_product(q.vec, t.vec)"


def _loss_sql(group: str, scale: str, extra: str = "") -> str:
    """Cross entropy from a table ``pairs(group, pos, t_pos, logit, is_truth)``."""
    return f"""maxima AS (SELECT {group}, pos, max(logit) AS top FROM pairs GROUP BY ALL),
losses AS (
  SELECT {group}, pos, any_value(top) + ln(sum(exp(logit - top))) - max(CASE WHEN is_truth THEN logit END) AS loss,
         max(CASE WHEN is_truth THEN t_pos END) AS label, arg_max(t_pos, logit) AS pred
  FROM pairs JOIN maxima USING ({group}, pos) GROUP BY {group}, pos)"""


_F4 = f"""{X.REPS},
pairs AS (
  SELECT q.batch_id, q.pos, t.pos AS t_pos, {_DOT} / 0.02::DOUBLE AS logit, q.pos = t.pos AS is_truth
  FROM reps q JOIN reps t ON q.batch_id = t.batch_id WHERE q.is_query AND NOT t.is_query),
{_loss_sql('batch_id', '')}"""

_LOGITS = f"""{X.REPS}, {X.CANDIDATES},
logits AS (
  SELECT c.query_id, c.cand_pos, c.target_id, {_DOT} / 0.02::DOUBLE AS logit
  FROM cands c JOIN reps q ON q.vec_id = c.query_id JOIN reps t ON t.vec_id = c.target_id),
predictions AS (
  SELECT query_id, CAST(arg_max(cand_pos, logit) AS INTEGER) AS predicted_index, count(*) AS num_candidates,
         CAST(max(CASE WHEN target_id = query_id + 1 THEN cand_pos END) AS INTEGER) AS ground_truth_index
  FROM logits GROUP BY query_id)"""

_F7 = f"""{X.REPS},
named AS (
  SELECT *, CASE WHEN label % 2 = 0 THEN 'inbatch_contrastive' ELSE 'inexample_contrastive' END AS loss_name
  FROM reps WHERE is_query),
slots AS (
  SELECT *, row_number() OVER (PARTITION BY batch_id, loss_name ORDER BY pos) - 1 AS ord FROM named),
owned AS (
  SELECT s.batch_id, s.loss_name, s.pos, s.ord, t.vec_id % 2 AS slot, t.vec
  FROM slots s JOIN reps t ON t.batch_id = s.batch_id AND t.pos = s.pos),
pairs AS (
  SELECT q.batch_id, q.loss_name, q.pos, {_DOT} AS logit,
         CASE q.loss_name WHEN 'inbatch_contrastive' THEN t.ord * 2 + t.slot ELSE t.slot END AS t_pos,
         t.slot = 0 AND t.pos = q.pos AS is_truth
  FROM slots q JOIN owned t ON t.batch_id = q.batch_id AND t.loss_name = q.loss_name
  WHERE q.loss_name = 'inbatch_contrastive' OR q.pos = t.pos),
{_loss_sql('batch_id, loss_name', '')}"""

_F7_STEPS = f"""{X.REPS},
named AS (
  SELECT *, list_extract(['{"', '".join(NAMES)}'], CAST(label % 3 + 1 AS INTEGER)) AS loss_name FROM reps WHERE is_query),
slots AS (
  SELECT *, row_number() OVER (PARTITION BY grp, loss_name ORDER BY shard, batch_id, pos) - 1 AS ord
  FROM (SELECT *, CASE WHEN loss_name = '{NAMES[2]}' THEN 'step ' || step_id ELSE 'batch ' || batch_id END AS grp FROM named)),
owned AS (
  SELECT s.grp, s.loss_name, s.batch_id, s.pos, s.ord, t.vec_id % 2 AS slot, t.vec
  FROM slots s JOIN reps t ON t.batch_id = s.batch_id AND t.pos = s.pos),
pairs AS (
  SELECT q.step_id, q.batch_id, q.loss_name, q.pos, {_DOT} AS logit,
         CASE q.loss_name WHEN '{NAMES[1]}' THEN t.slot ELSE t.ord * 2 + t.slot END AS t_pos,
         t.slot = 0 AND t.pos = q.pos AND t.batch_id = q.batch_id AS is_truth
  FROM slots q JOIN owned t ON t.grp = q.grp AND t.loss_name = q.loss_name
  WHERE q.loss_name <> '{NAMES[1]}' OR q.pos = t.pos),
{_loss_sql('step_id, batch_id, loss_name', '')}"""

SQL = {
    "c5_qrels": f"""WITH {X.QRELS}
SELECT query_id, corpus_id, round(max(score), 6) AS score FROM qrels WHERE score > 0 GROUP BY ALL""",
    "c5_qrels_maps": f"""WITH {X.QRELS},
best AS (SELECT query_id, corpus_id, max(score) AS score FROM qrels WHERE score > 0 GROUP BY ALL),
parts AS (
  SELECT query_id, ('0x' || substr(md5('map|' || corpus_id), 1, 8))::BIGINT % 3 AS part, count(*) AS n, sum(score) AS total FROM best GROUP BY ALL)
SELECT query_id, CAST(sum(n) AS BIGINT) AS documents, count(*) AS maps, CAST(max(n) AS INTEGER) AS largest_map, round(sum(total), 4) AS total
FROM parts GROUP BY query_id""",
    "f4_batch_violations": f"""WITH {X.REPS},
q AS (SELECT batch_id, count(*) AS n_queries FROM reps WHERE is_query GROUP BY batch_id),
t AS (SELECT batch_id, count(*) AS n_targets FROM reps WHERE NOT is_query AND (batch_id % 2 = 1 OR pos % 3 <> 0) GROUP BY batch_id)
SELECT batch_id, n_queries, coalesce(n_targets, 0) AS n_targets FROM q LEFT JOIN t USING (batch_id) WHERE coalesce(n_targets, 0) < n_queries""",
    "f7_unknown_names": f"""WITH {X.REPS}
SELECT batch_id, CASE label % 3 WHEN 1 THEN 'other' END AS loss_name, count(*) AS n FROM reps WHERE is_query AND label % 3 <> 0 GROUP BY ALL""",
    "f8_missing_vectors": f"""WITH {X.REPS}, {X.CANDIDATES}
SELECT 'query' AS side, query_id AS id, count(*) AS n FROM cands WHERE query_id % 7 = 0 GROUP BY query_id
UNION ALL SELECT 'target', target_id, count(*) FROM cands WHERE target_id % 7 = 0 GROUP BY target_id""",
    "c8_last_token_pooling": """WITH turns AS (
  SELECT conv_id AS seq_id, turn, (conv_id * 7 + turn) % (SELECT count(*) FROM embeddings) AS vec_id
         , CASE WHEN role <> 'system' THEN 1000000 ELSE 0 END + turn AS place FROM conversations),
lasts AS (SELECT seq_id, arg_max(vec_id, place) AS vec_id FROM turns GROUP BY seq_id),
vecs AS (SELECT seq_id, CAST(embedding AS DOUBLE[]) AS v FROM lasts JOIN embeddings USING (vec_id))
SELECT seq_id, CAST(unnest(range(0, len(v))) AS INTEGER) AS dim,
       round(unnest(v) / greatest(sqrt(list_dot_product(v, v)), 1e-12), 6) AS value FROM vecs""",
    "f2_l2_normalize": """WITH vecs AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
SELECT vec_id, CAST(unnest(range(0, len(v))) AS INTEGER) AS dim,
       round(unnest(v) / greatest(sqrt(list_dot_product(v, v)), 1e-12), 6) AS value FROM vecs""",
    "f3_similarity_logits": f"""WITH {_LOGITS}
SELECT query_id, CAST(cand_pos AS INTEGER) AS cand_pos, target_id, round(logit, 6) AS logit FROM logits""",
    "f4_in_batch_loss": f"WITH {_F4} SELECT batch_id, round(avg(loss), 4) AS loss, count(*) AS n FROM losses GROUP BY batch_id",
    "f4_in_batch_queries": f"WITH {_F4} SELECT batch_id, pos, label, pred, round(loss, 4) AS loss FROM losses",
    "f4_single_batch_tiled": f"""WITH {X.REPS},
pairs AS (
  SELECT q.vec_id // {BIG_BATCH} AS batch_id, q.vec_id // 2 AS pos, t.vec_id AS t_pos, {_DOT} AS logit,
         t.vec_id = q.vec_id AS is_truth
  FROM reps q JOIN reps t ON t.vec_id // {BIG_BATCH} = q.vec_id // {BIG_BATCH} WHERE q.is_query),
{_loss_sql('batch_id', '')}
SELECT batch_id, round(avg(loss), 4) AS loss,
       avg(CASE WHEN pred = label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS accuracy, count(*) AS n
FROM losses GROUP BY batch_id""",
    "f5_global_batch_loss": f"""WITH {X.REPS},
pairs AS (
  SELECT q.step_id, q.vec_id AS pos, t.vec_id AS t_pos, {_DOT} / 0.02::DOUBLE AS logit, t.vec_id = q.vec_id + 1 AS is_truth
  FROM reps q JOIN reps t ON q.step_id = t.step_id WHERE q.is_query AND NOT t.is_query),
{_loss_sql('step_id', '')}
SELECT step_id, round(avg(loss) * {SHARDS}, 4) AS loss, count(*) AS n FROM losses GROUP BY step_id""",
    "f6_in_example_loss": f"""WITH {X.REPS}, {X.CANDIDATES},
pairs AS (
  SELECT c.query_id, 0 AS pos, CASE WHEN c.target_id = c.query_id + 1 THEN 0 ELSE CAST(cand_pos + 1 AS INTEGER) END AS t_pos,
         list_dot_product(q.vec[1:{NDIM}], t.vec[1:{NDIM}]) AS logit, c.target_id = c.query_id + 1 AS is_truth
  FROM cands c JOIN reps q ON q.vec_id = c.query_id JOIN reps t ON t.vec_id = c.target_id),
{_loss_sql('query_id', '')}
SELECT query_id, round(loss, 6) AS loss, pred, label FROM losses""",
    "f7_routed_loss": f"""WITH {_F7},
means AS (SELECT batch_id, loss_name, avg(loss) AS loss FROM losses GROUP BY ALL)
SELECT batch_id, round(sum(loss), 4) AS loss, count(*) AS groups FROM means GROUP BY batch_id""",
    "f7_routed_queries": f"WITH {_F7} SELECT batch_id, loss_name, pos, label, pred, round(loss, 6) AS loss FROM losses",
    "f7_routed_distributed": f"""WITH {_F7_STEPS}
SELECT step_id, batch_id, loss_name, pos, label, pred, round(loss, 6) AS loss FROM losses""",
    "f8_ranking_accuracy": f"""WITH {_LOGITS}
SELECT round(count(*) FILTER (WHERE predicted_index = ground_truth_index) / count(*), 6) AS accuracy,
       count(*) FILTER (WHERE predicted_index = ground_truth_index) AS correct, count(*) AS total FROM predictions""",
    "f8_predictions": f"WITH {_LOGITS} SELECT * FROM predictions",
    "f9_random_baseline": f"""WITH {_LOGITS},
guesses AS (
  SELECT *, ('0x' || substr(md5('guess42|' || query_id), 1, 8))::BIGINT % num_candidates AS guess FROM predictions)
SELECT round(count(*) FILTER (WHERE guess = ground_truth_index) / count(*), 6) AS accuracy,
       count(*) FILTER (WHERE guess = ground_truth_index) AS correct, count(*) AS total,
       round(avg(1 / num_candidates), 6) AS expected_accuracy
FROM guesses""",
    "h1_all_customers": """WITH nodes AS (SELECT c_custkey AS node FROM customer UNION SELECT c_custkey + 7 FROM customer)
SELECT node, min(node) OVER (PARTITION BY node % 7) AS component FROM nodes""",
    "h1_connected_components": """WITH RECURSIVE links AS (
  SELECT c_custkey AS a, c_custkey + 7 AS b FROM customer WHERE c_custkey % 5 <> 0
  UNION SELECT c_custkey + 7, c_custkey FROM customer WHERE c_custkey % 5 <> 0),
reach(node, other) AS (
  SELECT a, a FROM links UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT node, min(other) AS component FROM reach GROUP BY node""",
}
SQL["h1_incremental"] = SQL["h1_connected_components"]
