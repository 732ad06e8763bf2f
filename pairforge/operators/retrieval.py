"""Candidate expansion, similarity, contrastive losses and ranking accuracy on precomputed vectors.

Batch losses need every query against every target of its batch. That product is taken tile by tile:
a task multiplies at most ``tile`` queries by ``tile`` targets with numpy and returns one row per
query (running maximum, sum of exponentials, best target), so neither the pairs nor a whole batch are
ever materialised, and a batch of any size spreads over many tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.functions.joins import salted_lookup
from pairforge.functions.keys import HOT_ROWS, SEED, block_index, hash_long
from pairforge.functions.text import full_query_text
from pairforge.functions.vectors import as_double, dot, l2_normalize, truncate_dims
from pairforge.session import written

# The two temperature conventions.
TEMPERATURE = 0.02  # logits are divided by it
UNIT_SCALE = 1.0  # logits are multiplied by it
TILE = 1024
# The names of the losses that can be routed.
GATHERED = "distributed_inbatch_contrastive"
WITHIN_BATCH = ("inbatch_contrastive", GATHERED)
WITHIN_EXAMPLE = "inexample_contrastive"


# -- relevance judgements ---------------------------------------------------------------------------


def positive_judgements(
    qrels: DataFrame, query: str = "query_id", doc: str = "corpus_id", score: str = "score"
) -> DataFrame:
    """Best positive score per (query, document); the flat form of the judgement map."""
    return qrels.where(F.col(score) > 0).groupBy(query, doc).agg(F.max(score).alias(score))


def judgement_maps(
    qrels: DataFrame, query: str = "query_id", doc: str = "corpus_id", score: str = "score",
    parts: int = 1,
) -> DataFrame:
    """``MAP<document, score>`` per query, or ``parts`` maps by hash of the document where one would be too large.

    The number of parts is the caller's alone; it never follows from the size of a query."""
    best = positive_judgements(qrels, query, doc, score)
    part = F.pmod(hash_long(doc, seed="map", digits=8), F.lit(parts))
    return best.withColumn("part", part).groupBy(query, "part").agg(
        F.map_from_entries(F.collect_list(F.struct(doc, score))).alias("judgements")
    )


# -- pooling ----------------------------------------------------------------------------------------


def last_token_pooling(
    states: DataFrame, seq: str = "seq_id", pos: str = "pos", mask: str = "mask", vec: str = "vec",
    pooling: str = "last", normalize: bool = False,
) -> DataFrame:
    """Vector at the last unmasked position, whichever side the padding is on; at the last position of a sequence
    that is masked throughout. Positions are unique within a sequence; only they are aggregated, not the vectors."""
    if pooling not in ("last", "eos"):
        raise NotImplementedError(f"pooling {pooling!r}")
    unmasked = F.coalesce(F.col(mask) == 1, F.lit(False))
    last = states.groupBy(seq).agg(F.max(F.struct(unmasked.alias("open"), F.col(pos).alias("at"))).alias("_last"))
    last = last.select(seq, F.col("_last.at").alias(pos))
    pooled = states.select(seq, pos, F.col(vec).alias("rep")).join(last, [seq, pos]).drop(pos)
    return pooled.withColumn("rep", l2_normalize(as_double("rep"))) if normalize else pooled


# -- candidate lists --------------------------------------------------------------------------------


def expand_candidates(records: DataFrame, id_col: str = "style_id") -> DataFrame:
    """One row per query and candidate."""
    return records.select(
        id_col,
        full_query_text("instruction_text", "query_text").alias("query_text"),
        F.lit("").alias("passage_text"),
        "ground_truth_index",
        F.posexplode("candidate_targets").alias("cand_pos", "_target"),
    ).select(
        id_col, "query_text", "passage_text", "cand_pos", F.col("_target.path").alias("passage_path"),
        (F.col("cand_pos") == F.col("ground_truth_index")).alias("is_ground_truth"),
    )


def candidate_logits(
    cands: DataFrame,
    query_reps: DataFrame,
    target_reps: DataFrame,
    query: str = "query_id",
    target: str = "target_id",
    scale: float = 1 / TEMPERATURE,
    ndim: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``logit`` to ``(query, cand_pos, target)`` rows.

    ``*_reps`` have the id and ``vec``. A target that occurs in very many lists, and a query with a
    very long list, are salted. Vectors travel as stored and become double only for the product. A candidate
    without a vector keeps its place with a NULL logit; :func:`missing_vectors` lists those.
    """
    with_target = salted_lookup(
        cands, target_reps.select(target, F.col("vec").alias("_t")), target, [query, "cand_pos"],
        how="left", hot_rows=hot_rows,
    )
    with_both = salted_lookup(
        with_target, query_reps.select(query, F.col("vec").alias("_q")), query, ["cand_pos", target],
        how="left", hot_rows=hot_rows, count_in=cands,
    )
    logit = dot(as_double(truncate_dims("_q", ndim)), as_double(truncate_dims("_t", ndim))) * F.lit(scale)
    return with_both.withColumn("logit", logit).drop("_q", "_t")


def missing_vectors(
    cands: DataFrame, query_reps: DataFrame, target_reps: DataFrame, query: str = "query_id", target: str = "target_id"
) -> DataFrame:
    """``(side, id, n)``: ids in the candidate rows that have no vector, with the number of their rows."""
    sides = []
    for side, key, reps in (("query", query, query_reps), ("target", target, target_reps)):
        used = cands.groupBy(F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("n"))
        known = reps.where(F.col("vec").isNotNull()).select(F.col(key).alias("id")).distinct()
        sides.append(used.join(known, "id", "left_anti").select(F.lit(side).alias("side"), "id", "n"))
    return sides[0].unionByName(sides[1])


def in_example_loss(
    logits: DataFrame, query: str = "query_id", pos: str = "cand_pos", logit: str = "logit", chunk: int = TILE
) -> DataFrame:
    """Per query: cross entropy with candidate 0 as the target, and the predicted position.

    Lists are reduced in chunks of ``chunk`` positions first, so no task holds a very long list.
    """
    keyed = logits.withColumn("_chunk", F.expr(f"`{pos}` div {chunk}"))
    of_chunk = Window.partitionBy(query, "_chunk")
    parts = (
        keyed.withColumn("_max", F.max(logit).over(of_chunk))
        .groupBy(query, "_chunk")
        .agg(
            F.max("_max").alias("top"),
            F.sum(F.exp(F.col(logit) - F.col("_max"))).alias("total"),
            F.max(F.when(F.col(pos) == 0, F.col(logit))).alias("truth"),
            F.max_by(F.col(pos), F.struct(F.col(logit), -F.col(pos))).alias("pred"),
        )
    )
    return _merge_parts(parts, [query]).withColumn("label", F.lit(0))


def _merge_parts(parts: DataFrame, keys: list[str], *kept: Column) -> DataFrame:
    """Loss and prediction from the ``top, total, truth, pred`` of each part of a query's scores."""
    merged = parts.groupBy(*keys).agg(
        *kept,
        F.max_by("pred", F.struct(F.col("top"), -F.col("pred"))).alias("pred"),
        F.max("top").alias("_top"),
        F.collect_list(F.struct("top", "total")).alias("_parts"),  # one entry per chunk or tile
        F.max("truth").alias("_truth"),
    )
    total = F.aggregate(
        "_parts", F.lit(0.0), lambda s, p: s + p["total"] * F.exp(p["top"] - F.col("_top"))
    )
    return merged.withColumn("loss", F.col("_top") + F.log(total) - F.col("_truth")).drop(
        "_top", "_parts", "_truth"
    )


def rank_candidates(logits: DataFrame, query: str = "query_id", pos: str = "cand_pos") -> DataFrame:
    """Best candidate per query; the lowest position wins ties."""
    return logits.groupBy(query).agg(
        F.max_by(F.col(pos), F.struct(F.col("logit"), -F.col(pos))).alias("predicted_index"),
        F.count(F.lit(1)).alias("num_candidates"),
    )


def ranking_accuracy(
    predictions: DataFrame, predicted: str = "predicted_index", truth: str = "ground_truth_index",
    num_candidates: str = "num_candidates",
) -> DataFrame:
    """One row ``accuracy, correct, total`` over the samples that have candidates."""
    scored = predictions.where(F.col(num_candidates) > 0)
    return scored.agg(
        F.count_if(F.col(predicted) == F.col(truth)).alias("correct"), F.count(F.lit(1)).alias("total")
    ).select(
        F.when(F.col("total") > 0, F.col("correct") / F.col("total")).otherwise(F.lit(0.0)).alias("accuracy"),
        "correct",
        "total",
    )


def random_predictions(
    samples: DataFrame, id_col: str = "query_id", num_candidates: str = "num_candidates", seed: int = SEED
) -> DataFrame:
    """A uniformly hashed guess per sample: the control for :func:`ranking_accuracy`."""
    guess = F.when(
        F.col(num_candidates) > 0,
        F.pmod(hash_long(id_col, seed=f"guess{seed}", digits=8), F.col(num_candidates)),
    )
    return samples.withColumn("predicted_index", guess)


def expected_random_accuracy(samples: DataFrame, num_candidates: str = "num_candidates") -> DataFrame:
    return samples.where(F.col(num_candidates) > 0).agg(
        F.coalesce(F.avg(1 / F.col(num_candidates)), F.lit(0.0)).alias("expected_accuracy")
    )


# -- batch losses -----------------------------------------------------------------------------------


def _tile_scores(group_cols: list[str], scale: float):
    """Scores of one tile: a row per query, never a row per pair.

    Returned as a closure without references to this module, so workers need not have it installed.
    """

    def matrix(column: pa.ChunkedArray) -> np.ndarray:
        vectors = column.combine_chunks()
        width = len(vectors[0]) if len(vectors) else 0
        return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)

    def run(table: pa.Table) -> pa.Table:
        is_query = table.column("is_query").to_numpy()
        positions = table.column("pos").to_numpy()
        reps = matrix(table.column("vec"))
        q_at, t_at = np.flatnonzero(is_query), np.flatnonzero(~is_query)
        t_at = t_at[np.argsort(positions[t_at], kind="stable")]
        t_pos = positions[t_at]
        logits = (reps[q_at] @ reps[t_at].T) * scale
        best = logits.argmax(axis=1)
        top = logits[np.arange(len(q_at)), best]
        wanted = table.column("label").to_numpy()[q_at]
        found = np.searchsorted(t_pos, wanted)
        found = np.where(found < len(t_pos), found, 0)
        inside = t_pos[found] == wanted
        truth = np.where(inside, logits[np.arange(len(q_at)), found], np.nan)
        out = {c: table.column(c).take(pa.array(q_at)) for c in group_cols}
        out |= {
            "pos": pa.array(positions[q_at]),
            "label": pa.array(wanted),
            "top": pa.array(top),
            "total": pa.array(np.exp(logits - top[:, None]).sum(axis=1)),
            "pred": pa.array(t_pos[best]),
            "truth": pa.array(truth, mask=~inside),
        }
        return pa.table(out)

    return run


def batch_sizes(queries: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """Queries and targets per batch."""
    sides = queries.select(*keys, F.lit(1).alias("_q"), F.lit(0).alias("_t")).unionByName(
        targets.select(*keys, F.lit(0).alias("_q"), F.lit(1).alias("_t"))
    )
    return sides.groupBy(*keys).agg(F.sum("_q").alias("n_queries"), F.sum("_t").alias("n_targets"))


def batch_violations(queries: DataFrame, targets: DataFrame, batch: str | list[str] = "batch_id") -> DataFrame:
    """Batches with fewer targets than queries, with both counts: no loss is defined for them."""
    keys = [batch] if isinstance(batch, str) else list(batch)
    return batch_sizes(queries, targets, keys).where("n_targets < n_queries")


def in_batch_loss(
    queries: DataFrame,
    targets: DataFrame,
    batch: str | list[str] = "batch_id",
    scale: float = 1 / TEMPERATURE,
    tile: int = TILE,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Per query of a batch: cross entropy against all targets of the batch, label and prediction.

    Both sides are ``(batch, pos, vec)`` with dense zero-based positions. With t targets per query the
    positive of query i is target i * t. ``sizes`` are known :func:`batch_sizes`. A batch with fewer targets than
    queries is an error; :func:`batch_violations` lists them beforehand.
    """
    keys = [batch] if isinstance(batch, str) else list(batch)
    counted = batch_sizes(queries, targets, keys) if sizes is None else sizes
    told = F.concat_ws(" ", F.lit("fewer targets than queries in batch"), *[F.col(k).cast("string") for k in keys])
    enough = F.when(F.col("n_targets") >= F.col("n_queries"), F.col("n_targets")).otherwise(F.raise_error(told).cast("bigint"))
    sizes = counted.where("n_queries > 0").withColumn("n_targets", enough)

    def tiles(n: str) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.expr(f"({n} - 1) div {tile}"))

    own = F.expr(f"cast(pos as bigint) div {tile}")
    per_query = F.expr("n_targets div n_queries")
    q = queries.join(sizes, keys).select(
        *keys, own.alias("q_tile"), F.explode(tiles("n_targets")).alias("t_tile"),
        F.col("pos").cast("long").alias("pos"), F.lit(True).alias("is_query"),
        (F.col("pos") * per_query).cast("long").alias("label"), "vec",
    )
    t = targets.join(sizes, keys).select(
        *keys, F.explode(tiles("n_queries")).alias("q_tile"), own.alias("t_tile"),
        F.col("pos").cast("long").alias("pos"), F.lit(False).alias("is_query"),
        F.lit(0).cast("long").alias("label"), "vec",
    )
    types = dict(queries.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys)
    schema += ", pos bigint, label bigint, top double, total double, pred bigint, truth double"
    # Partitioned by tile, not by batch, so the tiles of one batch run on different executors.
    parts = (
        q.unionByName(t)
        .repartition(*keys, "q_tile", "t_tile")
        .groupBy(*keys, "q_tile", "t_tile")
        .applyInArrow(_tile_scores(keys, float(scale)), schema)
    )
    return _merge_parts(parts, [*keys, "pos"], F.max("label").alias("label")).select(
        *keys, "pos", "label", "pred", "loss"
    )


def batch_loss(per_query: DataFrame, batch: str | list[str] = "batch_id", factor: float = 1.0) -> DataFrame:
    """Mean loss per batch, with the share of queries that rank their positive first."""
    keys = [batch] if isinstance(batch, str) else list(batch)
    return per_query.groupBy(*keys).agg(
        (F.avg("loss") * F.lit(float(factor))).alias("loss"),
        F.avg(F.when(F.col("pred") == F.col("label"), 1.0).otherwise(0.0)).alias("accuracy"),
        F.count(F.lit(1)).alias("n"),
    )


def global_positions(df: DataFrame, step: str = "step_id", shard: str = "shard", pos: str = "pos") -> DataFrame:
    """Positions after concatenating the shards of a step in order."""
    sizes = df.groupBy(step, shard).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(step).orderBy(shard).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(step, shard, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return df.join(starts, [step, shard]).withColumn(pos, F.col(pos) + F.col("_start")).drop("_start")


def global_batch_loss(
    queries: DataFrame,
    targets: DataFrame,
    step: str = "step_id",
    shard: str = "shard",
    scale: float = 1 / TEMPERATURE,
    world_size: int | None = None,
    tile: int = TILE,
) -> DataFrame:
    """Loss over the batches of all shards of a step, optionally multiplied by the number of shards."""
    per_query = in_batch_loss(
        global_positions(queries, step, shard), global_positions(targets, step, shard), step, scale, tile,
        sizes=batch_sizes(queries, targets, [step]),
    )
    return batch_loss(per_query, step, world_size or 1)


def unknown_losses(queries: DataFrame, batch: str = "batch_id", loss_name: str = "loss_name") -> DataFrame:
    """``(batch, loss_name, n)`` of the queries whose loss is not known, NULL included."""
    odd = queries.where(~F.coalesce(F.col(loss_name).isin(*WITHIN_BATCH, WITHIN_EXAMPLE), F.lit(False)))
    return odd.groupBy(batch, loss_name).agg(F.count(F.lit(1)).alias("n"))


def routed_loss(
    queries: DataFrame,
    targets: DataFrame,
    batch: str = "batch_id",
    loss_name: str = "loss_name",
    scale: float = UNIT_SCALE,
    tile: int = TILE,
    step: str | None = None,
    shard: str = "shard",
) -> DataFrame:
    """Per query: loss, label and prediction by the rule its ``loss_name`` asks for.

    ``queries`` are ``(batch, pos, vec, loss_name)``; targets ``(batch, pos, vec)`` belong to query
    ``pos div t``. Queries of one name form their own group with their own targets, numbered anew, and
    results return at the original position. Any other name is an error; :func:`unknown_losses` counts them beforehand.

    With ``step``, queries also have that column and ``shard``, and the result has the step: the distributed name is
    then scored over the batches of all shards of a step in the order of the shards. These must all have as many targets per query; other steps are
    errors that name the step.
    Without it every batch is a step of its own.
    """
    keys = [batch, loss_name]
    told = F.concat(F.lit("unknown loss "), F.coalesce(F.col(loss_name), F.lit("NULL")))
    known = F.col(loss_name).isin(*WITHIN_BATCH, WITHIN_EXAMPLE)
    queries = queries.withColumn(loss_name, F.when(known, F.col(loss_name)).otherwise(F.raise_error(told).cast("string")))
    # Places of the queries within their batch and name: narrow, and read several times below.
    steps = [step, shard] if step else []
    local = written(
        block_index(queries.select(*keys, *steps, F.col("pos").alias("_query")), "_query", keys, out="_at", block=1 << 16),
        "loss_slots",
    )
    per_batch = batch_sizes(queries, targets, [batch]).withColumn("_t", F.expr("n_targets div n_queries"))
    # Which batches share their targets, and where each begins: one row per batch and name.
    own_group = F.concat(F.lit("batch "), F.col(batch).cast("string"))
    group = own_group
    if step:
        whole_step = F.concat(F.lit("step "), F.col(step).cast("string"))
        group = F.when(F.col(loss_name) == GATHERED, whole_step).otherwise(own_group)
    before = Window.partitionBy("_group", loss_name).orderBy(*steps[1:], batch).rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        local.groupBy(*keys, *steps).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_group", group)
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .join(per_batch.select(batch, "_t"), batch)
    )
    # targets of a group are numbered by place and slot, which needs one number of slots
    whole = Window.partitionBy("_group", loss_name)
    uneven = F.concat(F.lit("different numbers of targets per query in "), F.col("_group"))
    even = F.min("_t").over(whole) == F.max("_t").over(whole)
    parts = parts.withColumn("_start", F.when(even, F.col("_start")).otherwise(F.raise_error(uneven).cast("long")))
    slots = local.drop(*steps).join(parts.drop("_n", "_t"), keys).withColumn("_at", F.col("_at") + F.col("_start"))
    owned = (
        targets.select(batch, "pos", "vec").join(per_batch.select(batch, "_t"), batch)
        .withColumn("_query", F.expr("pos div _t"))
        .withColumn("_slot", F.expr("pos % _t"))
        .join(slots, [batch, "_query"])
    )
    in_batch = F.col(loss_name).isin(*WITHIN_BATCH)
    shared = ["_group", loss_name]
    group_sizes = parts.groupBy(*shared).agg(
        F.sum("_n").alias("n_queries"), F.sum(F.col("_n") * F.col("_t")).alias("n_targets")
    )
    scored = in_batch_loss(
        queries.where(in_batch).select(*keys, F.col("pos").alias("_query"), "vec").join(slots, [*keys, "_query"])
        .select(*shared, F.col("_at").alias("pos"), "vec"),
        owned.where(in_batch).select(*shared, (F.col("_at") * F.col("_t") + F.col("_slot")).alias("pos"), "vec"),
        shared, scale, tile, sizes=group_sizes.where(in_batch),
    ).withColumnRenamed("pos", "_at")
    batchwise = scored.join(slots, [*shared, "_at"]).select(
        *keys, *steps[:1], F.col("_query").alias("pos"), "label", "pred", "loss"
    )

    single = F.col(loss_name) == WITHIN_EXAMPLE
    pairs = (
        owned.where(single)
        .select(*keys, *steps[:1], "_query", F.col("_slot").alias("cand_pos"), F.col("vec").alias("_t_vec"))
        .join(queries.where(single).select(*keys, F.col("pos").alias("_query"), F.col("vec").alias("_q_vec")),
              [*keys, "_query"])
        .select(
            F.struct(*keys, *steps[:1], "_query").alias("_id"), "cand_pos",
            (dot(as_double("_q_vec"), as_double("_t_vec")) * F.lit(float(scale))).alias("logit"),
        )
    )
    each = in_example_loss(pairs, "_id").select(
        *[F.col(f"_id.{k}").alias(k) for k in [*keys, *steps[:1]]], F.col("_id._query").alias("pos"),
        F.col("label").cast("long").alias("label"), F.col("pred").cast("long").alias("pred"), "loss",
    )
    return batchwise.unionByName(each)


def routed_total(per_query: DataFrame, batch: str = "batch_id", loss_name: str = "loss_name") -> DataFrame:
    """Sum over the loss names of the mean loss of each group; by step, if that is passed as ``batch``."""
    means = per_query.groupBy(batch, loss_name).agg(F.avg("loss").alias("_mean"))
    return means.groupBy(batch).agg(F.sum("_mean").alias("loss"), F.count(F.lit(1)).alias("groups"))
