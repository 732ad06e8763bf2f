"""Negative mining and candidate lists for evaluation queries.

Four samplers share one output, ``negatives ARRAY<STRING>`` per query:

* uniform: N+1 distinct positions of the indexed universe per query, by arithmetic, then one
  equi-join on the position;
* subset: the same with every set of positions equally likely, at a cost of N**2 comparisons a query;
* pooled: a few shuffled heads of the universe; every query filters its pool in place;
* rolling: consecutive windows of one shuffled universe, addressed by a closed form instead of a
  cursor.

None compares a query with the universe, and none needs the position of the ground truth: it is
dropped after the lookup, so a picture shared by a third of the queries is no hot join key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.functions.joins import bounded_broadcast
from pairforge.functions.keys import SEED, hash_hex, hash_index, hash_long
from pairforge.functions.text import instruction_text
from pairforge.operators.catalogue import TASK_CATEGORY, strict_long
from pairforge.session import spread, written

# List sizes, the window margin and the pool limits of the samplers.
NUM_CANDIDATES = 100
NUM_CANDIDATES_FAST = 25
WINDOW_MARGIN = 10
NUM_POOLS = 10

# Primes below 2**31. A step is usable when it does not divide the universe size.
STEP_PRIMES = (
    1140850681, 1207959503, 1275068407, 1342177237, 1409286139, 1476394991, 1543503851, 1610612711,
    1677721597, 1744830457, 1811939317, 1879048183, 1946157053, 2013265907, 2080374781, 2147483647,
)


def index_universe(universe: DataFrame, seed: int = SEED) -> DataFrame:
    """``(path, idx)`` in hash order; written once, because the samplers read it several times."""
    distinct = written(universe.select("path"), "paths")
    return written(hash_index(distinct, ["path"], seed=f"universe{seed}"), "universe")


def _size(universe: DataFrame) -> Column:
    return universe.agg(F.count(F.lit(1))).scalar()


def draw_positions(queries: DataFrame, query_id: str, size: Column, n: int, seed: int = SEED) -> DataFrame:
    """min(n, size) rows per query: its k-th position ``start + k * step`` below ``size``, as ``_k, idx``.

    The step is coprime to the size, so the positions are distinct; every position is equally likely to
    be drawn, and those of one query lie on one progression. Start and step are hashed once per query,
    below the explode.
    """
    steps = F.filter(
        F.array(*[F.lit(p).cast("long") for p in STEP_PRIMES]), lambda p: F.col("_size") % p != 0
    )
    pick = F.pmod(hash_long(query_id, seed=f"step{seed}"), F.size("_steps")) + 1
    progressions = (
        queries.withColumn("_size", size)
        .where("_size > 0")
        .withColumn("_steps", steps)
        .withColumn("_start", F.pmod(hash_long(query_id, seed=f"start{seed}"), F.col("_size")))
        .withColumn("_step", F.element_at("_steps", pick.cast("int")))
        .drop("_steps")
    )
    ks = F.sequence(F.lit(0).cast("long"), F.least(F.lit(n).cast("long"), F.col("_size")) - 1)
    return (
        progressions.withColumn("_k", F.explode(ks))
        .withColumn("idx", F.pmod(F.col("_start") + F.col("_k") * F.col("_step"), F.col("_size")))
        .drop("_size", "_start", "_step")
    )


def draw_subsets(queries: DataFrame, query_id: str, size: Column, n: int, seed: int = SEED) -> DataFrame:
    """min(n, size) rows per query, as ``_k, idx``: a subset of the positions below ``size``, in random order.

    Every subset is equally likely, and so is every order of it. For j from size - n to size - 1 a hashed number up to j
    joins the subset, or j itself if that number is already in it (Bentley and Floyd, 1987): n steps whatever the
    size, and never a rejected draw. The numbers are hashed once per step; numbers that are all distinct are the subset, as the
    first to give way would repeat an earlier one. Only lists with a repeat are walked step by step.
    """
    wanted = F.least(F.lit(n).cast("long"), F.col("_size"))
    first = F.col("_size") - F.col("_wanted")

    def number(k: Column) -> Column:
        return F.pmod(hash_long(query_id, k, seed=f"floyd{seed}"), first + k + 1)

    def add(chosen: Column, t: Column) -> Column:
        return F.concat(chosen, F.array(F.when(F.array_contains(chosen, t), first + F.size(chosen)).otherwise(t)))

    ks = F.sequence(F.lit(0).cast("long"), F.col("_wanted") - 1)
    drawn = (
        queries.withColumn("_size", size)
        .where("_size > 0")
        .withColumn("_wanted", wanted)
        .withColumn("_numbers", F.transform(ks, number))
    )
    walked = F.aggregate("_numbers", F.array().cast("array<bigint>"), add)
    subsets = drawn.withColumn(
        "_chosen", F.when(F.size(F.array_distinct("_numbers")) == F.col("_wanted"), F.col("_numbers")).otherwise(walked)
    )
    ordered = F.sort_array(
        F.transform("_chosen", lambda i: F.struct(hash_hex(query_id, i, seed=f"order{seed}").alias("h"), i.alias("idx")))
    )
    # Outer, though no list is empty: for the inner form Spark adds a filter on the list below it, which draws every list again.
    return (
        subsets.withColumn("_ordered", ordered)
        .select(*queries.columns, F.posexplode_outer("_ordered").alias("_k", "_at"))
        .select(*queries.columns, "_k", F.col("_at.idx").alias("idx"))
    )


def _drop_truth(paths: Column, truth: Column, n: int) -> Column:
    return F.slice(F.filter(paths, lambda p: ~p.eqNullSafe(truth)), 1, n)


def uniform_negatives(
    queries: DataFrame,
    universe: DataFrame,
    n: int,
    id_col: str = "style_id",
    truth: str = "default_image",
    seed: int = SEED,
    draw=draw_positions,
) -> DataFrame:
    """``n`` distinct images other than the ground truth; all others when the universe is smaller.

    ``universe`` is an indexed universe. One spare position is drawn, so dropping the ground truth
    leaves n without looking it up. ``draw`` is :func:`draw_positions` or :func:`draw_subsets`.
    """
    # Rows with the same id share their draws. Spread before the rows multiply: with a broadcast universe
    # the lookup then needs no other exchange. A large universe is not broadcast.
    ids = spread(queries.select(id_col).distinct(), id_col)
    drawn = draw(ids, id_col, _size(universe), n + 1, seed)
    found = (
        drawn.join(bounded_broadcast(universe), "idx")
        .groupBy(id_col)
        .agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct("_k", "path"))), lambda c: c["path"]
            ).alias("_paths"),  # n + 1 entries at most
        )
    )
    negatives = _drop_truth(F.coalesce(F.col("_paths"), F.array().cast("array<string>")), F.col(truth), n)
    return queries.join(found, id_col, "left").withColumn("negatives", negatives).drop("_paths")


def subset_negatives(queries: DataFrame, universe: DataFrame, n: int, *args, **options) -> DataFrame:
    """:func:`uniform_negatives` of which every set of ``n`` images is equally likely."""
    return uniform_negatives(queries, universe, n, *args, draw=draw_subsets, **options)


def pool_heads(universe: DataFrame, n: int, num_pools: int = NUM_POOLS, seed: int = SEED) -> DataFrame:
    """Per pool, the first ``n + 1`` images of its own shuffle, as one array.

    The rank limit is applied before the exchange, so only n + 1 rows per task and pool are moved.
    """
    pools = universe.select("path", F.explode(F.sequence(F.lit(0), F.lit(num_pools - 1))).alias("pool"))
    order = Window.partitionBy("pool").orderBy("_h", "path")
    heads = (
        pools.withColumn("_h", hash_hex("pool", "path", seed=f"pool{seed}"))
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= n + 1)
    )
    return heads.groupBy("pool").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("_rank", "path"))), lambda c: c["path"]
        ).alias("_head")
    )


def pooled_negatives(
    queries: DataFrame,
    universe: DataFrame,
    n: int,
    id_col: str = "style_id",
    truth: str = "default_image",
    num_pools: int = NUM_POOLS,
    seed: int = SEED,
) -> DataFrame:
    """The first ``n`` images of a randomly chosen shuffled pool, ground truth left out.

    A pool is a permutation of the universe, so when its head is too short the head already is the whole universe and joining pools adds nothing.
    The heads (pools x (n + 1) paths) are the only thing broadcast.
    """
    chosen = queries.withColumn("pool", F.pmod(hash_long(id_col, seed=f"pick{seed}"), F.lit(num_pools)).cast("int"))
    heads = F.broadcast(pool_heads(universe, n, num_pools, seed))
    picked = chosen.join(heads, "pool", "left")
    head = F.coalesce(F.col("_head"), F.array().cast("array<string>"))
    return picked.withColumn("negatives", _drop_truth(head, F.col(truth), n)).drop("pool", "_head")


def rolling_negatives(
    queries: DataFrame,
    universe: DataFrame,
    n: int,
    id_col: str = "style_id",
    truth: str = "default_image",
    split: str = "split",
    split_order: tuple[str, ...] = ("val", "test"),
    seed: int = SEED,
) -> DataFrame:
    """Consecutive windows of ``n + 10`` images of one shuffled universe, shared by all splits in order.

    The cursor that wraps to the start before a window would reach the end visits window
    ``r mod m`` at query r, with m = max(1, ceil(U / W) - 1).
    """
    width = n + WINDOW_MARGIN
    windows = (
        universe.withColumn("_window", F.expr(f"idx div {width}"))
        .groupBy("_window")
        .agg(
            F.transform(F.sort_array(F.collect_list(F.struct("idx", "path"))), lambda c: c["path"])
            .alias("_paths")  # one window: width entries
        )
    )
    place = F.lit(len(split_order))
    for i, name in enumerate(split_order):
        place = F.when(F.col(split) == name, F.lit(i)).otherwise(place)
    # Descriptions stay out of the shuffles until the last join; rows with the same id share a window.
    slim = queries.groupBy(id_col).agg(F.min(place).alias("_place"))
    ranked = hash_index(slim, [id_col], ["_place"], seed=f"roll{seed}", out="_r")
    earlier = Window.partitionBy(F.lit(0)).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        slim.groupBy("_place")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_place", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    # One row per split name.
    placed = ranked.join(F.broadcast(starts), "_place").withColumn("_size", _size(universe))
    m = F.greatest(F.lit(1), F.expr(f"(_size + {width - 1}) div {width}") - 1)
    found = (
        placed.withColumn("_window", F.pmod(F.col("_r") + F.col("_start"), m))
        .join(bounded_broadcast(windows, counted=universe), "_window")
        .select(id_col, "_paths")
    )
    paths = F.coalesce(F.col("_paths"), F.array().cast("array<string>"))
    return (
        queries.join(found, id_col, "left")
        .withColumn("negatives", _drop_truth(paths, F.col(truth), n))
        .drop("_paths")
    )


def candidate_lists(
    df: DataFrame, id_col: str = "style_id", truth: str = "default_image", seed: int = SEED
) -> DataFrame:
    """Ground truth and negatives in hash order, and the zero-based place of the ground truth."""
    paths = F.concat(F.array(F.col(truth)), F.col("negatives"))
    shuffled = F.sort_array(
        F.transform(
            paths,
            lambda p: F.struct(hash_hex(F.col(id_col), p, seed=f"shuffle{seed}").alias("h"), p.alias("path")),
        )
    )
    return (
        df.withColumn("_paths", F.transform(shuffled, lambda c: c["path"]))
        .withColumn(
            "candidate_targets",
            F.transform("_paths", lambda p: F.struct(F.lit("image").alias("type"), p.alias("path"))),
        )
        .withColumn("ground_truth_index", (F.array_position("_paths", F.col(truth)) - 1).cast("int"))
        .drop("_paths", "negatives")
    )


SAMPLERS = {"uniform": uniform_negatives, "subset": subset_negatives, "pooled": pooled_negatives, "rolling": rolling_negatives}


def mine_candidates(
    queries: DataFrame, universe: DataFrame, num_candidates: int = NUM_CANDIDATES,
    sampler: str = "uniform", seed: int = SEED, **options,
) -> DataFrame:
    sampled = SAMPLERS[sampler](queries, universe, num_candidates - 1, seed=seed, **options)
    return candidate_lists(sampled, seed=seed)


def eval_records(df: DataFrame, strict: bool = True, keep: list[str] | None = None) -> DataFrame:
    style_id = strict_long("style_id") if strict else F.col("style_id").cast("long")
    return df.select(
        instruction_text("master_category").alias("instruction_text"),
        F.col("description").alias("query_text"),
        F.lit(None).cast("string").alias("query_image_path"),
        "candidate_targets",
        "ground_truth_index",
        F.lit(TASK_CATEGORY).alias("task_category"),
        style_id.alias("style_id"),
        *(keep or []),
    )


def audit_candidates(
    df: DataFrame, num_candidates: int, truth: str = "default_image", id_col: str = "style_id"
) -> DataFrame:
    """One row per broken rule and record, over all records; empty means well formed."""
    size = F.size("candidate_targets")
    at = F.col("ground_truth_index")
    in_range = (at >= 0) & (at < size)
    paths = F.transform("candidate_targets", lambda c: c["path"])
    found = F.when(in_range, F.get(paths, at))
    rules = F.array(
        F.when(size != num_candidates, F.lit("size")),
        F.when(~in_range, F.lit("index_range")),
        F.when(in_range & ~found.eqNullSafe(F.col(truth)), F.lit("wrong_truth")),
        F.when(F.size(F.array_distinct(paths)) != size, F.lit("duplicate_path")),
    )
    return df.select(id_col, F.explode(F.filter(rules, lambda r: r.isNotNull())).alias("violation"))


def audit_split_overlap(df: DataFrame, id_col: str = "style_id", split: str = "split") -> DataFrame:
    """Ids that occur in more than one split."""
    return (
        df.groupBy(id_col)
        .agg(F.min(split).alias("_a"), F.max(split).alias("_b"))
        .where("_a <> _b")
        .select(id_col, F.lit("split_overlap").alias("violation"))
    )
