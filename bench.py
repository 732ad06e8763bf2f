"""Headline timings as one JSON line.

``BENCH_SF_DIR`` names the tables (default /root/testdata/sf0.1), ``BENCH_CPUS`` the local cores. The
build queries run the whole chain, catalogue CSV -> clean -> split -> negatives -> written JSON lines and
manifest, and also report catalogue rows per second. Writing the CSV input is not timed. One small build
runs first, untimed, so that class loading is not measured.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pairforge.plans import build  # noqa: E402
from pairforge.plans import fixtures as X  # noqa: E402
from pairforge.plans.queries import QUERIES  # noqa: E402
from pairforge.session import build_session, scratch_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

READ_ONLY = (
    "d1_stratified_split", "d3_uniform_negatives", "d6_candidate_lists_pooled", "e2_interleave_all", "e5_batches",
    "e9_pad_batches", "e10_packed_positions", "d7_thin_groups", "f4_in_batch_loss", "f4_single_batch_tiled",
    "f7_routed_loss", "f8_ranking_accuracy", "c5_qrels", "c8_last_token_pooling", "g2_even_sampling",
    "g5_temporal_crop", "b12_multiple_choice", "b15_token_budget", "h1_connected_components", "a3_jsonl_scan",
    "a6_attach_images", "k1_batched_map", "j2_windowed_counts",
)


def products(spark, table: str):
    """A catalogue over one of the larger tables."""
    if table == "lineitem":
        rows = X.table(spark, SF_DIR, "lineitem")
        key = F.expr("((l_orderkey * 100003 + l_partkey) * 10007 + l_suppkey) * 8 + l_linenumber")  # unique
        text, image, kind = F.concat_ws(" ", "l_returnflag", "l_linestatus", "l_shipdate"), F.col("l_orderkey"), "l_returnflag"
    else:
        rows = X.table(spark, SF_DIR, "orders")
        key = F.col("o_orderkey")
        text, image, kind = F.concat_ws(" ", "o_orderpriority", "o_orderdate"), F.col("o_orderkey"), "o_orderpriority"
    return rows.select(
        key.alias("style_id"), text.alias("description"),
        F.concat(F.lit("img/"), image.cast("string"), F.lit(".jpg")).alias("default_image"),
        F.col(kind).alias("master_category"),
    )


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = build_session(
        "pairforge-bench", f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "12g", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="pairforge-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    csv, rows = {}, {}
    for table in ("orders", "lineitem"):
        csv[table] = scratch_path(spark, f"{table}-csv")
        frame = products(spark, table)
        rows[table] = frame.count()
        frame.repartition(int(CPUS)).write.option("header", True).csv(csv[table])

    def run_build(table, num, sampler):
        out = scratch_path(spark, "build")
        build.build_from_csv(spark, csv[table], out, num_candidates=num, sampler=sampler, multi_line=False).collect()

    warmup = timed(lambda: run_build("orders", 25, "rolling"))
    seconds, rates = {}, {}
    for table, num, sampler in (
        ("orders", 25, "uniform"), ("orders", 25, "pooled"), ("orders", 25, "rolling"), ("orders", 100, "uniform"),
        ("lineitem", 25, "uniform"), ("lineitem", 25, "rolling"),
    ):
        name = f"build_{table}_{sampler}_{num}"
        seconds[name] = timed(lambda: run_build(table, num, sampler))
        rates[name] = round(rows[table] / seconds[name])
    for name in READ_ONLY:
        seconds[name] = timed(lambda: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "total query time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "rows_per_sec": rates, "catalogue_rows": rows,
        "cpus": int(CPUS), "spark": spark.version, "warmup_sec": warmup,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
