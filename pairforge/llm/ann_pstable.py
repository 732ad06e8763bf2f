"""Nearest neighbours by p-stable hashing with multiple probes.

A table hashes a vector x to floor((a . x + b) / w) for each of a few Gaussian directions a. A query visits, per table,
the buckets around its own in the order of the estimated probability that a neighbour at the typical distance fell
into them, until these add up to the wanted success. Candidates of all tables are ranked by exact distance.

The typical distance only starts the search. A query whose k-th distance found is larger probes on, until the wanted
success holds for that distance; one that found fewer than k rows, or would have to probe so much that comparing it
with every entry is no dearer, is compared with every entry.

Width and typical distance are fitted on a bounded sample; every row is indexed. Equal vectors are one entry with their
smallest ids, which is all that a result can hold of them. A bucket's vectors and the queries that probe it meet in one
task and only its best candidates leave it, so no candidate pairs are moved; buckets above ``CHUNK`` vectors are cut.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.llm.words import Sink, mix, rows
from pairforge.session import written

K = 10
TABLES = 2
SUCCESS = 0.95  # wanted probability that a neighbour at the typical distance is visited
SAMPLE = 4_000  # vectors that the width and the distance are fitted on
CHUNK = 2_000  # vectors of a bucket in one task
REACH = 4  # buckets to either side that a probe may go
MAX_PROBES = 20_000  # per table and query
SCAN_RATE = 200  # vectors that are compared in about the time that one probe takes to be moved
SCAN_CHUNK = 50_000  # vectors that a task of a scan holds


@dataclass
class Hashing:
    directions: np.ndarray  # tables x dimensions x hashes
    shifts: np.ndarray  # tables x hashes
    width: float
    distance: float
    factors: np.ndarray
    success: float

    def places(self, vectors: np.ndarray, table: int) -> np.ndarray:
        return (vectors @ self.directions[table] + self.shifts[table]) / self.width

    def keys(self, cells: np.ndarray, table: int) -> np.ndarray:
        """Bucket number of whole cells; two buckets that share a number are searched together."""
        code = mix(cells.astype(np.int64).view(np.uint64) * self.factors)
        return mix(code.sum(axis=-1, dtype=np.uint64) + np.uint64(table)).view(np.int64)

    def probes(self, place: np.ndarray) -> np.ndarray:
        """Cells in the order of estimated success, until they reach the wanted success of one table."""
        return self.walk(place, self.distance, MAX_PROBES)[0]

    def walk(self, place: np.ndarray, distance: float, most: int) -> tuple[np.ndarray, bool]:
        """At most ``most`` cells for a neighbour at ``distance``, and whether they reach the wanted success."""
        wanted = 1 - (1 - self.success) ** (1 / len(self.shifts))
        cell = np.floor(place)
        steps = np.arange(-REACH, REACH + 1)
        edge = (cell[:, None] + steps - place[:, None]) * self.width / distance
        chance = _normal(edge + self.width / distance) - _normal(edge)
        order = np.argsort(-chance, axis=1, kind="stable")
        ranked = np.take_along_axis(chance, order, 1)
        start = (0,) * len(cell)
        queue, seen, out, total = [(-ranked[:, 0].prod(), start)], {start}, [], 0.0
        while queue and total < wanted and len(out) < most:
            gain, at = heapq.heappop(queue)
            out.append(at)
            total -= gain
            for j, r in enumerate(at):
                if r + 1 < len(steps) and ranked[j, r] > 0:
                    further = at[:j] + (r + 1,) + at[j + 1 :]
                    if further not in seen:
                        seen.add(further)
                        heapq.heappush(queue, (gain * ranked[j, r + 1] / ranked[j, r], further))
        ranks = np.array(out)
        return cell + np.stack([steps[order[j]][ranks[:, j]] for j in range(len(cell))], axis=1), total >= wanted


def _normal(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.vectorize(math.erf)(x / math.sqrt(2)))


def usable(embedding: Column, dimensions: int | None = None) -> Column:
    """Neither null, empty nor zero, every component finite, and of the given length."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    right = F.size(embedding) == dimensions if dimensions else F.size(embedding) > 0
    return F.coalesce(embedding.isNotNull() & right & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def fit(entries: DataFrame, n: int, k: int, tables: int, success: float, seed: int) -> Hashing:
    """Hash functions for ``n`` entries from at most ``SAMPLE`` of them, chosen by hash.

    More entries get more hashes per table. The typical distance is that of the k-th of n neighbours, read off the
    distances inside the sample; a sample too small for that quantile gives its smallest distance, which is larger."""
    chosen = entries.orderBy(F.xxhash64(F.lit(seed), "h1", "h2"), "h1", "h2").limit(SAMPLE).select("vector").collect()
    vectors = np.array([np.frombuffer(r["vector"]) for r in chosen])
    dimensions = vectors.shape[1]
    hashes = max(4, math.ceil(math.log2(max(2, n)) / 4))
    some = vectors[:200]
    squares = (some**2).sum(1)[:, None] + (vectors**2).sum(1)[None, :] - 2 * some @ vectors.T
    apart = np.sqrt(np.maximum(squares, 0))
    apart.sort(axis=1)
    rank = max(1, round(k / n * len(vectors)))
    distance = float(np.median(apart[:, min(rank, apart.shape[1] - 1)]))
    spread = float(np.sqrt((apart**2).mean() / 2)) or 1.0
    rng = np.random.default_rng(seed)
    width = 1.5 * spread
    return Hashing(
        rng.standard_normal((tables, dimensions, hashes)), rng.uniform(0, width, (tables, hashes)), width,
        max(distance, 1e-3 * spread), rng.integers(1, 1 << 62, hashes).astype(np.uint64) * np.uint64(2) + np.uint64(1), success,
    )


_INDEX_ROWS = pa.schema([("bucket", pa.int64()), ("rep", pa.int64()), ("ids", pa.list_(pa.int64())), ("vector", pa.binary())])
_PROBE_ROWS = pa.schema([("bucket", pa.int64()), ("rep", pa.int64()), ("vector", pa.binary())])


def _index_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            packed = batch.column("vector")
            vectors = np.array([np.frombuffer(v) for v in packed.to_pylist()])
            for table in range(len(hashing.shifts)):
                keys = hashing.keys(np.floor(hashing.places(vectors, table)), table)
                ids = batch.column("ids").cast(_INDEX_ROWS.field("ids").type)
                yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("rep"), ids, packed], schema=_INDEX_ROWS)

    return run


def _probe_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing, sink = shared.value, Sink(_PROBE_ROWS)
        for rep, packed in rows(batches, "rep", "vector"):
            vector = np.frombuffer(packed)
            for table in range(len(hashing.shifts)):
                place = hashing.places(vector[None, :], table)[0]
                for key in hashing.keys(hashing.probes(place), table).tolist():
                    sink.add(key, rep, packed, size=len(packed) + 32)
                    if sink.full():
                        yield from sink.flush()
        yield from sink.flush()

    return run


def _further_rows(shared, most: int):
    """What a query still has to visit for the distance ``reach``: further buckets, or every entry (``scan``)."""
    schema = pa.schema([("rep", pa.int64()), ("vector", pa.binary()), ("buckets", pa.list_(pa.int64())), ("scan", pa.bool_())])

    def further(hashing: Hashing, vector: np.ndarray, reach: float | None) -> list[int] | None:
        out: list[int] = []
        for table in range(len(hashing.shifts)) if reach is not None else ():
            place = hashing.places(vector[None, :], table)[0]
            visited = set(hashing.keys(hashing.probes(place), table).tolist())
            cells, reached = hashing.walk(place, reach, min(MAX_PROBES, most + len(visited)))
            out += [key for key in dict.fromkeys(hashing.keys(cells, table).tolist()) if key not in visited]
            if not reached or len(out) > most:
                return None
        return out if reach is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = Sink(schema)
        for rep, packed, reach in rows(batches, "rep", "vector", "reach"):
            buckets = further(shared.value, np.frombuffer(packed), reach)
            sink.add(rep, packed, buckets or [], buckets is None, size=len(packed) + 8 * len(buckets or ()) + 32)
            if sink.full():
                yield from sink.flush()
        yield from sink.flush()

    return run


def _rank_rows(best: int):
    """The ``best`` nearest ids of each probe in a chunk, each with its smallest distance there."""
    schema = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("distance", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, place, ids, vectors, table = Sink(schema), None, [], [], None
        for bucket, salt, is_probe, rep, own, packed in rows(batches, "bucket", "salt", "is_probe", "rep", "ids", "vector"):
            if (bucket, salt) != place:
                place, ids, vectors, table = (bucket, salt), [], [], None
            if not is_probe:  # the vectors of a chunk come before its probes
                ids.append(own)
                vectors.append(np.frombuffer(packed))
                continue
            if not ids:
                continue
            if table is None:
                table = np.array(vectors)
                every, entry = np.concatenate(ids), np.repeat(np.arange(len(ids)), [len(i) for i in ids])
                order = np.argsort(every, kind="stable")
                names, starts = np.unique(every[order], return_index=True)
                entry = entry[order]
            apart = np.minimum.reduceat(np.sqrt(((table - np.frombuffer(packed)) ** 2).sum(axis=1))[entry], starts)
            near = np.lexsort((names, apart))[:best] if len(apart) <= 4 * best else _best(apart, names, best)
            for i in near.tolist():
                sink.add(rep, int(names[i]), float(apart[i]))
            if sink.full():
                yield from sink.flush()
        yield from sink.flush()

    return run


def _best(apart: np.ndarray, names: np.ndarray, best: int) -> np.ndarray:
    inside = np.flatnonzero(apart <= np.partition(apart, best - 1)[best - 1])  # with all ties
    return inside[np.lexsort((names[inside], apart[inside]))[:best]]


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    tables: int = TABLES,
    success: float = SUCCESS,
    seed: int = 1,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of every usable query row, by Euclidean distance.

    ``vectors(vec_id, embedding, ...)`` are all candidates, ``queries(vec_id)`` names rows of it; a row is no candidate
    of its own query. Ties go to the smaller id. Unusable vectors (see ``usable``, with the commonest length as the
    right one) take no part, nor do rows without id. Repeated rows count once. An id with several vectors is searched
    for with each of them and found by each; its smallest distance counts. Other columns are ignored; an empty table gives no rows.
    """
    rows_ = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    sound = rows_.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    common = sound.groupBy(F.size("embedding").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    if common is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sound = sound.where(F.size("embedding") == common["size"])
    hashed = F.struct(F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(seed), "embedding").alias("h2"), "embedding")
    keyed = sound.select("vec_id", hashed.alias("v")).select("vec_id", "v.*").dropDuplicates(["vec_id", "h1", "h2"])

    # equal vectors: one entry with the k + 1 smallest ids
    order = Window.partitionBy("h1", "h2").orderBy("vec_id")
    few = keyed.withColumn("_rank", F.dense_rank().over(order)).where(F.col("_rank") <= k + 1)
    grouped = few.groupBy("h1", "h2").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"), F.min_by("embedding", "vec_id").alias("embedding"))
    entries = written(
        grouped.select("h1", "h2", F.monotonically_increasing_id().alias("rep"), "ids", "embedding").mapInArrow(
            _pack_rows(), "h1 long, h2 long, rep long, ids array<long>, vector binary"
        ),
        "ann_entries",
    )
    n = entries.count()
    shared = vectors.sparkSession.sparkContext.broadcast(fit(entries, n, k, tables, success, seed))

    wanted = queries.where("vec_id is not null").select("vec_id").distinct()
    asked = keyed.select("vec_id", "h1", "h2").join(wanted, "vec_id").join(entries.select("h1", "h2", "rep"), ["h1", "h2"])
    asked = written(asked.select(F.col("vec_id").alias("query_id"), "rep"), "ann_asked")
    index = entries.select("rep", "ids", "vector").mapInArrow(_index_rows(shared), "bucket long, rep long, ids array<long>, vector binary")
    probing = entries.select("rep", "vector").join(asked.select("rep").distinct(), "rep", "left_semi")
    spread = max(1, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    probes = probing.repartition(spread, "rep").mapInArrow(_probe_rows(shared), "bucket long, rep long, vector binary")

    large = written(
        index.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CHUNK).select("bucket", F.ceil(F.col("n") / CHUNK).alias("salts")),
        "ann_large",
    )
    first = written(_lists(_meet(index, probes, large, k), k), "ann_first")

    # where the typical distance was too small
    chunks = max(spread, -(-n // SCAN_CHUNK))
    reach = F.when(F.size("near") > k, F.element_at("near", k + 1)["score"])
    short = first.select(F.col("query").alias("rep"), reach.alias("reach")).where(F.col("reach").isNull() | (F.col("reach") > shared.value.distance))
    further = written(
        entries.select("rep", "vector").join(short, "rep").repartition(spread, "rep").mapInArrow(
            _further_rows(shared, chunks + n // SCAN_RATE), "rep long, vector binary, buckets array<long>, scan boolean"
        ),
        "ann_further",
    )
    more = further.where("not scan").select(F.explode("buckets").alias("bucket"), "rep", "vector")
    scans = further.where("scan").select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("bucket"), "rep", "vector")
    all_ = entries.select(F.pmod(F.xxhash64("rep"), F.lit(chunks)).alias("bucket"), "rep", "ids", "vector")
    found = first.select("query", F.explode("near").alias("x")).select("query", "x.vec_id", F.col("x.score").alias("distance"))
    if not further.where("not scan").isEmpty():
        found = found.unionByName(_meet(index, more, large, k))
    if not further.where("scan").isEmpty():
        found = found.unionByName(_meet(all_, scans, None, k))
    lists = _lists(found, k)

    # each list has at most k + 1 entries; an id with several vectors has as many lists
    near = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    answers = asked.join(lists, asked["rep"] == lists["query"]).select("query_id", F.explode(near).alias("x"))
    answers = answers.groupBy("query_id", "x.vec_id").agg(F.min("x.score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _meet(index: DataFrame, probes: DataFrame, large: DataFrame | None, k: int) -> DataFrame:
    """``(query, vec_id, distance)``: the nearest ids of every probe in its bucket; ``large`` cuts buckets."""
    salts = F.lit(1).cast("long")
    if large is not None:
        salts = F.coalesce("salts", salts)
        index, probes = index.join(large, "bucket", "left"), probes.join(large, "bucket", "left")
    placed = index.select("bucket", F.pmod(F.xxhash64("rep"), salts).alias("salt"), F.lit(False).alias("is_probe"), "rep", "ids", "vector")
    visits = probes.select(
        "bucket", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), F.lit(True).alias("is_probe"), "rep",
        F.lit(None).cast("array<long>").alias("ids"), "vector",
    )
    met = placed.unionByName(visits).repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "is_probe")
    return met.mapInArrow(_rank_rows(k + 1), "query long, vec_id long, distance double")


def _lists(found: DataFrame, k: int) -> DataFrame:
    """``(query, near)``: the k + 1 nearest ids of each query in order."""
    nearest_ = found.groupBy("query", "vec_id").agg(F.min("distance").alias("distance"))
    ranked = Window.partitionBy("query").orderBy("distance", "vec_id")
    best = nearest_.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= k + 1)
    return best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct(F.col("distance").alias("score"), "vec_id"))).alias("near"))


def _pack_rows():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.array(v, np.float64).tobytes() for v in batch.column("embedding").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(packed, pa.binary())], names=["h1", "h2", "rep", "ids", "vector"])

    return run
