"""Near-duplicate documents by MinHash with tensored banding.

A table key is a pair (a_i, b_j) from two small collections of ``side`` half keys, each of ``half`` minhashes. So
``2 * side * half`` minhashes give ``side ** 2`` tables with keys of ``2 * half`` minhashes, where separate bands would
need ``side ** 2 * 2 * half``. Two documents of similarity s meet with probability (1 - (1 - s^half)^side)^2.

Documents with the same shingle set are one from the start. Documents that meet in a table are tied to the table's
smallest one, and the components of these ties are the clusters in which links are looked for. Inside a cluster
every pair whose sizes allow a link is compared on its full shingle sets, in blocks of bounded size, so a cluster
of any size spreads over many tasks and only a spanning forest of its links leaves a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.words import TO_LOWER, Sink, bounds, mix, rows, window_hashes
from pairforge.operators.components import connected_components
from pairforge.session import written

SHINGLE = 4
HALF, SIDE = 2, 9
PERCENT = 80
BLOCK_DOCS = 512
BLOCK_SHINGLES = 200_000
_COLUMNS = 4096  # shingles of a block compared at a time


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; the whole sequence is one if it is shorter."""
    data, starts, ends = bounds(b" ".join((text or b"").translate(TO_LOWER).split()))
    return np.unique(window_hashes(data, starts, ends, min(size, max(1, len(starts)))))


def _half_keys(found: np.ndarray, seeds: np.ndarray, half: int) -> list[int]:
    """2 * side half keys: each combines the minima of ``half`` permutations."""
    least = np.empty(len(seeds), np.uint64)
    for i, (flip, factor) in enumerate(seeds):
        least[i] = ((found ^ flip) * factor).min()
    keys = np.zeros(len(seeds) // half, np.uint64)
    for column in least.reshape(-1, half).T:
        keys = mix(keys * np.uint64(31) + column)
    return keys.view(np.int64).tolist()


def _signature_rows(size: int, half: int, side: int, seed: int):
    seeds = np.random.default_rng(seed).integers(0, 1 << 63, (2 * side * half, 2)).astype(np.uint64)
    seeds[:, 1] = seeds[:, 1] * np.uint64(2) + np.uint64(1)
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = Sink(schema)
        for doc, text in rows(batches, "doc_id", "text"):
            found = shingles(text, size)
            if len(found):
                p1 = int(mix(found).sum(dtype=np.uint64).view(np.int64))
                p2 = int(mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64))
                sink.add(doc, len(found), p1, p2, _half_keys(found, seeds, half), size=64 + 16 * side)
            else:
                sink.add(doc, 0, None, None, None)
            if sink.full():
                yield from sink.flush()
        yield from sink.flush()

    return run


def _set_rows(size: int):
    schema = pa.schema([("doc_id", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = Sink(schema)
        for doc, text in rows(batches, "doc_id", "text"):
            found = shingles(text, size).tobytes()
            sink.add(doc, found, size=len(found) + 32)
            if sink.full():
                yield from sink.flush()
        yield from sink.flush()

    return run


def _linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs reach the similarity: intersections are counted by products of 0/1 matrices over the shingles
    that both sides have, a slice of them at a time."""
    sizes = [np.array([len(s) for s in side]) for side in (left, right)]
    common = np.intersect1d(np.concatenate(left), np.concatenate(right))
    both = np.zeros((len(left), len(right)))
    places = [[np.searchsorted(common, s[np.isin(s, common, assume_unique=True)]) for s in side] for side in (left, right)]
    for at in range(0, len(common), _COLUMNS):
        slices = []
        for side in places:
            table = np.zeros((len(side), min(_COLUMNS, len(common) - at)), np.float32)
            for i, p in enumerate(side):
                a, b = np.searchsorted(p, (at, at + _COLUMNS))
                table[i, p[a:b] - at] = 1
            slices.append(table)
        both += slices[0] @ slices[1].T
    shared = both.astype(np.int64)
    union = sizes[0][:, None] + sizes[1][None, :] - shared
    return 100 * shared >= percent * union


def _forest(ids: list[int], linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ties of every linked document to the smallest one it reaches inside the block. ``linked`` is symmetric."""
    label = np.array(ids)
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(1))
        if (least == label).all():
            break
        label = least
    for own, low in zip(ids, label.tolist()):
        if own != low:
            yield own, low


def _edges(left: list, right: list, percent: int) -> Iterator[tuple[int, int]]:
    if not left or (len(left) < 2 and not right):
        return
    ids, sets = [d for d, _ in left + right], [s for _, s in left]
    if right:
        cross = _linked(sets, [s for _, s in right], percent)
        n, m = cross.shape
        linked = np.zeros((n + m, n + m), bool)
        linked[:n, n:], linked[n:, :n] = cross, cross.T
    else:
        linked = _linked(sets, sets, percent)
    yield from _forest(ids, linked)


def _compare(percent: int):
    """Rows sorted by task, each of them a block pair or a small cluster, to the edges of its forest."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, task, sides = Sink(schema), None, ([], [])
        for key, side, doc, packed in rows(batches, "task", "side", "doc_id", "shingles"):
            if key != task:
                for edge in _edges(*sides, percent):
                    sink.add(*edge)
                task, sides = key, ([], [])
                if sink.full():
                    yield from sink.flush()
            sides[side].append((doc, np.frombuffer(packed, np.uint64)))
        for edge in _edges(*sides, percent):
            sink.add(*edge)
        yield from sink.flush()

    return run


def _block_rows(members: DataFrame, block_docs: int, block_shingles: int) -> DataFrame:
    """``(task, side, doc_id)``: which document goes to which comparison.

    A cluster that fits one block is one task. Larger ones are cut by size band, a factor of 1.26 wide, so that
    links only join a band with itself or the next, and each band by hash into parts; every pair of parts is a task.
    """
    bands = members.withColumn("band", F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(1.26))).cast("int"))
    parts = bands.groupBy("cluster", "band").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"))
    parts = parts.withColumn("parts", F.greatest(F.ceil(F.col("n") / block_docs), F.ceil(F.col("size") / block_shingles)).cast("int"))
    total = parts.groupBy("cluster").agg(F.sum("n").alias("all_n"), F.sum("size").alias("all_size"))
    table = written(
        parts.join(total, "cluster")
        .withColumn("small", (F.col("all_n") <= block_docs) & (F.col("all_size") <= block_shingles))
        .select("cluster", "band", "parts", "small"),
        "near_parts",
    )
    around = [
        table.select("cluster", (F.col("band") + shift).alias("band"), F.col("parts").alias(name))
        for shift, name in ((-1, "above"), (1, "below"))
    ]
    placed = (
        bands.join(table, ["cluster", "band"]).join(around[0], ["cluster", "band"], "left").join(around[1], ["cluster", "band"], "left")
        .withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts").cast("long")).cast("int"))
    )
    packed = placed.where("small").select(
        F.xxhash64("cluster").alias("task"), F.lit(0).alias("side"), "doc_id"
    )
    key = lambda lb, lp, rb, rp: F.xxhash64("cluster", lb, lp, rb, rp)
    band, part, i32 = F.col("band"), F.col("part"), lambda n: F.lit(n).cast("int")
    upto = lambda n: F.when(n > 0, F.sequence(i32(0), n - 1)).otherwise(F.array().cast("array<int>"))
    # own part against the later parts of its band (side 0 of them, side 1 of the earlier), and across bands
    later = F.transform(upto(F.col("parts")), lambda p: F.struct(
        key(band, F.least(part, p), band, F.greatest(part, p)).alias("task"), F.when(part <= p, 0).otherwise(1).alias("side")))
    above = F.transform(upto(F.coalesce("above", i32(0))), lambda p: F.struct(key(band, part, band + 1, p).alias("task"), F.lit(0).alias("side")))
    below = F.transform(upto(F.coalesce("below", i32(0))), lambda p: F.struct(key(band - 1, p, band, part).alias("task"), F.lit(1).alias("side")))
    spread = placed.where("not small").select(
        "doc_id", F.explode(F.concat(later, above, below)).alias("at")
    ).select("at.task", "at.side", "doc_id")
    return packed.unionByName(spread)


def near_components(
    docs: DataFrame,
    size: int = SHINGLE,
    percent: int = PERCENT,
    half: int = HALF,
    side: int = SIDE,
    seed: int = 8,
    block_docs: int = BLOCK_DOCS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of ``docs(doc_id, text, ...)``.

    Documents are linked if their sets of ``size``-word shingles have 100 * common >= ``percent`` * united; a component
    is named by its smallest id. One row per input row. Null and empty texts have an empty set and no link. Rows that
    share an id are one document to the rule (each set of it can link); a row without id keeps itself and links
    nothing. Other columns are ignored. ``percent`` must be at least 80 (the size bands rely on it).
    """
    if percent < 80:
        raise ValueError("percent must be at least 80")
    text = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    signed = written(
        text.mapInArrow(_signature_rows(size, half, side, seed), "doc_id long, n_shingles long, p1 long, p2 long, keys array<long>"),
        "near_signatures",
    )
    usable = signed.where("doc_id is not null and n_shingles > 0")
    same = ["p1", "p2", "n_shingles"]
    first = usable.groupBy(*same).agg(F.min("doc_id").alias("rep"))
    reps = usable.join(first, same).where("doc_id = rep").select("rep", "keys").dropDuplicates(["rep", "keys"])

    left = F.transform(F.slice("keys", 1, side), lambda k, i: F.struct(i.alias("i"), k.alias("k")))
    right = F.transform(F.slice("keys", side + 1, side), lambda k, i: F.struct(i.alias("i"), k.alias("k")))
    pairs = F.flatten(F.transform(left, lambda a: F.transform(right, lambda b: F.xxhash64(a, b))))
    tables = reps.select("rep", F.explode(pairs).alias("key"))
    heads = tables.groupBy("key").agg(F.min("rep").alias("head"), F.max("rep").alias("top")).where("head < top").select("key", "head")
    ties = written(tables.join(heads, "key").where("rep <> head").select("rep", "head").distinct(), "near_ties")
    clusters = written(connected_components(ties, "rep", "head"), "near_clusters")

    sizes = usable.select(F.col("doc_id").alias("node"), "n_shingles").join(clusters, "node")
    members = sizes.select(F.col("component").alias("cluster"), F.col("node").alias("doc_id"), "n_shingles").distinct()
    placed = _block_rows(members, block_docs, block_shingles)
    sets = text.join(clusters.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").mapInArrow(_set_rows(size), "doc_id long, shingles binary")
    links = (
        placed.join(written(sets, "near_sets"), "doc_id").repartition("task").sortWithinPartitions("task")
        .mapInArrow(_compare(percent), "a long, b long")
    )
    copies = usable.join(first, same).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = written(links.unionByName(copies), "near_links")
    named = connected_components(found, "a", "b").withColumnRenamed("node", "doc_id")
    return (
        signed.select("doc_id", "n_shingles").join(named, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
