"""Exact Jaccard join of word shingles with token-group matrices.

A document is the set of its distinct shingles; equal sets are one from the start. The steps:

1. *Meeting.* Two linked sets of n and m shingles differ in at most d(n) = n (100 - percent) / percent shingles. Shingles
   are dealt by hash into more parts than that, so one of the first d(n) + 1 parts that are not empty is equal in both:
   the hash of each is a key. The number of parts follows the size in steps of 1.5; a set takes part in every step that a
   partner may be at. A set with too few filled parts also gives its empty ones. No link is lost, and sets that share
   less than whole parts of some four shingles never meet. Sets that share a key are tied to its smallest one, its head,
   in a batch before the shuffle and per key after it; linked sets have a head in common.
2. *Families.* Sets tied by several keys form families of mostly similar sets; a set also visits the families of its
   other heads, so that linked sets meet in one.
3. *Matrices.* In a family, sets with one closest head are a group. The groups of a block are a matrix of shingles by
   groups, each group being the union of its members' shingles. A set can only link into a group that holds ``percent``
   of its shingles; only such groups are opened and their members compared, and only where they are not connected yet.
4. *Large families* are first compared with the closest heads, which connects most copies at once, however many there
   are. Then they are cut by size and by what is connected into blocks, and pairs of blocks are compared as above; blocks
   of the largest connected part are never compared with each other.

Pairs are not emitted: comparisons leave the links of a spanning forest.
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
PERCENT = 85
GROUP_SETS = 64
BLOCK_SETS = 1024
BLOCK_SHINGLES = 500_000
STRONG = 4  # keys in common that tie two sets into one family
_BATCH_KEYS = 200_000


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles, A-Z lowered; a shorter text is one shingle."""
    data, starts, ends = bounds(b" ".join((text or b"").translate(TO_LOWER).split()))
    return np.unique(window_hashes(data, starts, ends, min(size, max(1, len(starts)))))


def _name(found: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set."""
    halves = (mix(found), mix(found ^ np.uint64(0x5851F42D4C957F2D)))
    return tuple(int(h.sum(dtype=np.uint64).view(np.int64)) for h in halves)


def _allowed(n: int, percent: int) -> int:
    """How many shingles a set of ``n`` and any partner may differ in."""
    return n * (100 - percent) // percent


def _steps(most: int) -> list[int]:
    found = [2]
    while found[-1] < most:
        found.append(-(-found[-1] * 3 // 2))
    return found


_STEPS = _steps(1 << 40)


def _step(n: int, percent: int) -> int:
    """The step of a set: its number of parts leaves room for some empty ones."""
    need = _allowed(n, percent) + 1
    return int(np.searchsorted(_STEPS, need + need // 8 + 1))


def part_keys(found: np.ndarray, percent: int) -> np.ndarray:
    """Keys of which two linked, different sets share one. Sets that can only link to equal ones have none."""
    n = len(found)
    need = _allowed(n, percent) + 1
    if need < 2:
        return np.empty(0, np.uint64)
    mixed, keys = mix(found), []
    for step in range(_step(n, percent), _step(n * 100 // percent, percent) + 1):
        parts = np.uint64(_STEPS[step])
        place = ((found >> np.uint64(32)) * parts) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        sums = np.add.reduceat(mixed, first)
        label = np.uint64(step << 48)
        keys.append(mix(sums[:need] ^ mix(place[first[:need]] ^ label)))
        if len(first) < need:
            empty = np.setdiff1d(np.arange(_STEPS[step], dtype=np.uint64), place[first])
            keys.append(mix(empty ^ label ^ np.uint64(1 << 47)))
    return np.concatenate(keys)


_SIGNED = "doc_id long, n_shingles long, p1 long, p2 long, key long, head long"


def _signed_rows(size: int, percent: int):
    """Documents (``doc_id, n_shingles, p1, p2``), keys (``key, p1``), each once per batch, and ties of sets that share a key
    within a batch (``p1, key, head``)."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_shingles", "p1", "p2", "key", "head")])

    def batch(*columns) -> pa.RecordBatch:
        n = next(len(c) for c in columns if c is not None)
        arrays = [pa.nulls(n, pa.int64()) if c is None else pa.array(c, pa.int64()) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def combined(keys: list[np.ndarray], names: list[int]) -> Iterator[pa.RecordBatch]:
        key = np.concatenate(keys).view(np.int64)
        name = np.repeat(np.array(names, np.int64), [len(k) for k in keys])
        order = np.lexsort((name, key))
        key, name = key[order], name[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        yield batch(None, None, name[first], None, key[first], None)
        head = np.repeat(name[first], np.diff(np.append(first, len(key))))
        tied = name != head
        if tied.any():
            yield batch(None, None, name[tied], None, key[tied], head[tied])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, keys, names, n = Sink(schema), [], [], 0
        for doc, text in rows(batches, "doc_id", "text"):
            found = shingle_set(text, size)
            p1, p2 = _name(found) if len(found) else (None, None)
            sink.add(doc, len(found), p1, p2, None, None)
            if sink.full():
                yield from sink.flush()
            if doc is not None and len(found):
                own = part_keys(found, percent)
                keys.append(own)
                names.append(p1)
                n += len(own)
                if n >= _BATCH_KEYS:
                    yield from combined(keys, names)
                    keys, names, n = [], [], 0
        if n:
            yield from combined(keys, names)
        yield from sink.flush()

    return run


def _tie_rows():
    """Rows sorted by key to the ties of its sets with the smallest one."""
    schema = pa.schema([("key", pa.int64()), ("p1", pa.int64()), ("head", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            key, name = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("key", "p1"))
            if not len(key):
                continue
            first = np.concatenate([[True], key[1:] != key[:-1]])
            if last is not None and key[0] == last[0]:
                first[0] = False
            heads = np.maximum.accumulate(np.where(first, np.arange(len(key)), -1))
            head = np.where(heads >= 0, name[heads], last[1] if last is not None else 0)
            last = (key[-1], head[-1])
            tied = head != name
            if tied.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[tied]) for x in (key, name, head)], schema=schema)

    return run


def _shipped_rows(size: int, schema: pa.Schema):
    """Rows of a text's assignments, one after the other, to the same rows with the set in place of the text. Rows that share
    an id may hold other sets; these are left out."""
    names = [f.name for f in schema if f.name != "shingles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, last, found, own = Sink(schema), None, None, None
        for p1, p2, text, *rest in rows(batches, "p1", "p2", "text", *names):
            if text is not last:
                last, found = text, shingle_set(text, size)
                own = _name(found) if len(found) else None
            if own == (p1, p2):
                sink.add(*rest, found.tobytes(), size=8 * len(found) + 64)
            if sink.full():
                yield from sink.flush()
        yield from sink.flush()

    return run


def _shipped(assigned: DataFrame, text: DataFrame, size: int) -> DataFrame:
    """``assigned(doc_id, p1, p2, ...)`` with ``shingles`` in place of these three. Texts are read once and their sets leave
    once per assignment."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    kept = [(c, t) for c, t in assigned.dtypes if c not in ("doc_id", "p1", "p2")]
    schema = pa.schema([(c, kinds[t]) for c, t in kept] + [("shingles", pa.binary())])
    types = ", ".join([f"{c} {t}" for c, t in kept] + ["shingles binary"])
    return text.join(assigned, "doc_id").mapInArrow(_shipped_rows(size, schema), types)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    shared = _common(a, b)
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _first_rows(percent: int):
    """Rows sorted by task, the head of the task's group before its members, to the links with the head."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, task, heads = Sink(schema), None, []
        for own, head, member, node, shingles in rows(batches, "task", "head", "member", "node", "shingles"):
            found = np.frombuffer(shingles, np.uint64)
            if (own, head) != task:
                task, heads = (own, head), []
            if not member:
                heads.append((node, found))
                continue
            for other, theirs in heads:
                if node != other and _linked(found, theirs, percent):
                    sink.add(node, other)
            if sink.full():
                yield from sink.flush()
        yield from sink.flush()

    return run


class Matrix:
    """Shingles by groups: for every shingle, the groups whose union holds it."""

    def __init__(self, groups: list[list[np.ndarray]]):
        unions = [np.unique(np.concatenate(g)) for g in groups]
        shingle = np.concatenate(unions)
        group = np.repeat(np.arange(len(unions)), [len(u) for u in unions])
        order = np.argsort(shingle, kind="stable")
        self._group, sorted_ = group[order], shingle[order]
        first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        self._shingles, self._from, self._to = sorted_[first], first, np.append(first[1:], len(sorted_))
        self.groups = len(groups)

    def overlaps(self, queries: list[np.ndarray]) -> Iterator[np.ndarray]:
        """Per query, how many of its shingles each group's union holds."""
        for found in queries:
            at = np.searchsorted(self._shingles, found)
            at[at == len(self._shingles)] = 0
            at = at[self._shingles[at] == found]
            start, width = self._from[at], self._to[at] - self._from[at]
            places = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width - start, width)
            yield np.bincount(self._group[places], minlength=self.groups)


def _root(parent: dict[int, int], x: int) -> int:
    while parent.setdefault(x, x) != x:
        parent[x] = x = parent[parent[x]]
    return x


def matrix_links(left: list[tuple], right: list[tuple], percent: int, group_sets: int = GROUP_SETS, seen: list | None = None) -> Iterator[tuple[int, int]]:
    """Links that connect what is not connected yet, between two blocks or, without a second, inside the first. Sets are
    ``(group, node, part, shingles)``; ``part`` names what is connected already. ``seen`` counts the comparisons."""
    left = sorted(left, key=lambda s: s[:2])
    groups: list[list[tuple]] = []
    for one in left:
        if not groups or groups[-1][0][0] != one[0] or len(groups[-1]) == group_sets:
            groups.append([])
        groups[-1].append(one)
    parent: dict[int, int] = {}
    matrix = Matrix([[s[3] for s in g] for g in groups])
    queries = right or left
    for (_, node, part, found), overlap in zip(queries, matrix.overlaps([q[3] for q in queries])):
        for g in np.flatnonzero(100 * overlap >= percent * len(found)).tolist():
            for _, other, its_part, theirs in groups[g]:
                a, b = _root(parent, part), _root(parent, its_part)
                if a != b:
                    if seen is not None:
                        seen.append((node, other))
                    if _linked(found, theirs, percent):
                        parent[a] = b
                        yield node, other


def _block_rows(percent: int, group_sets: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, task, sides = Sink(schema), None, ([], [])

        def close():
            if sides[0] and (task[1] or sides[1]):
                for link in matrix_links(sides[0], sides[1], percent, group_sets):
                    sink.add(*link)

        for own, alone, side, group, node, part, shingles in rows(batches, "task", "alone", "side", "grp", "node", "part", "shingles"):
            if task != (own, alone):
                if task:
                    close()
                    if sink.full():
                        yield from sink.flush()
                task, sides = (own, alone), ([], [])
            sides[side].append((group, node, part, np.frombuffer(shingles, np.uint64)))
        if task:
            close()
        yield from sink.flush()

    return run


def _block_tasks(members: DataFrame, block_sets: int, block_shingles: int) -> DataFrame:
    """``(task, alone, side, node, ...)``: which set goes to which comparison of blocks.

    Sets of a cluster are cut into bands of size, a factor of 1.18 wide, so that links join a band with itself or the next. In a band,
    a connected part that fills a block has blocks of its own; the others share blocks. A comparison with two blocks of
    one connected part, or two of the cluster's largest part, is left out."""
    bands = members.withColumn("band", F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(1.18))).cast("int"))
    need = F.greatest(F.count(F.lit(1)) / block_sets, F.sum("n_shingles") / block_shingles)
    filled = written(bands.groupBy("cluster", "band", "part").agg(need.alias("need")), "group_parts")
    alone = filled.where("need > 1").select("cluster", "band", "part", F.ceil("need").cast("int").alias("cuts"))
    shared = filled.where("need <= 1").groupBy("cluster", "band").agg(F.ceil(F.sum("need")).cast("int").alias("bins"))
    placed = bands.join(alone, ["cluster", "band", "part"], "left").join(shared, ["cluster", "band"], "left")
    own = F.col("cuts").isNotNull()
    cut = F.when(own, F.pmod(F.xxhash64("node"), F.col("cuts").cast("long"))).otherwise(F.pmod(F.xxhash64("part"), F.col("bins").cast("long")))
    placed = placed.withColumn("block", F.xxhash64("cluster", "band", F.when(own, F.col("part")), own, cut)).drop("cuts", "bins")
    largest = members.groupBy("cluster", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("cluster").agg(F.max(F.struct("n", "part"))["part"].alias("main"))
    blocks = placed.groupBy("cluster", "band", "block").agg(F.min("part").alias("low"), F.max("part").alias("high")).join(largest, "cluster")
    pure = F.when(F.col("low") == F.col("high"), F.col("low"))
    blocks = written(blocks.select("cluster", "band", "block", pure.alias("pure"), (F.coalesce(pure == F.col("main"), F.lit(False))).alias("is_main")), "group_blocks")
    # comparisons start at a block outside the largest part, or inside a mixed block
    near = blocks.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    near = near.select("cluster", "band", F.col("block").alias("other"), F.col("pure").alias("other_pure"), F.col("is_main").alias("other_main"))
    pairs = blocks.where(~F.col("is_main")).join(near, ["cluster", "band"]).where(
        (F.col("other_main") | (F.col("block") <= F.col("other"))) & ~F.coalesce(F.col("pure") == F.col("other_pure"), F.lit(False))
    )
    pairs = pairs.select(F.xxhash64("block", "other").alias("task"), "block", "other", (F.col("block") == F.col("other")).alias("alone"))
    sides = pairs.select("task", "alone", F.lit(0).alias("side"), "block").unionByName(
        pairs.where(~F.col("alone")).select("task", "alone", F.lit(1).alias("side"), F.col("other").alias("block"))
    )
    return placed.join(written(sides, "group_tasks"), "block").select("task", "alone", "side", "grp", "node", "part", "p1", "p2", "doc_id")


_SET = ["doc_id", "p1", "p2"]


def _first_links(asking: DataFrame, members: DataFrame, text: DataFrame, size: int, percent: int, block_sets: int) -> DataFrame:
    """Links of sets with the head of their group; the sets of a crowded head are cut into several tasks."""
    asking = asking.where("p1 <> grp")
    crowd = asking.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / block_sets).cast("int").alias("cuts"))
    crowd = written(crowd.withColumnRenamed("grp", "head"), "group_heads")
    part = F.pmod(F.xxhash64("node"), F.col("cuts").cast("long")).cast("int")
    asking = asking.join(crowd, asking["grp"] == crowd["head"]).select("head", part.alias("task"), F.lit(True).alias("member"), "node", *_SET)
    heads = members.withColumn("node", F.col("doc_id")).join(crowd, members["p1"] == crowd["head"]).select(
        "head", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("task"), F.lit(False).alias("member"), "node", *_SET)
    shipped = _shipped(written(asking.unionByName(heads), "group_asking"), text, size)
    sorted_ = shipped.repartition("head", "task").sortWithinPartitions("head", "task", "member")
    return sorted_.mapInArrow(_first_rows(percent), "a long, b long")


def similar_sets(
    docs: DataFrame,
    size: int = SHINGLE,
    percent: int = PERCENT,
    group_sets: int = GROUP_SETS,
    block_sets: int = BLOCK_SETS,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of ``docs(doc_id, text, ...)``, one row per input row.

    Documents link if their sets of ``size``-word shingles have 100 * common >= ``percent`` * united. A component is what
    links connect, named by its smallest id. Null and empty texts have an empty set and link with nothing. Rows that
    share an id are one document, each set of which can link; a row without id has no component of its own (null) and links
    with nothing. Other columns are ignored. The last three parameters steer the work, not the result.
    """
    if not 84 < percent < 100:
        raise ValueError("percent must be at least 85 and less than 100")
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    signed = written(text.mapInArrow(_signed_rows(size, percent), _SIGNED), "group_signatures")
    documents = signed.where("n_shingles is not null").select("doc_id", "n_shingles", "p1", "p2")
    usable = documents.where("doc_id is not null and n_shingles > 0")

    keys = signed.where("key is not null and head is null").select("key", "p1").repartition("key").sortWithinPartitions("key", "p1")
    met = written(keys.mapInArrow(_tie_rows(), "key long, p1 long, head long"), "group_met")
    # ties of a batch lead to its own smallest set, which may have met a smaller one
    first = met.groupBy("key").agg(F.min("head").alias("first"))
    within = signed.where("head is not null").select("key", "p1", "head").join(first, "key", "left")
    ties = met.select("p1", "head").unionByName(within.select("p1", F.coalesce("first", "head").alias("head")))
    ties = written(ties.groupBy("p1", "head").agg(F.count(F.lit(1)).alias("shared")), "group_ties")
    # one row per distinct set that met another: its smallest document stands for it
    sets = usable.groupBy("p1", "p2", "n_shingles").agg(F.min("doc_id").alias("doc_id"))
    copies = usable.join(sets.withColumnRenamed("doc_id", "rep"), ["p1", "p2", "n_shingles"]).where("doc_id <> rep")
    copies = copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    met_once = ties.select("p1").unionByName(ties.select(F.col("head").alias("p1"))).distinct()
    closest = ties.groupBy("p1").agg(F.max(F.struct("shared", F.col("head").alias("head")))["head"].alias("head"))
    members = sets.join(met_once, "p1").join(closest, "p1", "left").withColumn("grp", F.coalesce("head", "p1")).drop("head")
    members = written(members, "group_members")

    # families, with the visitors that share a key with one of their heads
    strong = connected_components(ties.where(F.col("shared") >= STRONG), "p1", "head")
    family = met_once.join(strong.withColumnRenamed("node", "p1"), "p1", "left").select("p1", F.coalesce("component", "p1").alias("cluster"))
    family = written(family, "group_families")
    visits = ties.select("p1", "head").join(family.select(F.col("p1").alias("head"), "cluster"), "head").select("p1", "cluster")
    placed = written(family.unionByName(visits).distinct().join(members, "p1"), "group_placed")
    sizes = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size")).where("n > 1")
    sizes = written(sizes.select("cluster", ((F.col("n") > block_sets) | (F.col("size") > block_shingles)).alias("large")), "group_sizes")
    placed = placed.withColumn("node", F.col("doc_id")).join(sizes, "cluster")
    tasks = placed.where(~F.col("large")).select(
        F.xxhash64("cluster").alias("task"), F.lit(True).alias("alone"), F.lit(0).alias("side"), "grp", "node", F.col("doc_id").alias("part"), *_SET)
    links = copies
    if not sizes.where("large").isEmpty():
        large = placed.where("large")
        links = written(_first_links(large.select("grp", "node", *_SET).distinct(), members, text, size, percent, block_sets).unionByName(copies), "group_links")
        parts = connected_components(links, "a", "b").withColumnRenamed("node", "doc_id")
        large = written(large.join(parts, "doc_id", "left").withColumn("part", F.coalesce("component", "doc_id")).drop("component"), "group_large")
        open_ = large.groupBy("cluster").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
        tasks = tasks.unionByName(_block_tasks(large.join(open_.select("cluster"), "cluster"), block_sets, block_shingles))
    shipped = _shipped(written(tasks, "group_assigned"), text, size)
    more = shipped.repartition("task").sortWithinPartitions("task", "alone").mapInArrow(_block_rows(percent, group_sets), "a long, b long")
    every = written(links.unionByName(more), "group_all_links")
    named = connected_components(every, "a", "b").withColumnRenamed("node", "doc_id")
    return documents.select("doc_id", "n_shingles").join(named, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
