"""Merkle manifest of a table in van Emde Boas layout.

Rows are leaves; per group they ascend by id and every ``ARITY`` consecutive nodes become one, until one is left: the
group's subroot. The subroots, in group order, likewise become the root.

A subtree of up to ``HEIGHT`` levels over aligned leaves is a *block*. It is built by one task and stored as one binary
of digests, in van Emde Boas order: a subtree is split at half its height, its top part comes first and then its bottom
parts one after the other, each laid out in the same way. Where a node lies is arithmetic on its level and index
(``VebLayout.address``), which serves construction and the retrieval of siblings alike. The roots of the blocks are the
leaves of the next round, so n leaves take log(n) / log(ARITY ** HEIGHT) rounds and no task sees more than one block.

Proofs come down the same way: the path of a block's root to the top is found once, in the block above, and every leaf of
the block extends it by its own siblings. Leaves are hashed in Spark expressions and only digests are moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.llm.words import Sink, rows
from pairforge.session import written

ARITY = 8
HEIGHT = 4  # levels of edges in a block: 4,096 leaves
DIGEST = 32  # bytes


def encoded(column: Column | str) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(columns: list[Column | str]) -> Column:
    """Lowercase hex sha256 of the encoded columns, one after the other."""
    return F.sha2(F.concat(*[encoded(c) for c in columns]), 256)


@cache
def _nodes(height: int, arity: int) -> int:
    return (arity ** (height + 1) - 1) // (arity - 1)


class VebLayout:
    """Addresses in a complete tree of ``height`` levels of edges, as if every leaf were there."""

    def __init__(self, height: int, arity: int = ARITY):
        self.height, self.arity, self.size = height, arity, _nodes(height, arity)

    def address(self, level: int, index: int) -> int:
        """Place of the ``index``-th node of a level; level 0 is the root."""
        height, at = self.height, 0
        while height:
            top = height // 2  # levels 0..top are the top part, the bottom parts hang below it
            if level <= top:
                height = top
                continue
            bottom = height - top - 1
            part, index = divmod(index, self.arity ** (level - top - 1))
            at += _nodes(top, self.arity) + part * _nodes(bottom, self.arity)
            height, level = bottom, level - top - 1
        return at

    def build(self, leaves: list[bytes]) -> bytearray:
        """All nodes over ``leaves``; places without a node stay zero."""
        store = bytearray(self.size * DIGEST)
        level, count = self.height, len(leaves)
        for i, leaf in enumerate(leaves):
            self._put(store, level, i, leaf)
        while level:
            for i in range(-(-count // self.arity)):
                run = (self.get(store, level, k) for k in range(i * self.arity, min(count, (i + 1) * self.arity)))
                self._put(store, level - 1, i, hashlib.sha256("".join(d.hex() for d in run).encode()).digest())
            level, count = level - 1, -(-count // self.arity)
        return store

    def _put(self, store: bytearray, level: int, index: int, digest: bytes) -> None:
        at = self.address(level, index) * DIGEST
        store[at : at + DIGEST] = digest

    def get(self, store: bytes, level: int, index: int) -> bytes:
        at = self.address(level, index) * DIGEST
        return bytes(store[at : at + DIGEST])

    def siblings(self, store: bytes, index: int, count: int) -> list[tuple[str, str]]:
        """Per level from leaf ``index`` of ``count`` upwards, the hex digests left and right of the path in its run."""
        found, level = [], self.height
        while level:
            first = index - index % self.arity
            run = [self.get(store, level, k).hex() for k in range(first, min(count, first + self.arity))]
            found.append(("".join(run[: index - first]), "".join(run[index - first + 1 :])))
            index, count, level = index // self.arity, -(-count // self.arity), level - 1
        return found


def _dense(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``idx``, the place of a row in its group in the given order, written to the shared folder.

    Rows are range-partitioned by the whole order, so a group of any size spreads over many tasks; a partition counts
    its rows per group, and the counts of earlier partitions, one row per group and partition, are added."""
    columns = [group, *order]
    spread = df.withColumn("row_no", F.monotonically_increasing_id())  # tells equal rows apart, so that they can be split
    spread = spread.repartitionByRange(*columns, "row_no").sortWithinPartitions(*columns, "row_no").drop("row_no")
    placed = written(spread.withColumns({"part": F.spark_partition_id(), "seq": F.monotonically_increasing_id()}), "merkle_sorted")
    counts = placed.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"))
    before = F.sum("n").over(Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col(group).alias("of_group"), F.col("part").alias("of_part"), "first", F.coalesce(before, F.lit(0)).alias("before"))
    joined = placed.join(written(offsets, "merkle_offsets"), placed[group].eqNullSafe(F.col("of_group")) & (placed["part"] == F.col("of_part")))
    return joined.withColumn("idx", F.col("before") + F.col("seq") - F.col("first")).select(*df.columns, "idx")


def _block_rows(arity: int):
    """Leaves sorted by block to one row per block with all its nodes."""
    schema = pa.schema([("grp", pa.int64()), ("block", pa.int64()), ("count", pa.int32()), ("height", pa.int32()), ("nodes", pa.binary()), ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, at, leaves, height = Sink(schema), None, [], 0

        def close():
            layout = VebLayout(height, arity)
            nodes = bytes(layout.build(leaves))
            sink.add(*at, len(leaves), height, nodes, layout.get(nodes, 0, 0).hex(), size=len(nodes) + 128)

        for grp, block, levels, digest in rows(batches, "grp", "block", "height", "digest"):
            if (grp, block) != at:
                if leaves:
                    close()
                    if sink.full():
                        yield from sink.flush()
                at, leaves, height = (grp, block), [], levels
            leaves.append(bytes.fromhex(digest))
        if leaves:
            close()
        yield from sink.flush()

    return run


_BLOCKS = "grp long, block long, count int, height int, nodes binary, digest string"
_STEP = "array<struct<before: string, after: string>>"


def _levels(count: Column, arity: int, most: int) -> Column:
    """Levels of edges until one node is left, at most ``most``."""
    return sum((count > arity**k).cast("int") for k in range(most))


def _blocks(leaves: DataFrame, height: int, arity: int) -> list[DataFrame]:
    """Block tables from the leaves ``(grp, idx, digest)`` up to the round in which every group has one block."""
    found, width = [], arity**height
    counts = leaves.groupBy("grp").agg((F.max("idx") + 1).alias("total"))
    while True:
        counts = written(counts, "merkle_counts")
        placed = leaves.join(counts, "grp").select(
            "grp", F.expr(f"idx div {width}").alias("block"), "idx", _levels(F.col("total"), arity, height).alias("height"), "digest"
        )
        sorted_ = placed.repartition("grp", "block").sortWithinPartitions("grp", "block", "idx")
        found.append(written(sorted_.mapInArrow(_block_rows(arity), _BLOCKS), "merkle_blocks"))
        if counts.where(F.col("total") > width).isEmpty():
            return found
        leaves = found[-1].select("grp", F.col("block").alias("idx"), "digest")
        counts = counts.select("grp", F.expr(f"(total + {width - 1}) div {width}").alias("total"))


def _path_rows(arity: int, fold: bool):
    """Blocks, each followed by the rows that ask for a leaf of it, to the paths or the proofs of those rows."""
    if fold:
        schema = pa.schema([("grp", pa.int64())] + [(n, pa.string()) for n in ("key", "leaf", "proof_sha256", "folded_root")])
    else:
        step = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        schema = pa.schema([("grp", pa.int64()), ("idx", pa.int64()), ("path", step)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = Sink(schema)
        names = ["kind", "grp", "idx", "count", "height", "nodes", "path"] + ["key", "digest", "other"] * fold
        for kind, grp, idx, *rest in rows(batches, *names):
            if kind == 0:
                count, height, nodes, upper = rest[:4]
                layout, upper = VebLayout(height, arity), [(s["before"], s["after"]) for s in upper]
                continue
            path = layout.siblings(nodes, idx % arity**layout.height if layout.height else 0, count) + upper
            if fold:
                key, digest, other = rest[4:]
                proof = hashlib.sha256("".join(a + b for a, b in path).encode()).hexdigest()
                folded = digest if other is None else other
                for before, after in path:
                    folded = hashlib.sha256((before + folded + after).encode()).hexdigest()
                sink.add(grp, key, digest, proof, folded, size=400)
            else:
                sink.add(grp, idx, [{"before": a, "after": b} for a, b in path], size=sum(len(a) + len(b) for a, b in path) + 64)
            if sink.full():
                yield from sink.flush()
        yield from sink.flush()

    return run


def _with_blocks(blocks: DataFrame, upper: DataFrame, asking: DataFrame, width: int) -> DataFrame:
    """Every block with the path of its root, then the rows of its leaves, in one partition. Rows are dealt by block, and a
    block has at most ``width`` leaves."""
    known = blocks.join(upper.select("grp", F.col("idx").alias("block"), "path"), ["grp", "block"])
    known = known.select("grp", "block", F.lit(0).alias("kind"), "count", "height", "nodes", "path")
    asked = asking.withColumns({"block": F.expr(f"idx div {width}"), "kind": F.lit(1)})
    both = known.unionByName(asked, allowMissingColumns=True)
    return both.repartition("grp", "block").sortWithinPartitions("grp", "block", "kind")


def _block_paths(tables: list[DataFrame], top: DataFrame, height: int, arity: int) -> DataFrame:
    """``(grp, idx, path)`` of the roots of the lowest blocks. ``top`` has the path of each group's subroot."""
    upper = top
    for blocks, below in zip(tables[:0:-1], tables[-2::-1]):
        asking = below.select("grp", F.col("block").alias("idx"))
        found = _with_blocks(blocks, upper, asking, arity**height).mapInArrow(_path_rows(arity, False), f"grp long, idx long, path {_STEP}")
        upper = written(found, "merkle_paths")
    return upper


def manifest(
    table: DataFrame,
    key: str,
    group: str,
    columns: list[str],
    tampered: Column | None = None,
    tamper: str | None = None,
    height: int = HEIGHT,
    arity: int = ARITY,
) -> DataFrame:
    """``(<key>, leaf, subroot, root, proof_sha256, folded_root, verified)``, one row per row of ``table``.

    A leaf is the hash of ``columns``. Leaves ascend by ``key`` per value of ``group``, groups by value, nulls first in
    both; rows that share a key ascend by leaf, and rows equal in all columns are interchangeable. ``proof_sha256`` hashes
    the siblings on the way from the leaf to the root. ``folded_root`` is folded from them and the row as it is read back:
    for rows where ``tampered`` holds, column ``tamper`` has its A-Z lowered (null text stays). ``verified`` says whether
    that gives the root. An empty table gives no row. Columns beside the named ones are ignored.
    """
    text = tamper or columns[0]
    lowered = F.translate(F.col(f"`{text}`").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    quoted = [F.col(f"`{c}`") for c in columns]
    changed = leaf_hash([lowered if c == text else F.col(f"`{c}`") for c in columns])
    other = F.when(tampered, changed) if tamper and tampered is not None else F.lit(None).cast("string")
    leaves = table.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{group}`").cast("string").alias("_group"), leaf_hash(quoted).alias("digest"), other.alias("other"))
    leaves = written(_dense(leaves, "_group", ["_key", "digest"]), "merkle_leaves")

    named = leaves.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).withColumn("all", F.lit(0))
    groups = written(_dense(named, "all", ["_group"]).select("_group", F.col("idx").alias("grp")), "merkle_groups")
    own = leaves.withColumnRenamed("_group", "_own")
    own = own.join(groups, own["_own"].eqNullSafe(groups["_group"])).drop("_own", "_group")
    tables = _blocks(own.select("grp", "idx", "digest"), height, arity)
    subroots = tables[-1].select("grp", F.col("digest").alias("subroot"))

    tops = _blocks(subroots.select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("idx"), F.col("subroot").alias("digest")), height, arity)
    root = tops[-1].select(F.col("digest").alias("root"))
    empty = F.array().cast(_STEP)
    end = tops[-1].select("grp", F.col("block").alias("idx"), empty.alias("path"))
    above = _block_paths(tops, end, height, arity)
    asking = subroots.select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("idx"))
    climbs = _with_blocks(tops[0], above, asking, arity**height).mapInArrow(_path_rows(arity, False), f"grp long, idx long, path {_STEP}")
    climbs = written(climbs.select(F.col("idx").alias("grp"), F.lit(0).cast("long").alias("idx"), "path"), "merkle_climbs")

    asking = own.select("grp", "idx", F.col("_key").cast("string").alias("key"), "digest", "other")
    upper = _block_paths(tables, climbs, height, arity)
    proved = _with_blocks(tables[0], upper, asking, arity**height).mapInArrow(
        _path_rows(arity, True), "grp long, key string, leaf string, proof_sha256 string, folded_root string"
    )
    joined = proved.join(subroots, "grp").join(F.broadcast(root))  # one row
    return joined.select(
        F.col("key").cast(table.schema[key].dataType).alias(key), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


DOCUMENT = ["doc_id", "source", "lang", "n_chars", "text"]


def document_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` by language; rows whose id's crc32 is divisible by 3 are tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return manifest(docs, "doc_id", "lang", DOCUMENT, tampered, "text")
