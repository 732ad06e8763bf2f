"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

Lines are hashed, and a rolling hash over the last ``roll`` line hashes ends a chunk where it is divisible by
``divisor``. A boundary so depends on nearby lines only: text inserted before a repeated passage moves the chunks
but does not change them. A chunk of several lines that occurs elsewhere too is kept once, in the document with
the smallest id and there at its first place; the other occurrences go. Chunks are grouped by their bytes; should
different chunks ever share both of their hashes, they all stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLL = 2
DIVISOR = 4
MIN_LINES = 2


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def line_chunks(text: Column, roll: int = ROLL, divisor: int = DIVISOR) -> Column:
    """Array of ``struct<n_lines, text>``: the lines of a text, cut at content-defined boundaries. Joining the
    chunks' texts by line feeds gives the text back."""

    def cut(lines: Column) -> Column:
        hashes = F.transform(lines, lambda line: F.md5(line))

        def ends(h: Column) -> Column:
            size = F.size(h)
            window = lambda i: F.concat(*[F.element_at(h, F.greatest(i - k, F.lit(0)) + 1) for k in reversed(range(roll))])
            rolling = lambda i: F.conv(F.substring(F.md5(window(i)), 1, 8), 16, 10).cast("long")
            inner = F.filter(F.sequence(F.lit(0), size - 1), lambda i: (i < size - 1) & (rolling(i) % divisor == 0))
            return F.concat(inner, F.array(size - 1))

        def slices(stops: Column) -> Column:
            def one(stop, k):
                start = F.when(k == 0, 0).otherwise(F.element_at(stops, F.greatest(k, F.lit(1))) + 1)
                part = F.slice(lines, start + 1, stop - start + 1)
                return F.struct((stop - start + 1).alias("n_lines"), F.array_join(part, "\n").alias("text"))

            return F.transform(stops, one)

        return _let(_let(hashes, ends), slices)

    return _let(F.split(text, "\n", -1), cut)


def removed_chunks(docs: DataFrame, roll: int = ROLL, divisor: int = DIVISOR, min_lines: int = MIN_LINES) -> DataFrame:
    """``(doc, row, gone)``: per row the places of the chunks that repeat an earlier one. ``row`` tells texts of one id apart."""
    chunks = docs.select("doc", "row", F.posexplode(line_chunks(F.coalesce("text", F.lit("")), roll, divisor)).alias("at", "chunk"))
    chunks = chunks.where(F.col("chunk.n_lines") >= min_lines).select(
        "doc", "row", "at", F.xxhash64("chunk.text").alias("h1"), F.md5("chunk.text").alias("h2"), F.col("chunk.text").alias("body")
    )
    keys = ["h1", "h2"]
    # grouping by the body compares the bytes, and merges the copies of a partition before they are moved
    bodies = chunks.groupBy(*keys, "body").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "row", "at")).alias("first"))
    alone = bodies.groupBy(*keys).agg(F.count(F.lit(1)).alias("bodies"), F.max("n").alias("n"), F.min("first").alias("first"))
    repeated = alone.where("bodies = 1 and n > 1").select(*keys, "first")
    others = chunks.select("doc", "row", "at", *keys).join(repeated, keys).where(F.struct("doc", "row", "at") != F.col("first"))
    return others.groupBy("doc", "row").agg(F.collect_set("at").alias("gone"))


def dedup_lines(docs: DataFrame, roll: int = ROLL, divisor: int = DIVISOR, min_lines: int = MIN_LINES) -> DataFrame:
    """``docs`` with all its columns, ``text`` without repeated multi-line chunks, and ``n_lines`` and ``n_removed``
    (lines) in place of columns of these names.

    One row per input row. A null text stays null and has no line; an empty one has one empty line. Every row is
    judged by its own text. Rows with the same id and text are treated alike; those with the same id and different texts
    follow each other by a hash of the text, and so do rows without id, after all others. Single lines are never removed, however often they occur (``min_lines``).
    """
    last = F.lit((1 << 63) - 1)
    doc = F.coalesce(F.col("doc_id").cast("long"), last)
    row = F.struct(F.xxhash64("text").alias("h1"), F.hash("text").alias("h2"))
    gone = removed_chunks(docs.select(doc.alias("doc"), row.alias("row"), "text"), roll, divisor, min_lines)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    joined = docs.select(F.struct(*columns).alias("of"), doc.alias("doc"), row.alias("row")).join(gone, ["doc", "row"], "left")
    gone_lines = lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + x["n_lines"])
    chunks = joined.withColumn("chunks", F.when(F.col("gone").isNotNull(), line_chunks(F.col("of.text"), roll, divisor)))
    split = chunks.withColumn("out", F.filter("chunks", lambda c, i: ~F.array_contains("gone", i)))
    n_lines = F.coalesce(F.length("of.text") - F.length(F.replace("of.text", F.lit("\n"))) + 1, F.lit(0))
    kept = F.when(F.col("out").isNull(), F.col("of.text")).otherwise(F.array_join(F.transform("out", lambda c: c["text"]), "\n"))
    removed = F.when(F.col("out").isNull(), 0).otherwise(gone_lines("chunks") - gone_lines("out"))
    extra = ["n_lines", "n_removed"]
    return split.select(
        *[kept.alias("text") if c == "text" else F.col("of")[c].alias(c) for c in docs.columns if c not in extra],
        n_lines.cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"),
    )


def line_digest(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_removed, kept_sha256`` (null text: as empty)."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
