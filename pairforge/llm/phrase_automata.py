"""Substring dedup by repeated-phrase automata.

A window of ``window`` words is a repeat where its word sequence also starts in a document with a smaller
id. The steps:

0. Copies of a whole text go at once; the one with the smallest id stands for them below.
1. Every window has an *anchor*: the ``gram`` consecutive words in it with the smallest hash. Equal windows
   have equal anchors, so only windows whose anchor occurs in two texts can repeat. Anchors are aggregated by hash, with
   64-bit hashes of the texts.
2. Consecutive windows with one anchor form a *segment* of the text. Segments with a recurring anchor are
   the candidate passages. Anchors of very many texts give single windows as segments, routed by the
   window itself, so that no route gathers a third of the corpus; equal segments are merged before and
   after the shuffle with the smallest and largest id of their documents.
3. Per route, segments are compared word by word. What two documents share is a confirmed *phrase*: a run of
   windows with the smallest document that holds them.
4. Documents are dealt into blocks of a few megabytes. A block's shard of the phrases, those of the segments it holds, is
   compiled into an Aho-Corasick automaton, and every document of the block is streamed through it. Each
   occurrence of a phrase that a smaller document has is removed. (Segments ask for their phrases by a hash: should
   two share it, the automaton gets phrases too many, and still finds only what stands in a document.)

Nothing is sampled and no candidate is capped; the result is exact. A row is judged by its own text; ids only say which
document is smaller.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.words import Sink, bounds, rows, window_hashes
from pairforge.session import written

WINDOW = 13
GRAM = 6
BUSY_DOCS = 10_000  # anchors of more documents are routed window by window
BLOCK_BYTES = 2 << 20  # of the documents that one automaton serves


def _anchors(data, starts, ends, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: anchor hash, first and last window of each run."""
    hashes = window_hashes(data, starts, ends, gram)
    span = window - gram + 1
    if len(hashes) < span:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    view = sliding_window_view(hashes, span)
    place = np.concatenate([view[i : i + 65536].argmin(1) + np.arange(i, min(i + 65536, len(view)))
                            for i in range(0, len(view), 65536)])
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:], [len(place)]]) - 1
    return hashes[place[first]], first, last


def _anchor_rows(window: int, gram: int):
    schema = pa.schema([("anchor", pa.int64()), ("row", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, own_rows, n = [], [], 0
        for row, text in rows(batches, "row", "text"):
            data, starts, ends = bounds(b" ".join((text or b"").split()))
            own = np.unique(_anchors(data, starts, ends, window, gram)[0])
            if len(own):
                found.append(own.view(np.int64))
                own_rows.append(np.full(len(own), row, np.int64))
                n += len(own)
            if n >= 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (found, own_rows)], schema=schema)
                found, own_rows, n = [], [], 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (found, own_rows)], schema=schema)

    return run


def _segment_rows(window: int, gram: int):
    schema = pa.schema([("route", pa.int64()), ("doc", pa.int64()), ("block", pa.int64()), ("segment", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = Sink(schema)
        for doc, block, text, once, busy in rows(batches, "doc", "block", "text", "once", "busy"):
            joined = b" ".join((text or b"").split())
            data, starts, ends = bounds(joined)
            anchor, first, last = _anchors(data, starts, ends, window, gram)
            anchor = anchor.view(np.int64)
            for i in np.flatnonzero(np.isin(anchor, np.array(once or [], np.int64))):
                a, b = int(first[i]), int(last[i])
                piece = joined[starts[a] : ends[b + window - 1]]
                sink.add(int(anchor[i]), doc, block, piece, size=len(piece) + 32)
                if sink.full():
                    yield from sink.flush()
            if busy:
                routes = window_hashes(data, starts, ends, window).view(np.int64)
                for i in np.flatnonzero(np.isin(anchor, np.array(busy, np.int64))):
                    for a in range(int(first[i]), int(last[i]) + 1):
                        piece = joined[starts[a] : ends[a + window - 1]]
                        sink.add(int(routes[a]), doc, block, piece, size=len(piece) + 32)
                    if sink.full():
                        yield from sink.flush()
        yield from sink.flush()

    return run


def _confirmed(members: list[tuple[int, bytes, int, int]], window: int) -> Iterator[tuple[int, bytes, int, int]]:
    """``(print, phrase, windows, low)`` of a route's distinct segments ``(print, segment, low, high)``: per segment its runs
    of windows that two documents have, with the smallest one."""
    if len(members) == 1:
        mark, segment, low, high = members[0]
        if low < high:
            yield mark, segment, segment.count(b" ") + 2 - window, low
        return
    split = [segment.split(b" ") for _, segment, _, _ in members]
    seen: dict[tuple, list[int]] = {}
    for words, (_, _, low, high) in zip(split, members):
        for i in range(len(words) - window + 1):
            known = seen.setdefault(tuple(words[i : i + window]), [low, high])
            known[0], known[1] = min(known[0], low), max(known[1], high)
    for words, (mark, *_) in zip(split, members):
        lows = [seen[tuple(words[i : i + window])] for i in range(len(words) - window + 1)]
        at = 0
        for (low, repeats), run in itertools.groupby(lows, key=lambda k: (k[0], k[0] < k[1])):
            n = sum(1 for _ in run)
            if repeats:
                yield mark, b" ".join(words[at : at + n + window - 1]), n, low
            at += n


def _phrase_rows(window: int):
    """Segments sorted by route to confirmed phrases."""
    schema = pa.schema([("route", pa.int64()), ("print", pa.int64()), ("phrase", pa.binary()), ("n", pa.int32()), ("low", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, members, route = Sink(schema), [], None
        for own, *member in rows(batches, "route", "print", "segment", "low", "high"):
            if own != route:
                for phrase in _confirmed(members, window) if members else ():
                    sink.add(route, *phrase, size=len(phrase[1]) + 48)
                if sink.full():
                    yield from sink.flush()
                route, members = own, []
            members.append(member)
        for phrase in _confirmed(members, window) if members else ():
            sink.add(route, *phrase, size=len(phrase[1]) + 48)
        yield from sink.flush()

    return run


class Phrases:
    """The automaton of a block's phrases. It reads bytes, each as one character; a space before and after a phrase keeps
    it to whole words."""

    def __init__(self, window: int):
        self._window, self._open = window, True
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)

    def add(self, phrase: bytes, n: int, low: int) -> None:
        self._automaton.add_word(f" {phrase.decode('latin-1')} ", (low, n + self._window - 1))

    def covered(self, words: list[bytes], doc: int) -> np.ndarray | None:
        """Which words lie in a window that a document before ``doc`` has."""
        if not len(self._automaton) or len(words) < self._window:
            return None
        if self._open:
            self._automaton.make_automaton()
            self._open = False
        text = f" {b' '.join(words).decode('latin-1')} "
        found = [(end, width) for end, (low, width) in self._automaton.iter(text) if low < doc]
        if not found:
            return None
        last_byte, width = np.array(found).T
        ends = np.cumsum([len(w) + 1 for w in words])  # place of the space after each word
        last = np.searchsorted(ends, last_byte)
        change = np.bincount(last - width + 1, minlength=len(words) + 1) - np.bincount(last + 1, minlength=len(words) + 1)
        return np.cumsum(change[:-1]) > 0


def _removal_rows(window: int, with_text: bool):
    """Rows sorted by block, the phrases before the documents, to what is left of the documents."""
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema(fields + ([("kept_text", pa.string())] if with_text else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, block, phrases = Sink(schema), None, None
        for own, kind, phrase, n, low, doc_id, doc, copy, text in rows(batches, "block", "kind", "phrase", "n", "low", "doc_id", "doc", "copy", "text"):
            if own != block:
                block, phrases = own, Phrases(window)
            if kind == 0:
                phrases.add(phrase, n, low)
                continue
            words = (text or b"").split()
            total = len(words)
            if copy:
                words = words if total < window else []
            elif (gone := phrases.covered(words, doc)) is not None:
                words = list(itertools.compress(words, (~gone).tolist()))
            kept = b" ".join(words)
            out = (doc_id, total, total - len(words), hashlib.sha256(kept).hexdigest())
            sink.add(*out, *([kept.decode("utf-8", "replace")] if with_text else []), size=160 + len(kept) * with_text)
            if sink.full():
                yield from sink.flush()
        yield from sink.flush()

    return run


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, busy_docs: int = BUSY_DOCS, with_text: bool = True, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256[, kept_text])`` of ``docs(doc_id, text, ...)``.

    One row per input row. Null and empty texts have no words. Rows that share an id are judged one by one, each by its own
    text; none is before the other. A row without id comes after all ids, and no such row before another. Texts shorter
    than the window are kept whole. Other columns are ignored. ``gram`` (below ``window``), ``busy_docs`` and
    ``block_bytes`` only steer the work; the result does not depend on them.
    """
    if not 0 < gram < window:
        raise ValueError("gram must be positive and less than window")
    last = F.lit((1 << 63) - 1)
    base = docs.select("doc_id", F.coalesce("doc_id", last).cast("long").alias("doc"), F.col("text").cast("binary").alias("text"))
    base = base.withColumn("row", F.xxhash64("text")).withColumn("print", F.xxhash64(F.lit(1), "text"))
    same = ["row", "print"]
    firsts = base.groupBy(*same).agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").drop("last")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    block = F.pmod(F.xxhash64("doc", "row"), F.lit(total // block_bytes + 1)).alias("block")
    anchors = base.select("row", "text").mapInArrow(_anchor_rows(window, gram), "anchor long, row long")
    base = base.join(written(firsts, "phrase_copies"), same, "left").withColumn("copy", F.coalesce(F.col("doc") > F.col("first"), F.lit(False)))
    spread = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("low"), F.max("row").alias("high"))
    own = (
        anchors.join(spread.where("low < high").select("anchor", "n"), "anchor")
        .groupBy("row")
        .agg(
            F.collect_set(F.when(F.col("n") <= busy_docs, F.col("anchor"))).alias("once"),
            F.collect_set(F.when(F.col("n") > busy_docs, F.col("anchor"))).alias("busy"),
        )
    )
    segments = written(
        base.where(~F.col("copy")).select("row", "doc", block, "text").join(own, "row")
        .mapInArrow(_segment_rows(window, gram), "route long, doc long, block long, segment binary"),
        "phrase_segments",
    )
    mark = F.xxhash64("segment").alias("print")
    merged = segments.groupBy("route", "segment").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).withColumn("print", mark)
    phrases = written(
        merged.repartition("route").sortWithinPartitions("route")
        .mapInArrow(_phrase_rows(window), "route long, print long, phrase binary, n int, low long"),
        "phrase_confirmed",
    )
    asked = segments.groupBy("block", "route", mark).agg(F.max("doc").alias("doc"))
    shards = asked.join(phrases, ["route", "print"]).where("low < doc").select("block", F.lit(0).alias("kind"), "phrase", "n", "low")
    streams = base.select(block, F.lit(1).alias("kind"), "doc_id", "doc", "copy", "text")
    both = shards.unionByName(streams, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "kind")
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return both.mapInArrow(_removal_rows(window, with_text), out)
