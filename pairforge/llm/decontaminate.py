"""Benchmark decontamination by suffix arrays of the training texts.

Each shard of documents gets a word-level suffix array: its suffixes in lexicographic order of their first
``window`` words, every word being a 64-bit hash. All suffixes of the benchmark are binary-searched in every
shard; the range that agrees in ``window`` words gives each verbatim occurrence, whose bytes are compared.
Occurrences of consecutive benchmark suffixes at consecutive places join into the longest verbatim matches.

The array is sparse: a training suffix is sorted only if its first word starts some benchmark suffix (and, if
no searched suffix is a single word, also its second word follows there), since no other can match.

The benchmark comes to the documents in blocks of bounded size, so it may grow too: every block is a job of its own over the
texts, which leaves only the matches and releases the block. With one block nothing else is moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.llm.words import Sink, bounds, rows, window_hashes
from pairforge.session import written

WINDOW = 13
BLOCK_BYTES = 4 << 20  # benchmark text per pass
SHARD_BYTES = 1 << 20  # training text per suffix array
_FILTER_BITS = 20

WORD_TABLE = bytes.maketrans(
    bytes(range(128)),
    bytes(c if 48 <= c < 58 or 97 <= c < 123 else c + 32 if 65 <= c < 91 else 32 for c in range(128)),
)


def words_of(text: bytes | None) -> bytes:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, joined by one space."""
    return b" ".join((text or b"").translate(WORD_TABLE).split())


def _keys(hashes: np.ndarray, places: np.ndarray, stop: np.ndarray, width: int) -> np.ndarray:
    """The first ``width`` word hashes of each suffix as fixed-length bytes that sort lexicographically.

    A word past the end of its text (``stop``) is zero; no word hash is."""
    index = places[:, None] + np.arange(width)
    inside = index < stop[:, None]
    table = np.where(inside, hashes[np.minimum(index, len(hashes) - 1)], np.uint64(0)).astype(">u8")
    return np.ascontiguousarray(table).view(f"S{8 * width}").ravel()


class TestSuffixes:
    """The suffixes of one block of benchmark items, as search keys."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window, self.names, self.texts = window, [], []
        low, high, owner, place, length, one, two = [], [], [], [], [], [], []
        for name, text in items:
            joined = words_of(text)
            if not joined:
                continue
            data, starts, ends = bounds(joined)
            hashes = window_hashes(data, starts, ends, 1) | np.uint64(1)
            n = len(hashes)
            width = min(window, n)
            places = np.arange(n - width + 1)
            key = _keys(hashes, places, np.minimum(places + width, n), window)
            low.append(key)
            tail = np.full((len(places), window), np.uint64((1 << 64) - 1))
            tail[:, :width] = hashes[places[:, None] + np.arange(width)]
            high.append(np.ascontiguousarray(tail.astype(">u8")).view(f"S{8 * window}").ravel())
            owner.append(np.full(len(places), len(self.names)))
            place.append(places)
            length.append(np.full(len(places), width))
            one.append(hashes[places])
            two.append(hashes[places + 1] if width > 1 else np.zeros(len(places), np.uint64))
            self.names.append(name)
            self.texts.append((joined, starts, ends))
        cat = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
        self.low, self.high = cat(low, f"S{8 * window}"), cat(high, f"S{8 * window}")
        self.owner, self.place, self.length = (cat(x, np.int64) for x in (owner, place, length))
        single = bool(len(self.length)) and int(self.length.min()) == 1
        self.pairs = not single
        start, follow = cat(one, np.uint64), cat(two, np.uint64)
        self.bits = np.zeros(1 << _FILTER_BITS, bool)
        self.bits[self._slot(start * np.uint64(3) + follow if self.pairs else start)] = True

    @staticmethod
    def _slot(x: np.ndarray) -> np.ndarray:
        return (x * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        if not self.pairs:
            return np.flatnonzero(self.bits[self._slot(hashes)])
        return np.flatnonzero(self.bits[self._slot(hashes[:-1] * np.uint64(3) + hashes[1:])])


def _shard_hits(joined: list[bytes], tests: TestSuffixes) -> list[list[tuple[int, int, int, int]]]:
    """Per document of a shard: (item, place in item, place in document, length) of each verbatim occurrence."""
    hits: list[list[tuple[int, int, int, int]]] = [[] for _ in joined]
    filled = [i for i, j in enumerate(joined) if j]
    if not filled or not len(tests.low):
        return hits
    buffer = b" ".join(joined[i] for i in filled)
    data, starts, ends = bounds(buffer)
    hashes = window_hashes(data, starts, ends, 1) | np.uint64(1)
    counts = np.array([joined[i].count(b" ") + 1 for i in filled])
    stops = np.cumsum(counts)
    places = tests.candidates(hashes)
    if not len(places):
        return hits
    which = np.searchsorted(stops, places, side="right")
    keys = _keys(hashes, places, stops[which], tests.window)
    order = np.argsort(keys, kind="stable")  # the suffix array of the shard
    keys = keys[order]
    left = np.searchsorted(keys, tests.low, side="left")
    right = np.searchsorted(keys, tests.high, side="right")
    for t in np.flatnonzero(left < right):
        item, at, width = int(tests.owner[t]), int(tests.place[t]), int(tests.length[t])
        text, s, e = tests.texts[item]
        wanted = text[s[at] : e[at + width - 1]]
        for k in order[left[t] : right[t]]:
            place, doc = int(places[k]), int(which[k])
            if place + width <= stops[doc] and buffer[starts[place] : ends[place + width - 1]] == wanted:
                hits[filled[doc]].append((item, at, place - int(stops[doc] - counts[doc]), width))
    return hits


def _pieces(joined: bytes, window: int, size: int) -> Iterator[tuple[int, bytes]]:
    """A long text in parts of about ``size`` bytes that overlap by window - 1 words, with the words before."""
    if len(joined) <= 2 * size:
        yield 0, joined
        return
    _, starts, ends = bounds(joined)
    step = max(window, len(starts) * size // len(joined))
    for at in range(0, max(1, len(starts) - window + 1), step):
        to = min(len(starts), at + step + window - 1)
        yield at, joined[starts[at] : ends[to - 1]]


def _merge(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


def _longest(found: list[tuple[int, int, int, int]]) -> list[dict]:
    """Join occurrences of consecutive suffixes at consecutive places: each maximal verbatim match once."""
    out, open_runs = [], {}
    for item, at, place, width in sorted(set(found), key=lambda f: (f[2], f[0], f[1])):
        run = open_runs.get((item, place - at))
        if run and run["start"] + run["length"] - width + 1 == place:
            run["length"] += 1
        else:
            run = {"item": item, "item_at": at, "start": place, "length": width}
            open_runs[item, place - at] = run
            out.append(run)
    return out


_SPARK_MATCH = T.ArrayType(
    T.StructType([T.StructField("item_id", T.StringType())] + [T.StructField(n, T.IntegerType()) for n in ("item_at", "start", "length")])
)
_MATCH_TYPE = pa.list_(pa.struct([("item_id", pa.string()), ("item_at", pa.int32()), ("start", pa.int32()), ("length", pa.int32())]))


def _search(items, window: int, kept: list[str], hits_only: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = TestSuffixes(items.value, window)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found: list[list] = [[] for _ in texts]
            n_words = [0] * len(texts)
            shard, size = [], 0

            def search():
                for (i, shift, _), hits in zip(shard, _shard_hits([x[2] for x in shard], tests)):
                    found[i] += [(item, at, place + shift, width) for item, at, place, width in hits]

            for i, text in enumerate(texts):
                joined = words_of(text)
                n_words[i] = joined.count(b" ") + 1 if joined else 0
                for shift, piece in _pieces(joined, window, SHARD_BYTES):
                    shard.append((i, shift, piece))
                    size += len(piece)
                    if size >= SHARD_BYTES:
                        search()
                        shard, size = [], 0
            search()
            matches = [
                [{"item_id": tests.names[m["item"]], "item_at": m["item_at"], "start": m["start"], "length": m["length"]}
                 for m in _longest(f)]
                for f in found
            ]
            out = pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(n_words, pa.int64()), pa.array(matches, _MATCH_TYPE)],
                names=[*kept, "n_words", "matches"],
            )
            yield out.filter(pa.array([bool(m) for m in matches], pa.bool_())) if hits_only else out

    return run


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(row, n_words, matches)``: the kept columns of each input row as a struct, and the maximal verbatim
    matches of benchmark items in its text, with item, place in the item, place and length in the document, in
    words.

    A match has at least ``window`` words, or the whole item if that is shorter. One row per input row; null
    texts have no words, null items and empty ones match nowhere, items without id are named by an empty string,
    and rows that share an item id count as one item; repeated rows are read once. Blocks hold the items with one hash, about ``block_bytes``
    of text each; a single longer item makes its block longer.
    """
    spark = docs.sparkSession
    own = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("binary").alias("text")
    ).where("text is not null")
    own = written(own.dropDuplicates(["item_id", "text"]), "benchmark_items")  # else one block holds all repeats of a row
    size = own.agg(F.sum(F.length("text")).alias("size")).first()["size"] or 0
    blocks = max(1, -(-size // block_bytes))
    frame = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("text").cast("binary").alias("text")
    )
    extra = [T.StructField("n_words", T.LongType()), T.StructField("matches", _SPARK_MATCH)]

    def searched(texts: DataFrame, kept: list[str], block: int, hits_only: bool):
        part = own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        items = spark.sparkContext.broadcast(sorted((r["item_id"], bytes(r["text"])) for r in part.collect()))  # about block_bytes
        schema = T.StructType([*(texts.schema[k] for k in kept), *extra])
        return texts.mapInArrow(_search(items, window, kept, hits_only), schema), items

    if blocks == 1:
        return searched(frame, ["row"], 0, False)[0]
    # rows get a number that is fixed by writing them, and each block's search leaves the numbers of the rows it matches
    frame = written(frame.withColumn("place", F.monotonically_increasing_id()), "benchmark_texts")
    counted = matched = None
    for block in range(blocks):
        hits, items = searched(frame.select("place", "text"), ["place"], block, block > 0)
        hits = written(hits, "benchmark_matches")
        items.destroy()
        counted = hits if block == 0 else counted
        matched = hits if block == 0 else matched.unionByName(hits)
    joined = matched.where(F.size("matches") > 0).groupBy("place").agg(F.flatten(F.collect_list("matches")).alias("matches"))
    known = counted.select("place", "n_words").join(joined, "place", "left")
    none = F.array().cast(_SPARK_MATCH)
    return frame.select("place", "row").join(known, "place").select("row", "n_words", F.coalesce("matches", none).alias("matches"))


def _digest():
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                        ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("longest_match", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = Sink(schema)
        for doc, n, matches in rows(batches, "doc_id", "n_words", "matches"):
            hit = sum(b - a for a, b in _merge([[m["start"], m["start"] + m["length"]] for m in matches]))
            names = sorted({m["item_id"] for m in matches})
            digest = hashlib.sha256(",".join(names).encode()).hexdigest()
            longest = max((m["length"] for m in matches), default=0)
            sink.add(doc, n, hit, len(names), digest, hit > 0 and 20 * hit >= n, longest, size=200)
            if sink.full():
                yield from sink.flush()
        yield from sink.flush()

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest_match``.

    A word is hit if a match covers it; a document is contaminated if a twentieth of its words or more are hit.
    """
    found = find_matches(docs, benchmark, ["doc_id"], window).select("row.doc_id", "n_words", "matches")
    return found.mapInArrow(
        _digest(),
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_match long",
    )


def _clean_rows():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n, matches in rows([batch], "n_words", "matches"):
                hit = sum(b - a for a, b in _merge([[m["start"], m["start"] + m["length"]] for m in matches]))
                keep.append(hit == 0 or 20 * hit < n)
            yield batch.select(["row"]).filter(pa.array(keep, pa.bool_()))

    return run


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns. Each row is judged by its own
    text, so repeated ids and rows without id need no rule; rows without text stay."""
    found = find_matches(docs, benchmark, docs.columns, window)
    return found.mapInArrow(_clean_rows(), T.StructType([found.schema["row"]])).select("row.*")
