"""Alignment of two tokenizers by galloping intersection of their token ends.

Each text is encoded twice. The byte offsets at which tokens of both encodings end cut it into groups: the shorter list
of ends drives an exponential, then binary search into the longer one, and the ranks of the common ends in both lists
say which tokens a group overlaps. Every token of one encoding is linked with every token of the other in its group.

A *block* is some megabytes of documents of one task; its texts are laid end to end, so that one intersection aligns all
of them (a text's end is an end in both lists). A block asks for the corpus-wide count of each id pair once, however
many of its documents hold it, and gets the answers back: the shuffle carries the distinct pairs of blocks, and no pair
has more rows than there are blocks. Nothing about a document passes through the driver; the only broadcasts are the two
vocabulary files and one number per id of the first vocabulary.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge.llm.words import Sink, rows
from pairforge.session import written

FOLDER = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 2 << 20
GROUP_LINKS = 1 << 20  # groups with more links are multiplied as distinct ids with counts
#: Fixed: the pattern of byte-level pre-tokenization.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BITS = 20  # of an id in a packed pair


def vocabulary_file(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file of a few megabytes, from any store that Spark reads."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in a byte-level vocabulary: printable ones stand for themselves, the others
    for the letters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Encoder and token bytes of a byte-level BPE file. Its ids follow the order of its merges, so they are the ranks."""

    def __init__(self, content: bytes):
        import tiktoken

        found, letters = json.loads(content), _byte_letters()
        special = {t["content"] for t in found["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in found["model"]["vocab"].items() if t not in special}
        self.bytes = [b""] * (1 + max(ranks.values()))
        for token, i in ranks.items():
            self.bytes[i] = token
        self._encoding = tiktoken.Encoding("byte", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self._encoding.encode_ordinary(" " + text)


class PieceBpe:
    """Encoder and token bytes of a piece model, which puts a space before the text itself."""

    def __init__(self, content: bytes):
        import sentencepiece

        self._model = model = sentencepiece.SentencePieceProcessor(model_proto=content)
        piece = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(piece)]

    def encode(self, text: str) -> list[int]:
        return self._model.encode(text, num_threads=1)


def _advance(long: np.ndarray, start: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """First place in ``long`` whose value is not below ``wanted``, for places known to be at least ``start``: steps that
    double, then halving."""
    size, low, high, step = len(long), start.copy(), start.copy(), 1
    going = np.flatnonzero(high < size)
    while len(going):
        going = going[long[high[going]] < wanted[going]]
        low[going] = high[going] + 1
        high[going] = np.minimum(low[going] + step - 1, size)
        going, step = going[high[going] < size], step * 2
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) >> 1
        below = long[middle] < wanted[going]
        low[going[below]] = middle[below] + 1
        high[going[~below]] = middle[~below]
        going = going[low[going] < high[going]]
    return low


def galloped(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in both increasing lists of the values they share.

    The values of ``short`` are searched in rounds: one between each two that are done, from the place of its left
    neighbour on. So each search is as long as the gap it crosses, and a round is one vector operation per step."""
    place = np.zeros(len(short), np.int64)
    if len(short) and len(long):
        place[:1] = _advance(long, place[:1], short[:1])
        stride = 1 << max(0, (len(short) - 1).bit_length() - 1)
        while stride:
            at = np.arange(stride, len(short), 2 * stride)
            place[at] = _advance(long, place[at - stride], short[at])
            stride //= 2
    inside = np.flatnonzero(place < len(long))
    same = inside[long[place[inside]] == short[inside]]
    return same, place[same]


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the common values in ``a`` and in ``b``."""
    if len(a) <= len(b):
        return galloped(a, b)
    in_b, in_a = galloped(b, a)
    return in_a, in_b


def _counts(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with how often each occurs."""
    if times is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    if times is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(times, first) if len(first) else times


class _Block:
    """Documents of one task, laid end to end."""

    def __init__(self):
        self.ids, self.a, self.b, self.tokens, self.size = [], [], [], [], 0

    def add(self, doc, a: list[int], b: list[int], size: int) -> None:
        self.ids.append(doc)
        self.tokens.append((len(a), len(b)))
        self.a.append(np.array(a, np.int64))
        self.b.append(np.array(b, np.int64))
        self.size += size + 16

    def links(self, a, b, na, nb, group_doc) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, id, id) of all links, packed, and how often each occurs."""
        a_at, b_at = np.cumsum(na) - na, np.cumsum(nb) - nb
        total = na * nb
        few = np.flatnonzero(total <= GROUP_LINKS)
        found, times = [], []
        upto = np.cumsum(total[few])
        at = 0
        while at < len(few):  # slices of groups with a bounded number of links
            to = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + 2 * GROUP_LINKS, "right"))
            groups = few[at : max(to, at + 1)]
            at += len(groups)
            own = np.repeat(groups, na[groups])  # the group of each token of a
            inner = np.arange(len(own)) - np.repeat(np.cumsum(na[groups]) - na[groups], na[groups])
            left = (group_doc[own] << 2 * _BITS) | (a[a_at[own] + inner] << _BITS)
            width = nb[own]
            right = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width - b_at[own], width)
            keys, n = _counts(np.repeat(left, width) | b[right])
            found.append(keys)
            times.append(n)
        for g in np.flatnonzero(total > GROUP_LINKS).tolist():
            ids_a, n_a = _counts(a[a_at[g] : a_at[g] + na[g]])
            ids_b, n_b = _counts(b[b_at[g] : b_at[g] + nb[g]])
            for one, n in zip(ids_a.tolist(), n_a.tolist()):
                found.append((int(group_doc[g]) << 2 * _BITS) | (one << _BITS) | ids_b)
                times.append(n * n_b)
        if len(found) < 2:
            return (found[0], times[0]) if found else (np.empty(0, np.int64), np.empty(0, np.int64))
        return _counts(np.concatenate(found), np.concatenate(times))

    def rows(self, block: int, sizes, words, with_groups: bool) -> Iterator[tuple]:
        """The block's distinct pairs with the number of its documents that hold them, then its documents."""
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (self.a, self.b))
        in_a, in_b = common_ends(np.cumsum(sizes[0][a]), np.cumsum(sizes[1][b]))
        na, nb = np.diff(in_a, prepend=-1), np.diff(in_b, prepend=-1)
        tokens = np.array(self.tokens, np.int64).reshape(-1, 2)
        last = np.cumsum(tokens, 0) - 1
        groups_to = np.searchsorted(in_a, last[:, 0], "right")
        n_groups = np.diff(groups_to, prepend=0)
        group_doc = np.repeat(np.arange(len(tokens)), n_groups)
        packed, times = self.links(a, b, na, nb, group_doc)
        pair, doc = packed & ((1 << 2 * _BITS) - 1), packed >> 2 * _BITS
        distinct = np.unique(pair)
        place = np.searchsorted(distinct, pair)
        links_to = np.searchsorted(doc, np.arange(len(tokens)), "right")
        held = np.bincount(place, minlength=len(distinct))
        yield (block, 0, None, 0, 0, 0, 0, "", None, (distinct >> _BITS).tolist(), (distinct & ((1 << _BITS) - 1)).tolist(), held.tolist(), *([None] if with_groups else []))
        yield from self._documents(block, a, b, na, nb, tokens, groups_to, n_groups, place, times, links_to, words, with_groups)

    def _documents(self, block, a, b, na, nb, tokens, groups_to, n_groups, place, times, links_to, words, with_groups):
        a_to, b_to = np.cumsum(tokens, 0).T
        total = na * nb
        for i, doc in enumerate(self.ids):
            g0, g1, k0, k1 = groups_to[i] - n_groups[i], groups_to[i], links_to[i - 1] if i else 0, links_to[i]
            n_a, n_b = tokens[i].tolist()
            text, payload = b"", None
            if n_a:
                wide_a, wide_b = na[g0:g1], nb[g0:g1]
                written_ids = np.empty(n_a + n_b, np.uint64)
                # where the tokens of each group go: those of a, then those of b
                before = np.cumsum(wide_a + wide_b) - wide_a - wide_b
                at_a = np.arange(n_a) + np.repeat(before - (np.cumsum(wide_a) - wide_a), wide_a)
                at_b = np.arange(n_b) + np.repeat(before + wide_a - (np.cumsum(wide_b) - wide_b), wide_b)
                own_a, own_b = a[a_to[i] - n_a : a_to[i]], b[b_to[i] - n_b : b_to[i]]
                written_ids[at_a], written_ids[at_b] = words[0][0][own_a], words[1][0][own_b]
                ends_a, ends_b = np.cumsum(wide_a) - 1, np.cumsum(wide_b) - 1
                written_ids[at_a[ends_a]], written_ids[at_b[ends_b]] = words[0][1][own_a[ends_a]], words[1][1][own_b[ends_b]]
                text = written_ids.tobytes().translate(None, b"\0")[:-1]
                payload = zlib.compress(np.diff(place[k0:k1], prepend=0).astype(np.uint32).tobytes() + times[k0:k1].astype(np.int64).tobytes(), 1)
            digest = hashlib.sha256(text).hexdigest() if n_a else ""
            yield (block, 1, doc, n_a, n_b, int(n_groups[i]), int(total[g0:g1].sum()), digest, payload, None, None, None, *([text.decode()] if with_groups else []))


def _printed(n: int, end: str) -> np.ndarray:
    """Every id below ``n`` as decimal digits and ``end``, padded with zero bytes to eight."""
    return np.frombuffer(b"".join(f"{i}{end}".encode().ljust(8, b"\0") for i in range(n)), np.uint64)


_FIELDS = [("block", pa.int64()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
           ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("links", pa.binary()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())),
           ("held", pa.list_(pa.int64()))]
_TYPES = ("block long, kind int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, "
          "a array<int>, b array<int>, held array<long>")


def _aligned_rows(files, block_bytes: int, with_groups: bool):
    schema = pa.schema(_FIELDS + [("groups", pa.string())] * with_groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contents = files.value
        coders = ByteBpe(contents[0]), PieceBpe(contents[1])
        sizes = [np.array([len(t) for t in c.bytes], np.int64) for c in coders]
        words = [[_printed(len(c.bytes), end) for end in ends] for c, ends in zip(coders, ((",", "|"), (",", ";")))]
        task, sink, block, n = TaskContext.get().partitionId(), Sink(schema), _Block(), 0
        for doc, text in rows(batches, "doc_id", "text"):
            a = b = []
            if text:
                wanted = b" " + text.encode()
                a, b = (c.encode(text) for c in coders)
                if any(b"".join(map(c.bytes.__getitem__, x)) != wanted for c, x in zip(coders, (a, b))):
                    a = b = []
            block.add(doc, a, b, len(wanted) if a else 0)
            if block.size >= block_bytes:
                for row in block.rows((task << 32) | n, sizes, words, with_groups):
                    sink.add(*row, size=200 + len(row[8] or b"") + 16 * len(row[9] or []) + (len(row[-1] or "") if with_groups else 0))
                    if sink.full():
                        yield from sink.flush()
                block, n = _Block(), n + 1
        for row in block.rows((task << 32) | n, sizes, words, with_groups) if block.ids else ():
            sink.add(*row, size=200 + len(row[8] or b"") + 16 * len(row[9] or []) + (len(row[-1] or "") if with_groups else 0))
            if sink.full():
                yield from sink.flush()
        yield from sink.flush()

    return run


def _answered_rows(with_groups: bool):
    out = [f for f in _FIELDS[2:8]] + [("n_best", pa.int64()), ("count_sum", pa.int64())] + [("groups", pa.string())] * with_groups
    schema = pa.schema(out)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, block, known = Sink(schema), None, None
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            column = {f: batch.column(i) for i, f in enumerate(batch.schema.names)}
            blocks, kinds = column["block"].to_numpy(), column["kind"].to_numpy()
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for at, to in zip([0, *cuts.tolist()], [*cuts.tolist(), len(blocks)]):
                if to == at:
                    continue
                if blocks[at] != block:
                    block, known, parts = blocks[at], None, []
                if kinds[at] == 0:  # the answers of a block come first, in the order of its pairs
                    parts.append(tuple(column[c].slice(at, to - at).to_numpy(zero_copy_only=False) for c in ("count", "best")))
                    continue
                if known is None:
                    known = [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, np.int64), np.empty(0, bool)]
                    parts = []
                fields = [column[c].slice(at, to - at).to_pylist() for c in [*names, "links", *["groups"] * with_groups]]
                for row in zip(*fields):
                    best = total = 0
                    if row[6]:
                        raw = zlib.decompress(row[6])
                        size = len(raw) // 12
                        place = np.cumsum(np.frombuffer(raw, np.uint32, size).astype(np.int64))
                        times = np.frombuffer(raw[4 * size :], np.int64)
                        total, best = int((known[0][place] * times).sum()), int(times[known[1][place]].sum())
                    sink.add(*row[:6], best, total, *row[7:], size=200 + (len(row[7]) if with_groups else 0))
                    if sink.full():
                        yield from sink.flush()
        yield from sink.flush()

    return run


def align(
    docs: DataFrame,
    byte_bpe: str = f"{FOLDER}/{BYTE_BPE}",
    piece_bpe: str = f"{FOLDER}/{PIECE_BPE}",
    block_bytes: int = BLOCK_BYTES,
    with_groups: bool = True,
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups])`` of ``docs(doc_id, text, ...)``.

    ``groups`` lists the token ids of both encodings group by group, ``a1,a2|b1;a3|b2,b3``. A pair's count is the number
    of rows of ``docs`` that link it; ``count_sum`` adds it up over a row's links, ``n_best`` counts the links whose pair
    has the highest count of its first id, ties included. One row per input row: rows that repeat an id, or have none,
    are documents of their own. A text that is null, empty or not given back byte for byte by either encoding has no
    tokens: all numbers 0 and an empty string in place of the digest. Other columns are ignored. Memory is bounded by
    ``block_bytes`` and the longest text, not by the number of rows; the result does not depend on ``block_bytes``.
    """
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast(tuple(vocabulary_file(spark, p) for p in (byte_bpe, piece_bpe)))
    groups = ", groups string" * with_groups
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    aligned = written(text.mapInArrow(_aligned_rows(files, block_bytes, with_groups), _TYPES + groups), "align_blocks")
    asked = (
        aligned.where("kind = 0").select("block", F.posexplode(F.arrays_zip("a", "b", "held")).alias("at", "pair"))
        .select("block", "at", "pair.a", "pair.b", "pair.held")
    )
    counts = written(asked.groupBy("a", "b").agg(F.sum("held").alias("count")), "align_counts")
    highest = F.broadcast(counts.groupBy("a").agg(F.max("count").alias("most")))  # at most one row per id of the vocabulary
    judged = counts.join(highest, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = asked.drop("held").join(judged, ["a", "b"]).select("block", F.lit(0).alias("kind"), "at", "count", "best")
    documents = aligned.where("kind = 1").drop("a", "b", "held")
    both = answers.unionByName(documents, allowMissingColumns=True)
    out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long" + groups
    done = both.repartition("block").sortWithinPartitions("block", "kind", "at").mapInArrow(_answered_rows(with_groups), out)
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *["groups"] * with_groups)
