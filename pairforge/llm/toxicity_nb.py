"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct hashed character n-grams of the lower-cased text, which Spark takes from a bounded sample of
labelled texts. One task counts in how many of them a feature occurs in each class; the smoothed log ratio of the two
shares is its scale r. A logistic regression on r / sqrt(number of features) then learns a weight per feature by gradient
steps in the same task, which returns the weights only. A score only uses the text, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.llm.words import Sink, rows
from pairforge.session import written

ORDERS = (3, 4, 5)
BITS = 18
MAX_ROWS = 2_000  # labelled rows of each class that are learnt from, chosen by hash of the id
STEPS = 30
RATE, BIAS_RATE, MOMENTUM = 30.0, 1.0, 0.9
SMOOTHING = 5.0  # texts, shared between the classes in proportion to their size
_SLICE = 1 << 18
_PARTS = 8
_FEATURES = 1 << 20  # that a step handles at a time


def features(text: str | None, orders=ORDERS, bits: int = BITS) -> Iterator[np.ndarray]:
    """Hashed n-grams of the lower-cased text with a space on both sides, in slices of bounded size."""
    points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    longest = max(orders)
    for at in range(0, max(1, len(points)), _SLICE):
        part = points[at : at + _SLICE + longest - 1].astype(np.uint64)
        code, found = part.copy(), []
        for n in range(2, longest + 1):
            if len(part) < n:
                break
            code = code[:-1] * np.uint64(0x100000001B3) + part[n - 1 :]
            if n in orders:
                own = code[:_SLICE]
                found.append((((own ^ (own >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15 + 2 * n)) >> np.uint64(64 - bits)).astype(np.int32))
        if found:
            yield np.concatenate(found)


def present(text: str | None, orders=ORDERS, bits: int = BITS) -> np.ndarray:
    """The distinct features of a whole text, in order."""
    seen = np.zeros(1 << bits, bool)
    for found in features(text, orders, bits):
        seen[found] = True
    return np.flatnonzero(seen).astype(np.int32)


def _chance(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


@dataclass
class Model:
    weights: np.ndarray  # scale times learnt weight
    bias: float
    orders: tuple[int, ...] = ORDERS
    bits: int = BITS

    def margin(self, found: np.ndarray) -> float:
        return self.bias + float(self.weights[found].sum()) / max(1, len(found)) ** 0.5

    def score(self, text: str | None) -> float:
        return round(_chance(self.margin(present(text, self.orders, self.bits))), 6)


def held_out(doc_id: Column) -> Column:
    """Every fifth document by crc32 of the id as text is never learnt from. A null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``(text, toxic)`` of at most ``max_rows`` learnable documents of each class, with whole texts.

    Labels without id or mark are not used; repeated labels of a document are joined by the larger mark."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    known = marks.where(~held_out(F.col("doc_id"))).join(docs.select("doc_id").distinct(), "doc_id")
    known = written(known, "toxic_marks")
    chosen = [
        known.where(F.col("toxic") == kind).orderBy(F.md5(F.concat(F.lit("toxic"), F.col("doc_id").cast("string"))), "doc_id").limit(max_rows)
        for kind in (False, True)
    ]
    ids = written(chosen[0].unionByName(chosen[1]), "toxic_ids")  # at most 2 * max_rows narrow rows
    texts = docs.select("doc_id", "text").join(ids, "doc_id").repartition(_PARTS, "doc_id").sortWithinPartitions("doc_id", "text")
    return texts.select("text", F.col("toxic").cast("int").alias("toxic"))


def _pack(orders, bits: int):
    schema = pa.schema([("found", pa.binary()), ("toxic", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = Sink(schema)
        for text, toxic in rows(batches, "text", "toxic"):
            packed = present(text, orders, bits).tobytes()
            sink.add(packed, toxic, size=len(packed) + 32)
            if sink.full():
                yield from sink.flush()
        yield from sink.flush()

    return run


def fit(texts: list[np.ndarray], toxic: np.ndarray, bits: int = BITS, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights (scale times learnt weight) and bias from the features and classes (0 or 1) of texts of both classes."""
    size, n = 1 << bits, np.bincount(toxic, minlength=2).astype(np.float64)
    lengths = np.array([len(t) for t in texts])
    norm, share = np.maximum(lengths, 1) ** -0.5, (0.5 / n)[toxic]
    cuts = np.searchsorted(np.cumsum(lengths), np.arange(_FEATURES, lengths.sum() + _FEATURES, _FEATURES), "right")
    slices = [(a, b) for a, b in zip([0, *cuts], [*cuts, len(texts)]) if a < b]

    def totals(values: np.ndarray, a: int, b: int) -> np.ndarray:
        return np.bincount(np.concatenate(texts[a:b]), weights=np.repeat(values[a:b], lengths[a:b]), minlength=size)

    counts = np.stack([sum(totals((toxic == kind).astype(np.float64), a, b) for a, b in slices) for kind in (0, 1)])
    extra = SMOOTHING * n / n.mean()
    shares = (counts + extra[:, None]) / (n + 2 * extra)[:, None]
    ratio = np.log(shares[1] / shares[0])
    learnt, bias, pace, side_pace = np.zeros(size), 0.0, np.zeros(size), 0.0
    for _ in range(steps):
        weights, total, side = ratio * learnt, np.zeros(size), 0.0
        for a, b in slices:
            sums = np.add.reduceat(np.append(weights[np.concatenate(texts[a:b])], 0.0), np.cumsum(lengths[a:b]) - lengths[a:b])
            margin = bias + np.where(lengths[a:b] > 0, sums, 0.0) * norm[a:b]
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - toxic[a:b]) * share[a:b]
            whole = np.zeros(len(texts))
            whole[a:b] = error * norm[a:b]
            total += totals(whole, a, b)
            side += float(error.sum())
        pace = MOMENTUM * pace + ratio * total
        side_pace = MOMENTUM * side_pace + side
        learnt = learnt - RATE * pace
        bias -= BIAS_RATE * side_pace
    return ratio * learnt, bias


def _fit_rows(bits: int, steps: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = sorted(rows(batches, "toxic", "found"))  # the order of sums, and so the result, does not hang on files
        toxic, texts = np.array([t for t, _ in sample], np.int64), [np.frombuffer(f, np.int32) for _, f in sample]
        n = np.bincount(toxic, minlength=2)
        if n.all():
            weights, bias = fit(texts, toxic, bits, steps)
        else:
            weights, bias = np.zeros(1 << bits), float(np.log((n[1] + 1) / (n[0] + 1)))
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()]), pa.array([bias])], names=["weights", "bias"])

    return run


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, orders=ORDERS, bits: int = BITS, steps: int = STEPS) -> Model:
    """Fit on at most ``max_rows`` labelled documents of each class, none of them held out; both weigh the same.

    Without a labelled text of both classes the model is a constant: the smoothed share of toxic texts. One task holds the
    bounded sample, of each text at most 2**bits distinct features; the driver gets one vector of 2**bits weights.
    """
    packed = training_sample(docs, labels, max_rows).mapInArrow(_pack(orders, bits), "found binary, toxic int")
    sample = written(packed, "toxic_sample")
    got = sample.coalesce(1).mapInArrow(_fit_rows(bits, steps), "weights binary, bias double").collect()
    if not got:  # no sample, no partition
        return Model(np.zeros(1 << bits), 0.0, tuple(orders), bits)
    return Model(np.frombuffer(got[0]["weights"]), got[0]["bias"], tuple(orders), bits)


def _score_rows(model, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.value.score(text) for (text,) in rows([batch], "text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(scores, pa.float64())], names=[*kept, "score"])

    return run


def scored(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``(row, score)``: the kept columns of each row as a struct, and the score of its whole text (null: empty)."""
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits weights
    schema = T.StructType([frame.schema["row"], T.StructField("score", T.DoubleType())])
    return frame.mapInArrow(_score_rows(shared, ["row"]), schema)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per input row, whatever its other columns."""
    out = scored(docs, model, ["doc_id"]).select("row.doc_id", "score")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` with a score below 0.5, with all their columns."""
    return scored(docs, model, docs.columns).where("score < 0.5").select("row.*")
