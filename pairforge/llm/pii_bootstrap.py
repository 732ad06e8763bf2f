"""Personal data by fixed expressions and bootstrapped contextual patterns.

Emails, addresses, card and phone numbers with a fixed form are the seeds, whatever characters they hold. They and every
other token that looks like an identifier (six characters or more, a digit among them) stand in lexical patterns: the
word before it, the two words before it, and the leading letters with a ``=`` or ``:`` inside or before it. Patterns and tokens form a graph, weighted by the number of
occurrences of an edge. Spark scores it in turns: a pattern by the share of its weight that goes to good tokens, a token
by the share of its weight that comes from good patterns; seeds keep score 1. Patterns above a threshold with enough
distinct tokens then give the tokens that no fixed expression finds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.llm.words import Sink, rows
from pairforge.session import written

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"
ROUNDS = 3
MIN_SCORE = 0.6
MIN_INSTANCES = 3
SMOOTHING = 2.0

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[A-Za-z0-9_@./:=+#-]{6,}")
_TOKEN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_@./:=+#-")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]+")
_KEY = re.compile(r"[A-Za-z_]+[=:]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each ``@`` outwards so that long words cost no retries."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four parts at a time of each maximal dotted run of numbers; a match with a part above 255 is dropped."""
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        start = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            stop = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                yield start, stop
            start = stop + 1


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("+")
    if at < 0:
        return
    for m in _PHONE.finditer(text, at):
        if 9 <= len(_DIGIT.findall(m.group())) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` in code points, by kind as in ``KINDS``, then start."""
    return [(k, a, b) for k, find in enumerate((emails, addresses, cards, phones)) for a, b in find(text)]


def _before(text: str, start: int) -> list[str]:
    """Up to two lower-cased words that end before ``start`` in the 60 characters before it."""
    return [w.lower() for w in _WORD.findall(text, max(0, start - 60), start)[-2:]]


def _patterns(text: str, start: int) -> list[str]:
    """Patterns of what stands in the unbroken run of token characters that begins at ``start``."""
    words = _before(text, start)
    patterns = [f"1 {words[-1]}"] if words else []
    if len(words) == 2:
        patterns.append(f"2 {words[0]} {words[1]}")
    if key := _KEY.match(text, start):
        patterns.append(f"= {key.group().lower()}")
    return patterns


def candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int, bool, list[str]]]:
    """Instances: text, start, end, whether it is a seed, and its patterns. The seeds are the base spans, overlapping
    ones as one; the others are the identifier-like tokens that touch no base span."""
    seeds: list[tuple[int, int]] = []
    for a, b in sorted((a, b) for _, a, b in base):
        if seeds and a < seeds[-1][1]:
            seeds[-1] = (seeds[-1][0], max(b, seeds[-1][1]))
        else:
            seeds.append((a, b))
    last, run, patterns = 0, -1, []
    for start, stop in seeds:
        at = start
        while at > last and text[at - 1] in _TOKEN_CHARS:
            at -= 1
        if at > last or run < 0:  # else the run goes on from the last seed
            run, patterns = at, _patterns(text, at)
        last = start
        yield text[start:stop], start, stop, True, patterns
    i = 0
    for m in _TOKEN.finditer(text):
        token = m.group().rstrip(".:/=+#-")
        if len(token) < 6 or not _DIGIT.search(token):
            continue
        start, stop = m.start(), m.start() + len(token)
        while i < len(seeds) and seeds[i][1] <= start:
            i += 1
        if i == len(seeds) or seeds[i][0] >= stop:
            yield token, start, stop, False, _patterns(text, start)


_CANDIDATE = "struct<token:string,start:int,stop:int,seed:boolean,patterns:array<string>>"
_SPAN = "struct<kind:int,start:int,stop:int>"


def _span_rows():
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])
    candidate = pa.struct([("token", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("seed", pa.bool_()), ("patterns", pa.list_(pa.string()))])
    schema = pa.schema([("doc_id", pa.int64()), ("base", pa.list_(span)), ("tokens", pa.list_(candidate))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = Sink(schema)
        for doc, text in rows(batches, "doc_id", "text"):
            text = text or ""
            base = base_spans(text) if _DIGIT.search(text) or "@" in text else []
            tokens = [dict(zip(("token", "start", "stop", "seed", "patterns"), c)) for c in candidates(text, base)] if base or _DIGIT.search(text) else []
            sink.add(doc, [dict(zip(("kind", "start", "stop"), s)) for s in base], tokens, size=64 + 64 * len(base) + sum(256 + len(t["token"]) for t in tokens))
            if sink.full():
                yield from sink.flush()
        yield from sink.flush()

    return run


def score_patterns(uses: DataFrame, rounds: int = ROUNDS, smoothing: float = SMOOTHING) -> DataFrame:
    """``(pattern, score, instances)`` from ``uses(pattern, token, seed, n)``: ``instances`` counts distinct seeds.

    ``n`` is the number of occurrences of an edge; a token is a seed where any of its uses is one."""
    seeds = uses.groupBy("token").agg(F.max("seed").alias("seed"))
    graph = written(uses.groupBy("pattern", "token").agg(F.sum("n").alias("n")).join(seeds, "token"), "pii_graph")
    tokens = graph.select("pattern", "token", "n", "seed", F.col("seed").cast("double").alias("good"))
    for turn in range(rounds):
        patterns = tokens.groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("good")) / (F.sum("n") + smoothing)).alias("score"), F.sum(F.col("seed").cast("long")).alias("instances")
        )
        patterns = written(patterns, f"pii_patterns_{turn}")
        if turn + 1 < rounds:
            back = graph.join(patterns.select("pattern", "score"), "pattern")
            support = back.groupBy("token").agg((F.sum(F.col("n") * F.col("score")) / F.sum("n")).alias("support"))
            tokens = graph.join(support, "token").select(
                "pattern", "token", "n", "seed", F.when(F.col("seed"), F.lit(1.0)).otherwise(F.col("support")).alias("good")
            )
    return patterns


def find_personal(
    docs: DataFrame,
    rounds: int = ROUNDS,
    min_score: float = MIN_SCORE,
    min_instances: int = MIN_INSTANCES,
) -> DataFrame:
    """``(doc_id, base, found)``: arrays of ``struct<kind, start, stop>``, in code points.

    ``base`` holds the spans of the fixed expressions, by kind as in ``KINDS`` and start; ``found`` the tokens that
    accepted patterns add, none of which touches a base span. One row per input row; null and empty texts have no
    spans. Rows that share an id are scanned one by one. Other columns are ignored.
    """
    scanned = docs.select("doc_id", "text").mapInArrow(_span_rows(), f"doc_id long, base array<{_SPAN}>, tokens array<{_CANDIDATE}>")
    scanned = written(scanned.withColumn("row", F.monotonically_increasing_id()), "pii_scan")
    tokens = scanned.select("row", F.explode("tokens").alias("t")).select("row", "t.*")
    uses = tokens.select("row", "token", "seed", F.explode("patterns").alias("pattern")).groupBy("pattern", "token").agg(
        F.max("seed").alias("seed"), F.count(F.lit(1)).alias("n")
    )
    accepted = score_patterns(uses, rounds).where((F.col("score") >= min_score) & (F.col("instances") >= min_instances)).select("pattern")
    fresh = tokens.where("not seed").select("row", "start", "stop", F.explode("patterns").alias("pattern"))
    found = fresh.join(accepted, "pattern").groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct(F.lit(len(KINDS)).alias("kind"), "start", "stop"))).alias("found")
    )
    return scanned.join(found, "row", "left").select("doc_id", "base", F.coalesce("found", F.array().cast(f"array<{_SPAN}>")).alias("found"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in (*KINDS, FOUND)])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"])), ",")


def personal_digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone`` (base spans), ``base_sha256``, ``spans`` (base, then found), ``n_found``."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.concat("base", "found")).alias("spans"), F.size("found").cast("long").alias("n_found"),
    )
