"""Chats, URLs, personal data, mixing, toxicity and neighbours on edge cases, against plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairforge.llm import ann_pstable, chat_format, fair_mix, pii_bootstrap, toxicity_nb, url_vocab

CHATS = "conv_id long, turn long, role string, text string, formatted string"
ODD = ["", "<|im_end|>", "<|im_start|>assistant ok", "\\", "<\\|", "<|", "<\\\\|im_next|>", "a<", "|>", "x\ny\n", "漢字 é", "<|im_next|>\\<|"]


def test_chats_round_trip(table):
    rng, rows = random.Random(1), []
    for conv in range(30):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "od\nd<|im_end|>", None]), rng.choice([None, *ODD]), "clash"))
    rows += [(None, 1, "user", "hi", ""), (40, None, "assistant", "first", ""), (40, 1, "assistant", "b", ""), (40, 1, "assistant", "a", ""), (40, 1, "assistant", "a", "")]
    rows.append((41, 0, "assistant", "long " * 50_000, ""))
    want = {}
    for conv, turn, role, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    chats = chat_format.format_chats(table(rows, CHATS))
    read = chats.select(
        "conv_id", "formatted", chat_format.read_back(F.col("formatted")).alias("turns"),
        chat_format.loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss"),
    )
    got = {r["conv_id"]: r for r in read.collect()}
    assert set(got) == set(want)
    for conv, turns in want.items():
        r = got[conv]
        split_role = [role.split("\n")[0] for role, _ in turns]
        if all(role == s for (role, _), s in zip(turns, split_role)):
            assert [tuple(t) for t in r["turns"]] == turns
        assert r["loss"] == "".join(t for role, t in turns if role == "assistant")
    assert got[40]["formatted"].count("<|im_start|>") == 1  # merged
    assert chat_format.chat_digest(chat_format.format_chats(table([], CHATS))).collect() == []


def test_urls(table):
    urls = [
        ("https://A.Example.ORG/es/x?q", "a.example.org", "/es/x", "example.org/es/", "block"),
        ("https://example.org/en/1", "example.org", "/en/1", "example.org/en/1", "block"),
        ("https://myexample.org/es/", "myexample.org", "/es/", "org/", "allow"),
        ("http://x.com/fr/casino", "x.com", "/fr/casino", "com/fr/", "allow"),
        ("http://com/de/", "com", "/de/", "com/de/", "block"),
        ("http://x.com/FR/", "x.com", "/FR/", None, "allow"),
        ("http://casino-win.net/", "casino-win.net", "/", None, "block"),
        ("http://casinos.net/", "casinos.net", "/", None, "allow"),
        ("http://cheap.net/pills", "cheap.net", "/pills", None, "block"),
        ("http://cheap.net/cheap-cheap", "cheap.net", "/cheap-cheap", None, "allow"),
        ("http://x.net?free=1#win", "x.net", "", None, "block"),
        ("nothing://", "", "", None, "allow"),
        ("a.org/x", "", "", None, "allow"),
        ("http://a.org", "a.org", "", None, "allow"),
        ("x://y://z/q", "y:", "//z/q", None, "allow"),
        ("http://x.net/" + "a" * 200_000, "x.net", "/" + "a" * 200_000, None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    rows = [(i, u, "clash") for i, (u, *_) in enumerate(urls)] + [(3, urls[3][0], "again"), (None, None, None)]
    out = url_vocab.judge_urls(table(rows, "page_id long, url string, host string"))
    got = sorted((tuple(r)[:5] for r in out.collect()), key=str)
    want = [(i, *rest) for i, (_, *rest) in enumerate(urls)] + [(3, *urls[3][1:]), (None, "", "", None, "allow")]
    assert got == sorted(want, key=str)
    assert url_vocab.judge_urls(table([], "page_id long, url string")).collect() == []


# personal data

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    def good(kind, match):
        digits = re.sub(r"[^0-9]", "", match)
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "card":
            total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
            return 13 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return [(k, *m.span()) for k, (_, r) in enumerate(PLAIN.items()) for m in r.finditer(text) if good(list(PLAIN)[k], m.group())]


def test_base_spans_match_the_expressions():
    rng = random.Random(4)
    pieces = ["a", "Z9", "@", ".", "..", "b.c", "-", "_", "%", "+", "+1", " ", "(", ")", "1.2.3.4", "255", "256", "0001", "é", "4111 1111 1111 1111",
              "4111-1111-1111-1112", "+1 (212) 555-0100", "\n", "x@y.z", "@@", "12", "3", "１"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert pii_bootstrap.base_spans(text) == plain_spans(text), text
    long = "a" * 300_000 + "9" * 300_000 + "." * 1000
    assert pii_bootstrap.base_spans(long) == []


def test_patterns_find_unseen_identifiers(table):
    texts = [f"please write to user{i}@mail.example.com today" for i in range(8)] + ["please write to agent-0047x today"]
    texts += [f"the serial{i}2345 is a part" for i in range(8)] + [None, ""]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(0, texts[0], "again"), (None, texts[8], "")]
    out = pii_bootstrap.personal_digest(pii_bootstrap.find_personal(table(rows, "doc_id long, text string, base string")))
    got = {(r["doc_id"], r["spans"]): r for r in out.collect()}
    assert (8, "id:16:27") in got and (None, "id:16:27") in got
    assert sum(r["n_found"] for r in got.values()) == 2
    assert Counter(r["doc_id"] for r in out.collect())[0] == 2
    assert got[(0, "email:16:38")]["n_email"] == 1
    assert pii_bootstrap.find_personal(table([], "doc_id long, text string")).collect() == []


def test_every_base_span_is_a_seed(table):
    names = ["jane.doe", "joe", "ann.lee", "max", "eve.adams"]
    seeds = [f"her inbox {n}@example.com is full" for n in names]
    seeds += [f"please ring +1 555 123 456{i} at noon" for i in range(5)]
    seeds += [f"was charged {c} twice" for c in ("4111 1111 1111 1111", "5500 0000 0000 0004", "3400 0000 0000 009", "6011 0000 0000 0004", "3088 0000 0000 0009")]
    seeds += [f"set mailto={n}@example.org here" for n in names]
    unseen = ["her inbox agent-0047x is full", "please ring desk-0047x at noon", "was charged acct-0047x twice", "use mailto=agent-0047x here"]
    rows = list(enumerate(seeds + unseen))
    got = {r["doc_id"]: r for r in pii_bootstrap.find_personal(table(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        assert len(got[i]["base"]) == (i < len(seeds)), text
        assert [text[s["start"] : s["stop"]].endswith("-0047x") for s in got[i]["found"]] == [True] * (i >= len(seeds)), text


def test_seeds_of_one_run_share_its_patterns():
    text = "see net=1.2.3.4/5.6.7.8 and +4222 222 222 222 or mailto:a.b@c.de"
    got = list(pii_bootstrap.candidates(text, pii_bootstrap.base_spans(text)))
    assert [(t, seed, p[-1]) for t, _, _, seed, p in got] == [
        ("1.2.3.4", True, "= net="), ("5.6.7.8", True, "= net="), ("+4222 222 222 222", True, "2 net and"), ("a.b@c.de", True, "= mailto:")
    ]


# mixing

DOCS = "doc_id long, text string, source string, size string"


def test_targets(table):
    sizes = [("b", 100), ("a", 10), (None, 500), ("c", 0), ("é", 90)]
    got = {r["source"]: r["target"] for r in fair_mix.source_targets(table(sizes, "source string, source_size long")).collect()}
    # a: weight 5, cap 30; b: 2; c: 1, nothing; é: 5, cap 270; null: 2. 700 in all
    assert got["a"] == 30 and got["c"] == 0 and got["é"] == 270
    assert got["b"] == got[None] == 200
    assert sum(got.values()) == 700


def test_mix(table):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(1, 30)), rng.choice(["a", "a", "a", "b", "c", None]), "x") for i in range(900)]
    rows += [(900, None, "a", ""), (901, "", "only empty", ""), (902, " \n\t", "b", ""), (5, rows[5][1], rows[5][2], ""), (None, "x y", "c", "")]
    docs = table(rows, DOCS)
    out = fair_mix.mix(docs)
    assert out.columns == ["doc_id", "text", "source", "size", "source_size", "target", "taken"]
    got = [r.asDict() for r in out.collect()]
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    total = sum(r["size"] for r in got)
    taken, target = Counter(), {}
    for r in got:
        assert r["size"] == len((r["text"] or "").split()) and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert abs(sum(target.values()) - total) < 1e-6
    assert all(abs(taken[s] - t) <= 60 for s, t in target.items())
    assert total - 60 <= sum(taken.values()) <= total
    again = fair_mix.mix_plan(docs.repartition(7), bucket_rows=10)  # other buckets, same mix
    assert sorted((r["doc_id"] or -1, r["taken"]) for r in again.collect()) == sorted((r["doc_id"] or -1, r["taken"]) for r in got)
    assert fair_mix.mix(table([], DOCS)).collect() == []


# toxicity


def test_toxicity(table):
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    rows, marks = [], []
    for i in range(600):
        words, toxic = [rng.choice(vocab) for _ in range(rng.randint(10, 80))], i % 3 == 0
        if toxic:
            words[rng.randrange(len(words))] = "zorkly" + rng.choice("xyz")
            words[rng.randrange(len(words))] = "zork"
        rows.append((i, " ".join(words), "en", 1.0))
        marks.append((i, int(toxic), 0))
    rows += [(700, None, None, None), (701, "", None, None), (None, "zork " * 60_000, None, None), (0, rows[0][1], "en", 1.0)]
    marks += [(None, 1, 1), (5, None, 1), (5, 0, 0), (9999, 1, 1)]
    docs, labels = table(rows, "doc_id long, text string, lang string, score double"), table(marks, "doc_id long, toxic int, quality int")
    model = toxicity_nb.train(docs, labels)
    got = toxicity_nb.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 600]
    assert len(held) > 80
    assert sum(r["predicted"] == (r["doc_id"] % 3 == 0) for r in held) >= 0.97 * len(held)
    kept = toxicity_nb.remove_toxic(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(1 - r["predicted"] for r in got)
    assert {700, 701} <= {r["doc_id"] for r in kept.collect()}


def test_toxicity_without_labels(table):
    docs = table([(1, "a"), (2, None)], "doc_id long, text string")
    model = toxicity_nb.train(docs, table([], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity_nb.score(docs, model).collect()} == {0.5}
    assert toxicity_nb.score(docs.limit(0), model).collect() == []


# nearest neighbours

VECTORS = "vec_id long, embedding array<double>, score string"


def brute_nearest(rows, ids, k):
    usable = {}
    for i, v, *_ in rows:
        if i is not None and v and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[i] = np.array(v)
    out = {}
    for q in ids:
        if q in usable:
            near = sorted((float(np.sqrt(((usable[q] - v) ** 2).sum())), i) for i, v in usable.items() if i != q)
            out[q] = near[:k]
    return out


def test_neighbours(table):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 16)) * 3
    rows = [(i, (centres[i % 8] + rng.normal(size=16)).tolist(), "x") for i in range(900)]
    rows += [(1000 + i, rows[0][1], "") for i in range(200)]  # copies of one vector
    rows += [(2000, None, ""), (2001, [0.0] * 16, ""), (2002, [None] * 16, ""), (2003, [float("nan")] * 16, ""), (2004, [1.0] * 3, ""),
             (2005, [float("inf")] * 16, ""), (2006, [], ""), (None, rows[0][1], ""), rows[7]]
    df = table(rows, VECTORS)
    ids = [r[0] for r in rows if r[0] is not None and (r[0] % 20 == 0 or r[0] >= 2000)]
    got = {}
    for r in ann_pstable.nearest(df, df.where("vec_id % 20 = 0 or vec_id >= 2000")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute_nearest(rows, ids, 10)
    assert set(got) == set(want)
    hits = 0
    for q, near in want.items():
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1)) and q not in [m[1] for m in mine]
        hits += len({i for _, i in near} & {m[1] for m in mine})
        if q == 0 or q >= 1000:
            assert [m[1] for m in mine] == [i for _, i in near]  # ties to the smaller id
    assert hits >= 0.95 * sum(map(len, want.values()))


def test_neighbours_with_ties_and_few_rows(table):
    grid = [(i, [float(i % 3), float(i // 3), 1.0], "") for i in range(9)]
    got = ann_pstable.nearest(table(grid, VECTORS), table([(4,)], "vec_id long"), k=4)
    assert [(r["rank"], r["vec_id"]) for r in got.orderBy("rank").collect()] == [(1, 1), (2, 3), (3, 5), (4, 7)]
    got = ann_pstable.nearest(table(grid[:3], VECTORS), table([(0,), (77,)], "vec_id long"))
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in got.orderBy("rank").collect()] == [(0, 1, 1.0), (0, 2, 2.0)]
    assert ann_pstable.nearest(table([], VECTORS), table([], "vec_id long")).collect() == []


@pytest.mark.parametrize("kind", ["clusters", "far", "lognormal"])
def test_neighbours_of_mixed_density(table, kind):
    rng = np.random.default_rng(11)
    n = 3000
    points = rng.normal(size=(n, 16))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    if kind == "clusters":  # 60 % in tight clusters
        tight = rng.random(n) < 0.6
        points[tight] = points[rng.integers(0, 20, tight.sum())] + rng.normal(size=(tight.sum(), 16)) * 0.02
    elif kind == "far":
        points[rng.random(n) < 0.05] *= 10
    else:
        points *= rng.lognormal(size=(n, 1))
    rows = [(i, v.tolist(), "") for i, v in enumerate(points)]
    df = table(rows, VECTORS)
    got = {}
    for r in ann_pstable.nearest(df, df.where("vec_id % 15 = 0")).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = []
    for q in range(0, n, 15):
        apart = np.sqrt(((points - points[q]) ** 2).sum(1))
        apart[q] = np.inf
        assert len(got[q]) == 10
        recall.append(len(got[q] & set(np.argsort(apart, kind="stable")[:10].tolist())) / 10)
    assert np.mean(recall) >= 0.95 and min(recall) >= 0.5, (np.mean(recall), min(recall))


def test_ids_with_several_vectors(table):
    rng = np.random.default_rng(12)
    rows = [(int(rng.integers(0, 150)), rng.normal(size=6).tolist(), "") for _ in range(600)]
    rows += [(200, [x + 0.001 * i for x in rows[0][1]], "") for i in range(40)] + [(i, rows[0][1], "") for i in range(300, 305)]
    df = table(rows + rows[:5], VECTORS)
    got = {}
    for r in ann_pstable.nearest(df, df).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    ids, points = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    hits = 0
    for q in sorted(set(ids.tolist())):
        apart = np.sqrt(((points[ids == q][:, None] - points[None]) ** 2).sum(2)).min(0)
        least = {i: float(apart[ids == i].min()) for i in set(ids.tolist()) if i != q}
        assert sorted(got[q]) == list(range(1, 11)) and len({i for i, _ in got[q].values()}) == 10
        want = sorted(least, key=lambda i: (least[i], i))[:10]
        hits += len(set(want) & {i for i, s in got[q].values() if abs(s - least[i]) < 1e-9})
    assert hits >= 0.95 * 10 * len(got)


def test_probes_follow_the_estimated_success():
    hashing = ann_pstable.Hashing(np.zeros((1, 2, 3)), np.zeros((1, 3)), 1.0, 0.7, np.ones(3, np.uint64), 0.95)
    place = np.array([0.2, 0.5, 0.9])
    cells = hashing.probes(place)
    normal = ann_pstable._normal
    chance = [np.prod(normal((c + 1 - place) / 0.7) - normal((c - place) / 0.7)) for c in cells]
    assert len({tuple(c) for c in cells}) == len(cells)
    assert all(a >= b - 1e-12 for a, b in zip(chance, chance[1:]))
    assert 0.95 <= sum(chance) < 0.95 + chance[-1] + 1e-9


@pytest.mark.parametrize("name", ["op1_multiprobe_search"])
def test_recall_on_the_table(spark, sf_dir, name):
    from pairforge.llm import queries

    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in queries.table(spark, sf_dir, "embeddings").collect()]
    got = {}
    for r in queries.QUERIES[name](spark, sf_dir).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    vectors = np.array([v for _, v in rows])
    hits = total = 0
    for q in (i for i, _ in rows if i % 100 == 0):
        apart = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        apart[q] = np.inf
        true = set(np.argsort(apart, kind="stable")[:10].tolist())
        hits, total = hits + len(true & got[q]), total + 10
    assert hits >= 0.9 * total


def test_roles_with_line_feeds_and_control_strings_come_back(table):
    """The turns themselves, not their digest, which joins role and text by a line feed."""
    from pairforge.llm import chat_format

    odd = ["user\nx", "\n", "<\n", "<\\n", "\\n", "\\", "<|im_end|>", "<\\|", "<\\\\n|", "a\n\nb", "assistant", "", "<", "<<\n|"]
    rows = [(7, i, role, text) for i, (role, text) in enumerate((r, t) for r in odd for t in ("hello", "\nx", "<|im_start|>\\", ""))]
    chats = chat_format.format_chats(table(rows, "conv_id long, turn long, role string, text string"))
    back = chats.select(chat_format.read_back(F.col("formatted")).alias("t")).first()["t"]
    assert [(r["role"], r["text"]) for r in back] == [(role, text) for _, _, role, text in rows]


def plain_toxicity(texts, toxic, bits=12, steps=30):
    """Dense rows, one gradient step after the other: scores of all texts."""
    grams = [{sum_ for part in toxicity_nb.features(t, bits=bits) for sum_ in part.tolist()} for t in texts]
    x = np.zeros((len(texts), 1 << bits))
    for i, g in enumerate(grams):
        x[i, list(g)] = 1
    y = np.array(toxic, float)
    n = np.array([(y == 0).sum(), (y == 1).sum()], float)
    extra = 5.0 * n / n.mean()
    shares = [(x[y == k].sum(0) + extra[k]) / (n[k] + 2 * extra[k]) for k in (0, 1)]
    ratio = np.log(shares[1] / shares[0])
    scaled = x * ratio / np.sqrt(np.maximum(x.sum(1), 1))[:, None]
    weight, bias, pace, side = np.zeros(1 << bits), 0.0, np.zeros(1 << bits), 0.0
    for _ in range(steps):
        error = (1 / (1 + np.exp(-(scaled @ weight + bias))) - y) * np.where(y == 1, 0.5 / n[1], 0.5 / n[0])
        pace, side = 0.9 * pace + scaled.T @ error, 0.9 * side + error.sum()
        weight, bias = weight - 30.0 * pace, bias - side
    return 1 / (1 + np.exp(-(scaled @ weight + bias)))


@pytest.mark.parametrize("slice_size", [50, 1 << 20])
def test_toxicity_scores_equal_plain_gradient_steps(table, monkeypatch, slice_size):
    monkeypatch.setattr(toxicity_nb, "_FEATURES", slice_size)
    rng = random.Random(12)
    vocab = ["".join(rng.choice("abcdeé漢") for _ in range(rng.randint(2, 6))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(vocab[: 40 if i % 3 else 60]) for _ in range(rng.randint(0, 30)))) for i in range(90)]
    marks = [(i, int(i % 3 == 0)) for i in range(90)]
    import zlib

    learnt = [i for i in range(90) if zlib.crc32(str(i).encode()) % 5]
    docs = table(rows, "doc_id long, text string")
    model = toxicity_nb.train(docs, table(marks, "doc_id long, toxic int"), bits=12)
    got = {r["doc_id"]: r["score"] for r in toxicity_nb.score(docs, model).collect()}
    want = plain_toxicity([rows[i][1] for i in learnt], [marks[i][1] for i in learnt])
    assert all(abs(got[i] - s) < 2e-6 for i, s in zip(learnt, want))


def test_toxicity_of_held_out_documents(spark):
    """Accuracy on the documents that are never learnt from, on a given table."""
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    got = {r["doc_id"]: r["predicted"] for r in toxicity_nb.score(docs, toxicity_nb.train(docs, labels)).where("held_out").collect()}
    marks = [(got[r["doc_id"]], r["toxic"]) for r in labels.collect() if r["doc_id"] in got]
    assert len(marks) > 50 and sum(p == t for p, t in marks) >= 0.9 * len(marks)
