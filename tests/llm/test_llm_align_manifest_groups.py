"""Token alignment, Merkle manifest and token groups against plain Python."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from pairforge.llm import merkle_manifest, queries, token_align, token_groups
from test_llm_texts import WORDS, passages

DIR = "/root/testdata/sf0.001"
FOLDER = token_align.FOLDER
DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, count string"  # the last two clash


# --- token alignment -------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def coders():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(f"{FOLDER}/{token_align.BYTE_BPE}")
    plain.encode_special_tokens = True
    byte, piece = (c(open(f"{FOLDER}/{n}", "rb").read()) for c, n in ((token_align.ByteBpe, token_align.BYTE_BPE), (token_align.PieceBpe, token_align.PIECE_BPE)))
    return plain, byte, piece


def brute_align(coders, rows):
    plain, byte, piece = coders
    found, held = [], Counter()
    for doc, text in rows:
        a = plain.encode(" " + text, add_special_tokens=False).ids if text else []
        b = piece.encode(text) if text else []
        wanted = (" " + (text or "")).encode()
        if any(b"".join(c.bytes[i] for i in x) != wanted for c, x in ((byte, a), (piece, b))):
            a = b = []
        ends = [dict(zip(np.cumsum([len(c.bytes[i]) for i in x], dtype=int).tolist(), range(1, len(x) + 1))) for c, x in ((byte, a), (piece, b))]
        groups, p, q = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            groups.append((a[p : ends[0][end]], b[q : ends[1][end]]))
            p, q = ends[0][end], ends[1][end]
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        held.update(set(links))
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        found.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest() if a else "", text))
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return sorted(
        ((doc, na, nb, ng, sum(links.values()), sum(n for (x, y), n in links.items() if held[x, y] == most[x]),
          sum(n * held[p] for p, n in links.items()), sha, text) for doc, na, nb, ng, links, sha, text in found), key=str)


def odd_texts():
    rng = random.Random(3)
    letters = "aaab  \n\t.,'0123éß漢字🙂▁ "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts += [None, "", " ", "<|endoftext|> </s> <s>", "it's  two", "a" * 5000, "▁", "\x00x", "x" * 3 + " " * 3000 + "y", "漢" * 2000, "same text", "same text"]
    texts += ["".join(rng.choice("0123456789abcdef") for _ in range(20_000))]
    return [(i if i % 9 else None, t) for i, t in enumerate(texts)] + [(5, "same text"), (5, "other text")]


@pytest.mark.parametrize("block", [1, 3000, token_align.BLOCK_BYTES])
def test_alignment_matches_brute_force(table, coders, block):
    rows = odd_texts()
    docs = table([(i, None, "x", 1, t, "leaf", "9") for i, t in rows], DOCS)
    out = token_align.align(docs, block_bytes=block)
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == brute_align(coders, rows)
    assert sum(r[1] == 0 for r in got) > 5  # texts that do not come back
    assert token_align.align(docs.limit(0)).collect() == []


def test_alignment_query(spark, coders):
    rows = [tuple(r) for r in queries.table(spark, DIR, "documents").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.QUERIES["op11_token_align"](spark, DIR).collect()), key=str)
    assert got == sorted((r[:-1] for r in brute_align(coders, rows)), key=str)


def test_large_groups_are_multiplied_as_counts(monkeypatch):
    block = token_align._Block()
    a, b, n = np.array([1, 2, 1, 3, 4]), np.array([7, 7, 8, 9]), (np.array([4, 1]), np.array([3, 1]))
    whole = block.links(a, b, *n, np.array([0, 1]))
    monkeypatch.setattr(token_align, "GROUP_LINKS", 2)
    cut = block.links(a, b, *n, np.array([0, 1]))
    assert [x.tolist() for x in whole] == [x.tolist() for x in cut]
    assert sum(whole[1].tolist()) == 13


def test_galloping_intersection():
    rng = np.random.default_rng(1)
    for n, m in ((0, 5), (1, 1), (3, 1000), (1000, 900), (500, 20), (64, 64)):
        a, b = (np.sort(rng.choice(2000, k, replace=False)) for k in (n, m))
        at, to = token_align.common_ends(a, b)
        assert a[at].tolist() == b[to].tolist() == np.intersect1d(a, b).tolist()


def test_byte_encoder_equals_the_file_for_every_character(coders):
    plain, byte, _ = coders
    for at in range(0, 0x110000, 1 << 16):
        texts = [f"a{c}b {c}1{c} {c}{c}." for c in map(chr, range(at, at + (1 << 16), 1 if at < 0x30000 else 97)) if not 0xD800 <= ord(c) < 0xE000]
        for text, found in zip(texts, plain.encode_batch([" " + t for t in texts], add_special_tokens=False)):
            assert found.ids == byte.encode(text)


# --- Merkle manifest -------------------------------------------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    encoded = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: H(*[encoded(v) for v in (*r[:4], text)])

    def tree(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([H(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
        return levels

    def path(levels, i):
        found = []
        for level in levels[:-1]:
            first = i - i % 8
            found.append(("".join(level[first:i]), "".join(level[i + 1 : first + 8])))
            i //= 8
        return found

    by, trees, out = {}, {}, []
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda k: (k is not None, (k or "").encode()))
    for k in langs:
        by[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees[k] = tree([leaf(r, r[4]) for r in by[k]])
    top = tree([trees[k][-1][0] for k in langs])
    for at, k in enumerate(langs):
        for i, r in enumerate(by[k]):
            steps = path(trees[k], i) + path(top, at)
            own = folded = leaf(r, r[4])
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                folded = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            for a, b in steps:
                folded = H(a, folded, b)
            out.append((r[0], own, trees[k][-1][0], top[-1][0], H(*[a + b for a, b in steps]), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def manifest_rows(seed, n, langs):
    rng = random.Random(seed)
    text = lambda: rng.choice([None, "", "Plain text", "lower", "É Ñ 漢", "X" * 3000])
    rows = [(i, rng.choice(["s", None, ""]), rng.choice(langs), rng.choice([None, 7]), text()) for i in rng.sample(range(-5, 5 * n), n)]
    return rows + rows[:3] + [(None, None, None, None, None), (None, "s", "en", 1, "T"), (rows[0][0], "s", rows[0][2], 1, "Another")]


@pytest.mark.parametrize("n, langs, height", [(150, ["en", "de", None, "é", "z", ""], 1), (700, ["en"], 2), (40, [f"l{i}" for i in range(90)], 4), (1, ["en"], 4)])
def test_manifest_matches_brute_force(table, n, langs, height):
    rows = manifest_rows(n, n, langs)
    docs = table([(*r, "leaf", "9") for r in rows], DOCS)
    tampered = merkle_manifest.F.crc32(merkle_manifest.F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    out = merkle_manifest.manifest(docs, "doc_id", "lang", merkle_manifest.DOCUMENT, tampered, "text", height=height)
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == brute_manifest(rows)


def test_manifest_of_one_row_and_none(table):
    one = merkle_manifest.document_manifest(table([(4, "s", "en", 1, "Text", "", "")], DOCS)).collect()
    assert [tuple(r) for r in one] == brute_manifest([(4, "s", "en", 1, "Text")])
    assert one[0]["proof_sha256"] == H() and one[0]["root"] == one[0]["leaf"]
    assert merkle_manifest.document_manifest(table([], DOCS)).collect() == []


def test_layout():
    for height in range(6):
        layout = merkle_manifest.VebLayout(height, 3)
        places = [layout.address(level, i) for level in range(height + 1) for i in range(3**level)]
        assert sorted(places) == list(range(layout.size))
    # height 3 splits at 1: the top part holds the root and its children, each bottom part a grandchild with its children
    layout = merkle_manifest.VebLayout(3, 2)
    assert [layout.address(0, 0), layout.address(1, 1), layout.address(2, 0), layout.address(3, 0), layout.address(2, 1)] == [0, 2, 3, 4, 6]


# --- token groups ----------------------------------------------------------------------------------------------------


def brute_similar(rows, size=4, percent=85):
    sets = []
    for doc, text in rows:
        words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        width = min(size, max(1, len(words)))
        sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)})
    low = {doc: doc for doc, _ in rows if doc is not None}
    edges = [
        (rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None
        and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    return sorted(((doc, len(s), low.get(doc)) for (doc, _), s in zip(rows, sets)), key=str)


def near_rows(seed):
    """Copies with few and many changes, so that similarities lie on both sides of the threshold."""
    rng = random.Random(seed)
    rows = [(r[0], r[1]) for r in passages(seed, 20) if r[1] is None or len(r[1]) < 50_000]
    for base in range(12):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(rng.choice([5, 6, 7, 9, 14, 30, 80, 300]))]
        for _ in range(rng.randint(2, 14)):
            own = list(words)
            for _ in range(rng.randint(0, 1 + len(words) // 20)):
                at = rng.randrange(len(own))
                own[at : at + rng.randint(0, 1)] = [f"v{rng.randint(0, 9)}"] * rng.randint(0, 2)
            rows.append((1000 * (base + 1) + rng.randint(0, 900), " ".join(own)))
    return rows + [(None, rows[5][1]), (None, None), (3, rows[-1][1]), (7, rows[-1][1]), (7, "entirely different words stand here")]


@pytest.mark.parametrize("seed, sizes", [(1, {}), (2, {"group_sets": 2, "block_sets": 3, "block_shingles": 400}), (3, {"block_sets": 1})])
def test_similar_sets_match_brute_force(table, seed, sizes):
    rows = near_rows(seed)
    docs = table([(i, None, "x", 1, t, "leaf", "9") for i, t in rows], DOCS)
    got = sorted((tuple(r) for r in token_groups.similar_sets(docs, **sizes).collect()), key=str)
    assert got == brute_similar(rows)
    assert len({r[2] for r in got}) < len(got) - 30


def test_similar_sets_of_an_empty_table(table):
    assert token_groups.similar_sets(table([], DOCS)).collect() == []
    with pytest.raises(ValueError):
        token_groups.similar_sets(table([], DOCS), percent=80)


@pytest.mark.parametrize("n", [6, 7, 10, 40, 500])
def test_linked_sets_share_a_key(n):
    rng = np.random.default_rng(n)
    for _ in range(300):
        base = rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2)
        drop, more = rng.integers(0, 1 + n // 6, 2)
        other = np.unique(np.concatenate([base[drop:], rng.integers(0, 1 << 63, more).astype(np.uint64)]))
        base = np.unique(base)
        if len(other) and token_groups._linked(base, other, 85) and len(base) != np.isin(base, other).sum():
            assert np.isin(token_groups.part_keys(base, 85), token_groups.part_keys(other, 85)).any()


def test_templates_open_few_groups():
    """1,500 sets that share a third with each other and link with none: no group is opened for them."""
    rng = np.random.default_rng(5)
    template = rng.integers(0, 1 << 63, 100).astype(np.uint64)
    sets = [(i // 8, i, i, np.unique(np.concatenate([template, rng.integers(0, 1 << 63, 100).astype(np.uint64)]))) for i in range(1500)]
    seen = []
    assert list(token_groups.matrix_links(sets, [], 85, seen=seen)) == []
    assert len({tuple(sorted(s)) for s in seen if s[0] != s[1]}) <= 8 * 1500
