"""Text operators on edge cases, against brute force in plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pairforge.llm import decontaminate, line_chunks, phrase_automata, tensor_minhash, words

DOCS = "doc_id long, text string, lang string, n_words long, row string"  # the last two clash with result columns
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def vocabulary(seed, n=40):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdeé漢") for _ in range(rng.randint(1, 5))) for _ in range(n)]


def passages(seed, n_docs=60):
    """Texts that share passages, with odd whitespace, copies, near copies, an empty, a null and a long one."""
    rng, vocab = random.Random(seed), vocabulary(seed)
    shared = [[rng.choice(vocab) for _ in range(rng.randint(11, 40))] for _ in range(6)]
    texts = []
    for _ in range(n_docs):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += rng.choice(shared) if rng.random() < 0.5 else [rng.choice(vocab) for _ in range(rng.randint(1, 25))]
        texts.append("".join(w + rng.choice([" ", "  ", "\n", "\t", "\x0b", " \x0c"]) for w in parts))
    texts += [None, "", " \n ", texts[3], texts[3], " ".join(rng.choice(vocab) for _ in range(30_000)), shared[0][0]]
    near = texts[4].split()
    texts += [" ".join(near[:-1]), " ".join(near + ["Z"])]
    return [(i, t, "en", 7, "x") for i, t in enumerate(texts)]


def brute_repeats(rows, width=13):
    found, first = [], {}
    split = [(doc if doc is not None else (1 << 63) - 1, WORDS.findall(text or "")) for doc, text, *_ in rows]
    for doc, ws in split:
        for i in range(len(ws) - width + 1):
            key = tuple(ws[i : i + width])
            first[key] = min(first.get(key, doc), doc)
    for (doc, ws), (own, *_) in zip(split, rows):
        gone = {p for i in range(len(ws) - width + 1) if first[tuple(ws[i : i + width])] < doc for p in range(i, i + width)}
        kept = " ".join(w for p, w in enumerate(ws) if p not in gone)
        found.append((own, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(found, key=str)


@pytest.mark.parametrize("busy", [0, 3, 10_000])
def test_repeats_match_brute_force(table, busy):
    rows = passages(1) + [(None, "a b c", None, 1, ""), (5, passages(1)[5][1], "fr", 1, "")]
    out = phrase_automata.remove_repeats(table(rows, DOCS), busy_docs=busy)
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out.collect()), key=str)
    assert got == brute_repeats(rows)
    assert sum(r[2] for r in got) > 100
    texts = {r["kept_sha256"]: r["kept_text"] for r in out.collect()}
    assert all(hashlib.sha256(t.encode()).hexdigest() == h for h, t in texts.items())


def test_repeats_of_an_empty_table(table):
    assert phrase_automata.remove_repeats(table([], DOCS)).collect() == []
    with pytest.raises(ValueError):
        phrase_automata.remove_repeats(table([], DOCS), gram=13)


def test_window_hashes_of_sliced_texts():
    joined = b" ".join(b"w%d" % (i % 50) for i in range(1000))
    data, starts, ends = words.bounds(joined)
    whole = words.window_hashes(data, starts, ends, 5)
    old, words._SLICE = words._SLICE, 64
    try:
        assert (words.window_hashes(data, starts, ends, 5) == whole).all()
    finally:
        words._SLICE = old
    assert len(set(whole.tolist())) == 50
    assert len(words.window_hashes(*words.bounds(b""), 1)) == 0


# benchmark decontamination


def brute_contamination(rows, items, width=13):
    fold = str.maketrans(words.UPPER.decode(), words.LOWER.decode())
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(fold))
    windows = {}
    for item, text in items:
        ws = split(text)
        n = min(width, len(ws))
        for i in range(len(ws) - n + 1) if ws else ():
            windows.setdefault(tuple(ws[i : i + n]), set()).add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text, *_ in rows:
        ws, hit, names = split(text), set(), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                if found := windows.get(tuple(ws[i : i + n])):
                    hit |= set(range(i, i + n))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc, len(ws), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(ws)))
    return sorted(out, key=str)


def items_of(rows, single):
    rng = random.Random(2)
    items = [(3, None), (4, ""), (5, " ".join(WORDS.findall(rows[7][1] or "x")[:9])), (11, rows[3][1]), (11, rows[3][1]), (None, rows[8][1])]
    items += [(20 + i, " ".join(WORDS.findall(rows[i][1])[2 : 2 + rng.randint(10, 30)])) for i in range(10, 20) if rows[i][1]]
    return items + ([(50, vocabulary(1)[0].upper())] if single else [])


@pytest.mark.parametrize("single", [False, True])
def test_contamination_matches_brute_force(table, single, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1 << 22)
    rows = passages(1) + [(None, passages(1)[3][1], None, 1, ""), (3, passages(1)[3][1], None, 1, "")]
    rows = [(d, t and t.upper() if d == 12 else t, *x) for d, t, *x in rows]
    items = items_of(rows, single)
    bench = table(items, "item_id long, text string")
    out = decontaminate.contamination(table(rows, DOCS), bench)
    got = sorted((tuple(r)[:6] for r in out.collect()), key=str)
    assert got == brute_contamination(rows, items)
    kept = decontaminate.remove_contaminated(table(rows, DOCS), bench)
    assert kept.columns == ["doc_id", "text", "lang", "n_words", "row"]
    clean = sorted((r[0] for r in got if not r[5]), key=str)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == clean


def test_matches_in_several_blocks_and_long_texts(table, monkeypatch):
    rows = passages(1)
    items = items_of(rows, False)
    docs, bench = table(rows, DOCS), table(items, "item_id long, text string")
    listed = lambda df: sorted((r["row"]["doc_id"], sorted(map(tuple, r["matches"]))) for r in df.collect())
    whole = decontaminate.find_matches(docs, bench, ["doc_id"])
    parts = decontaminate.find_matches(docs, bench, ["doc_id"], block_bytes=300)
    assert listed(whole) == listed(parts)
    longest = max(m["length"] for r in whole.collect() for m in r["matches"])
    assert longest >= len(WORDS.findall(rows[3][1]))


def test_repeated_items_fill_no_block(table, monkeypatch):
    rows = passages(2)
    items = [(f"i{i}", r[1]) for i, r in enumerate(rows[:40]) if r[1]]
    many = items + [items[0]] * 500
    sizes, search = [], decontaminate._search
    monkeypatch.setattr(decontaminate, "_search", lambda items, *a: sizes.append(sum(len(t) for _, t in items.value)) or search(items, *a))
    docs = table(rows, DOCS)
    found = [
        sorted(str(r) for r in decontaminate.find_matches(docs, table(x, "item_id string, text string"), ["doc_id"], block_bytes=4000).collect())
        for x in (items, many)
    ]
    assert found[0] == found[1]
    assert sum(sizes) == 2 * sum(len(text.encode()) for _, text in items)


def test_contamination_without_items_or_documents(table):
    none = table([], "item_id long, text string")
    assert [r["contaminated"] for r in decontaminate.contamination(table(passages(1)[:3], DOCS), none).collect()] == [False] * 3
    assert decontaminate.contamination(table([], DOCS), none).collect() == []


# near duplicates


def brute_components(rows, size=4):
    fold = str.maketrans(words.UPPER.decode(), words.LOWER.decode())
    sets = []
    for doc, text, *_ in rows:
        ws = WORDS.findall((text or "").translate(fold))
        sets.append((doc, {tuple(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set()))
    name = {doc: doc for doc, _ in sets}

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 80 * len(s | t):
                low, high = sorted((find(a), find(b)))
                name[high] = low
    return sorted(((d, len(s), find(d) if d is not None else None, d is None or find(d) == d) for d, s in sets), key=str)


def near_rows():
    rng, vocab = random.Random(5), vocabulary(5, 400)
    rows = passages(1)
    base = [rng.choice(vocab) for _ in range(120)]
    texts = []
    for _ in range(60):  # a cluster whose links are around the limit
        ws = list(base)
        for _ in range(rng.randint(0, 4)):
            ws[rng.randrange(len(ws))] = rng.choice(vocab)
        texts.append(" ".join(ws))
    rows += [(100 + i, t, None, 0, None) for i, t in enumerate(texts)]
    return rows + [(None, texts[0], None, 0, None), (300, "A b", None, 0, None), (301, "a B ", None, 0, None), (302, "a", None, 0, None)]


@pytest.mark.parametrize("block_docs", [512, 7])
def test_components_match_brute_force(table, block_docs):
    rows = near_rows()
    out = tensor_minhash.near_components(table(rows, DOCS), block_docs=block_docs)
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute_components(rows)


def test_components_of_odd_tables(table):
    assert tensor_minhash.near_components(table([], DOCS)).collect() == []
    rows = [(1, "a b c d e", "en", 0, ""), (1, "a b c d e", "en", 0, ""), (2, "a b c d e", "en", 0, "")]
    out = tensor_minhash.near_components(table(rows, DOCS))
    assert sorted((r["doc_id"], r["component_id"]) for r in out.collect()) == [(1, 1), (1, 1), (2, 1)]
    with pytest.raises(ValueError):
        tensor_minhash.near_components(table([], DOCS), percent=50)


# repeated chunks of lines


def brute_lines(rows, roll=2, divisor=4, least=2, order=lambda text: 0):
    """``order`` says in which order texts of one id follow each other."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    cut = []
    for n, (doc, text, *_) in enumerate(rows):
        lines, chunks, start = (text or "").split("\n"), [], 0
        hashes = [md5(x) for x in lines]
        for i in range(len(lines)):
            rolling = md5("".join(hashes[max(i - k, 0)] for k in reversed(range(roll))))
            if i == len(lines) - 1 or int(rolling[:8], 16) % divisor == 0:
                chunks.append(lines[start : i + 1])
                start = i + 1
        cut.append((doc if doc is not None else (1 << 63) - 1, order(text), chunks))
    first = {}
    for doc, row, chunks in cut:
        for at, chunk in enumerate(chunks):
            if len(chunk) >= least:
                first[tuple(chunk)] = min(first.get(tuple(chunk), (doc, row, at)), (doc, row, at))
    out = []
    for (doc, row, chunks), (own, text, *_) in zip(cut, rows):
        kept = [c for at, c in enumerate(chunks) if len(c) < least or first[tuple(c)] == (doc, row, at)]
        total, left = sum(map(len, chunks)), sum(map(len, kept))
        text = None if text is None else "\n".join("\n".join(c) for c in kept)
        out.append((own, text, total if text is not None else 0, total - left))
    return sorted(out, key=str)


def test_line_chunks_match_brute_force(table):
    rng = random.Random(3)
    block = [f"line {i}" for i in range(12)]
    rows = []
    for i in range(40):
        lines = [f"own {i} {rng.randint(0, 5)}" for _ in range(rng.randint(0, 6))]
        if i % 3:
            at = rng.randint(0, len(lines))
            lines[at:at] = block[rng.randint(0, 3) :]
        rows.append((i, "\n".join(lines), "en", 1, ""))
    rows += [(50, None, None, 1, ""), (51, "", None, 1, ""), (None, "\n".join(block), None, 1, ""), (52, "\n" * 9, "", 1, ""), (53, "\n" * 9, "", 1, "")]
    rows += [rows[1], rows[1]]
    out = line_chunks.dedup_lines(table(rows, "doc_id long, text string, lang string, n_lines long, n_words string"))
    assert out.columns == ["doc_id", "text", "lang", "n_words", "n_lines", "n_removed"]
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in out.collect()), key=str)
    assert got == brute_lines(rows)
    assert sum(r[3] for r in got) > 50


def test_line_chunks_survive_shifts(table):
    body = "\n".join(f"shared line number {i}" for i in range(60))
    rows = [(1, body), (2, "a new first line\nand another\n" + body), (3, body + "\nmore")]
    out = {r["doc_id"]: r for r in line_chunks.dedup_lines(table(rows, "doc_id long, text string")).collect()}
    assert out[1]["n_removed"] == 0 and out[2]["n_removed"] > 45 and out[3]["n_removed"] > 45


def test_line_chunks_join_back(spark):
    texts = ["", "\n", "a", "a\nb\n\nc" * 30, "x\n" * 5]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    joined = F.array_join(F.transform(line_chunks.line_chunks(F.col("text")), lambda c: c["text"]), "\n")
    assert [r[0] for r in df.select(joined).collect()] == texts


def test_lines_of_rows_without_or_with_one_id(table):
    """A row loses only what itself repeats: unique texts beside a repeat stay whole, with one id and without."""
    unique = ["\n".join(f"only {k} has line {i}" for i in range(30)) for k in range(4)]
    shared = "\n".join(f"shared line {i}" for i in range(30))
    rows = [(None, unique[0]), (None, shared), (None, shared + "\nend"), (3, unique[1]), (3, shared), (3, unique[2]), (4, shared), (None, unique[3])]
    out = line_chunks.dedup_lines(table(rows, "doc_id long, text string")).collect()
    by = {(r["doc_id"], r["n_lines"], r["n_removed"]) for r in out}
    assert {r["text"] for r in out} >= set(unique)
    assert (3, 30, 0) in by and not any(d == 3 and n for d, _, n in by)
    assert all(n > 20 for d, lines, n in by if d == 4 or lines == 31)
    hashes = {r["text"]: (r["h1"], r["h2"]) for r in table(rows, "doc_id long, text string").select("text", F.xxhash64("text").alias("h1"), F.hash("text").alias("h2")).collect()}
    assert sorted((tuple(r) for r in out), key=str) == brute_lines(rows, order=hashes.get)


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_repeats_of_rows_without_or_with_one_id(table, block):
    rng = random.Random(8)
    text = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    shared, unique = text(60), [text(100) for _ in range(4)]
    rows = [(None, unique[0], "", 0, ""), (None, unique[1] + " " + shared, "", 0, ""), (None, shared, "", 0, ""), (2, "short text", "", 0, ""),
            (2, text(300) + " " + shared + " " + text(20), "", 0, ""), (2, shared, "", 0, ""), (5, unique[2] + " " + shared, "", 0, ""), (5, unique[3], "", 0, "")]
    out = phrase_automata.remove_repeats(table(rows, DOCS), block_bytes=block).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out), key=str) == brute_repeats(rows)
    assert {r["kept_text"] for r in out} >= set(unique)
    assert sum(r["n_removed"] for r in out) == 180
