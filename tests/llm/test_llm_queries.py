"""The registered queries against SQL, and the pipeline's stages against plain versions."""

import hashlib
import os

import oracle
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pairforge.llm import queries, toxicity_nb
from test_llm_texts import brute_components, brute_contamination, brute_lines

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle.duck(DIR)


def test_registered():
    assert set(queries.QUERIES) < set(entry.queries()) and "pipeline" in entry.queries()
    assert set(queries.SQL) <= set(queries.QUERIES)
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, duck, name):
    difference = oracle.compare(spark, duck, queries.QUERIES[name], queries.SQL[name], DIR)
    assert difference is None, difference


def test_pii_query(spark):
    from test_llm_records import plain_spans

    texts = {r["doc_id"]: r["text"] or "" for r in queries.table(spark, DIR, "documents").collect()}
    got = queries.QUERIES["op5_pii_bootstrap"](spark, DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        spans = [f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for k, a, b in plain_spans(texts[r["doc_id"]])]
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert r["spans"].split(",")[: len(spans)] == spans or not spans
        assert r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] == len(spans)


def test_toxicity_query(spark):
    docs = queries.table(spark, DIR, "documents")
    got = queries.QUERIES["op7_toxicity"](spark, DIR)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.count() == docs.count()


def test_pipeline_stages(spark):
    """Each stage on what its predecessor kept."""
    assert [s[0] for s in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    docs = queries.table(spark, DIR, "documents")
    plain = lambda df: [tuple(r) for r in df.select("doc_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)

    out = stages["toxicity"](spark, docs, DIR).cache()
    model = toxicity_nb.train(docs, queries.table(spark, DIR, "labels"))
    assert sorted(plain(out)) == sorted((i, t) for i, t in plain(docs) if model.score(t) < 0.5)
    assert out.columns == docs.columns
    docs = out

    out = stages["line_dedup"](spark, docs, DIR).cache()
    assert sorted(plain(out)) == sorted(r[:2] for r in brute_lines(plain(docs)))
    assert out.columns == docs.columns
    docs = out

    out = stages["near_dedup"](spark, docs, DIR).cache()
    assert sorted(r[0] for r in plain(out)) == sorted(r[0] for r in brute_components(plain(docs), 5) if r[3])
    assert out.columns == docs.columns
    docs = out

    out = stages["decontamination"](spark, docs, DIR).cache()
    items = [tuple(r) for r in queries.table(spark, DIR, "benchmark").select("item_id", "text").collect()]
    assert sorted(r[0] for r in plain(out)) == sorted(r[0] for r in brute_contamination(plain(docs), items) if not r[5])
    assert out.columns == docs.columns
    docs = out

    out = stages["mixing"](spark, docs, DIR).collect()
    sizes = {i: len((t or "").encode().split()) for i, t in plain(docs)}
    assert all(r["size"] == sizes[r["doc_id"]] and 0 < r["taken"] <= 3 * r["size"] and r["taken"] % r["size"] == 0 for r in out)
    longest = max(sizes.values())
    assert sum(sizes.values()) - 3 * longest <= sum(r["taken"] for r in out) <= sum(sizes.values())


def test_near_dedup_of_repeated_and_nameless_rows(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(5, a, "en"), (5, a, "de"), (5, a, None), (9, a, "en"), (None, a, "en"), (None, b, "x"), (None, b, "x"), (None, b + " more", "x"),
            (None, None, "x"), (None, None, "x"), (7, None, "x"), (7, c, "en"), (8, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = corpus_pipeline.drop_near_copies(spark, docs, DIR)
    assert out.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    of_b = [r for r in got if r in [(None, b), (None, b + " more")]]
    assert len(of_b) == 1
    assert sorted(map(str, got)) == sorted(map(str, [(5, a), of_b[0], (None, None), (7, None), (7, c), (8, "")]))


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, DIR)
    assert 0 < out.count() <= queries.table(spark, DIR, "documents").count()
    assert {"doc_id", "text", "lang", "source", "n_chars", "taken"} <= set(out.columns)
