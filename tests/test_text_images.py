"""Text, path and image-size rules against plain Python."""

import math
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairforge.functions import images as I
from pairforge.functions import text as T

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
TEXTS = st.text(alphabet=st.sampled_from("ab \t\n\x0b\x1c\x85\xa0  　'\"é"), max_size=12)


def _one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).coalesce(1).select(*cols).collect()]


@SETTINGS
@given(st.lists(st.tuples(st.none() | TEXTS, st.none() | TEXTS), min_size=1, max_size=60))
def test_full_query_text_strips_like_python(spark, pairs):
    got = _one(spark, pairs, "i string, q string", T.full_query_text("i", "q"))
    assert [g for (g,) in got] == [f"{i or ''} {q or ''}".strip() for i, q in pairs]


def test_prompt(spark):
    rows = [("do", "x"), ("do", ""), ("do", None)]
    got = _one(spark, rows, "i string, t string", T.prompt("i", "t"), T.prompt("i", "t", add_image_token=True))
    assert got == [("do x", "<|image_1|> do x"), ("do", "<|image_1|> do"), ("do", "<|image_1|> do")]
    with pytest.raises(ValueError):
        T.prompt("i", "t", add_video_token=True)


@pytest.mark.parametrize("base", ["/", "/data", "/data/"])
def test_normalize_path(spark, base):
    paths = ["a.jpg", "./a.jpg", "a/../b.jpg", "/x//y/./z.png", "/..", "../../up.png", "/dbfs/./k.png", "a./b", "a/..",
             "https://h/../x", "http://h/x.png", "dir/", ".", "/a/b/../../../c"]
    got = _one(spark, [(p,) for p in paths], "p string", T.normalize_path("p", base))
    want = [p if p.startswith(("http://", "https://", "/dbfs/")) else os.path.normpath(os.path.join(base, p)) for p in paths]
    assert [g for (g,) in got] == want


def test_is_url(spark):
    cases = {
        "http://example.com": True, "https://a.b-c.org/x?y=1": True, "ftp://example.com/f": True, "FTPS://EXAMPLE.COM": True,
        "http://localhost:8080/": True, "http://127.0.0.1/a": True, "example.com": False, "http://": False,
        "img/1.jpg": False, "http://exa mple.com": False, "http://example.com/a b": False, "xhttp://example.com": False,
    }
    got = _one(spark, [(c,) for c in cases], "u string", T.is_url("u"))
    assert [g for (g,) in got] == list(cases.values())
    assert _one(spark, [(None,)], "u string", T.is_url("u")) == [(False,)]


def _choice(question, options, answer):
    lettered = [f"({chr(65 + i)}) {o}" for i, o in enumerate(options)]
    at = max((i for i, o in enumerate(options) if o == answer), default=-1)
    text = "\n".join([question, "Options:", *lettered]).rstrip()
    return text, lettered, f"({chr(65 + at)}) {answer}", at


def test_multiple_choice(spark):
    cases = [("Q?", ["x", "y"], "y"), ("Q?", ["x", "x", "z"], "x"), ("Q?", ["x"], "none"), ("Q \n", [], "a"),
             ("Q", ["end \t\n"], "end \t\n"), ("Q", [str(i) for i in range(30)], "27")]
    got = _one(spark, cases, "q string, o array<string>, a string", *T.multiple_choice("q", "o", "a"))
    assert [tuple(g) for g in got] == [_choice(*c) for c in cases]


def test_image_tags(spark):
    cases = [("<|image_1|> a <|image_2|>", 2, True), ("<|image_2|>", 1, False), ("<|image_1|><|image_1|>", 1, True),
             ("none", 0, True), ("<|image_1|><|image_3|>", 2, False), ("<|image_1|>", 2, False),
             ("<|image_99999999999999999999|>", 1, False), ("<|image_10|>" + "".join(f"<|image_{i}|>" for i in range(1, 10)), 10, True)]
    got = _one(spark, [c[:2] for c in cases], "p string, m int", *T.image_tag_check("p", "m"))
    assert [g[-1] for g in got] == [c[2] for c in cases]


SIZES = [(w, h) for w in (1, 64, 336, 500, 1344, 1345, 2016, 4000) for h in (1, 63, 336, 700, 1344, 3000)]


def test_resize_plan(spark):
    got = _one(spark, SIZES, "w int, h int", *I.resize_plan("w", "h"))
    for (w, h), new in zip(SIZES, got):
        if max(w, h) <= 1344:
            assert new == (w, h)
        elif w > h:
            assert new == (1344, int(h * 1344 / w))
        else:
            assert new == (int(w * 1344 / h), 1344)
    for name, size in I.RESOLUTIONS.items():
        assert _one(spark, [(5, 9)], "w int, h int", *I.resize_plan("w", "h", F.lit(name))) == [size]


@pytest.mark.parametrize("crops", [1, 4, 16])
def test_padded_size_and_tokens(spark, crops):
    got = _one(spark, SIZES, "w int, h int", *I.padded_size("w", "h", crops))
    for (w, h), (pw, ph) in zip(SIZES, got):
        big, small = max(w, h), min(w, h)
        scale = max(s for s in range(1, crops + 1) if s * math.ceil(s / (big / small)) <= crops)
        short = math.ceil(int(scale * 336 / (big / small)) / 336) * 336
        assert (pw, ph) == ((short, scale * 336) if w < h else (scale * 336, short))
    tokens = _one(spark, [(672, 336), (336, 1008)], "w int, h int", I.image_tokens("w", "h"))
    assert tokens == [(3 * 144 + 1 + 2 * 12,), (4 * 144 + 1 + 4 * 12,)]
