"""Sizes from image headers: whole, odd and damaged files."""

import struct

import pytest

from pairforge.sources import image_headers as H
from pairforge.sources.images import png_bytes


def segment(marker, body):
    return bytes([0xFF, marker]) + struct.pack(">H", len(body) + 2) + body


def frame(marker, width, height):
    return segment(marker, struct.pack(">BHHB", 8, height, width, 1) + b"\1\x11\0")


SOI = b"\xff\xd8"
LONG = segment(0xE1, b"\xff\xc0" * 30_000)
FILES = {
    "a b%20.png": (png_bytes(31, 7), ("png", "ok", 31, 7)),
    "plain.jpg": (SOI + segment(0xE0, b"JFIF\0") + frame(0xC0, 640, 480), ("jpeg", "ok", 640, 480)),
    "progressive.jpg": (SOI + frame(0xC2, 3, 65_000) + b"\xff\xd9", ("jpeg", "ok", 3, 65_000)),
    "long.jpg": (SOI + LONG * 3 + segment(0xC4, b"\0" * 20) + frame(0xC1, 12, 13), ("jpeg", "ok", 12, 13)),
    "fill.jpg": (SOI + b"\xff\xff" + frame(0xC0, 5, 6), ("jpeg", "ok", 5, 6)),
    "restart.jpg": (SOI + b"\xff\xd0" + frame(0xC0, 5, 6), ("jpeg", "ok", 5, 6)),
    "cut.png": (png_bytes(31, 7)[:20], ("png", "damaged", None, None)),
    "zero.png": (png_bytes(31, 7)[:16] + b"\0" * 8, ("png", "damaged", None, None)),
    "wrong.png": (png_bytes(31, 7)[:12] + b"IDAT" + b"\1" * 8, ("png", "damaged", None, None)),
    "cut.jpg": (SOI + LONG, ("jpeg", "damaged", None, None)),
    "frame-cut.jpg": (SOI + frame(0xC0, 640, 480)[:8], ("jpeg", "damaged", None, None)),
    "scan-first.jpg": (SOI + segment(0xDA, b"\0" * 6) + frame(0xC0, 1, 1), ("jpeg", "damaged", None, None)),
    "no-height.jpg": (SOI + frame(0xC0, 640, 0), ("jpeg", "damaged", None, None)),
    "short-segment.jpg": (SOI + b"\xff\xe0\0\0" + frame(0xC0, 1, 1), ("jpeg", "damaged", None, None)),
    "text.png": (b"GIF89a or something else", (None, "unknown", None, None)),
    "empty.png": (b"", (None, "unknown", None, None)),
}


@pytest.mark.parametrize("name", sorted(FILES))
def test_header_size(name):
    content, want = FILES[name]
    assert H.header_size(lambda start, length: content[start : start + length]) == want


def test_files(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    for k, (name, (content, _)) in enumerate(FILES.items()):
        (tmp_path / ("deep" if k % 2 else ".") / name).write_bytes(content)
    rows = H.read_image_headers(spark, str(tmp_path)).collect()
    got = {r["path"].rsplit("/", 1)[-1]: (r["format"], r["status"], r["width"], r["height"]) for r in rows}
    assert got == {name: want for name, (content, want) in FILES.items() if content}  # empty files are not listed
    assert all(r["path"].startswith(str(tmp_path)) for r in rows)
    jpgs = H.read_image_headers(spark, str(tmp_path), "*.jpg")
    assert jpgs.count() == sum(n.endswith(".jpg") for n in FILES)
    assert "content" not in jpgs._jdf.queryExecution().executedPlan().toString()


def test_a_file_that_is_gone():
    assert H._of_file("file:/nowhere/at/all.png") == (None, "unreadable", None, None)
