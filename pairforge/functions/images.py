"""Image geometry as arithmetic on width and height columns; pixels are never touched."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named resolutions and the size, token and crop constants of the image budget.
RESOLUTIONS = {"high": (1344, 1344), "mid": (672, 672), "low": (128, 128)}
MAX_DIM = 1344
TILE = 336
TOKENS_PER_TILE = 144
ROW_SEPARATORS = 12


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def resize_plan(width, height, resolution=None, max_dim: int = MAX_DIM) -> list[Column]:
    """Target size: a named resolution is square, otherwise the longer side is capped."""
    w, h, name = _col(width), _col(height), _col(resolution) if resolution is not None else F.lit("")
    longer = F.greatest(w, h)

    def side(i: int, own: Column, other: Column) -> Column:
        out = None
        for label, size in RESOLUTIONS.items():
            out = (F if out is None else out).when(name == label, F.lit(size[i]))
        scaled = F.floor(own * max_dim / other).cast("int")
        return (
            out.when(longer <= max_dim, own)
            .when((own > other) | ((own == other) & F.lit(i == 1)), F.lit(max_dim))
            .otherwise(scaled)
            .cast("int")
        )

    return [side(0, w, h).alias("new_width"), side(1, h, w).alias("new_height")]


def padded_size(width, height, num_crops: int = 16) -> list[Column]:
    """Size after tiling: the widest tile row that keeps the tile count within ``num_crops``."""
    w, h = _col(width), _col(height)
    long_side, short_side = F.greatest(w, h), F.least(w, h)
    ratio = long_side / short_side
    scale = F.array_max(
        F.filter(
            F.sequence(F.lit(1), F.lit(num_crops)), lambda s: s * F.ceil(s / ratio) <= num_crops
        )
    )
    new_long = scale * TILE
    new_short = F.floor(new_long / ratio)
    padded_short = F.ceil(new_short / TILE) * TILE
    return [
        F.when(w < h, padded_short).otherwise(new_long).cast("int").alias("padded_width"),
        F.when(w < h, new_long).otherwise(padded_short).cast("int").alias("padded_height"),
    ]


def image_tokens(padded_width, padded_height) -> Column:
    """Token count of a padded image: tiles plus one overview, with row separators."""
    w, h = _col(padded_width), _col(padded_height)
    tiles = F.floor(F.floor(h / TILE) * w / TILE)
    rows = F.floor(h / TILE)
    return (
        ((tiles + 1) * TOKENS_PER_TILE + 1 + (rows + 1) * ROW_SEPARATORS).cast("int").alias("image_tokens")
    )
