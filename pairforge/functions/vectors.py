"""Vector arithmetic on ARRAY columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NORM_FLOOR = 1e-12


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c) -> Column:
    return _col(c).cast("array<double>")


def dot(a, b) -> Column:
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x
    )


def l2_norm(c) -> Column:
    return F.sqrt(F.aggregate(_col(c), F.lit(0.0), lambda s, x: s + x * x))


def l2_normalize(c) -> Column:
    vec = _col(c)
    norm = F.greatest(l2_norm(vec), F.lit(NORM_FLOOR))
    return F.transform(vec, lambda x: x / norm)


def truncate_dims(c, ndim: int | None) -> Column:
    return _col(c) if not ndim else F.slice(_col(c), 1, ndim)
