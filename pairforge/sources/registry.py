"""Parsers by name, and batched maps over their rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

Parser = Callable[..., DataFrame]
_PARSERS: dict[str, Parser] = {}
MAP_BATCH = 100  # fixed value: rows per call of a batched map


def register(name: str) -> Callable[[Parser], Parser]:
    """Decorator that registers a parser ``fn(spark, **config) -> DataFrame``. Names are unique."""

    def add(parser: Parser) -> Parser:
        if name in _PARSERS:
            raise ValueError(f"a parser named {name!r} is already registered")
        _PARSERS[name] = parser
        return parser

    return add


def registered() -> list[str]:
    return sorted(_PARSERS)


def instantiate(spark: SparkSession, dataset_parser: str, **config) -> DataFrame:
    if dataset_parser not in _PARSERS:
        raise KeyError(f"no parser named {dataset_parser!r}; registered: {registered()}")
    return _PARSERS[dataset_parser](spark, **config)


def map_batches(
    df: DataFrame,
    fn: Callable[..., dict],
    schema: str,
    batch_size: int = MAP_BATCH,
    fn_kwargs: dict | None = None,
) -> DataFrame:
    """Apply ``fn(columns, **fn_kwargs) -> columns`` to dicts of lists of up to ``batch_size`` rows.

    The result may have more or fewer rows than the input; its columns follow ``schema``.
    """
    kwargs = dict(fn_kwargs or {})
    target = df.sparkSession.createDataFrame([], schema).schema
    names = target.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                out = fn(batch.slice(start, batch_size).to_pydict(), **kwargs)
                arrays = [pa.array(out[n], type=arrow.field(n).type) for n in names]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, target)
