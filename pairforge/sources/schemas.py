"""Explicit schemas of every record type."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_TEXT, _INT, _LONG = StringType(), IntegerType(), LongType()

CATALOGUE = _struct(style_id=_LONG, description=_TEXT, default_image=_TEXT, master_category=_TEXT)
TRAIN = _struct(
    instruction_text=_TEXT, query_text=_TEXT, query_image_path=_TEXT, target_image_path=_TEXT,
    task_category=_TEXT, style_id=_LONG,
)
EVAL = _struct(
    instruction_text=_TEXT, query_text=_TEXT, query_image_path=_TEXT,
    candidate_targets=ArrayType(_struct(type=_TEXT, path=_TEXT)), ground_truth_index=_INT,
    task_category=_TEXT, style_id=_LONG,
)
# Keys without which a record cannot be used.
REQUIRED_TRAIN = ("instruction_text", "query_text", "target_image_path", "style_id")
REQUIRED_EVAL = ("instruction_text", "query_text", "candidate_targets", "ground_truth_index", "style_id")

IMAGES = _struct(
    paths=ArrayType(_TEXT), bytes=ArrayType(BinaryType()), resolutions=ArrayType(ArrayType(_INT))
)
MULTIMODAL = _struct(
    query_text=_TEXT, query_image=IMAGES, pos_text=_TEXT, pos_image=IMAGES, neg_text=_TEXT, neg_image=IMAGES,
    global_dataset_name=_TEXT,
)


def record_schema(split: str) -> tuple[StructType, tuple[str, ...]]:
    """Schema and required keys of a split's records."""
    return (TRAIN, REQUIRED_TRAIN) if split == "train" else (EVAL, REQUIRED_EVAL)
