"""Bring pair tables to the nested multimodal record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.sources.schemas import IMAGES, MULTIMODAL


def image_group(path: Column | None = None, content: Column | None = None, resolution: Column | None = None) -> Column:
    """One image as the list-valued group of the record; a missing path gives empty lists."""
    if path is None:
        return F.lit(None).cast(IMAGES)

    def listed(value: Column | None, kind: str) -> Column:
        value = F.lit(None).cast(kind) if value is None else value.cast(kind)
        return F.when(path.isNotNull(), F.array(value)).otherwise(F.array().cast(f"array<{kind}>"))

    return F.struct(
        listed(path, "string").alias("paths"),
        listed(content, "binary").alias("bytes"),
        listed(resolution, "array<int>").alias("resolutions"),
    )


def conform(df: DataFrame) -> DataFrame:
    """The seven fields in order, cast to their types; absent ones NULL, others dropped."""
    fields = []
    for f in MULTIMODAL.fields:
        value = F.col(f.name) if f.name in df.columns else F.lit(None)
        fields.append(value.cast(f.dataType).alias(f.name))
    return df.select(*fields)


def tag(df: DataFrame, name: str | None = None) -> DataFrame:
    """Constant dataset name; the text "None" when there is none."""
    return df.withColumn("global_dataset_name", F.lit("None" if name is None else name))


def resolution_violations(df: DataFrame) -> DataFrame:
    """Rows in which some resolution is not a [width, height] pair, by field."""
    checks = [
        F.when(~F.forall(F.col(f"{c}.resolutions"), lambda r: F.coalesce(F.size(r) == 2, F.lit(True))), F.lit(c))
        for c in ("query_image", "pos_image", "neg_image")
    ]
    bad = F.filter(F.array(*checks), lambda c: c.isNotNull())
    return df.withColumn("violation", F.explode(bad))
