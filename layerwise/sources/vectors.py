"""SRC-02: flattened vectors with a class label; train or test part; seeded order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.splits import weighted_split


def scan_vectors(spark: SparkSession, path: str, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label", quantise: int | None = 256, split: str | None = None,
                 weights=(7, 3), seed=42) -> DataFrame:
    """Read (id, features ARRAY<DOUBLE>, label). ``split`` = 'train' or 'test' picks a part of
    the exact seeded split (parts in order of ``weights``)."""
    df = spark.read.parquet(path)
    if quantise:
        feats = F.transform(vec_col, lambda v: F.round(v.cast("double") * F.lit(float(quantise)))
                            / F.lit(float(quantise)))
    else:
        feats = F.transform(vec_col, lambda v: v.cast("double"))
    out = df.select(F.col(id_col).alias("id"), feats.alias("features"), F.col(label_col).cast("int").alias("label"))
    if split is None:
        return out
    part = {"train": 0, "test": 1}[split] if isinstance(split, str) else int(split)
    return weighted_split(out, "id", list(weights), seed).filter(F.col("part") == part).drop("part")
