"""SRC-01: delimited records with an explicit schema (no header, no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan_delimited(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",",
                   header: bool = False) -> DataFrame:
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("mode", "FAILFAST").csv(path))


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", False).option("sep", sep).csv(path)
