"""Evaluation as grouped counting: confusion matrix, per-class and macro metrics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def confusion(df: DataFrame, k: int, label_col: str = "label", pred_col: str = "pred",
              zero_cells: bool = True) -> DataFrame:
    """EVL-01: (actual, predicted, n) with all k x k cells when ``zero_cells``.

    One aggregation: every scored row counts 1 and every grid cell (from ``spark.range(k*k)``,
    no cross join) counts 0, so the partial + final hash aggregate yields the full matrix,
    including labels outside 0..k-1, with a single shuffle of at most tasks x k^2 partial rows.
    """
    rows = df.select(F.col(label_col).cast("bigint").alias("actual"),
                     F.col(pred_col).cast("bigint").alias("predicted"), F.lit(1).cast("bigint").alias("n"))
    if zero_cells:
        grid = df.sparkSession.range(k * k).select((F.col("id") / k).cast("bigint").alias("actual"),
                                                    (F.col("id") % k).cast("bigint").alias("predicted"),
                                                    F.lit(0).cast("bigint").alias("n"))
        rows = rows.unionByName(grid)
    return rows.groupBy("actual", "predicted").agg(F.sum("n").cast("bigint").alias("n"))


def confusion_wide(conf: DataFrame, k: int) -> DataFrame:
    """EVL-01 as a k x k grid: one row per actual class, one column per predicted class.

    The pivot values are given, so no extra pass collects them.
    """
    return (conf.groupBy("actual").pivot("predicted", list(range(k))).agg(F.sum("n"))
            .na.fill(0).orderBy("actual"))


def partial_confusions(df: DataFrame, k: int, part_col: str, label_col: str = "label",
                       pred_col: str = "pred") -> DataFrame:
    """EVL-03: (part, actual, predicted, n) of every part in one pass over the scored rows."""
    rows = df.select(part_col, F.col(label_col).cast("bigint").alias("actual"),
                     F.col(pred_col).cast("bigint").alias("predicted"))
    return rows.groupBy(part_col, "actual", "predicted").agg(F.count(F.lit(1)).alias("n"))


def merge_confusions(parts: Sequence[DataFrame]) -> DataFrame:
    """EVL-03: partial confusion tables merged by summing their counts."""
    u = reduce(lambda a, b: a.unionByName(b), parts)
    return u.groupBy("actual", "predicted").agg(F.sum("n").cast("bigint").alias("n"))


def class_metrics(conf: DataFrame) -> DataFrame:
    """EVL-02 per class: tp, fp, fn, precision, recall, f1 (NULL where 0/0).

    Each confusion cell contributes to its actual class and to its predicted class;
    one grouped pass over the (small) k x k table gives all per-class counts.
    """
    as_actual = conf.select(F.col("actual").alias("cls"), F.col("n").alias("n_actual"), F.lit(0).cast("bigint").alias("n_pred"),
                            F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp"))
    as_pred = conf.select(F.col("predicted").alias("cls"), F.lit(0).cast("bigint").alias("n_actual"),
                          F.col("n").alias("n_pred"), F.lit(0).cast("bigint").alias("tp"))
    m = (as_actual.unionByName(as_pred).groupBy("cls")
         .agg(F.sum("tp").alias("tp"), F.sum("n_actual").alias("n_actual"), F.sum("n_pred").alias("n_pred"))
         .select("cls", F.col("tp").cast("bigint").alias("tp"),
                 (F.col("n_pred") - F.col("tp")).cast("bigint").alias("fp"),
                 (F.col("n_actual") - F.col("tp")).cast("bigint").alias("fn")))
    prec = F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0))
    rec = F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))
    return (m.withColumn("precision", prec).withColumn("recall", rec)
            .withColumn("f1", F.lit(2.0) * F.col("precision") * F.col("recall")
                        / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0))))


def summary(conf: DataFrame) -> DataFrame:
    """EVL-02 overall: accuracy and macro precision / recall / F1 (classes with 0/0 left out)."""
    per = class_metrics(conf)
    return per.agg(F.sum(F.col("tp") + F.col("fn")).cast("bigint").alias("total"),
                   F.sum("tp").cast("bigint").alias("correct"),
                   (F.sum("tp") / F.sum(F.col("tp") + F.col("fn"))).alias("accuracy"),
                   F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
                   F.avg("f1").alias("macro_f1"))
