"""SNK-03: statistics of activations, parameters and updates by layer, as mergeable histogram sketches.

A sketch is one row a (key, bin) with count, sum, sum of squares, smallest and largest value; bins are ``width`` wide and start at
0, so sketches of any tasks, rounds or runs add up without knowing the range first. Tasks add up their own values
before the exchange, which carries at most tasks x keys x bins rows. Values are rounded to ``DIGITS`` places to
find their bin, so the last bits of a value do not decide it; null and NaN are counted in the null bin.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .model import Net
from .scoring import score, score_columns

DIGITS = 9


def value_histograms(rows: DataFrame, keys: Sequence[str], value: str, width: float) -> DataFrame:
    """(keys, bin, n, total, squares, low, high) of the numbers in ``value``; bin b holds b * width <= value < (b + 1) * width."""
    v = F.col(value).cast("double")
    v = F.when(~F.isnan(v), v)
    binned = rows.select(*keys, F.floor(F.round(v, DIGITS) / F.lit(float(width))).cast("bigint").alias("bin"), v.alias("_v"))
    return binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("_v").alias("total"), F.sum(F.col("_v") * F.col("_v")).alias("squares"),
                                            F.min("_v").alias("low"), F.max("_v").alias("high"))


def merge_histograms(sketches: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One sketch of everything the given ones have seen (same width)."""
    rows = reduce(DataFrame.unionByName, sketches)
    return rows.groupBy(*keys, "bin").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"),
                                          F.min("low").alias("low"), F.max("high").alias("high"))


def summarise(sketch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n, missing, mean, deviation, low, high): whole-number counts; a key without any number has null moments."""
    real = F.when(F.col("bin").isNotNull(), F.col("n"))
    d = sketch.groupBy(*keys).agg(F.coalesce(F.sum(real), F.lit(0)).alias("n"), F.sum(F.when(F.col("bin").isNull(), F.col("n")).otherwise(0)).alias("missing"),
                                  F.sum("total").alias("_t"), F.sum("squares").alias("_s"), F.min("low").alias("low"), F.max("high").alias("high"))
    mean = F.when(F.col("n") > 0, F.col("_t") / F.col("n"))
    spread = F.sqrt(F.greatest(F.when(F.col("n") > 0, F.col("_s") / F.col("n")) - mean * mean, F.lit(0.0)))
    return d.select(*keys, "n", "missing", mean.alias("mean"), F.when(F.col("n") > 0, spread).alias("deviation"), "low", "high")


def activation_histograms(df: DataFrame, net: Net, inputs: dict | str, width: float, columns: bool = True) -> DataFrame:
    """Sketch by ``vertex`` of every activation of the net on the rows of ``df``: one pass for all layers.

    ``columns``: scored by array expressions (small nets); otherwise by ``score`` inside tasks."""
    names = [v.name for v in net.vertices]
    scored = (score_columns if columns else score)(df, net, inputs, outputs={n: f"_a{i}" for i, n in enumerate(names)})
    layers = F.explode(F.array(*[F.struct(F.lit(n).alias("vertex"), F.col(f"_a{i}").alias("a")) for i, n in enumerate(names)])).alias("l")
    return value_histograms(scored.select(layers).select("l.vertex", F.explode("l.a").alias("v")), ["vertex"], "v", width)


def parameter_histograms(params: DataFrame, width: float) -> DataFrame:
    """Sketch by (layer, name) of a written table of parameters (layer, name, idx, value)."""
    return value_histograms(params, ["layer", "name"], "value", width)


def update_histograms(before: DataFrame, after: DataFrame, width: float) -> DataFrame:
    """Sketch by (layer, name) of after - before, two written versions of a model's parameters."""
    at = ["layer", "name", "idx"]
    moved = before.select(*at, F.col("value").alias("_old")).join(after.select(*at, F.col("value").alias("_new")), at)
    return value_histograms(moved.select("layer", "name", (F.col("_new") - F.col("_old")).alias("v")), ["layer", "name"], "v", width)
