"""Example tables derived from the driver tables (same formulas as the SQL oracles).

FIXED VALUES (shared with the oracles):
  vectors64   x = round(v * 256) / 256 of the 64 embedding floats (as DOUBLE)
  image 8x8x1 pixel = floor((v + 1) * 127.5) with v as DOUBLE, index i -> (y, x) = (i div 8, i mod 8)
  image 4x4x4 index i -> (c, y, x) = (i div 16, (i mod 16) div 4, i mod 4), values from vectors64
  people13    features = vectors64 values 1..8, label = vec_id mod 13
  animals3    lineitem quantity, extendedprice, discount, tax; label = position of
              l_returnflag in (A, N, R)
  path labels url without the trailing '/?([?#].*)?$' part, second-last '/' segment
  user series events per user ordered by (ts, event_id); one-hot of event_type over
              (click, error, purchase, signup, view)
  order classes o_orderstatus over (F, O, P)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = 42
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
RETURN_FLAGS = ["A", "N", "R"]
ORDER_STATUS = ["F", "O", "P"]
URL_TAIL = r"/?([?#].*)?$"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quantise(col, scale: int = 256):
    return F.round(col.cast("double") * F.lit(float(scale))) / F.lit(float(scale))


def vectors64(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"),
                    F.transform("embedding", lambda v: quantise(v)).alias("features"),
                    F.col("label").cast("int").alias("label"))


def image8(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"),
                    F.transform("embedding", lambda v: F.floor((v.cast("double") + F.lit(1.0)) * F.lit(127.5))
                                .cast("int")).alias("px"),
                    F.col("label").cast("int").alias("label"))


def people13(spark, sf_dir) -> DataFrame:
    v = vectors64(spark, sf_dir)
    return v.select("id", F.slice("features", 1, 8).alias("features"),
                    (F.col("id") % 13).cast("int").alias("label"))


def _index_of(col, values):
    expr = F.lit(None).cast("int")
    for i, val in reversed(list(enumerate(values))):
        expr = F.when(F.col(col) == F.lit(val), F.lit(i)).otherwise(expr)
    return expr


def animals3(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                     _index_of("l_returnflag", RETURN_FLAGS).alias("flag_id"))


def path_labels(spark, sf_dir) -> DataFrame:
    g = table(spark, sf_dir, "pages")
    trimmed = F.regexp_replace("url", URL_TAIL, "")
    parts = F.split(trimmed, "/")
    return g.select("page_id", "url", F.element_at(parts, -2).alias("label"))


def user_series(spark, sf_dir) -> DataFrame:
    v = table(spark, sf_dir, "events")
    onehot = F.array(*[F.when(F.col("event_type") == F.lit(t), F.lit(1.0)).otherwise(F.lit(0.0))
                       for t in EVENT_TYPES])
    return v.select("user_id", "ts", "event_id", "value", onehot.alias("features"))


def order_inputs(spark, sf_dir) -> DataFrame:
    """input1: 3 order features, quantised to 1/256 after power-of-two scaling."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"),
                    F.array(quantise(F.col("o_totalprice") / F.lit(65536.0)),
                            (F.col("o_custkey") % 16).cast("double") / F.lit(16.0),
                            _index_of("o_orderstatus", ORDER_STATUS).cast("double") / F.lit(2.0)).alias("in1"),
                    _index_of("o_orderstatus", ORDER_STATUS).alias("status_id"),
                    F.col("o_totalprice"))


def line_inputs(spark, sf_dir) -> DataFrame:
    """input2: per-order lineitem aggregates (3); lineitem has no unique key, so aggregate first."""
    li = table(spark, sf_dir, "lineitem")
    agg = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"),
                                       F.sum("l_quantity").alias("qty"),
                                       F.max("l_discount").alias("max_disc"))
    return agg.select(F.col("l_orderkey").alias("id"),
                      F.array(F.col("n_lines").cast("double") / F.lit(8.0),
                              quantise(F.col("qty") / F.lit(256.0)),
                              quantise(F.col("max_disc") * F.lit(8.0))).alias("in2"),
                      F.col("n_lines"))
