"""Queries for sources and sinks: delimited scan, image folders, model tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prep
from ..operators import scoring as S
from ..session import scratch_path
from ..sources.delimited import scan_delimited, write_delimited
from ..sources.images import scan_images, split_images, write_png_folder
from ..sources.model_store import read_model, write_model
from . import fixtures as fx
from .queries_scoring import SCORER_SQL, scorer_net
from .registry import IMG8, order_key, register


@register("src01_scan_delimited", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def src01(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    path = scratch_path(spark, "customer-csv")
    write_delimited(c, path)
    return scan_delimited(spark, path, "c_custkey long, c_nationkey int, c_acctbal double")


@register("src03_scan_image_folder", f"""
SELECT id, label::VARCHAR AS label, 1::INTEGER AS c, 8::INTEGER AS h, 8::INTEGER AS w,
       generate_subscripts(px, 1) - 1 AS i, unnest(px) AS value FROM ({IMG8})""")
def src03(spark, sf_dir):
    img = fx.image8(spark, sf_dir)
    root = scratch_path(spark, "photos")
    write_png_folder(img, root, "id", "px", "label", 8, 8)
    scanned = scan_images(spark, root)
    rows = scanned.select(F.regexp_extract("origin", r"/(\d+)\.png$", 1).cast("bigint").alias("id"),
                          "label", "c", "h", "w", F.transform("px", lambda p: p.cast("int")).alias("px"))
    out = prep.explode_array(rows, ["id", "label", "c", "h", "w"], "px", "i", "value")
    return out.withColumn("value", F.col("value").cast("int"))


@register("src03_split_image_paths", f"""
WITH k AS (SELECT id, label, px, label::VARCHAR || '/' || id::VARCHAR || '.png' AS key FROM ({IMG8})),
r AS (SELECT *, row_number() OVER (ORDER BY {order_key(11, 'key')}, key) - 1 AS place, count(*) OVER () AS n FROM k)
SELECT id, label::VARCHAR AS label, (place >= n * 7 // 10)::BIGINT AS part, list_sum(px)::BIGINT AS total FROM r""")
def src03_split(spark, sf_dir):
    """70 / 30 by path: every part opens its own files only."""
    root = scratch_path(spark, "photos")
    write_png_folder(fx.image8(spark, sf_dir), root, "id", "px", "label", 8, 8)
    parts = [p.withColumn("part", F.lit(j).cast("bigint")) for j, p in enumerate(split_images(spark, root, [7, 3], seed=11))]
    total = F.aggregate("px", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return parts[0].unionByName(parts[1]).select(F.regexp_extract("origin", r"/(\d+)\.png$", 1).cast("bigint").alias("id"), "label", "part", total.alias("total"))


@register("snk01_02_model_round_trip", f"""
WITH {SCORER_SQL}
SELECT id, j::BIGINT AS i, round(p, 6) AS value FROM s""")
def snk01(spark, sf_dir):
    path = scratch_path(spark, "model")
    write_model(spark, scorer_net(), path)
    restored = read_model(spark, path)
    v = fx.vectors64(spark, sf_dir)
    out = S.score(v, restored, "features", keep=["id"])
    ex = prep.explode_array(out, ["id"], "out", "i", "value")
    return ex.withColumn("value", F.round("value", 6))
