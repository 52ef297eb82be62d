"""Queries for splits, preparation, label handling and the flagship slice."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prep, splits
from ..operators.evaluation import confusion
from ..operators.model import Net, output
from ..operators.scoring import predict
from ..operators.training import gradient
from ..session import scratch_path
from . import fixtures as fx
from .registry import IMG8, V64, explode, order_key, register

SEED = fx.SEED


# ---------------------------------------------------------------- flagship (survey 7.2 step 1)

def flagship(spark, sf_dir):
    """embeddings -> 70/30 split -> one full-batch softmax step from zero -> score test -> confusion."""
    v = fx.vectors64(spark, sf_dir)
    parts = splits.weighted_split(v, "id", [7, 3], SEED)
    train = parts.filter(F.col("part") == 0)
    test = parts.filter(F.col("part") == 1)
    net = Net.sequential((64,), [output(10, "softmax", "nll")]).init(scheme="zero")
    grads, _, _ = gradient(train, net, "features", "label", 10)
    lr = 1.0
    for k in net.params:
        net.params[k] = net.params[k] - lr * grads[k]
    pred = predict(test, net, "features", keep=["id", "label"])
    return confusion(pred, 10)


FLAGSHIP_SQL = f"""
WITH v AS ({V64}),
r AS (SELECT id, x, label, row_number() OVER (ORDER BY {order_key(SEED)}, id) - 1 AS rk,
             count(*) OVER () AS n FROM v),
tr AS (SELECT id, x, label FROM r WHERE rk < (n * 7) // 10),
te AS (SELECT id, x, label FROM r WHERE rk >= (n * 7) // 10),
ntr AS (SELECT count(*)::DOUBLE AS n FROM tr),
d AS (SELECT tr.id, t.j AS j,
             0.1::DOUBLE - CASE WHEN tr.label = t.j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS dz
      FROM tr, range(10) t(j)),
xe AS ({explode('tr', 'x')}),
gw AS (SELECT xe.i, d.j, sum(xe.v * d.dz) / (SELECT n FROM ntr) AS g FROM xe JOIN d ON xe.id = d.id
       GROUP BY xe.i, d.j),
gb AS (SELECT j, sum(dz) / (SELECT n FROM ntr) AS g FROM d GROUP BY j),
tx AS ({explode('te', 'x', 'id, label')}),
z AS (SELECT tx.id, tx.label, gw.j, sum(tx.v * (0 - gw.g)) AS s FROM tx JOIN gw ON tx.i = gw.i
      GROUP BY tx.id, tx.label, gw.j),
zz AS (SELECT z.id, z.label, z.j, z.s + (0 - gb.g) AS z FROM z JOIN gb ON z.j = gb.j),
pred AS (SELECT id, label, j FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY z DESC, j) AS rn FROM zz)
         WHERE rn = 1),
counts AS (SELECT label::BIGINT AS actual, j::BIGINT AS predicted, count(*) AS n FROM pred GROUP BY 1, 2)
SELECT a.i::BIGINT AS actual, p.j::BIGINT AS predicted, coalesce(c.n, 0)::BIGINT AS n
FROM range(10) a(i), range(10) p(j) LEFT JOIN counts c ON c.actual = a.i AND c.predicted = p.j
"""

register("flagship_train_score_evaluate", FLAGSHIP_SQL)(flagship)


# ---------------------------------------------------------------- SPL-01..03, PRE-09

@register("spl01_seeded_order", f"""
SELECT vec_id AS id, (row_number() OVER (ORDER BY {order_key(SEED, 'vec_id')}, vec_id) - 1)::BIGINT AS pos
FROM embeddings""")
def spl01(spark, sf_dir):
    e = fx.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"))
    return splits.seeded_order(e, "id", SEED)


def _split_sql(a: int, b: int) -> str:
    return f"""
SELECT o_orderkey, CASE WHEN rk < (n * {a}) // {a + b} THEN 0 ELSE 1 END::BIGINT AS part
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {order_key(SEED, 'o_orderkey')}, o_orderkey) - 1 AS rk,
             count(*) OVER () AS n FROM orders)"""


@register("spl02_split_70_30", _split_sql(7, 3))
def spl02_7030(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey")
    return splits.weighted_split(o, "o_orderkey", [7, 3], SEED)


@register("spl02_split_90_10", _split_sql(9, 1))
def spl02_9010(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey")
    return splits.weighted_split(o, "o_orderkey", [9, 1], SEED)


_BATCH_SQL = f"""(SELECT o_orderkey, (row_number() OVER (ORDER BY {order_key(SEED, 'o_orderkey')}, o_orderkey) - 1)
                  // {{size}} AS batch_id FROM orders)"""


@register("spl03_stride_sample", f"""
SELECT o_orderkey, batch_id::BIGINT AS batch_id, CASE WHEN batch_id % 3 = 0 THEN 'test' ELSE 'train' END AS part
FROM {_BATCH_SQL.format(size=10)}""")
def spl03(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey")
    b = splits.assign_batches(o, "o_orderkey", 10, SEED)
    return splits.stride_sample(b, "batch_id", every=3, exclude=True)


@register("pre09_batches", f"""
SELECT batch_id::BIGINT AS batch_id, count(*)::BIGINT AS n, min(o_orderkey) AS min_id, max(o_orderkey) AS max_id
FROM {_BATCH_SQL.format(size=128)} GROUP BY batch_id""")
def pre09(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey")
    b = splits.assign_batches(o, "o_orderkey", 128, SEED)
    return splits.batch_bounds(b, "o_orderkey")


@register("spl02_split_from_index", f"""
WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY {order_key(SEED, 'o_orderkey')}, o_orderkey) - 1 AS rank, count(*) OVER () AS n
           FROM orders)
SELECT CASE WHEN rank < (n * 7) // 10 THEN 0 ELSE 1 END AS part, (rank // 128)::BIGINT AS batch_id, rank::BIGINT AS rank, o_orderkey, o_totalprice FROM r""")
def spl02_split_from_index(spark, sf_dir):
    path = scratch_path(spark, "shuffled-orders")
    splits.write_shuffled(fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", SEED, path, block_rows=1 << 14)
    cuts = [0, *splits.split_sizes(splits.shuffled_size(spark, path), [7, 3])]
    train, test = (splits.read_ranks(spark, path, a, b).withColumn("part", F.lit(j)) for j, (a, b) in enumerate(zip(cuts, cuts[1:])))
    return train.unionByName(test).select("part", F.floor(F.col("rank") / 128).cast("bigint").alias("batch_id"), "rank", "o_orderkey", "o_totalprice")


# ---------------------------------------------------------------- SRC-02: vectors with split

@register("src02_scan_vectors_train", f"""
WITH v AS ({V64}),
r AS (SELECT *, row_number() OVER (ORDER BY {order_key(SEED)}, id) - 1 AS rk, count(*) OVER () AS n FROM v)
SELECT id, label, generate_subscripts(x, 1) - 1 AS i, unnest(x) AS value FROM r WHERE rk < (n * 7) // 10""")
def src02(spark, sf_dir):
    from ..sources.vectors import scan_vectors
    v = scan_vectors(spark, f"{sf_dir}/embeddings.parquet", split="train", seed=SEED, weights=(7, 3))
    return prep.explode_array(v, ["id", "label"], "features", "i", "value")


# ---------------------------------------------------------------- PRE-01..04

@register("pre01_split_label", """
SELECT l_orderkey, l_linenumber,
       (CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END)::INTEGER AS label,
       generate_subscripts(f, 1) - 1 AS i, unnest(f) AS value
FROM (SELECT *, [l_quantity, l_extendedprice, l_discount, l_tax] AS f FROM lineitem)""")
def pre01(spark, sf_dir):
    a = fx.animals3(spark, sf_dir)
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "flag_id"]
    s = prep.split_label(a, cols, label_index=4, keep=["l_orderkey", "l_linenumber"])
    return prep.explode_array(s, ["l_orderkey", "l_linenumber", "label"], "features", "i", "value")


@register("pre02_index_labels", """
SELECT c_custkey, c_mktsegment, (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::INTEGER AS label FROM customer""")
def pre02(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return prep.index_labels(c, "c_mktsegment").select("c_custkey", "c_mktsegment", "label")


@register("pre03_one_hot", """
SELECT vec_id AS id, t.i AS i, CASE WHEN label = t.i THEN 1.0 ELSE 0.0 END::DOUBLE AS value
FROM embeddings, range(10) t(i)""")
def pre03(spark, sf_dir):
    e = fx.table(spark, sf_dir, "embeddings")
    oh = e.select(F.col("vec_id").alias("id"), prep.one_hot("label", 10).alias("y"))
    return prep.explode_array(oh, ["id"], "y", "i", "value")


@register("pre04_check_labels", """
SELECT count(*)::BIGINT AS n_rows, sum(CASE WHEN p_size < 0 OR p_size >= 13 THEN 1 ELSE 0 END)::BIGINT AS n_bad
FROM part""")
def pre04(spark, sf_dir):
    t = fx.table(spark, sf_dir, "part").select("p_size")
    return prep.label_report(t, "p_size", 13)


# ---------------------------------------------------------------- PRE-05 scaling

@register("pre05_scale_pixels", f"""
SELECT id, generate_subscripts(px, 1) - 1 AS i, unnest(list_transform(px, lambda p: p::DOUBLE / 255 * 1.0 + 0.0))
       AS value FROM ({IMG8})""")
def pre05(spark, sf_dir):
    img = fx.image8(spark, sf_dir)
    s = img.select("id", prep.scale_pixels("px", 0.0, 1.0).alias("px01"))
    return prep.explode_array(s, ["id"], "px01", "i", "value")


@register("pre05_fit_range", """
WITH s AS (SELECT min(p_retailprice) AS lo1, max(p_retailprice) AS hi1, min(p_size) AS lo2, max(p_size) AS hi2
           FROM part)
SELECT p_partkey,
       (p_retailprice - lo1) / (hi1 - lo1) * 2.0::DOUBLE + (-1.0)::DOUBLE AS p_retailprice_scaled,
       (p_size::DOUBLE - lo2) / (hi2 - lo2) * 2.0::DOUBLE + (-1.0)::DOUBLE AS p_size_scaled
FROM part, s""")
def pre05_fit(spark, sf_dir):
    t = fx.table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
    stats = prep.fit_range(t, ["p_retailprice", "p_size"])
    return prep.apply_range(t, stats, -1.0, 1.0).select("p_partkey", "p_retailprice_scaled", "p_size_scaled")


# ---------------------------------------------------------------- PRE-06..08, PRE-10 images

def _resize_sql(h, w, oh, ow, src="px", c=1) -> str:
    """Bilinear resize in SQL: explicit neighbour arithmetic per output pixel."""
    sy, sx = h / oh, w / ow
    return f"""
SELECT id, k AS i, (1.0::DOUBLE - ty) * ((1.0::DOUBLE - tx) * p00 + tx * p01)
                  + ty * ((1.0::DOUBLE - tx) * p10 + tx * p11) AS value
FROM (
  SELECT id, k,
         fy - floor(fy) AS ty, fx - floor(fx) AS tx,
         {src}[(ch * {h * w} + least(floor(fy), {h - 1}) * {w} + least(floor(fx), {w - 1}))::BIGINT + 1]::DOUBLE AS p00,
         {src}[(ch * {h * w} + least(floor(fy), {h - 1}) * {w} + least(least(floor(fx), {w - 1}) + 1, {w - 1}))::BIGINT + 1]::DOUBLE AS p01,
         {src}[(ch * {h * w} + least(least(floor(fy), {h - 1}) + 1, {h - 1}) * {w} + least(floor(fx), {w - 1}))::BIGINT + 1]::DOUBLE AS p10,
         {src}[(ch * {h * w} + least(least(floor(fy), {h - 1}) + 1, {h - 1}) * {w} + least(least(floor(fx), {w - 1}) + 1, {w - 1}))::BIGINT + 1]::DOUBLE AS p11
  FROM (
    SELECT id, {src}, t.k AS k, t.k // {oh * ow} AS ch,
           greatest(((t.k % {oh * ow}) // {ow} + 0.5::DOUBLE) * {sy}::DOUBLE - 0.5::DOUBLE, 0.0::DOUBLE) AS fy,
           greatest(((t.k % {ow}) + 0.5::DOUBLE) * {sx}::DOUBLE - 0.5::DOUBLE, 0.0::DOUBLE) AS fx
    FROM ({IMG8}), range({c * oh * ow}) t(k)))"""


@register("pre06_resize_down", _resize_sql(8, 8, 4, 4))
def pre06_down(spark, sf_dir):
    img = fx.image8(spark, sf_dir)
    r = img.select("id", prep.resize("px", 1, 8, 8, 4, 4).alias("r"))
    return prep.explode_array(r, ["id"], "r", "i", "value")


@register("pre06_resize_up", _resize_sql(8, 8, 16, 16))
def pre06_up(spark, sf_dir):
    img = fx.image8(spark, sf_dir)
    r = img.select("id", prep.resize("px", 1, 8, 8, 16, 16).alias("r"))
    return prep.explode_array(r, ["id"], "r", "i", "value")


@register("pre06_resize_mixed", f"""
WITH img AS (SELECT id, px, CASE WHEN id % 3 = 0 THEN 8 WHEN id % 3 = 1 THEN 4 ELSE 16 END AS h,
                    CASE WHEN id % 3 = 0 THEN 8 WHEN id % 3 = 1 THEN 6 ELSE 4 END AS w FROM ({IMG8})),
g AS (SELECT id, px, h, w, t.k AS k, greatest(((t.k // 7) + 0.5::DOUBLE) * (h::DOUBLE / 5) - 0.5::DOUBLE, 0.0::DOUBLE) AS fy,
             greatest(((t.k % 7) + 0.5::DOUBLE) * (w::DOUBLE / 7) - 0.5::DOUBLE, 0.0::DOUBLE) AS fx FROM img, range(35) t(k)),
n AS (SELECT *, floor(fy)::BIGINT AS y0, floor(fx)::BIGINT AS x0, least(floor(fy)::BIGINT + 1, h - 1) AS y1,
             least(floor(fx)::BIGINT + 1, w - 1) AS x1, fy - floor(fy) AS ty, fx - floor(fx) AS tx FROM g)
SELECT id, k AS i, (1.0::DOUBLE - ty) * ((1.0::DOUBLE - tx) * px[y0 * w + x0 + 1] + tx * px[y0 * w + x1 + 1])
                   + ty * ((1.0::DOUBLE - tx) * px[y1 * w + x0 + 1] + tx * px[y1 * w + x1 + 1]) AS value FROM n""")
def pre06_mixed(spark, sf_dir):
    """Images of three shapes (8x8, 4x6, 16x4), each resized by its own shape to 5x7."""
    img = fx.image8(spark, sf_dir)
    kind = F.col("id") % 3
    img = img.withColumn("h", F.when(kind == 0, 8).when(kind == 1, 4).otherwise(16)) \
        .withColumn("w", F.when(kind == 0, 8).when(kind == 1, 6).otherwise(4))
    img = img.withColumn("px", F.slice("px", F.lit(1), F.col("h") * F.col("w")))
    return prep.explode_array(img.select("id", prep.resize("px", 1, "h", "w", 5, 7).alias("r")), ["id"], "r", "i", "value")


@register("pre07_flip", f"""
SELECT id, t.k AS i, px[(t.k // 8) * 8 + 7 - (t.k % 8) + 1]::INTEGER AS value FROM ({IMG8}), range(64) t(k)""")
def pre07(spark, sf_dir):
    img = fx.image8(spark, sf_dir)
    f = img.select("id", prep.flip_horizontal("px", 1, 8, 8).alias("f"))
    return prep.explode_array(f, ["id"], "f", "i", "value")


_AUG_COIN = "(('0x' || substr(md5(concat_ws('|', '42', '1', '0', id::VARCHAR)), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


@register("pre08_augment", f"""
WITH r AS ({_resize_sql(8, 8, 4, 4)}),
a AS (SELECT id, i, value, {_AUG_COIN} < 0.5::DOUBLE AS flip FROM r)
SELECT a.id, a.i, CASE WHEN a.flip THEN b.value ELSE a.value END AS value
FROM a JOIN r b ON b.id = a.id AND b.i = (a.i // 4) * 4 + 3 - (a.i % 4)""")
def pre08(spark, sf_dir):
    img = fx.image8(spark, sf_dir)
    steps = [(lambda c: prep.resize(c, 1, 8, 8, 4, 4), 1.0),
             (lambda c: prep.flip_horizontal(c, 1, 4, 4), 0.5)]
    aug = prep.augment(img, "px", "id", steps, seed=SEED, epoch=0, out_col="aug")
    return prep.explode_array(aug.select("id", "aug"), ["id"], "aug", "i", "value")


@register("pre10_reshape_rows", f"""
WITH v AS ({V64}), e AS ({explode('v', 'x')})
SELECT id, (i // 16)::BIGINT AS c, ((i % 16) // 4)::BIGINT AS y, (i % 4)::BIGINT AS x, v AS value FROM e""")
def pre10(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    rows = prep.to_pixel_rows(v, "id", "features", 4, 4, 4)
    back = prep.from_pixel_rows(rows, "id", 4, 4, out_col="features")
    return prep.to_pixel_rows(back, "id", "features", 4, 4, 4)


# ---------------------------------------------------------------- SRC-04 labels from paths

@register("src04_path_labels", """
WITH l AS (SELECT string_split(regexp_replace(url, '/?([?#].*)?$', ''), '/') AS parts FROM pages),
c AS (SELECT parts[len(parts) - 1] AS label, count(*)::BIGINT AS n FROM l GROUP BY 1)
SELECT label, n, (row_number() OVER (ORDER BY label) - 1)::INTEGER AS class_id FROM c""")
def src04(spark, sf_dir):
    from ..sources.images import label_from_path
    g = fx.table(spark, sf_dir, "pages").select("page_id", "url")
    labelled = label_from_path(g, "url", strip=fx.URL_TAIL)
    return prep.class_list(labelled, "label").select("label", "n", "class_id")
