"""Queries for the forward operators SCR-01..16 and evaluation EVL-01..03."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.hashing import hash01
from ..operators import image_ops as I
from ..operators import image_tiles
from ..operators import prep, sequence
from ..operators import scoring as S
from ..operators.evaluation import class_metrics, confusion, merge_confusions, partial_confusions, summary
from ..operators.model import Net, Vertex, activation_layer, batchnorm_layer, conv2d, dense, fixed_weight, output
from ..operators.statistics import activation_histograms, merge_histograms
from . import fixtures as fx
from . import sql_tensors as Q
from .registry import IMG8, V64, act_sql, b_sql, dense_sql, explode, register, softmax_sql, w_sql

SEED = fx.SEED


def _explode(df, keys, col, idx="i", val="value"):
    return prep.explode_array(df, keys, col, idx, val)


def _rounded(df, cols, digits=6):
    for c in cols:
        df = df.withColumn(c, F.round(F.col(c), digits))
    return df


# ---------------------------------------------------------------- SCR-01 dense, SCR-02 activations

@register("scr01_dense", f"""
WITH v AS ({V64}), e AS ({explode('v', 'x')})
SELECT id, j::BIGINT AS i, z AS value FROM ({dense_sql('e', 0, 10)})""")
def scr01(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    net = Net.sequential((64,), [dense(10, "identity")]).fixed_init()
    return _explode(S.score(v, net, "features", keep=["id"]), ["id"], "out")


@register("scr01_dense_blocked", f"""
WITH v AS ({V64}), e AS ({explode('v', 'x')})
SELECT id, j::BIGINT AS i, z AS value FROM ({dense_sql('e', 0, 50)})""")
def scr01_blocked(spark, sf_dir):
    """64 x 50 weights from tables in tiles of 24 x 16, borders included."""
    v = fx.vectors64(spark, sf_dir)
    W = spark.range(64 * 50).selectExpr("id div 50 AS i", "id % 50 AS j").selectExpr("i", "j", "(((i * 7 + j * 13) % 17) - 8) / 64D AS w")
    b = spark.range(50).selectExpr("id AS j", "((id * 5) % 9 - 4) / 64D AS b")
    return _explode(S.dense_blocked(v, "id", "features", W, b, 64, 50, out_col="out", inner=24, cols=16, row_blocks=8), ["id"], "out")


ACTS = ["relu", "leakyrelu", "sigmoid", "tanh"]


@register("scr02_activations", f"""
WITH v AS ({V64}), e AS ({explode('v', 'x')}), z AS ({dense_sql('e', 0, 10)}),
s AS ({softmax_sql('z')})
SELECT id, j::BIGINT AS i, z,
       {', '.join(f'round({act_sql(a)}, 6) AS {a}' for a in ACTS)}, round(p, 6) AS softmax FROM s""")
def scr02(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    net = Net.sequential((64,), [dense(10, "identity")]).fixed_init()
    z = S.score(v, net, "features", keep=["id"], outputs={"0": "z"})
    acts = [S.act_expr("z", a).alias(a) for a in ACTS + ["softmax"]]
    zz = z.select("id", F.arrays_zip(F.col("z").alias("z"), *acts).alias("t"))
    ex = zz.select("id", F.posexplode("t").alias("i", "t"))
    out = ex.select("id", F.col("i").cast("bigint"), F.col("t.z").alias("z"),
                    *[F.col(f"t.{a}").alias(a) for a in ACTS + ["softmax"]])
    return _rounded(out, ACTS + ["softmax"])


# ---------------------------------------------------------------- SCR-03 conv, SCR-04 pool

def _weights(net):
    """(weights, bias) of a net's only layer."""
    by_name = {name: value for (_, name), value in net.params.items()}
    return by_name["W"], by_name["b"]


def _img_rows(src_sql, arr, h, w):
    return Q.pixels(f"({src_sql})", arr, h, w)


@register("scr03_conv_8x8_stride1_truncate", f"""
WITH p AS ({_img_rows(IMG8, 'px', 8, 8)}), c AS ({Q.conv('p', 0, 2, 3, 3, 1, 0, 0, 6, 6)})
{Q.flat('c', 6, 6)}""")
def scr03_a(spark, sf_dir):
    img = fx.image8(spark, sf_dir).select("id", F.transform("px", lambda p: p.cast("double")).alias("x"))
    net = Net.sequential((1, 8, 8), [conv2d(2, (3, 3), (1, 1), (0, 0), "truncate")]).fixed_init()
    return _explode(img.select("id", I.conv2d("x", 1, 8, 8, *_weights(net)).alias("out")), ["id"], "out")


@register("scr03_conv_4x4x4_stride2_same", f"""
WITH p AS ({_img_rows(V64, 'x', 4, 4)}), c AS ({Q.conv('p', 0, 3, 3, 3, 2, 0, 0, 2, 2)})
{Q.flat('c', 2, 2)}""")
def scr03_b(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    net = Net.sequential((4, 4, 4), [conv2d(3, (3, 3), (2, 2), (0, 0), "same")]).fixed_init()
    out = I.conv2d("features", 4, 4, 4, *_weights(net), stride=(2, 2), mode="same")
    return _explode(v.select("id", out.alias("out")), ["id"], "out")


@register("scr04_maxpool_2x2", f"""
WITH p AS ({_img_rows(IMG8, 'px', 8, 8)}), q AS ({Q.pool('p', 2, 2, 4, 4)}) {Q.flat('q', 4, 4)}""")
def scr04_a(spark, sf_dir):
    img = fx.image8(spark, sf_dir).select("id", F.transform("px", lambda p: p.cast("double")).alias("x"))
    return _explode(img.select("id", I.pool2d("x", 1, 8, 8, (2, 2), (2, 2)).alias("out")), ["id"], "out")


@register("scr04_maxpool_3x3_stride2", f"""
WITH p AS ({_img_rows(IMG8, 'px', 8, 8)}), q AS ({Q.pool('p', 3, 2, 3, 3)}) {Q.flat('q', 3, 3)}""")
def scr04_b(spark, sf_dir):
    img = fx.image8(spark, sf_dir).select("id", F.transform("px", lambda p: p.cast("double")).alias("x"))
    return _explode(img.select("id", I.pool2d("x", 1, 8, 8, (3, 3), (2, 2)).alias("out")), ["id"], "out")


@register("scr04_wide_maxpool_7x6", f"""
WITH p AS ({_img_rows(IMG8, 'px', 8, 8)}),
q AS (SELECT id, c, oy.oy AS y, ox.ox AS x, max(v) AS v FROM p, range(2) oy(oy), range(3) ox(ox)
      WHERE p.y BETWEEN oy.oy AND oy.oy + 6 AND p.x BETWEEN ox.ox AND ox.ox + 5 GROUP BY id, c, oy.oy, ox.ox) {Q.flat('q', 2, 3)}""")
def scr04_wide(spark, sf_dir):
    img = fx.image8(spark, sf_dir).select("id", F.transform("px", lambda p: p.cast("double")).alias("x"))
    return _explode(img.select("id", I.wide_pool2d("x", 1, 8, 8, (7, 6), (1, 1)).alias("out")), ["id"], "out")


# ---------------------------------------------------------------- SCR-05 LRN, SCR-06 batch norm, SCR-07 pad

@register("scr05_lrn", f"""
WITH p AS ({_img_rows(V64, 'x', 4, 4)}),
s AS (SELECT a.id, a.c, a.y, a.x, a.v, sum(b.v * b.v) AS ss FROM p a JOIN p b
      ON a.id = b.id AND a.y = b.y AND a.x = b.x AND abs(a.c - b.c) <= 2 GROUP BY a.id, a.c, a.y, a.x, a.v),
o AS (SELECT id, c, y, x, round(v / pow(2.0::DOUBLE + 0.0001::DOUBLE * ss, 0.75::DOUBLE), 6) AS v FROM s)
{Q.flat('o', 4, 4)}""")
def scr05(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    return _rounded(_explode(v.select("id", I.lrn("features", 4, 4, 4).alias("out")), ["id"], "out"), ["value"])


@register("scr05_tiled_conv_lrn_pool", f"""
WITH p AS ({_img_rows(IMG8, 'px', 8, 8)}), c AS ({Q.conv('p', 0, 2, 3, 3, 1, 1, 1, 8, 8)}),
s AS (SELECT a.id, a.c, a.y, a.x, a.v, sum(b.v * b.v) AS ss FROM c a JOIN c b
      ON a.id = b.id AND a.y = b.y AND a.x = b.x AND abs(a.c - b.c) <= 2 GROUP BY a.id, a.c, a.y, a.x, a.v),
o AS (SELECT id, c, y, x, v / pow(2.0::DOUBLE + 0.0001::DOUBLE * ss, 0.75::DOUBLE) AS v FROM s),
q AS ({Q.pool('o', 3, 2, 3, 3)}) {Q.flat('q', 3, 3, val='round(v, 6)')}""")
def scr05_tiled(spark, sf_dir):
    grid = image_tiles.Grid(1, 8, 8, 3, 3)
    net = Net.sequential((1, 8, 8), [conv2d(2, (3, 3), (1, 1), (0, 0), "same")]).fixed_init()
    tiles = image_tiles.cut_tiles(fx.image8(spark, sf_dir), "id", "px", grid)
    tiles, grid = image_tiles.conv2d_tiles(tiles, "id", grid, *_weights(net), mode="same", tile=(4, 3))
    tiles, grid = image_tiles.lrn_tiles(tiles, "id", grid)
    tiles, grid = image_tiles.pool2d_tiles(tiles, "id", grid, (3, 3), (2, 2), tile=(2, 2))
    return _rounded(image_tiles.tile_values(tiles, "id", grid), ["value"])


# twelve vectors make an image of 3 channels and 2 x 2 tiles of 8 x 8 places
@register("scr03_tiled_conv_11x11x3_stride4", f"""
WITH whole AS (SELECT vec_id // 12 AS id FROM embeddings GROUP BY 1 HAVING count(*) = 12),
e AS (SELECT vec_id // 12 AS id, (vec_id % 12) // 4 AS ch, vec_id % 4 AS q, generate_subscripts(embedding, 1) - 1 AS k,
             round(unnest(embedding)::DOUBLE * 256) / 256 AS v FROM embeddings),
p AS (SELECT id, ch AS c, (q // 2) * 8 + k // 8 AS y, (q % 2) * 8 + k % 8 AS x, v FROM e WHERE id IN (SELECT id FROM whole)),
c AS ({Q.conv('p', 0, 4, 11, 11, 4, 2, 2, 3, 3)}) {Q.flat('c', 3, 3, val='round(v, 6)')}""")
def scr03_tiled(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    tile = F.col("id") % 4
    tiles = v.groupBy(F.floor(F.col("id") / 12).cast("bigint").alias("image"), F.floor(tile / 2).cast("int").alias("ty"), (tile % 2).cast("int").alias("tx")) \
        .agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("id", "features"))), lambda r: r["features"])).alias("px"))
    whole = v.groupBy(F.floor(F.col("id") / 12).cast("bigint").alias("image")).agg(F.count(F.lit(1)).alias("n")).filter("n = 12").select("image")
    net = Net.sequential((3, 16, 16), [conv2d(4, (11, 11), (4, 4), (2, 2), "truncate")]).fixed_init()
    tiles = tiles.join(whole, "image").withColumnRenamed("image", "id")
    tiles, grid = image_tiles.conv2d_tiles(tiles, "id", image_tiles.Grid(3, 16, 16, 8, 8), *_weights(net), stride=(4, 4), padding=(2, 2), tile=(2, 2))
    return _rounded(image_tiles.tile_values(tiles, "id", grid), ["value"])


@register("scr06_batchnorm_fit", f"""
WITH p AS ({_img_rows(V64, 'x', 4, 4)}),
st AS (SELECT c, avg(v) AS m, var_pop(v) AS s2 FROM p GROUP BY c),
o AS (SELECT id, p.c, y, x, round((v - m) / sqrt(s2 + 0.00001::DOUBLE), 6) AS v FROM p JOIN st ON p.c = st.c)
{Q.flat('o', 4, 4)}""")
def scr06(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    mean, var = S.batchnorm_fit(v, "features", 4, 4, 4)
    out = v.select("id", S.batchnorm_apply("features", 16, mean, var).alias("bn"))
    return _rounded(_explode(out, ["id"], "bn"), ["value"])


@register("scr07_zero_padding", f"""
SELECT id, t.k AS i,
       CASE WHEN t.k // 14 - 3 BETWEEN 0 AND 7 AND t.k % 14 - 3 BETWEEN 0 AND 7
            THEN px[(t.k // 14 - 3) * 8 + (t.k % 14 - 3) + 1]::DOUBLE ELSE 0.0::DOUBLE END AS value
FROM ({IMG8}), range(196) t(k)""")
def scr07(spark, sf_dir):
    img = fx.image8(spark, sf_dir).select("id", F.transform("px", lambda p: p.cast("double")).alias("x"))
    return _explode(img.select("id", I.zero_pad("x", 1, 8, 8, 3, 3, 3, 3).alias("out")), ["id"], "out")


# ---------------------------------------------------------------- SCR-08 merge, SCR-09 residual add

def two_input_net():
    vs = [Vertex("ly1", "layer", ["input1"], dense(4, "relu")),
          Vertex("ly2", "layer", ["input2"], dense(4, "relu")),
          Vertex("merge", "merge", ["ly1", "ly2"]),
          Vertex("out", "layer", ["merge"], output(3, "identity", "mse"))]
    return Net({"input1": (3,), "input2": (3,)}, vs, ["out"]).fixed_init()


TWO_INPUTS_SQL = """
o AS (SELECT o_orderkey AS id,
             [round(o_totalprice / 65536 * 256) / 256, (o_custkey % 16)::DOUBLE / 16,
              (CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END)::DOUBLE / 2] AS in1
      FROM orders),
l AS (SELECT l_orderkey AS id,
             [count(*)::DOUBLE / 8, round(sum(l_quantity) / 256 * 256) / 256, round(max(l_discount) * 8 * 256) / 256]
             AS in2 FROM lineitem GROUP BY l_orderkey),
j AS (SELECT o.id, o.in1, l.in2 FROM o JOIN l ON o.id = l.id)"""


@register("scr08_merge_two_inputs", f"""
WITH {TWO_INPUTS_SQL},
e1 AS ({explode('j', 'in1')}), e2 AS ({explode('j', 'in2')}),
h1 AS (SELECT id, j AS i, greatest(z, 0.0::DOUBLE) AS v FROM ({dense_sql('e1', 0, 4)})),
h2 AS (SELECT id, j + 4 AS i, greatest(z, 0.0::DOUBLE) AS v FROM ({dense_sql('e2', 1, 4)})),
m AS (SELECT * FROM h1 UNION ALL SELECT * FROM h2)
SELECT id, j::BIGINT AS i, z AS value FROM ({dense_sql('m', 3, 3)})""")
def scr08(spark, sf_dir):
    merged = S.merge_inputs(fx.order_inputs(spark, sf_dir).select("id", "in1"),
                            fx.line_inputs(spark, sf_dir).select("id", "in2"), "id", "in1", "in2")
    out = S.score(merged, two_input_net(), {"input1": "in1", "input2": "in2"}, keep=["id"])
    return _explode(out, ["id"], "out")


@register("scr09_residual_add", f"""
WITH v AS ({V64}), e AS ({explode('v', 'x')}),
d AS (SELECT id, j AS i, greatest(z, 0.0::DOUBLE) AS v FROM ({dense_sql('e', 0, 64)}))
SELECT e.id, e.i::BIGINT AS i, e.v + d.v AS value FROM e JOIN d ON e.id = d.id AND e.i = d.i""")
def scr09(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    net = Net.sequential((64,), [dense(64, "relu")]).fixed_init()
    branch = S.score(v, net, "features", keep=["id", "features"], outputs={"0": "branch"})
    out = branch.select("id", S.residual_add("features", "branch").alias("sum"))
    return _explode(out, ["id"], "sum")


# ---------------------------------------------------------------- SCR-10..12 series

def _lstm_sql() -> str:
    """Peephole LSTM (5 -> 5) + per-step softmax output on [x, h], one recursion step per time step."""
    sig = "(1.0::DOUBLE / (1.0::DOUBLE + exp(-({})))) "
    types = ", ".join(f"'{t}'" for t in fx.EVENT_TYPES)
    return f"""
WITH RECURSIVE
ev AS (SELECT user_id, event_id, event_type,
              row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step FROM events),
x AS (SELECT ev.user_id, ev.step, ev.event_id, t.i AS i,
             CASE WHEN ev.event_type = [{types}][t.i + 1] THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS v
      FROM ev, range(5) t(i)),
st(user_id, step, u, h, c) AS (
  SELECT DISTINCT user_id, -1::BIGINT, t.u, 0.0::DOUBLE, 0.0::DOUBLE FROM ev, range(5) t(u)
  UNION ALL
  SELECT * FROM (
    WITH cur AS (SELECT * FROM st),
    xs AS (SELECT x.user_id, x.step, x.i, x.v FROM x JOIN (SELECT DISTINCT user_id, step FROM cur) k
           ON x.user_id = k.user_id AND x.step = k.step + 1),
    gx AS (SELECT xs.user_id, xs.step, t.k, sum(xs.v * {w_sql(0, 'xs.i', 't.k')}) AS s FROM xs, range(20) t(k)
           GROUP BY xs.user_id, xs.step, t.k),
    gh AS (SELECT cur.user_id, t.k, sum(cur.h * {w_sql(1, 'cur.u', 't.k')}) AS s FROM cur, range(20) t(k)
           GROUP BY cur.user_id, t.k),
    g AS (SELECT gx.user_id, gx.step, gx.k, gx.s + gh.s + CASE WHEN gx.k BETWEEN 5 AND 9 THEN 1.0::DOUBLE
                 ELSE 0.0::DOUBLE END AS g FROM gx JOIN gh ON gx.user_id = gh.user_id AND gx.k = gh.k),
    gates AS (SELECT user_id, step, k % 5 AS u, max(CASE WHEN k < 5 THEN g END) AS gi,
                     max(CASE WHEN k BETWEEN 5 AND 9 THEN g END) AS gf, max(CASE WHEN k BETWEEN 10 AND 14 THEN g END) AS go,
                     max(CASE WHEN k >= 15 THEN g END) AS gc FROM g GROUP BY user_id, step, k % 5),
    c2 AS (SELECT gates.user_id, gates.step, gates.u, gates.go,
                  {sig.format('gates.gf + cur.c / 64')} * cur.c + {sig.format('gates.gi + cur.c / 64')} * tanh(gates.gc) AS c
           FROM gates JOIN cur ON cur.user_id = gates.user_id AND cur.u = gates.u)
    SELECT user_id, step, u, {sig.format('go + c / 64')} * tanh(c) AS h, c FROM c2)
),
feat AS (SELECT user_id, step, i, v FROM x UNION ALL SELECT user_id, step, 5 + u AS i, h AS v FROM st WHERE step >= 0),
z AS (SELECT user_id, step, t.j AS j, sum(v * {w_sql(2, 'i', 't.j')}) AS z FROM feat, range(5) t(j)
      GROUP BY user_id, step, t.j),
p AS ({softmax_sql('z', keys='user_id, step')})
SELECT p.user_id, ev.event_id, p.step::BIGINT AS step, p.j::BIGINT AS i, round(p.p, 6) AS value
FROM p JOIN ev ON ev.user_id = p.user_id AND ev.step = p.step"""


@register("scr10_lstm_user_series", _lstm_sql())
def scr10(spark, sf_dir):
    s = fx.user_series(spark, sf_dir)
    params = sequence.lstm_params(5, 5, 5)
    out = sequence.lstm_score(s, "user_id", ["ts", "event_id"], "features", params, units=5, keep=["event_id"])
    return _rounded(_explode(out, ["user_id", "event_id", "step"], "out"), ["value"])


@register("scr10_lstm_segments", _lstm_sql())
def scr10_segments(spark, sf_dir):
    s = fx.user_series(spark, sf_dir)
    out = sequence.lstm_score_segments(s, "user_id", ["ts", "event_id"], "features", sequence.lstm_params(5, 5, 5), units=5, segment=32, keep=["event_id"])
    return _rounded(_explode(out, ["user_id", "event_id", "step"], "out"), ["value"])


CONV1D_W = np.array([[fixed_weight(0, d, o) for d in range(3)] for o in range(2)])
CONV1D_B = np.array([((o * 5) % 9 - 4) / 64.0 for o in range(2)])


@register("scr11_conv1d_series", f"""
WITH q AS (SELECT user_id, ts, event_id, round(value * 256) / 256 AS value FROM events),
s AS (SELECT user_id, value,
                  coalesce(lag(value) OVER w, 0.0::DOUBLE) AS xm, coalesce(lead(value) OVER w, 0.0::DOUBLE) AS xp,
                  row_number() OVER w - 1 AS pos
           FROM q WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, pos::BIGINT AS pos, o.o::BIGINT AS i,
       xm * {w_sql(0, '0', 'o.o')} + value * {w_sql(0, '1', 'o.o')} + xp * {w_sql(0, '2', 'o.o')}
             + {b_sql(0, 'o.o')} AS value
FROM s, range(2) o(o)""")
def scr11(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", fx.quantise(F.col("value")).alias("value"))
    out = sequence.conv1d(ev, "user_id", ["ts", "event_id"], "value", CONV1D_W, CONV1D_B, padding=1)
    return _explode(out, ["user_id", "pos"], "out")


@register("scr12_pool1d_series", """
WITH s AS (SELECT user_id, max(value) OVER (w ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS value,
                  row_number() OVER w - 1 AS pos
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, (pos // 2)::BIGINT AS pos, value FROM s WHERE pos % 2 = 0""")
def scr12(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return sequence.pool1d(ev, "user_id", ["ts", "event_id"], "value", 3, 2, 1, "max")


def _wide_sql(agg: str) -> str:
    """Windows of 31 rows, 15 before and 15 behind, at every third row."""
    return f"""
WITH s AS (SELECT user_id, {agg}(value) OVER (w ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING) AS value,
                  row_number() OVER w - 1 AS pos
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, (pos // 3)::BIGINT AS pos, {'value' if agg == 'max' else 'round(value, 6)'} AS value FROM s WHERE pos % 3 = 0"""


@register("scr12_wide_maxpool1d", _wide_sql("max"))
def scr12_wide_max(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return sequence.wide_pool1d(ev, "user_id", ["ts", "event_id"], "value", 31, 3, 15, "max")


@register("scr12_wide_meanpool1d", _wide_sql("avg"))
def scr12_wide_mean(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return _rounded(sequence.wide_pool1d(ev, "user_id", ["ts", "event_id"], "value", 31, 3, 15, "avg"), ["value"])


# ---------------------------------------------------------------- SCR-13 residual blocks

def identity_block_net():
    """conv1x1(2)-bn-relu-conv3x3 same(2)-bn-relu-conv1x1(4)-bn, + input, relu. Vertex index = layer."""
    L = lambda name, ins, lay: Vertex(name, "layer", ins, lay)
    vs = [L("c1", ["input"], conv2d(2, (1, 1))), L("b1", ["c1"], batchnorm_layer()),
          L("r1", ["b1"], activation_layer("relu")),
          L("c2", ["r1"], conv2d(2, (3, 3), mode="same")), L("b2", ["c2"], batchnorm_layer()),
          L("r2", ["b2"], activation_layer("relu")),
          L("c3", ["r2"], conv2d(4, (1, 1))), L("b3", ["c3"], batchnorm_layer()),
          Vertex("add", "add", ["b3", "input"]), L("out", ["add"], activation_layer("relu"))]
    return Net({"input": (4, 4, 4)}, vs, ["out"]).fixed_init()


def conv_block_net():
    """Projection shortcut: main conv1x1/2(2)-bn-relu-conv3x3 same(2)-bn-relu-conv1x1(4)-bn;
    shortcut conv1x1/2(4)-bn; add, relu."""
    L = lambda name, ins, lay: Vertex(name, "layer", ins, lay)
    vs = [L("c1", ["input"], conv2d(2, (1, 1), (2, 2))), L("b1", ["c1"], batchnorm_layer()),
          L("r1", ["b1"], activation_layer("relu")),
          L("c2", ["r1"], conv2d(2, (3, 3), mode="same")), L("b2", ["c2"], batchnorm_layer()),
          L("r2", ["b2"], activation_layer("relu")),
          L("c3", ["r2"], conv2d(4, (1, 1))), L("b3", ["c3"], batchnorm_layer()),
          L("sc", ["input"], conv2d(4, (1, 1), (2, 2))), L("bs", ["sc"], batchnorm_layer()),
          Vertex("add", "add", ["b3", "bs"]), L("out", ["add"], activation_layer("relu"))]
    return Net({"input": (4, 4, 4)}, vs, ["out"]).fixed_init()


@register("scr13_identity_block", f"""
WITH p AS ({_img_rows(V64, 'x', 4, 4)}),
c1 AS ({Q.conv('p', 0, 2, 1, 1, 1, 0, 0, 4, 4)}), b1 AS ({Q.batchnorm_fixed('c1', 1)}), r1 AS ({Q.relu('b1')}),
c2 AS ({Q.conv('r1', 3, 2, 3, 3, 1, 1, 1, 4, 4)}), b2 AS ({Q.batchnorm_fixed('c2', 4)}), r2 AS ({Q.relu('b2')}),
c3 AS ({Q.conv('r2', 6, 4, 1, 1, 1, 0, 0, 4, 4)}), b3 AS ({Q.batchnorm_fixed('c3', 7)}),
a AS ({Q.add('b3', 'p')}), r AS (SELECT id, c, y, x, round(greatest(v, 0.0::DOUBLE), 6) AS v FROM a)
{Q.flat('r', 4, 4)}""")
def scr13_identity(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    return _rounded(_explode(S.score_columns(v, identity_block_net(), "features", keep=["id"]), ["id"], "out"), ["value"])


@register("scr13_conv_block", f"""
WITH p AS ({_img_rows(V64, 'x', 4, 4)}),
c1 AS ({Q.conv('p', 0, 2, 1, 1, 2, 0, 0, 2, 2)}), b1 AS ({Q.batchnorm_fixed('c1', 1)}), r1 AS ({Q.relu('b1')}),
c2 AS ({Q.conv('r1', 3, 2, 3, 3, 1, 1, 1, 2, 2)}), b2 AS ({Q.batchnorm_fixed('c2', 4)}), r2 AS ({Q.relu('b2')}),
c3 AS ({Q.conv('r2', 6, 4, 1, 1, 1, 0, 0, 2, 2)}), b3 AS ({Q.batchnorm_fixed('c3', 7)}),
sc AS ({Q.conv('p', 8, 4, 1, 1, 2, 0, 0, 2, 2)}), bs AS ({Q.batchnorm_fixed('sc', 9)}),
a AS ({Q.add('b3', 'bs')}), r AS (SELECT id, c, y, x, round(greatest(v, 0.0::DOUBLE), 6) AS v FROM a)
{Q.flat('r', 2, 2)}""")
def scr13_conv(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    return _rounded(_explode(S.score_columns(v, conv_block_net(), "features", keep=["id"]), ["id"], "out"), ["value"])


# ---------------------------------------------------------------- SCR-14..16 whole nets

def scorer_net():
    """64-16-10: leaky ReLU hidden layer, softmax output (fixed parameters)."""
    return Net.sequential((64,), [dense(16, "leakyrelu"), output(10, "softmax", "nll")]).fixed_init()


SCORER_SQL = f"""v AS ({V64}), e AS ({explode('v', 'x', 'id, label')}),
h AS (SELECT id, label, j AS i, {act_sql('leakyrelu')} AS v FROM ({dense_sql('e', 0, 16, 'id, label')})),
z AS ({dense_sql('h', 1, 10, 'id, label')}),
s AS ({softmax_sql('z')}),
pred AS (SELECT id, label, j AS pred FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY p DESC, j) AS rn
         FROM s) WHERE rn = 1)"""


@register("scr14_score_layers", f"""
WITH {SCORER_SQL}
SELECT id, j::BIGINT AS i, round(p, 6) AS value FROM s""")
def scr14(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    out = S.score_columns(v, scorer_net(), "features", keep=["id"])
    return _rounded(_explode(out, ["id"], "out"), ["value"])


@register("snk03_layer_statistics", f"""
WITH {SCORER_SQL},
a AS (SELECT '{{0}}' AS vertex, v FROM h UNION ALL SELECT '{{1}}' AS vertex, p AS v FROM s)
SELECT vertex, floor(round(v, 9) / 0.0625::DOUBLE)::BIGINT AS bin, count(*) AS n, round(sum(v), 6) AS total, round(min(v), 6) AS low, round(max(v), 6) AS high
FROM a GROUP BY ALL""".format(*[v.name for v in scorer_net().vertices]))
def snk03_layer_statistics(spark, sf_dir):
    """Histograms of all activations of the scoring net by layer, from the sketches of two halves of the rows."""
    v = fx.vectors64(spark, sf_dir)
    halves = [activation_histograms(v.filter(half), scorer_net(), "features", 1 / 16) for half in ("id % 2 = 0", "id % 2 <> 0 or id is null")]
    return _rounded(merge_histograms(halves, ["vertex"]).select("vertex", "bin", "n", "total", "low", "high"), ["total", "low", "high"])


@register("scr15_predict_argmax", f"""
WITH {SCORER_SQL}
SELECT id, pred::INTEGER AS pred FROM pred""")
def scr15(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    return S.predict(v, scorer_net(), "features", keep=["id"]).select("id", "pred")


def multi_task_net():
    vs = [Vertex("ly1", "layer", ["input"], dense(4, "relu")),
          Vertex("out1", "layer", ["ly1"], output(3, "softmax", "nll")),
          Vertex("out2", "layer", ["ly1"], output(2, "identity", "mse"))]
    return Net({"input": (3,)}, vs, ["out1", "out2"]).fixed_init()


MULTI_SQL = """o AS (SELECT o_orderkey AS id,
             [round(o_totalprice / 65536 * 256) / 256, (o_custkey % 16)::DOUBLE / 16,
              (CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END)::DOUBLE / 2] AS in1
      FROM orders)"""


@register("scr16_multi_output", f"""
WITH {MULTI_SQL}, e AS ({explode('o', 'in1')}),
h AS (SELECT id, j AS i, greatest(z, 0.0::DOUBLE) AS v FROM ({dense_sql('e', 0, 4)})),
z1 AS ({dense_sql('h', 1, 3)}), s1 AS ({softmax_sql('z1')}),
z2 AS ({dense_sql('h', 2, 2)})
SELECT id, 'out1' AS head, j::BIGINT AS i, round(p, 6) AS value FROM s1
UNION ALL SELECT id, 'out2' AS head, j::BIGINT AS i, round(z, 6) AS value FROM z2""")
def scr16(spark, sf_dir):
    o = fx.order_inputs(spark, sf_dir).select("id", "in1")
    out = S.score_columns(o, multi_task_net(), "in1", keep=["id"], outputs={"out1": "o1", "out2": "o2"})
    a = _explode(out, ["id"], "o1").withColumn("head", F.lit("out1"))
    b = _explode(out, ["id"], "o2").withColumn("head", F.lit("out2"))
    return _rounded(a.unionByName(b).select("id", "head", "i", "value"), ["value"])


# ---------------------------------------------------------------- EVL-01..03

def scored_predictions(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    return S.predict(v, scorer_net(), "features", keep=["id", "label"])


CONFUSION_SQL = f"""WITH {SCORER_SQL},
counts AS (SELECT label::BIGINT AS actual, pred::BIGINT AS predicted, count(*) AS n FROM pred GROUP BY 1, 2),
conf AS (SELECT a.i::BIGINT AS actual, p.j::BIGINT AS predicted, coalesce(c.n, 0)::BIGINT AS n
         FROM range(10) a(i), range(10) p(j) LEFT JOIN counts c ON c.actual = a.i AND c.predicted = p.j)"""


@register("evl01_confusion", CONFUSION_SQL + "\nSELECT * FROM conf")
def evl01(spark, sf_dir):
    return confusion(scored_predictions(spark, sf_dir), 10)


CLASS_SQL = """per AS (SELECT a.cls, tp, n_pred - tp AS fp, n_act - tp AS fn FROM
   (SELECT actual AS cls, sum(n) AS n_act, sum(CASE WHEN actual = predicted THEN n ELSE 0 END) AS tp
    FROM conf GROUP BY actual) a JOIN (SELECT predicted AS cls, sum(n) AS n_pred FROM conf GROUP BY predicted) p
   ON a.cls = p.cls),
m AS (SELECT cls, tp, fp, fn, tp::DOUBLE / nullif(tp + fp, 0) AS precision, tp::DOUBLE / nullif(tp + fn, 0) AS recall
      FROM per),
f AS (SELECT *, 2.0::DOUBLE * precision * recall / nullif(precision + recall, 0.0::DOUBLE) AS f1 FROM m)"""


@register("evl02_class_metrics", CONFUSION_SQL + ", " + CLASS_SQL + """
SELECT cls::BIGINT AS cls, tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn,
       round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM f""")
def evl02(spark, sf_dir):
    per = class_metrics(confusion(scored_predictions(spark, sf_dir), 10))
    return _rounded(per, ["precision", "recall", "f1"])


@register("evl02_summary", CONFUSION_SQL + ", " + CLASS_SQL + """
SELECT sum(tp + fn)::BIGINT AS total, sum(tp)::BIGINT AS correct, round(sum(tp)::DOUBLE / sum(tp + fn), 6) AS accuracy,
       round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall,
       round(avg(f1), 6) AS macro_f1 FROM f""")
def evl02_summary(spark, sf_dir):
    s = summary(confusion(scored_predictions(spark, sf_dir), 10))
    return _rounded(s, ["accuracy", "macro_precision", "macro_recall", "macro_f1"])


@register("evl03_merge_partial", CONFUSION_SQL + "\nSELECT * FROM conf")
def evl03(spark, sf_dir):
    pred = scored_predictions(spark, sf_dir)
    parts = partial_confusions(pred.withColumn("half", hash01(SEED, "id") < F.lit(0.5)), 10, "half")
    grid = confusion(pred.limit(0), 10)  # zero cells
    return merge_confusions([parts.drop("half"), grid])
