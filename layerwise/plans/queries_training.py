"""Queries for losses, gradients, parameter-averaging fits and the fit options."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from ..operators import prep
from ..operators import training as TR
from ..operators.evaluation import confusion
from ..operators.model import Net, Vertex, conv2d, dense, output, pool2d
from ..operators.scoring import predict
from ..operators.splits import assign_batches, weighted_split
from . import fixtures as fx
from . import sql_fit as SF
from . import sql_tensors as Q
from .queries_scoring import SCORER_SQL, TWO_INPUTS_SQL, scorer_net
from .registry import V64, b_sql, dense_sql, explode, md5_int, order_key, register, softmax_sql, w_sql

SEED = fx.SEED
L1, L2 = 1e-3, 1e-4


def params_frame(spark, net: Net):
    """Model-sized parameter table (layer, name, idx, value) from the driver-side net."""
    names = {v.name: i for i, v in enumerate(net.vertices)}
    rows = []
    for vname, pname, _ in net.param_keys():
        vals = net.params[(vname, pname)].ravel()
        rows += [(names[vname], pname, i, float(x)) for i, x in enumerate(vals)]
    return spark.createDataFrame(rows, "layer int, name string, idx bigint, value double")


# ---------------------------------------------------------------- TRN-01 losses and penalties

def _penalty_sql():
    parts = []
    for layer, (n_in, n_out) in enumerate([(64, 16), (16, 10)]):
        parts.append(f"SELECT {w_sql(layer, 'a.i', 'b.j')} AS w FROM range({n_in}) a(i), range({n_out}) b(j)")
    return " UNION ALL ".join(parts)


@register("trn01_losses", f"""
WITH {SCORER_SQL},
r AS (SELECT id, sum(CASE WHEN label = j THEN -ln(greatest(p, 1e-10::DOUBLE)) ELSE 0.0::DOUBLE END) AS nll,
             sum((p - CASE WHEN label = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) ^ 2) / 10 AS mse,
             sum(CASE WHEN label = j THEN ln(1.0::DOUBLE) - ln(greatest(p, 1e-10::DOUBLE)) ELSE 0.0::DOUBLE END) AS kl
      FROM s GROUP BY id),
pen AS (SELECT {L1}::DOUBLE * sum(abs(w)) AS l1_penalty, 0.5::DOUBLE * {L2}::DOUBLE * sum(w * w) AS l2_penalty
        FROM ({_penalty_sql()}))
SELECT round(avg(nll), 6) AS mean_nll, round(avg(mse), 6) AS mean_mse, round(avg(kl), 6) AS mean_kl,
       round(max(l1_penalty), 6) AS l1_penalty, round(max(l2_penalty), 6) AS l2_penalty,
       round(avg(nll) + max(l1_penalty) + max(l2_penalty), 6) AS score
FROM r, pen""")
def trn01(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    net = scorer_net()
    rows = TR.loss_table(v, net, "features", "label", 10)
    l1p = TR.penalty(net, l1=L1)
    l2p = TR.penalty(net, l2=L2)
    agg = rows.agg(F.avg("loss_nll").alias("mean_nll"), F.avg("loss_mse").alias("mean_mse"),
                   F.avg("loss_kl").alias("mean_kl"))
    out = agg.select("mean_nll", "mean_mse", "mean_kl", F.lit(l1p).alias("l1_penalty"),
                     F.lit(l2p).alias("l2_penalty"),
                     (F.col("mean_nll") + F.lit(l1p) + F.lit(l2p)).alias("score"))
    for c in out.columns:
        out = out.withColumn(c, F.round(c, 6))
    return out


# ---------------------------------------------------------------- TRN-02 gradient, OPT-4 renormalisation

def grad_net():
    return Net.sequential((64,), [dense(16, "relu"), output(10, "softmax", "nll")]).fixed_init()


GRAD_SQL = f"""v AS ({V64}), n AS (SELECT count(*)::DOUBLE AS n FROM v),
e AS ({explode('v', 'x', 'id, label')}),
z1 AS ({dense_sql('e', 0, 16, 'id, label')}),
h AS (SELECT id, label, j AS i, greatest(z, 0.0::DOUBLE) AS v, z FROM z1),
z2 AS ({dense_sql('h', 1, 10, 'id, label')}),
s AS ({softmax_sql('z2')}),
dz2 AS (SELECT id, j, p - CASE WHEN label = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS d FROM s),
gw1 AS (SELECT h.i, dz2.j, sum(h.v * dz2.d) / (SELECT n FROM n) AS g FROM h JOIN dz2 ON h.id = dz2.id
        GROUP BY h.i, dz2.j),
gb1 AS (SELECT j, sum(d) / (SELECT n FROM n) AS g FROM dz2 GROUP BY j),
dh AS (SELECT dz2.id, t.i AS i, sum(dz2.d * {w_sql(1, 't.i', 'dz2.j')}) AS d FROM dz2, range(16) t(i)
       GROUP BY dz2.id, t.i),
dz1 AS (SELECT dh.id, dh.i, CASE WHEN h.z > 0 THEN dh.d ELSE 0.0::DOUBLE END AS d FROM dh
        JOIN h ON h.id = dh.id AND h.i = dh.i),
gw0 AS (SELECT e.i, dz1.i AS j, sum(e.v * dz1.d) / (SELECT n FROM n) AS g FROM e JOIN dz1 ON e.id = dz1.id
        GROUP BY e.i, dz1.i),
gb0 AS (SELECT i AS j, sum(d) / (SELECT n FROM n) AS g FROM dz1 GROUP BY i),
grads AS (SELECT 0 AS layer, 'W' AS name, i * 16 + j AS idx, g FROM gw0
          UNION ALL SELECT 0, 'b', j, g FROM gb0
          UNION ALL SELECT 1, 'W', i * 10 + j, g FROM gw1
          UNION ALL SELECT 1, 'b', j, g FROM gb1)"""


@register("trn02_gradient", f"""
WITH {GRAD_SQL}
SELECT layer::INTEGER AS layer, name, idx::BIGINT AS idx, round(g, 6) AS value FROM grads""")
def trn02(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    net = grad_net()
    grads, _, _ = TR.gradient(v, net, "features", "label", 10)
    g = net.copy()
    g.params = grads
    return params_frame(spark, g).withColumn("value", F.round("value", 6))


@register("opt4_renormalise_l2", f"""
WITH {GRAD_SQL}
SELECT layer::INTEGER AS layer, name, idx::BIGINT AS idx,
       round(g / sqrt(sum(g * g) OVER (PARTITION BY layer)), 6) AS value FROM grads""")
def opt4(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    net = grad_net()
    grads, _, _ = TR.gradient(v, net, "features", "label", 10)
    g = net.copy()
    g.params = TR.renormalise_l2(net, grads)
    return params_frame(spark, g).withColumn("value", F.round("value", 6))


# ---------------------------------------------------------------- TRN-03 parameter averaging

FIT_W, FIT_B, FIT_LR = 3, 16, 0.5


def softmax_regression_fit(spark, sf_dir, frequency=1, updater=None, net=None, **resume):
    v = fx.vectors64(spark, sf_dir)
    net = net or Net.sequential((64,), [output(10, "softmax", "nll")]).init(scheme="zero")
    spec = TR.FitSpec(workers=FIT_W, batch=FIT_B, frequency=frequency, epochs=1, seed=SEED,
                      updater=updater or TR.Updater("sgd", lr=FIT_LR))
    return TR.fit_averaging(v, net, "id", "features", "label", 10, spec, run="softmax-regression", **resume)


FIT_SQL = f"""
WITH RECURSIVE
v AS ({V64}),
d0 AS (SELECT id, x, label, {md5_int(SEED, 'id')} % {FIT_W} AS worker, {order_key(SEED)} AS k FROM v),
d AS (SELECT id, x, label, worker, (row_number() OVER (PARTITION BY worker ORDER BY k, id) - 1) // {FIT_B} AS rnd
      FROM d0),
xe AS (SELECT id, worker, rnd, label, generate_subscripts(x, 1) - 1 AS i, unnest(x) AS v FROM d
       UNION ALL SELECT id, worker, rnd, label, 64 AS i, 1.0::DOUBLE AS v FROM d),
nr AS (SELECT max(rnd) + 1 AS n FROM d),
p(r, i, j, w) AS (
  SELECT 0::BIGINT, a.i, b.j, 0.0::DOUBLE FROM range(65) a(i), range(10) b(j)
  UNION ALL
  SELECT * FROM (
    WITH cur AS (SELECT r, i, j, w FROM p WHERE r < (SELECT n FROM nr)),
    rows_r AS (SELECT * FROM xe WHERE rnd = (SELECT max(r) FROM cur)),
    z AS (SELECT rows_r.id, rows_r.worker, rows_r.label, cur.j, sum(rows_r.v * cur.w) AS z
          FROM rows_r JOIN cur ON cur.i = rows_r.i GROUP BY rows_r.id, rows_r.worker, rows_r.label, cur.j),
    pz AS (SELECT *, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM z),
    dz AS (SELECT id, worker, j,
                  e / sum(e) OVER (PARTITION BY id) - CASE WHEN label = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS d
           FROM pz),
    cnt AS (SELECT worker, count(DISTINCT id)::DOUBLE AS m FROM rows_r GROUP BY worker),
    gk AS (SELECT rows_r.worker, rows_r.i, dz.j, sum(rows_r.v * dz.d) / max(cnt.m) AS g
           FROM rows_r JOIN dz ON rows_r.id = dz.id JOIN cnt ON cnt.worker = rows_r.worker
           GROUP BY rows_r.worker, rows_r.i, dz.j),
    gg AS (SELECT i, j, avg(g) AS g FROM gk GROUP BY i, j)
    SELECT cur.r + 1, cur.i, cur.j, cur.w - {FIT_LR}::DOUBLE * gg.g FROM cur JOIN gg ON gg.i = cur.i AND gg.j = cur.j
  )
)
SELECT 0::INTEGER AS layer, CASE WHEN i < 64 THEN 'W' ELSE 'b' END AS name,
       (CASE WHEN i < 64 THEN i * 10 + j ELSE j END)::BIGINT AS idx, round(w, 6) AS value
FROM p WHERE r = (SELECT n FROM nr)"""


FIT_METRICS_SQL = f"""
WITH RECURSIVE
v AS ({V64}),
d0 AS (SELECT id, x, label, {md5_int(SEED, 'id')} % {FIT_W} AS worker, {order_key(SEED)} AS k FROM v),
d AS (SELECT id, x, label, worker, (row_number() OVER (PARTITION BY worker ORDER BY k, id) - 1) // {FIT_B} AS rnd
      FROM d0),
xe AS (SELECT id, worker, rnd, label, generate_subscripts(x, 1) - 1 AS i, unnest(x) AS v FROM d
       UNION ALL SELECT id, worker, rnd, label, 64 AS i, 1.0::DOUBLE AS v FROM d),
nr AS (SELECT max(rnd) + 1 AS n FROM d),
p(r, i, j, w, score) AS (
  SELECT 0::BIGINT, a.i, b.j, 0.0::DOUBLE, NULL::DOUBLE FROM range(65) a(i), range(10) b(j)
  UNION ALL
  SELECT * FROM (
    WITH cur AS (SELECT r, i, j, w FROM p WHERE r < (SELECT n FROM nr)),
    rows_r AS (SELECT * FROM xe WHERE rnd = (SELECT max(r) FROM cur)),
    z AS (SELECT rows_r.id, rows_r.worker, rows_r.label, cur.j, sum(rows_r.v * cur.w) AS z
          FROM rows_r JOIN cur ON cur.i = rows_r.i GROUP BY rows_r.id, rows_r.worker, rows_r.label, cur.j),
    pz AS (SELECT *, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM z),
    dz AS (SELECT id, worker, j,
                  e / sum(e) OVER (PARTITION BY id) - CASE WHEN label = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS d
           FROM pz),
    cnt AS (SELECT worker, count(DISTINCT id)::DOUBLE AS m FROM rows_r GROUP BY worker),
    gk AS (SELECT rows_r.worker, rows_r.i, dz.j, sum(rows_r.v * dz.d) / max(cnt.m) AS g
           FROM rows_r JOIN dz ON rows_r.id = dz.id JOIN cnt ON cnt.worker = rows_r.worker
           GROUP BY rows_r.worker, rows_r.i, dz.j),
    gg AS (SELECT i, j, avg(g) AS g FROM gk GROUP BY i, j),
    lw AS (SELECT worker, avg(-ln(greatest(e / se, 1e-10::DOUBLE))) AS loss FROM (
             SELECT z.id, z.worker, z.j, z.label, pz.e, sum(pz.e) OVER (PARTITION BY z.id) AS se
             FROM z JOIN pz ON pz.id = z.id AND pz.j = z.j) WHERE label = j GROUP BY worker),
    sc AS (SELECT avg(loss) AS score FROM lw)
    SELECT cur.r + 1, cur.i, cur.j, cur.w - {FIT_LR}::DOUBLE * gg.g, (SELECT score FROM sc)
    FROM cur JOIN gg ON gg.i = cur.i AND gg.j = cur.j
  )
)
SELECT DISTINCT 'softmax-regression' AS run, 0::INTEGER AS epoch, (r - 1)::INTEGER AS round, r::BIGINT AS iteration,
       round(score, 6) AS score
FROM p WHERE r >= 1"""


@register("trn03_fit_averaging", FIT_SQL)
def trn03(spark, sf_dir):
    net, _, _ = softmax_regression_fit(spark, sf_dir)
    return params_frame(spark, net).withColumn("value", F.round("value", 6))


NF2_LR, NF2_MU = 0.1, 0.9


def _worker_grad_sql(rows: str, params: str, keyed: bool) -> str:
    """Per-worker mean softmax-regression gradient on ``rows`` with weights ``params``
    (common weights when not keyed, per-worker weights when keyed)."""
    on = "w.i = xe.i AND w.worker = xe.worker" if keyed else "w.i = xe.i"
    return f"""(SELECT xe.worker, xe.i, dz.j, sum(xe.v * dz.d) / max(cn.m) AS g FROM {rows} xe JOIN (
       SELECT id, j, e / sum(e) OVER (PARTITION BY id) - CASE WHEN label = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS d
       FROM (SELECT id, label, j, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM (
             SELECT xe.id, xe.label, w.j, sum(xe.v * w.w) AS z FROM {rows} xe JOIN {params} w ON {on}
             GROUP BY xe.id, xe.label, w.j))) dz ON dz.id = xe.id
     JOIN (SELECT worker, count(DISTINCT id)::DOUBLE AS m FROM {rows} GROUP BY worker) cn ON cn.worker = xe.worker
     GROUP BY xe.worker, xe.i, dz.j)"""


FIT_NF2_SQL = f"""
WITH RECURSIVE
v AS ({V64}),
d0 AS (SELECT id, x, label, {md5_int(SEED, 'id')} % {FIT_W} AS worker, {order_key(SEED)} AS k FROM v),
d AS (SELECT id, x, label, worker, (row_number() OVER (PARTITION BY worker ORDER BY k, id) - 1) // {FIT_B} AS bt
      FROM d0),
xe AS (SELECT id, worker, bt, label, generate_subscripts(x, 1) - 1 AS i, unnest(x) AS v FROM d
       UNION ALL SELECT id, worker, bt, label, 64 AS i, 1.0::DOUBLE AS v FROM d),
nr AS (SELECT max(bt) // 2 + 1 AS n FROM d),
p(r, i, j, w, vel) AS (
  SELECT 0::BIGINT, a.i, b.j, 0.0::DOUBLE, 0.0::DOUBLE FROM range(65) a(i), range(10) b(j)
  UNION ALL
  SELECT * FROM (
    WITH cur AS (SELECT r, i, j, w, vel FROM p WHERE r < (SELECT n FROM nr)),
    r1 AS (SELECT * FROM xe WHERE bt = 2 * (SELECT max(r) FROM cur)),
    r2 AS (SELECT * FROM xe WHERE bt = 2 * (SELECT max(r) FROM cur) + 1),
    g1 AS {_worker_grad_sql('r1', 'cur', False)},
    s1 AS (SELECT g1.worker, cur.i, cur.j, {NF2_MU}::DOUBLE * cur.vel - {NF2_LR}::DOUBLE * g1.g AS vel, cur.vel AS v0,
                  cur.w AS w0 FROM g1 JOIN cur ON cur.i = g1.i AND cur.j = g1.j),
    w1 AS (SELECT worker, i, j, w0 + (1 + {NF2_MU}::DOUBLE) * vel - {NF2_MU}::DOUBLE * v0 AS w, vel FROM s1),
    g2 AS {_worker_grad_sql('r2', 'w1', True)},
    w2 AS (SELECT w1.worker, w1.i, w1.j,
                  CASE WHEN g2.g IS NULL THEN w1.w
                       ELSE w1.w + (1 + {NF2_MU}::DOUBLE) * ({NF2_MU}::DOUBLE * w1.vel - {NF2_LR}::DOUBLE * g2.g)
                            - {NF2_MU}::DOUBLE * w1.vel END AS w,
                  CASE WHEN g2.g IS NULL THEN w1.vel ELSE {NF2_MU}::DOUBLE * w1.vel - {NF2_LR}::DOUBLE * g2.g END AS vel
           FROM w1 LEFT JOIN g2 ON g2.worker = w1.worker AND g2.i = w1.i AND g2.j = w1.j)
    SELECT (SELECT max(r) FROM cur) + 1, i, j, avg(w), avg(vel) FROM w2 GROUP BY i, j)
)
SELECT 0::INTEGER AS layer, CASE WHEN i < 64 THEN 'W' ELSE 'b' END AS name,
       (CASE WHEN i < 64 THEN i * 10 + j ELSE j END)::BIGINT AS idx, round(w, 6) AS value
FROM p WHERE r = (SELECT n FROM nr)"""


@register("trn03_fit_nesterov_f2", FIT_NF2_SQL)
def trn03_nesterov(spark, sf_dir):
    """Two batches per worker between averages, Nesterov momentum (updater state averaged too)."""
    net, _, _ = softmax_regression_fit(spark, sf_dir, frequency=2,
                                       updater=TR.Updater("nesterovs", lr=NF2_LR, momentum=NF2_MU))
    return params_frame(spark, net).withColumn("value", F.round("value", 6))


@register("snk02_resume_fit", FIT_NF2_SQL)
def snk02_resume(spark, sf_dir):
    """The same fit in two halves: the model, its updater state, kind, rates and iteration are written after
    the first rounds, read again, and the rest of the rounds continue from them."""
    from ..session import scratch_path
    from ..sources.model_store import read_model, read_updater, write_model
    updater = TR.Updater("nesterovs", lr=NF2_LR, momentum=NF2_MU)
    net, metrics, state = softmax_regression_fit(spark, sf_dir, frequency=2, updater=updater, stop_round=2)
    path = scratch_path(spark, "resume")
    done = metrics.agg(F.max("iteration")).first()[0] or 0
    write_model(spark, net, path, state=state, updater=updater, iteration=done)
    net, state = read_model(spark, path, with_state=True)
    updater, iteration = read_updater(spark, path)
    net, _, _ = softmax_regression_fit(spark, sf_dir, frequency=2, updater=updater, net=net, state=state,
                                       iteration=iteration, start_round=2)
    return params_frame(spark, net).withColumn("value", F.round("value", 6))


@register("snk03_training_metrics", FIT_METRICS_SQL)
def snk03(spark, sf_dir):
    """Metrics rows of the averaging fit, written and read back; elapsed_ms stays in the
    table but is left out here because wall-clock time cannot be compared."""
    from ..session import scratch_path
    from ..sources.model_store import write_metrics
    _, metrics, _ = softmax_regression_fit(spark, sf_dir)
    path = scratch_path(spark, "metrics")
    write_metrics(metrics, path)
    back = spark.read.parquet(path)
    return back.select("run", "epoch", "round", "iteration", F.round("score", 6).alias("score"))


# ---------------------------------------------------------------- TRN-04 convolutional net, TRN-05 graph

def lenet_small():
    """LeNet-shaped layer list for 8x8x1 inputs: conv 3x3 (4) - max pool - dense 16 relu - softmax 10."""
    return Net.sequential((1, 8, 8), [conv2d(4, (3, 3)), pool2d((2, 2), (2, 2)), dense(16, "relu"),
                                      output(10, "softmax", "nll")])


@register("trn04_fit_conv_net")
def trn04(spark, sf_dir):
    img = fx.image8(spark, sf_dir)
    scaled = img.select("id", "label", prep.scale_pixels("px").alias("x"))
    parts = weighted_split(scaled, "id", [7, 3], SEED)
    train = parts.filter(F.col("part") == 0)
    test = parts.filter(F.col("part") == 1)
    spec = TR.FitSpec(workers=3, batch=32, frequency=2, epochs=1, seed=SEED, l2=5e-4,
                      updater=TR.Updater("nesterovs", lr=0.01, momentum=0.9))
    net, _, _ = TR.fit_averaging(train, lenet_small().init(seed=SEED), "id", "x", "label", 10, spec, run="lenet")
    return confusion(predict(test, net, "x", keep=["id", "label"]), 10)


def graph_net():
    vs = [Vertex("ly1", "layer", ["input1"], dense(4, "relu")),
          Vertex("ly2", "layer", ["input2"], dense(4, "relu")),
          Vertex("merge", "merge", ["ly1", "ly2"]),
          Vertex("out1", "layer", ["merge"], output(3, "softmax", "nll")),
          Vertex("out2", "layer", ["merge"], output(2, "identity", "mse"))]
    return Net({"input1": (3,), "input2": (3,)}, vs, ["out1", "out2"])


def _graph_fit(spark, sf_dir):
    j = graph_table(spark, sf_dir)
    spec = TR.FitSpec(workers=3, batch=256, frequency=5, epochs=1, seed=SEED,
                      updater=TR.Updater("nesterovs", lr=0.01, momentum=0.9))
    return TR.fit_averaging(j, graph_net().init(seed=SEED), "id", {"input1": "in1", "input2": "in2"},
                            {"out1": "status_id", "out2": "target"}, {"out1": 3, "out2": 2}, spec, run="graph")


@register("trn05_fit_graph")
def trn05(spark, sf_dir):
    """Two inputs merged, two outputs (class: order status, regression: scaled price and line count)."""
    _, metrics, _ = _graph_fit(spark, sf_dir)
    return metrics.select("run", "epoch", "round", "iteration", F.round("score", 6).alias("score"))


def _graph_rows() -> list:
    """The graph as two dense layers over 6 inputs, 8 hidden units and 5 outputs, absent connections left out."""
    p = graph_net().init(seed=SEED).params
    rows = []
    for name, i0, j0 in (("ly1", 0, 0), ("ly2", 3, 4)):
        rows += [(0, i + i0, j + j0, float(p[(name, "W")][i, j])) for i in range(3) for j in range(4)]
        rows += [(0, 6, j + j0, float(p[(name, "b")][j])) for j in range(4)]
    for name, j0, k in (("out1", 0, 3), ("out2", 3, 2)):
        rows += [(1, i, j + j0, float(p[(name, "W")][i, j])) for i in range(8) for j in range(k)]
        rows += [(1, 8, j + j0, float(p[(name, "b")][j])) for j in range(k)]
    return rows


_GRAPH_DELTA = """SELECT o.worker, o.id, o.j, o.e / sum(o.e) OVER (PARTITION BY o.id) - CASE WHEN r.label = o.j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS d
FROM (SELECT *, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM {z} WHERE j < 3) o JOIN rows_now r ON r.id = o.id
UNION ALL SELECT o.worker, o.id, o.j, o.z - CASE WHEN o.j = 3 THEN r.t0 ELSE r.t1 END AS d FROM {z} o JOIN rows_now r ON r.id = o.id WHERE o.j >= 3"""

GRAPH_FIT_SQL = SF.fit_ctes(f"""{TWO_INPUTS_SQL},
t AS (SELECT o_orderkey AS id, (CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END) AS label,
             round(o_totalprice / 524288 * 256) / 256 AS t0 FROM orders),
d AS (SELECT j.id, {md5_int(SEED, 'j.id')} % 3 AS worker, {order_key(SEED, 'j.id')} AS k, list_concat(j.in1, j.in2) AS x, t.label, t.t0, j.in2[1] AS t1
      FROM j JOIN t ON t.id = j.id)""", [6, 8, 5], ["relu"], _graph_rows(), _GRAPH_DELTA, 3, 256, 5, 1, 0.01, 0.9) + """
SELECT (CASE WHEN l = 0 AND j < 4 THEN 0 WHEN l = 0 THEN 1 WHEN j < 3 THEN 3 ELSE 4 END)::INTEGER AS layer,
       CASE WHEN i < CASE l WHEN 0 THEN 6 ELSE 8 END THEN 'W' ELSE 'b' END AS name,
       (CASE WHEN l = 0 AND i = 6 THEN j % 4 WHEN l = 0 THEN (i % 3) * 4 + j % 4 WHEN i = 8 THEN CASE WHEN j < 3 THEN j ELSE j - 3 END
             WHEN j < 3 THEN i * 3 + j ELSE i * 2 + j - 3 END)::BIGINT AS idx, round(w, 6) AS value FROM fitted"""


@register("trn05_graph_params", GRAPH_FIT_SQL)
def trn05_params(spark, sf_dir):
    """The weights the graph fit ends with."""
    net, _, _ = _graph_fit(spark, sf_dir)
    return params_frame(spark, net).withColumn("value", F.round("value", 6))


# ---------------------------------------------------------------- OPT-3 schedules, OPT-6 dropout

STEP_SCHEDULE = {"type": "step", "decay": 0.1, "step": 10}
MAP_SCHEDULE = {"type": "map", "values": {0: 0.01, 30: 0.005, 90: 0.001}}


@register("opt3_lr_schedule", f"""
SELECT batch_id::BIGINT AS iteration, round(0.01::DOUBLE * pow(0.1::DOUBLE, floor(batch_id / 10)), 12) AS step_rate,
       CASE WHEN batch_id >= 90 THEN 0.001::DOUBLE WHEN batch_id >= 30 THEN 0.005::DOUBLE ELSE 0.01::DOUBLE END
       AS map_rate
FROM (SELECT DISTINCT (row_number() OVER (ORDER BY {order_key(SEED, 'o_orderkey')}, o_orderkey) - 1) // 128
      AS batch_id FROM orders)""")
def opt3(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey")
    it = assign_batches(o, "o_orderkey", 128, SEED).select(F.col("batch_id").alias("iteration")).distinct()
    return it.select("iteration", F.round(TR.schedule_expr("iteration", STEP_SCHEDULE, 0.01), 12).alias("step_rate"),
                     TR.schedule_expr("iteration", MAP_SCHEDULE, 0.01).alias("map_rate"))


def _coin_sql(seed: int, iteration: int, vertex: str) -> str:
    """The dropout coin of (id, i) in 32-bit arithmetic."""
    head = (seed * TR.COIN[0] + iteration * TR.COIN[1] + zlib.crc32(vertex.encode())) % (1 << 32)
    x = f"(({head} + ((id::HUGEINT & 4294967295) * {TR.COIN[2]}) + i::HUGEINT * {TR.COIN[3]}) % 4294967296)::BIGINT"
    for _ in range(2):
        x = f"((xor({x}, ({x}) >> 16)::HUGEINT * {TR.COIN_MIX}) % 4294967296)::BIGINT"
    return f"(xor({x}, ({x}) >> 16) / 4294967296.0::DOUBLE)"


@register("opt6_dropout_mask", f"""
WITH v AS ({V64}), e AS ({explode('v', 'x')})
SELECT id, i::BIGINT AS i, CASE WHEN {_coin_sql(SEED, 0, '0')} < 0.5::DOUBLE THEN v / 0.5::DOUBLE ELSE 0.0::DOUBLE END AS value
FROM e""")
def opt6(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    d = v.select("id", TR.dropout_expr("features", "id", SEED, 0, "0", 0.5).alias("dropped"))
    return prep.explode_array(d, ["id"], "dropped", "i", "value")


# ---------------------------------------------------------------- TRN-05 one step in SQL, OPT-2 updates in SQL

def graph_table(spark, sf_dir):
    o = fx.order_inputs(spark, sf_dir)
    li = fx.line_inputs(spark, sf_dir)
    return o.join(li, "id").select("id", "in1", "in2", "status_id",
                                   F.array(fx.quantise(F.col("o_totalprice") / F.lit(524288.0)),
                                           F.col("n_lines").cast("double") / F.lit(8.0)).alias("target"))


@register("trn05_graph_gradient", f"""
WITH {TWO_INPUTS_SQL},
t AS (SELECT o_orderkey AS id, (CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END) AS status_id,
             round(o_totalprice / 524288 * 256) / 256 AS t0 FROM orders),
jt AS (SELECT j.id, j.in1, j.in2, t.status_id, t.t0, j.in2[1] AS t1 FROM j JOIN t ON t.id = j.id),
n AS (SELECT count(*)::DOUBLE AS n FROM jt),
e1 AS ({explode('jt', 'in1')}), e2 AS ({explode('jt', 'in2')}),
h AS (SELECT id, j AS i, greatest(z, 0.0::DOUBLE) AS v, z FROM ({dense_sql('e1', 0, 4)})
      UNION ALL SELECT id, j + 4 AS i, greatest(z, 0.0::DOUBLE) AS v, z FROM ({dense_sql('e2', 1, 4)})),
z3 AS ({dense_sql('h', 3, 3)}), s3 AS ({softmax_sql('z3')}),
d3 AS (SELECT s3.id, s3.j, p - CASE WHEN jt.status_id = s3.j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS d
       FROM s3 JOIN jt ON jt.id = s3.id),
z4 AS ({dense_sql('h', 4, 2)}),
d4 AS (SELECT z4.id, z4.j, z4.z - CASE WHEN z4.j = 0 THEN jt.t0 ELSE jt.t1 END AS d FROM z4 JOIN jt ON jt.id = z4.id),
dh AS (SELECT id, i, sum(d) AS d FROM (
         SELECT d3.id, t.i, d3.d * {w_sql(3, 't.i', 'd3.j')} AS d FROM d3, range(8) t(i)
         UNION ALL SELECT d4.id, t.i, d4.d * {w_sql(4, 't.i', 'd4.j')} AS d FROM d4, range(8) t(i)) GROUP BY id, i),
dz AS (SELECT dh.id, dh.i, CASE WHEN h.z > 0 THEN dh.d ELSE 0.0::DOUBLE END AS d FROM dh
       JOIN h ON h.id = dh.id AND h.i = dh.i),
grads AS (
  SELECT 0 AS layer, 'W' AS name, e1.i * 4 + dz.i AS idx, sum(e1.v * dz.d) / (SELECT n FROM n) AS g
  FROM e1 JOIN dz ON e1.id = dz.id AND dz.i < 4 GROUP BY e1.i, dz.i
  UNION ALL SELECT 0, 'b', i, sum(d) / (SELECT n FROM n) FROM dz WHERE i < 4 GROUP BY i
  UNION ALL SELECT 1, 'W', e2.i * 4 + dz.i - 4, sum(e2.v * dz.d) / (SELECT n FROM n)
  FROM e2 JOIN dz ON e2.id = dz.id AND dz.i >= 4 GROUP BY e2.i, dz.i
  UNION ALL SELECT 1, 'b', i - 4, sum(d) / (SELECT n FROM n) FROM dz WHERE i >= 4 GROUP BY i
  UNION ALL SELECT 3, 'W', h.i * 3 + d3.j, sum(h.v * d3.d) / (SELECT n FROM n) FROM h JOIN d3 ON h.id = d3.id
  GROUP BY h.i, d3.j
  UNION ALL SELECT 3, 'b', j, sum(d) / (SELECT n FROM n) FROM d3 GROUP BY j
  UNION ALL SELECT 4, 'W', h.i * 2 + d4.j, sum(h.v * d4.d) / (SELECT n FROM n) FROM h JOIN d4 ON h.id = d4.id
  GROUP BY h.i, d4.j
  UNION ALL SELECT 4, 'b', j, sum(d) / (SELECT n FROM n) FROM d4 GROUP BY j)
SELECT layer::INTEGER AS layer, name, idx::BIGINT AS idx, round(g, 6) AS value FROM grads""")
def trn05_gradient(spark, sf_dir):
    net = graph_net().fixed_init()
    grads, _, _ = TR.gradient(graph_table(spark, sf_dir), net, {"input1": "in1", "input2": "in2"},
                              {"out1": "status_id", "out2": "target"}, {"out1": 3, "out2": 2})
    g = net.copy()
    g.params = grads
    return params_frame(spark, g).withColumn("value", F.round("value", 6))


NEST_LR, NEST_MU = 0.1, 0.9


def _softmax_grad_sql(w_table: str, src: str = "xe") -> str:
    """Mean softmax-regression gradient (bias as input 64) for weights in w_table(i, j, w)."""
    return f"""(SELECT xe.i, dz.j, sum(xe.v * dz.d) / (SELECT n FROM n) AS g FROM {src} xe JOIN (
       SELECT id, j, e / sum(e) OVER (PARTITION BY id) - CASE WHEN label = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS d
       FROM (SELECT id, label, j, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM (
             SELECT xe.id, xe.label, w.j, sum(xe.v * w.w) AS z FROM {src} xe JOIN {w_table} w ON w.i = xe.i
             GROUP BY xe.id, xe.label, w.j))) dz ON dz.id = xe.id GROUP BY xe.i, dz.j)"""


@register("opt2_nesterov_two_steps", f"""
WITH v AS ({V64}), n AS (SELECT count(*)::DOUBLE AS n FROM v),
xe AS (SELECT id, label, generate_subscripts(x, 1) - 1 AS i, unnest(x) AS v FROM v
       UNION ALL SELECT id, label, 64 AS i, 1.0::DOUBLE AS v FROM v),
w0 AS (SELECT a.i, b.j, 0.0::DOUBLE AS w FROM range(65) a(i), range(10) b(j)),
g0 AS {_softmax_grad_sql('w0')},
s1 AS (SELECT i, j, {NEST_MU}::DOUBLE * 0.0::DOUBLE - {NEST_LR}::DOUBLE * g AS vel FROM g0),
w1 AS (SELECT w0.i, w0.j, w0.w + (1 + {NEST_MU}::DOUBLE) * s1.vel - {NEST_MU}::DOUBLE * 0.0::DOUBLE AS w
       FROM w0 JOIN s1 USING (i, j)),
g1 AS {_softmax_grad_sql('w1')},
s2 AS (SELECT s1.i, s1.j, s1.vel AS v_old, {NEST_MU}::DOUBLE * s1.vel - {NEST_LR}::DOUBLE * g1.g AS vel
       FROM s1 JOIN g1 USING (i, j)),
w2 AS (SELECT w1.i, w1.j, w1.w + (1 + {NEST_MU}::DOUBLE) * s2.vel - {NEST_MU}::DOUBLE * s2.v_old AS w
       FROM w1 JOIN s2 USING (i, j))
SELECT 0::INTEGER AS layer, CASE WHEN i < 64 THEN 'W' ELSE 'b' END AS name,
       (CASE WHEN i < 64 THEN i * 10 + j ELSE j END)::BIGINT AS idx, round(w, 6) AS value FROM w2""")
def opt2(spark, sf_dir):
    v = fx.vectors64(spark, sf_dir)
    net = Net.sequential((64,), [output(10, "softmax", "nll")]).init(scheme="zero")
    upd = TR.Updater("nesterovs", lr=NEST_LR, momentum=NEST_MU)
    state = None
    for _ in range(2):
        grads, _, _ = TR.gradient(v, net, "features", "label", 10)
        g = net.copy()
        g.params = grads
        w, gv = net.flat(), g.flat()
        state = np.zeros_like(w) if state is None else state
        w2, state = upd.step(w, gv, state, np.full(w.size, upd.lr))
        net.set_flat(w2)
    return params_frame(spark, net).withColumn("value", F.round("value", 6))


# ---------------------------------------------------------------- TRN-04 core: conv + max-pool gradient in SQL

def conv_grad_net():
    return Net.sequential((1, 8, 8), [conv2d(2, (3, 3)), pool2d((2, 2), (2, 2)),
                                      output(10, "softmax", "nll")]).fixed_init()


_IMG256 = ("SELECT vec_id AS id, label, list_transform(embedding, lambda e: floor((e::DOUBLE + 1) * 127.5) / 256) "
           "AS x FROM embeddings")


@register("trn04_conv_gradient", f"""
WITH img AS ({_IMG256}), n AS (SELECT count(*)::DOUBLE AS n FROM img),
p AS ({Q.pixels('img', 'x', 8, 8)}),
cv AS ({Q.conv('p', 0, 2, 3, 3, 1, 0, 0, 6, 6)}),
rk AS (SELECT id, c, y, x, v, row_number() OVER (PARTITION BY id, c, y // 2, x // 2 ORDER BY v DESC, y % 2, x % 2)
       AS r FROM cv),
feat AS (SELECT id, c * 9 + (y // 2) * 3 + (x // 2) AS i, v, c, y AS ay, x AS ax FROM rk WHERE r = 1),
z AS (SELECT f.id, t.j, sum(f.v * {w_sql(2, 'f.i', 't.j')}) + {b_sql(2, 't.j')} AS z FROM feat f, range(10) t(j)
      GROUP BY f.id, t.j),
s AS ({softmax_sql('z')}),
d2 AS (SELECT s.id, s.j, s.p - CASE WHEN img.label = s.j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS d
       FROM s JOIN img ON img.id = s.id),
dpool AS (SELECT feat.id, feat.c, feat.ay, feat.ax, sum(d2.d * {w_sql(2, 'feat.i', 'd2.j')}) AS d
          FROM feat JOIN d2 ON feat.id = d2.id GROUP BY feat.id, feat.c, feat.ay, feat.ax),
grads AS (
  SELECT 0 AS layer, 'W' AS name, dp.c * 9 + ky.ky * 3 + kx.kx AS idx, sum(dp.d * p.v) / (SELECT n FROM n) AS g
  FROM dpool dp CROSS JOIN range(3) ky(ky) CROSS JOIN range(3) kx(kx)
  JOIN p ON p.id = dp.id AND p.y = dp.ay + ky.ky AND p.x = dp.ax + kx.kx GROUP BY dp.c, ky.ky, kx.kx
  UNION ALL SELECT 0, 'b', c, sum(d) / (SELECT n FROM n) FROM dpool GROUP BY c
  UNION ALL SELECT 2, 'W', feat.i * 10 + d2.j, sum(feat.v * d2.d) / (SELECT n FROM n)
  FROM feat JOIN d2 ON feat.id = d2.id GROUP BY feat.i, d2.j
  UNION ALL SELECT 2, 'b', j, sum(d) / (SELECT n FROM n) FROM d2 GROUP BY j)
SELECT layer::INTEGER AS layer, name, idx::BIGINT AS idx, round(g, 6) AS value FROM grads""")
def trn04_gradient(spark, sf_dir):
    img = fx.image8(spark, sf_dir).select("id", "label",
                                          F.transform("px", lambda p: p.cast("double") / F.lit(256.0)).alias("x"))
    net = conv_grad_net()
    grads, _, _ = TR.gradient(img, net, "x", "label", 10)
    g = net.copy()
    g.params = grads
    return params_frame(spark, g).withColumn("value", F.round("value", 6))
