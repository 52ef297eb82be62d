"""Forward scoring of layered models over distributed rows.

One ``mapInArrow`` per chain of layers: each Arrow batch becomes a NumPy matrix,
runs through every layer, and leaves as array columns. Parameters travel with the
task (small) or as a broadcast variable, always behind a size check.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import let, literal_array
from . import image_ops
from .kernels import BN_EPS
from .model import Net

COLUMN_MODEL_PARAMS = 1 << 14
CLOSURE_BYTES = 1 << 20          # ship inside the task closure below this
DEFAULT_MAX_MODEL_BYTES = 1 << 29  # 512 MiB: broadcast bound for parameters


def max_model_bytes(spark) -> int:
    try:
        return int(spark.conf.get("spark.layerwise.maxModelBytes"))
    except Exception:  # noqa: BLE001 - unset
        return DEFAULT_MAX_MODEL_BYTES


def ship(spark, net: Net):
    """Return a zero-argument getter usable inside tasks; size-checked."""
    return ship_releasable(spark, net)[0]


def ship_releasable(spark, net: Net):
    """(getter, release): like ``ship``; ``release()`` drops a broadcast copy once a job is done."""
    size = net.nbytes()
    limit = max_model_bytes(spark)
    if size > limit:
        raise ValueError(f"model has {size} bytes of parameters, above the broadcast bound {limit}; "
                         "score dense layers with dense_blocked() instead")
    if size <= CLOSURE_BYTES:
        return (lambda: net), (lambda: None)
    bc = spark.sparkContext.broadcast(net)
    return (lambda: bc.value), (lambda: bc.unpersist(blocking=False))


def to_matrix(col, width: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if n == 0:
        return np.zeros((0, width))
    if col.null_count:
        raise ValueError(f"{col.null_count} null feature arrays: fill or filter them before scoring")
    vals = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if vals.size != n * width:
        raise ValueError(f"expected {width} values per row, got {vals.size / max(n, 1)}")
    return vals.reshape(n, width)


def to_list_array(m: np.ndarray) -> pa.Array:
    n = m.shape[0]
    k = int(np.prod(m.shape[1:])) if m.ndim > 1 else 1
    offsets = pa.array(np.arange(0, n * k + 1, k, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(m).ravel(), type=pa.float64()))


def _batches(batches, rows: int | None):
    """Arrow batches cut to at most ``rows`` rows."""
    for rb in batches:
        for a in range(0, rb.num_rows, rows or max(rb.num_rows, 1)):
            yield rb.slice(a, rows) if rows else rb


def score(df: DataFrame, net: Net, inputs: dict | str, keep: Sequence[str] = (),
          outputs: dict | None = None, batch_rows: int | None = None) -> DataFrame:
    """SCR-14 (and single-layer SCR-01..09, 13, 16): add one array column per output.

    inputs: input name -> array column (a single string for one-input nets);
    outputs: vertex name -> output column (default: the net's outputs as 'out', 'out_<name>');
    batch_rows: rows scored at once (default: Spark's Arrow batches).
    """
    if isinstance(inputs, str):
        inputs = {next(iter(net.inputs)): inputs}
    if outputs is None:
        outputs = {o: ("out" if len(net.outputs) == 1 else f"out_{o}") for o in net.outputs}
    keep = list(keep)
    widths = {k: int(np.prod(net.inputs[k])) for k in inputs}
    get = ship(df.sparkSession, net)
    fields = [df.schema[c] for c in keep] + [T.StructField(c, T.ArrayType(T.DoubleType())) for c in outputs.values()]
    schema = T.StructType(fields)
    in_cols = dict(inputs)
    out_map = dict(outputs)

    def run(batches):
        model = get()
        for rb in _batches(batches, batch_rows):
            feeds = {name: to_matrix(rb.column(col), widths[name]) for name, col in in_cols.items()}
            vals = model.values(feeds, out_map)
            arrays = [rb.column(c) for c in keep]
            arrays += [to_list_array(vals[v]) for v in out_map]
            yield pa.RecordBatch.from_arrays(arrays, names=keep + list(out_map.values()))

    return df.select(*keep, *[c for c in set(in_cols.values()) if c not in keep]).mapInArrow(run, schema)


def dense_expr(x: Column | str, W: np.ndarray, b: np.ndarray) -> Column:
    """SCR-01 as an array expression: x . W + b with the weights as one literal."""
    n_in, n_out = W.shape
    flat, shift = literal_array(W.ravel()), literal_array(b)

    def body(arr):
        def unit(o):
            return F.aggregate(F.sequence(F.lit(0), F.lit(n_in - 1)), F.lit(0.0), lambda acc, i: acc + F.get(arr, i) * F.get(flat, i * n_out + o)) + F.get(shift, o)
        return F.when(arr.isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(n_out - 1)), unit))
    return let(F.col(x) if isinstance(x, str) else x, body)


def score_columns(df: DataFrame, net: Net, inputs: dict | str, keep: Sequence[str] = (), outputs: dict | None = None) -> DataFrame:
    """SCR-13, 14, 16 without Python: every vertex of the net is one array expression of its inputs.

    Same arguments and result as ``score``; the weights are literals of the plan, so this is for models up
    to COLUMN_MODEL_PARAMS parameters (larger ones raise: ``score`` ships them to the tasks)."""
    if net.n_params() > COLUMN_MODEL_PARAMS:
        raise ValueError(f"{net.n_params()} parameters as literals; use score()")
    if isinstance(inputs, str):
        inputs = {next(iter(net.inputs)): inputs}
    if outputs is None:
        outputs = {o: ("out" if len(net.outputs) == 1 else f"out_{o}") for o in net.outputs}
    at = {name: f"_v_{name}" for name in [*net.inputs, *[v.name for v in net.vertices]]}
    doubles = [F.transform(c, lambda x: x.cast("double")).alias(at[name]) for name, c in inputs.items()]
    cur = df.select(*keep, *doubles)
    for v in net.vertices:
        ins = [F.col(at[i]) for i in v.inputs]
        cur = cur.withColumn(at[v.name], _vertex_expr(net, v, ins))
    return cur.select(*keep, *[F.col(at[v]).alias(c) for v, c in outputs.items()])


def _vertex_expr(net: Net, v, ins: list) -> Column:
    if v.op == "merge":
        return F.concat(*ins)
    if v.op == "add":
        out = ins[0]
        for i in ins[1:]:
            out = residual_add(out, i)
        return out
    lay, x, shape = v.layer, ins[0], net.shapes[v.inputs[0]]
    p = {name: value for (vertex, name), value in net.params.items() if vertex == v.name}
    if lay.kind in ("dense", "output"):
        return act_expr(dense_expr(x, p["W"], p["b"]), lay.activation)
    if lay.kind == "activation":
        return act_expr(x, lay.activation)
    c, h, w = shape
    if lay.kind == "conv2d":
        return act_expr(image_ops.conv2d(x, c, h, w, p["W"], p["b"], lay.stride, lay.padding, lay.mode), lay.activation)
    if lay.kind == "pool2d":
        return image_ops.pool2d(x, c, h, w, lay.kernel, lay.stride, lay.padding, lay.mode, lay.pool)
    if lay.kind == "lrn":
        return image_ops.lrn(x, c, h, w, **lay.opts)
    if lay.kind == "zeropad":
        return image_ops.zero_pad(x, c, h, w, *lay.padding)
    if lay.kind == "batchnorm":
        return batchnorm_apply(x, h * w, p["mean"], p["var"], p["gamma"], p["beta"], lay.opts.get("eps", BN_EPS))
    raise ValueError(lay.kind)


def argmax(col: Column | str) -> Column:
    """SCR-15: predicted class; ties go to the lowest index."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def predict(df: DataFrame, net: Net, features_col: str, keep: Sequence[str] = (),
            prob_col: str = "prob", pred_col: str = "pred", batch_rows: int | None = None) -> DataFrame:
    out = score(df, net, features_col, keep=keep, outputs={net.outputs[0]: prob_col}, batch_rows=batch_rows)
    return out.withColumn(pred_col, argmax(prob_col))


def dense_blocked(df: DataFrame, id_col: str, features_col: str, W: DataFrame, b: DataFrame, n_in: int, n_out: int,
                  out_col: str = "z", inner: int = 512, cols: int = 512, row_blocks: int | None = None) -> DataFrame:
    """SCR-01 as a blocked matrix product, for weight matrices of any size: no task and no broadcast holds more than tiles.

    W(i, j, w) and b(j, b) are tables. Weights are gathered to tiles (inner block, column block) of at most inner x cols
    values, features to tiles (row block, inner block). Tiles carry the replicated block keys (row, inner,
    column block) of the products they take part in, each product is one group, and the partial products of a row and column block are summed
    in the order of the inner blocks. Exchanged are features x column blocks, weights x row blocks and
    rows x outputs x inner blocks; ``row_blocks`` (default: Spark's shuffle partitions) bounds the rows of a group.

    ``id_col`` is unique; a null feature array gives a null result; missing weights count as 0.
    """
    spark = df.sparkSession
    row_blocks = row_blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kb, jb = -(-(n_in + 1) // inner), -(-n_out // cols)  # the bias is the weight of one more input, which is 1
    x = df.filter(F.col(features_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.concat(F.transform(features_col, lambda v: v.cast("double")), F.array(F.lit(1.0))).alias("x"))
    x = x.select("id", F.pmod(F.xxhash64("id"), F.lit(row_blocks)).cast("int").alias("rb"),
                 F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(kb - 1)), lambda k: F.slice("x", k * inner + 1, inner))).alias("kb", "part"))
    x = x.withColumn("jb", F.explode(F.sequence(F.lit(0), F.lit(jb - 1))))
    cells = W.select(F.col("i").cast("long"), F.col("j").cast("long"), F.col("w").cast("double")) \
        .unionByName(b.select(F.lit(n_in).cast("long").alias("i"), F.col("j").cast("long"), F.col("b").cast("double").alias("w")))
    tiles = cells.groupBy(F.floor(F.col("i") / inner).cast("int").alias("kb"), F.floor(F.col("j") / cols).cast("int").alias("jb")).agg(
        F.collect_list(((F.col("i") % inner) * cols + F.col("j") % cols).cast("int")).alias("at"), F.collect_list("w").alias("w"))
    tiles = tiles.withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))

    def product(key, left: pa.Table, right: pa.Table) -> pa.Table:
        tile = np.zeros(inner * cols)
        for at, w in zip(right.column("at").combine_chunks(), right.column("w").combine_chunks()):
            tile[at.values.to_numpy()] = w.values.to_numpy()
        parts = left.column("part").combine_chunks()
        width = len(parts.values[parts.offsets[0].as_py():parts.offsets[-1].as_py()]) // max(len(parts), 1)
        m = to_matrix(parts, width) @ tile.reshape(inner, cols)[:width] if len(parts) else np.zeros((0, cols))
        n = len(parts)
        return pa.table({"id": left.column("id"), "jb": pa.array(np.full(n, key[2].as_py(), np.int32)),
                         "kb": pa.array(np.full(n, key[1].as_py(), np.int32)), "z": to_list_array(m)})
    id_type = df.schema[id_col].dataType.simpleString()
    partial = x.groupBy("rb", "kb", "jb").cogroup(tiles.groupBy("rb", "kb", "jb")) \
        .applyInArrow(product, f"id {id_type}, jb int, kb int, z array<double>")
    add = lambda acc, p: F.zip_with(acc, p["z"], lambda u, v: u + v)
    zero = F.array_repeat(F.lit(0.0), cols)
    summed = partial.groupBy("id", "jb").agg(F.sort_array(F.collect_list(F.struct("kb", "z"))).alias("p")) \
        .select("id", "jb", F.aggregate("p", zero, add).alias("z"))
    whole = summed.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("jb", "z"))).alias("p")) \
        .select(F.col("id").alias(id_col), F.slice(F.flatten(F.transform("p", lambda s: s["z"])), 1, n_out).alias(out_col))
    none = df.filter(F.col(features_col).isNull()).select(id_col, F.lit(None).cast("array<double>").alias(out_col))
    return whole.unionByName(none)


# ---------------------------------------------------------------- native activations (SCR-02)

def act_expr(col: Column | str, kind: str, slope: float = 0.01) -> Column:
    """Element-wise activation on an array column, evaluated on the JVM (no Python)."""
    c = F.col(col) if isinstance(col, str) else col
    kind = kind.lower()
    if kind == "identity":
        return c
    if kind == "relu":
        return F.transform(c, lambda x: F.greatest(x, F.lit(0.0)))
    if kind == "leakyrelu":
        return F.transform(c, lambda x: F.when(x > 0, x).otherwise(x * F.lit(slope)))
    if kind == "sigmoid":
        return F.transform(c, lambda x: F.lit(1.0) / (F.lit(1.0) + F.exp(-x)))
    if kind == "tanh":
        return F.transform(c, lambda x: F.tanh(x))
    if kind == "softmax":
        shifted = let(c, lambda a: let(F.array_max(a), lambda m: F.transform(a, lambda x: F.exp(x - m))))
        return let(shifted, lambda e: let(F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x), lambda s: F.transform(e, lambda x: x / s)))
    raise ValueError(kind)


def _row_moments(arr: Column, c: int, hw: int) -> Column:
    """An array of (mean, squared deviations from it) of each channel of one row."""
    def state(ch):
        mean = F.aggregate(ch, F.lit(0.0), lambda acc, x: acc + x) / F.lit(float(hw))
        return let(mean, lambda m: F.struct(m.alias("m"), F.aggregate(ch, F.lit(0.0), lambda acc, x: acc + (x - m) * (x - m)).alias("q")))
    return F.transform(F.sequence(F.lit(0), F.lit(c - 1)), lambda k: let(F.slice(arr, k * hw + 1, hw), state))


def channel_moments(df: DataFrame, columns: Sequence[tuple[str, int, int]]) -> list[tuple[list[float], list[float]]]:
    """Per-channel mean and population variance over rows and pixels of several array columns in one pass.

    columns: (array column, channels, pixels per channel). Each row gives a channel's mean and squared deviations
    from it; the states (count, mean, M2) of rows and tasks are merged by Spark's central-moment aggregates, so no
    second pass is needed and large offsets cancel nothing. The result is 2 numbers a channel.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    rows = df
    for t, (col, c, hw) in enumerate(columns):
        rows = rows.withColumn(f"_moments{t}", _row_moments(F.col(col), c, hw))
        for k in range(c):
            at = F.col(f"_moments{t}")[k]
            aggs += [F.avg(at["m"]).alias(f"m{t}_{k}"), F.var_pop(at["m"]).alias(f"v{t}_{k}"), F.sum(at["q"]).alias(f"q{t}_{k}")]
    row = rows.select([f"_moments{t}" for t in range(len(columns))]).agg(*aggs).first()
    return [([row[f"m{t}_{k}"] for k in range(c)],
             [row[f"q{t}_{k}"] / (row["n"] * hw) + row[f"v{t}_{k}"] for k in range(c)]) for t, (_, c, hw) in enumerate(columns)]


def batchnorm_fit(df: DataFrame, px_col: str, c: int, h: int, w: int) -> tuple[list[float], list[float]]:
    """SCR-06 fit: per-channel mean and population variance over rows and pixels, in one pass."""
    return channel_moments(df, [(px_col, c, h * w)])[0]


def batchnorm_apply(px: Column | str, hw: int, mean, var, gamma=None, beta=None, eps: float = 1e-5) -> Column:
    """SCR-06 apply: (x - mean_c) / sqrt(var_c + eps) * gamma_c + beta_c on a channel-major array."""
    arr = F.col(px) if isinstance(px, str) else px
    c = len(mean)
    gamma = gamma if gamma is not None else [1.0] * c
    beta = beta if beta is not None else [0.0] * c
    m_a, v_a = F.array(*[F.lit(float(x)) for x in mean]), F.array(*[F.lit(float(x)) for x in var])
    g_a, b_a = F.array(*[F.lit(float(x)) for x in gamma]), F.array(*[F.lit(float(x)) for x in beta])

    def one(x, i):
        ch = (i / F.lit(hw)).cast("int") + 1
        return ((x - F.element_at(m_a, ch)) / F.sqrt(F.element_at(v_a, ch) + F.lit(eps))
                * F.element_at(g_a, ch) + F.element_at(b_a, ch))

    return F.transform(arr, one)


def residual_add(a: Column | str, b: Column | str) -> Column:
    """SCR-09: element-wise sum of two branches."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.zip_with(ca, cb, lambda x, y: x + y)


def merge_inputs(left: DataFrame, right: DataFrame, id_col: str, a: str, b: str,
                 out_col: str = "merged") -> DataFrame:
    """SCR-08: inner equi-join on id, then concatenate the two vectors."""
    return left.join(right, id_col, "inner").withColumn(out_col, F.concat(F.col(a), F.col(b)))


def fit_batchnorm_layers(df: DataFrame, net: Net, inputs: dict | str) -> Net:
    """SCR-06 feeding SCR-13: fit every batch-norm vertex's mean and variance from data.

    A level holds the batch norms with no unfitted one before them; all of a level are fitted by one job, which
    scores the net up to their inputs (with the statistics fitted so far) and merges their moments.
    Returns a copy of the net with the fitted statistics.
    """
    out = net.copy()
    if isinstance(inputs, str):
        inputs = {next(iter(net.inputs)): inputs}
    level = {name: 0 for name in net.inputs}
    norms: dict[int, list] = {}
    for v in net.vertices:
        level[v.name] = max(level[i] for i in v.inputs)
        if v.layer is not None and v.layer.kind == "batchnorm":
            norms.setdefault(level[v.name], []).append(v)
            level[v.name] += 1
    for _, vertices in sorted(norms.items()):
        sources = list(dict.fromkeys(v.inputs[0] for v in vertices))
        inner = {src: f"_bn_{i}" for i, src in enumerate(sources) if src not in out.inputs}
        given = {src: inputs[src] for src in sources if src in out.inputs}
        scored = score(df, out, inputs, keep=list(given.values()), outputs=inner) if inner else df
        columns = {}
        for src in sources:
            shape = out.shapes[src]
            c, h, w = (shape + (1, 1))[:3] if len(shape) < 3 else shape
            columns[src] = ({**inner, **given}[src], c, h * w)
        moments = dict(zip(columns, channel_moments(scored, list(columns.values()))))
        for v in vertices:
            mean, var = moments[v.inputs[0]]
            out.params[(v.name, "mean")] = np.asarray(mean, dtype=float)
            out.params[(v.name, "var")] = np.asarray(var, dtype=float)
    return out
