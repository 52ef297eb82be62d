"""Training as Spark jobs: distributed gradients and parameter-averaging rounds.

* ``gradient``: every partition adds up its rows' gradients in NumPy and emits one
  partial vector in fixed-size chunks; chunks are summed by a grouped job, so no
  task or driver ever holds row data. Only the model-sized result is collected.
* ``fit_averaging``: each worker (md5 bucket of the id) runs F mini-batches from
  the common parameters; the workers' parameters and updater state are averaged.
  The prepared table is written once, partitioned by round block, so a round reads
  only its own rows, and lineage never grows with the number of rounds.  Rounds of little
  arithmetic, which a job of its own would take longer to start than to run, run a bounded
  block to a task; rounds of much arithmetic are a job each, with the workers in tasks of their own.
"""

from __future__ import annotations

import math
import time
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import md5_int
from ..session import drop_scratch, scratch_path
from . import kernels as K
from .model import Net
from .scoring import ship_releasable, to_matrix
from .splits import assign_batches

CHUNK = 4096
FAN_IN = 16   # first-level groups of partial vectors per chunk
ROUNDS_PER_BLOCK = 64
DRIVER_AVERAGE_BYTES = 1 << 26  # workers x parameters below this are averaged after one collect
CACHE_ROUNDS_BYTES = 1 << 33    # prepared round tables up to this size are persisted co-located
ROUND_PRODUCTS = 1 << 30        # rounds of fewer multiplications (about a second's work) run in blocks, one task a block
BLOCK_BYTES = 1 << 24           # features and labels of such a block


# ---------------------------------------------------------------- losses and penalties (TRN-01)

def penalty(net: Net, l1: float = 0.0, l2: float = 0.0) -> float:
    s = 0.0
    if not (l1 or l2):
        return s
    for k in net.weight_keys():
        w = net.params[k]
        s += l1 * float(np.abs(w).sum()) + 0.5 * l2 * float((w * w).sum())
    return s


def penalty_grads(net: Net, grads: dict, l1: float = 0.0, l2: float = 0.0):
    if not (l1 or l2):
        return grads
    for k in net.weight_keys():
        grads[k] = grads[k] + l2 * net.params[k] + l1 * np.sign(net.params[k])
    return grads


def _labelled(df: DataFrame, labels: dict, n_classes: dict) -> DataFrame:
    """Class labels must be 0..k-1 and not null: a bad one raises where the rows are read."""
    from .prep import check_labels
    for out, c in labels.items():
        if not isinstance(df.schema[c].dataType, T.ArrayType):
            df = check_labels(df, c, n_classes[out])
    return df


def _onehot(labels: np.ndarray, k: int) -> np.ndarray:
    y = np.zeros((labels.shape[0], k))
    y[np.arange(labels.shape[0]), labels.astype(int)] = 1.0
    return y


# ---------------------------------------------------------------- distributed gradient (TRN-02)

_PARTIAL = T.StructType([T.StructField("chunk", T.IntegerType()), T.StructField("n", T.LongType()),
                         T.StructField("loss", T.DoubleType()),
                         T.StructField("vals", T.ArrayType(T.DoubleType()))])


def _chunks(vec: np.ndarray, n: int, loss: float):
    m = max(1, math.ceil(vec.size / CHUNK))
    ch = np.arange(m, dtype=np.int32)
    offsets = np.minimum(np.arange(m + 1) * CHUNK, vec.size).astype(np.int32)
    vals = pa.ListArray.from_arrays(pa.array(offsets), pa.array(vec, type=pa.float64()))
    return pa.RecordBatch.from_arrays(
        [pa.array(ch), pa.array(np.full(m, n, dtype=np.int64)), pa.array(np.full(m, loss)), vals],
        names=["chunk", "n", "loss", "vals"])


def _sum_chunks(pdf: pd.DataFrame) -> pd.DataFrame:
    acc = np.sum(np.stack(pdf["vals"].to_numpy()), axis=0)
    return pd.DataFrame({"chunk": [int(pdf["chunk"].iloc[0])], "n": [int(pdf["n"].sum())],
                         "loss": [float(pdf["loss"].sum())], "vals": [acc]})


def tree_sum(partial: DataFrame, n_partials: int) -> DataFrame:
    """Sum per-task partial vectors chunk by chunk in two grouped levels.

    Level 1 groups (chunk, task mod S), level 2 groups chunk, with S ~ sqrt(#partials):
    no group ever holds more than ~sqrt(#partials) chunk rows.
    """
    s = max(1, math.isqrt(max(n_partials, 1)))
    if s > 1:
        lvl1 = partial.withColumn("_g", (F.spark_partition_id() % F.lit(s)).cast("int"))
        partial = lvl1.groupBy("chunk", "_g").applyInPandas(_sum_chunks, _PARTIAL)
    return partial.groupBy("chunk").applyInPandas(_sum_chunks, _PARTIAL)


def gradient(df: DataFrame, net: Net, features: dict | str, labels: dict | str, n_classes: dict | int,
             l1: float = 0.0, l2: float = 0.0):
    """Mean gradient over all rows of ``df`` (plus penalty gradient) and the mean score.

    Returns (grads dict keyed like net.params, score float, n rows).
    """
    if isinstance(features, str):
        features = {next(iter(net.inputs)): features}
    if isinstance(labels, str):
        labels = {net.outputs[0]: labels}
    if isinstance(n_classes, int):
        n_classes = {net.outputs[0]: n_classes}
    widths = {k: int(np.prod(net.inputs[k])) for k in features}
    get, release = ship_releasable(df.sparkSession, net)
    feats, labs, ks = dict(features), dict(labels), dict(n_classes)
    keys = net.param_keys()

    def run(batches):
        model = get()
        acc = {k: np.zeros_like(v) for k, v in model.params.items()}
        n, loss = 0, 0.0
        for rb in batches:
            m = rb.num_rows
            if m == 0:
                continue
            fd = {name: to_matrix(rb.column(c), widths[name]) for name, c in feats.items()}
            ld = {}
            for o, c in labs.items():
                col = rb.column(c)
                if pa.types.is_list(col.type):
                    ld[o] = to_matrix(col, ks[o])
                else:
                    ld[o] = _onehot(col.to_numpy(zero_copy_only=False), ks[o])
            _, g, rows = model.loss_and_grads(fd, ld, train=False, reduce="sum")
            for k in acc:
                acc[k] += g[k]
            n += m
            loss += float(rows.sum())
        vec = np.concatenate([acc[(a, b)].ravel() for a, b, _ in keys]) if keys else np.zeros(1)
        yield _chunks(vec, n, loss)

    cols = list(dict.fromkeys(list(feats.values()) + list(labs.values())))
    partial = _labelled(df.select(*cols), labs, ks).mapInArrow(run, _PARTIAL)
    total = tree_sum(partial, FAN_IN * FAN_IN).collect()  # model-sized
    release()
    total = sorted(total, key=lambda r: r["chunk"])
    n = total[0]["n"] if total else 0
    vec = np.concatenate([np.asarray(r["vals"], dtype=float) for r in total]) / max(n, 1)
    loss = (total[0]["loss"] / max(n, 1)) if total else 0.0
    out = net.copy().set_flat(vec[:net.n_params()]).params
    out = penalty_grads(net, out, l1, l2)
    return out, loss + penalty(net, l1, l2), n


def loss_table(df: DataFrame, net: Net, features: str, label: str, k: int, kinds=("nll", "mse", "kl"),
               keep=("id",)) -> DataFrame:
    """TRN-01 per row: loss of each kind on the net's output (scored in one mapInArrow)."""
    from .scoring import score
    scored = score(df, net, features, keep=list(keep) + [label], outputs={net.outputs[0]: "_p"})
    y = F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                    lambda j: F.when(j == F.col(label), F.lit(1.0)).otherwise(F.lit(0.0)))
    eps = F.lit(K.LOG_EPS)
    sel = [F.col(c) for c in keep]
    for kind in kinds:
        if kind == "nll":
            e = -F.aggregate(F.zip_with(y, "_p", lambda a, p: a * F.log(F.greatest(p, eps))), F.lit(0.0),
                             lambda s, x: s + x)
        elif kind == "mse":
            e = F.aggregate(F.zip_with(y, "_p", lambda a, p: (p - a) * (p - a)), F.lit(0.0),
                            lambda s, x: s + x) / F.lit(float(k))
        elif kind == "kl":
            e = F.aggregate(F.zip_with(y, "_p", lambda a, p: F.when(a > 0, a * (F.log(F.greatest(a, eps))
                                                                               - F.log(F.greatest(p, eps))))
                                       .otherwise(F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)
        else:
            raise ValueError(kind)
        sel.append(e.alias(f"loss_{kind}"))
    return scored.select(*sel)


# ---------------------------------------------------------------- updaters and schedules (OPT-2..4)

@dataclass
class Updater:
    kind: str = "sgd"          # sgd | nesterovs | rmsprop
    lr: float = 0.1
    momentum: float = 0.9
    decay: float = 0.95
    eps: float = 1e-8
    schedule: dict | None = None   # {"type": "step", "decay": 0.1, "step": 100000} or {"type": "map", "values": {...}}
    bias_lr: float | None = None

    def rate(self, iteration: int, is_bias: bool = False) -> float:
        rate = schedule_rate(self.schedule, self.lr, iteration)
        # a bias rate of its own follows the schedule in the same proportion
        return rate * self.bias_lr / self.lr if is_bias and self.bias_lr is not None else rate

    def state_size(self, n: int) -> int:
        return n if self.kind in ("nesterovs", "rmsprop") else 0

    def step(self, w: np.ndarray, g: np.ndarray, s: np.ndarray, lr: np.ndarray):
        if self.kind == "sgd":
            return w - lr * g, s
        if self.kind == "nesterovs":
            v2 = self.momentum * s - lr * g
            return w + (1 + self.momentum) * v2 - self.momentum * s, v2
        if self.kind == "rmsprop":
            s2 = self.decay * s + (1 - self.decay) * g * g
            return w - lr * g / np.sqrt(s2 + self.eps), s2
        raise ValueError(self.kind)


def schedule_rate(schedule: dict | None, base: float, iteration: int) -> float:
    """OPT-3: step decay base * decay^floor(i/step), or a map iteration -> rate (latest key <= i)."""
    if not schedule:
        return base
    if schedule["type"] == "step":
        return base * schedule["decay"] ** math.floor(iteration / schedule["step"])
    if schedule["type"] == "map":
        keys = sorted(int(k) for k in schedule["values"])
        rate = base
        for k in keys:
            if k <= iteration:
                rate = schedule["values"][k] if k in schedule["values"] else schedule["values"][str(k)]
        return rate
    raise ValueError(schedule)


def renormalise_l2(net: Net, grads: dict) -> dict:
    """OPT-4: each layer's gradient (weights and bias together) scaled to unit L2 norm."""
    by_layer: dict = {}
    for (v, p), g in grads.items():
        by_layer.setdefault(v, []).append((p, g))
    out = {}
    for v, items in by_layer.items():
        norm = math.sqrt(sum(float((g * g).sum()) for _, g in items))
        for p, g in items:
            out[(v, p)] = g / norm if norm > 0 else g
    return out


# FIXED VALUES of the dropout coin: odd multipliers of a 32-bit counter hash
COIN = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE3D, 0x27D4EB2F)
COIN_MIX = 0x045D9F3B


def _vertex_code(vname) -> int:
    return zlib.crc32(str(vname).encode())


def dropout_mask(seed: int, iteration: int, ids: np.ndarray, vname: str, shape, keep: float) -> np.ndarray:
    """OPT-6: keep-mask from a 32-bit hash of (seed, iteration, vertex, id, unit) < keep, on whole arrays
    (same coin as ``dropout_expr``)."""
    n, units, m = shape[0], int(np.prod(shape[1:])), np.uint64(0xFFFFFFFF)
    head = (seed * COIN[0] + iteration * COIN[1] + _vertex_code(vname)) % (1 << 32)
    row = (np.asarray(ids).astype(np.int64).view(np.uint64) & m) * np.uint64(COIN[2])
    x = (np.uint64(head) + row[:, None] + np.arange(units, dtype=np.uint64)[None, :] * np.uint64(COIN[3])) & m
    for _ in range(2):
        x = ((x ^ (x >> np.uint64(16))) * np.uint64(COIN_MIX)) & m
    x = x ^ (x >> np.uint64(16))
    return (x / 4294967296.0 < keep).astype(float).reshape(shape)


# ---------------------------------------------------------------- parameter averaging (TRN-03..05)

@dataclass
class FitSpec:
    workers: int = 3
    batch: int = 16
    frequency: int = 1
    epochs: int = 1
    seed: int = 42
    updater: Updater = field(default_factory=Updater)
    l1: float = 0.0
    l2: float = 0.0
    renorm_l2: bool = False
    dropout_seed: int = 7
    reshuffle_each_epoch: bool = False
    score_every: int = 1          # SNK-03: keep a metrics row every N rounds (and the last of each epoch)
    score_every_iterations: int | None = None  # or whenever N more mini-batches are done


def _worker_step(model: Net, spec: FitSpec, w: np.ndarray, s: np.ndarray, keys, fd, ld, iteration, ids):
    model.set_flat(w)
    mask_fn = None
    if any(v.layer is not None and v.layer.keep < 1.0 for v in model.vertices):
        def mask_fn(v, shape):
            return dropout_mask(spec.dropout_seed, iteration, ids, v.name, shape, v.layer.keep)
    loss, g, _ = model.loss_and_grads(fd, ld, train=True, mask_fn=mask_fn)
    g = penalty_grads(model, g, spec.l1, spec.l2)
    if spec.renorm_l2:
        g = renormalise_l2(model, g)
    gvec = np.concatenate([g[(a, b)].ravel() for a, b, _ in keys])
    lr = np.concatenate([np.full(int(np.prod(shp)), spec.updater.rate(iteration, b == "b")) for a, b, shp in keys])
    w2, s2 = spec.updater.step(w, gvec, s, lr)
    return w2, s2, loss + penalty(model, spec.l1, spec.l2)


def prepare_rounds(df: DataFrame, id_col: str, spec: FitSpec, epoch: int = 0, block: int = ROUNDS_PER_BLOCK) -> DataFrame:
    """Worker, rank inside the worker, batch and round columns (TRN-03 fixed semantics, section 7.4 of the survey)."""
    seed = spec.seed + (epoch if spec.reshuffle_each_epoch else 0)
    d = df.withColumn("worker_id", (md5_int(seed, id_col) % F.lit(spec.workers)).cast("int"))
    d = assign_batches(d, id_col, spec.batch, seed, partition_cols=["worker_id"], n_groups=spec.workers,
                       batch_col="batch_idx", rank_col="_rank")
    d = d.withColumn("round", (F.col("batch_idx") / F.lit(spec.frequency)).cast("bigint"))
    return d.withColumn("round_block", (F.col("round") / F.lit(block)).cast("bigint"))


def rounds_together(net: Net, spec: FitSpec, widths: dict, n_classes: dict) -> int:
    """Rounds of a block that one task runs; 0 where a round has work enough for a job of its own, a task per worker."""
    rows = spec.workers * spec.frequency * spec.batch
    if rows * net.products() > ROUND_PRODUCTS:
        return 0
    return BLOCK_BYTES // (rows * 8 * (sum(widths.values()) + sum(n_classes.values())))


def _block_table(spark, src: DataFrame, id_col: str, spec: FitSpec, epoch: int, block: int):
    """Write the epoch's round table once, one file a block of rounds; return (table, number of rounds, path)."""
    path = scratch_path(spark, f"rounds-e{epoch}")
    prep = prepare_rounds(src, id_col, spec, epoch, block)
    prep.drop("batch_idx").repartition("round_block").write.mode("overwrite").partitionBy("round_block").parquet(path)
    data = spark.read.schema(prep.drop("batch_idx").schema).parquet(path)
    last = data.agg(F.max("round")).first()[0]
    return data, 0 if last is None else int(last) + 1, path


def _round_table(spark, src: DataFrame, id_col: str, spec: FitSpec, epoch: int):
    """Write the epoch's round table once; return (table, number of rounds, co-located flag, path)."""
    path = scratch_path(spark, f"rounds-e{epoch}")
    prep = prepare_rounds(src, id_col, spec, epoch)
    # one writer per round block and worker, rows sorted by round: a round reads one directory and,
    # through row-group statistics, only its own rows
    (prep.repartition("round_block", "worker_id").sortWithinPartitions("round", "worker_id")
     .write.mode("overwrite").partitionBy("round_block").parquet(path))
    data = spark.read.parquet(path)
    n_rounds_row = data.agg(F.max("round").alias("r")).first()
    n_rounds = 0 if n_rounds_row["r"] is None else int(n_rounds_row["r"]) + 1
    # Small prepared tables are kept in executor memory (spilling to disk), hash-partitioned so
    # every worker's rows of a round sit in one partition: a round is then one stage with no
    # shuffle. Larger tables stay on shared storage and a round groups its rows by worker.
    size = int(str(data._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    co_located = size <= cache_limit(spark)
    if co_located:
        parts = max(1, min(spark.sparkContext.defaultParallelism,
                           spec.workers * (n_rounds // ROUNDS_PER_BLOCK + 1)))
        data = (data.repartition(parts, "worker_id", "round_block").sortWithinPartitions("round")
                .persist(StorageLevel.MEMORY_AND_DISK))  # sorted: cached-batch statistics prune rounds
    return data, n_rounds, co_located, path


def fit_averaging(df: DataFrame, net: Net, id_col: str, features: dict | str, labels: dict | str,
                  n_classes: dict | int, spec: FitSpec, run: str = "fit", listener=None,
                  state: np.ndarray | None = None, iteration: int = 0, start_round: int = 0, stop_round: int | None = None):
    """TRN-03: synchronous parameter averaging. Returns (trained Net, metrics DataFrame, state vector).

    The round table is written once per fit (or once per epoch when reshuffling). Per round
    one Spark job: read round r (cached co-located rows, or partition-pruned Parquet grouped by
    worker), run F mini-batches in NumPy from the shipped parameters, emit the worker's
    parameters + updater state in chunks, and average them (one collect when small, a grouped
    chunk sum otherwise). ``state`` and ``iteration`` continue an earlier fit (see
    ``model_store.read_updater``); rounds, counted over all epochs, outside
    [start_round, stop_round) are left out.
    """
    spark = df.sparkSession
    if isinstance(features, str):
        features = {next(iter(net.inputs)): features}
    if isinstance(labels, str):
        labels = {net.outputs[0]: labels}
    if isinstance(n_classes, int):
        n_classes = {net.outputs[0]: n_classes}
    net = net.copy()
    keys = net.param_keys()
    n_par = net.n_params()
    state = np.zeros(spec.updater.state_size(n_par)) if state is None else np.asarray(state, dtype=float)
    if state.size != spec.updater.state_size(n_par):
        raise ValueError(f"updater state of {state.size} values where {spec.updater.state_size(n_par)} are needed")
    widths = {k: int(np.prod(net.inputs[k])) for k in features}
    cols = list(dict.fromkeys([id_col] + list(features.values()) + list(labels.values())))
    metrics = []
    t0 = time.time()
    done = 0
    # the input is computed once: written to the shared folder, then ranked from the written copy
    src_path = scratch_path(spark, "fit-input")
    _labelled(df.select(*cols), labels, n_classes).write.mode("overwrite").parquet(src_path)
    src = spark.read.parquet(src_path)
    data = None
    co_located = False
    together = rounds_together(net, spec, widths, n_classes)
    for epoch in range(spec.epochs):
        if data is None or spec.reshuffle_each_epoch:
            if data is not None:
                data.unpersist()
                drop_scratch(spark, rounds_path)
            if together:
                data, n_rounds, rounds_path = _block_table(spark, src, id_col, spec, epoch, together)
            else:
                data, n_rounds, co_located, rounds_path = _round_table(spark, src, id_col, spec, epoch)
        if together:
            first = max(start_round - done, 0)
            end = n_rounds if stop_round is None else min(n_rounds, stop_round - done)
            done += n_rounds
            for block in range(first // together, math.ceil(end / together)):
                span = (max(first, block * together), min(end, (block + 1) * together))
                if span[0] >= span[1]:
                    continue
                shipped = Net(net.inputs, net.vertices, net.outputs)
                shipped.params = dict(net.params)
                shipped.fit_state = state
                get, release = ship_releasable(spark, shipped)
                elapsed = int((time.time() - t0) * 1000)
                rows = data.filter(F.col("round_block") == F.lit(block)).coalesce(1)
                found = rows.mapInArrow(_make_block(get, iteration, span, n_rounds, spec, id_col, dict(features), dict(labels),
                                                    dict(n_classes), widths), _BLOCK_RESULT).toArrow()
                release()
                found = found.sort_by("chunk").to_pylist()
                vec = np.concatenate([np.asarray(row["vals"]) for row in found if row["chunk"] >= 0])
                net.set_flat(vec[:n_par])
                state = vec[n_par:]
                iteration = found[-1]["iteration"]
                for row in sorted((row for row in found if row["chunk"] < 0), key=lambda row: row["round"]):
                    rec = (run, epoch, row["round"], row["iteration"], row["score"], elapsed + row["ms"])
                    metrics.append(rec)
                    if listener is not None:
                        listener(rec)
            continue
        for r in range(n_rounds):
            done += 1
            if done <= start_round or (stop_round is not None and done > stop_round):
                continue
            vec = np.concatenate([net.flat(), state])
            shipped = Net(net.inputs, net.vertices, net.outputs)
            shipped.params = dict(net.params)
            shipped.fit_state = state  # parameters and state travel once, together
            get, release = ship_releasable(spark, shipped)
            base_iter = iteration
            feats, labs, ks = dict(features), dict(labels), dict(n_classes)

            train = _make_train(get, base_iter, n_par, keys, spec, id_col, feats, labs, ks, widths)

            schema = T.StructType(_PARTIAL.fields + [T.StructField("nb", T.LongType())])
            rnd = data.filter((F.col("round_block") == F.lit(r // ROUNDS_PER_BLOCK)) & (F.col("round") == F.lit(r)))
            if co_located:
                per_worker = rnd.mapInArrow(_per_partition(train), schema)
            else:
                per_worker = rnd.groupBy("worker_id").applyInArrow(_as_table(train), schema)
            if spec.workers * vec.size * 8 <= DRIVER_AVERAGE_BYTES:
                # W small parameter vectors: one collect, averaged on the driver
                rows = per_worker.collect()
                by_chunk: dict = {}
                for row in rows:
                    by_chunk.setdefault(row["chunk"], []).append(row)
                summed = [{"chunk": c, "n": sum(x["n"] for x in rs), "loss": sum(x["loss"] for x in rs),
                           "vals": np.sum([np.asarray(x["vals"], dtype=float) for x in rs], axis=0),
                           "nb": max(x["nb"] for x in rs)} for c, rs in by_chunk.items()]
            else:
                # many workers or large models: chunk-wise sums run as a grouped job
                summed = per_worker.groupBy("chunk").applyInPandas(
                    lambda pdf: _sum_chunks(pdf).assign(nb=int(pdf["nb"].max())), schema).collect()
            release()  # one broadcast per round: drop it once the round's job is done
            summed = sorted(summed, key=lambda row: row["chunk"])
            n_workers = summed[0]["n"]
            avg = np.concatenate([np.asarray(row["vals"], dtype=float) for row in summed]) / n_workers
            net.set_flat(avg[:n_par])
            state = avg[n_par:]
            iteration += int(summed[0]["nb"])
            score = summed[0]["loss"] / n_workers
            rec = (run, epoch, r, iteration, float(score), int((time.time() - t0) * 1000))
            if _due(spec, r, n_rounds, base_iter, iteration):
                metrics.append(rec)
                if listener is not None:
                    listener(rec)
    if data is not None:
        data.unpersist()
        drop_scratch(spark, rounds_path)
    drop_scratch(spark, src_path)
    mdf = spark.createDataFrame(metrics, "run string, epoch int, round int, iteration bigint, score double, "
                                         "elapsed_ms bigint")
    return net, mdf, state


def _due(spec: FitSpec, r: int, n_rounds: int, before: int, after: int) -> bool:
    """Whether round r, which led from iteration ``before`` to ``after``, has a metrics row."""
    if r == n_rounds - 1:
        return True
    if spec.score_every_iterations:
        return after // spec.score_every_iterations > before // spec.score_every_iterations
    return r % max(spec.score_every, 1) == 0


def cache_limit(spark) -> int:
    try:
        return int(spark.conf.get("spark.layerwise.cacheRoundsBytes"))
    except Exception:  # noqa: BLE001 - unset
        return CACHE_ROUNDS_BYTES


def _per_partition(train):
    """mapInArrow body: the round's rows of the workers hashed to this partition, one worker at a time."""

    def run(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts)
        workers = rows.column("worker_id").to_numpy()
        for w in np.unique(workers):
            yield train(rows.filter(pa.array(workers == w)))

    return run


def _as_table(train):
    """applyInArrow body: one worker's round rows in, its parameter chunks out."""

    def run(tbl: pa.Table) -> pa.Table:
        return pa.Table.from_batches([train(tbl)])

    return run


def _make_train(_get, _base, n_par, keys, spec, id_col, feats, labs, ks, widths):
    """One worker's part of a round: F mini-batches from the common parameters, on Arrow data.

    The worker's rows are sorted once by rank (md5 key, id), turned into whole matrices,
    and each mini-batch is a slice of them.
    """
    import pyarrow.compute as pc

    def train(tbl: pa.Table) -> pa.RecordBatch:
        given = _get()
        model = given.copy()
        order = pc.sort_indices(tbl, sort_keys=[("_rank", "ascending")])
        tbl = tbl.take(order).combine_chunks()
        bidx = tbl.column("batch_idx").to_numpy()
        starts = np.flatnonzero(np.r_[True, bidx[1:] != bidx[:-1]])
        ends = np.r_[starts[1:], len(bidx)]
        fmat = {name: to_matrix(tbl.column(c), widths[name]) for name, c in feats.items()}
        lmat = {}
        for o, c in labs.items():
            col = tbl.column(c)
            lmat[o] = (to_matrix(col, ks[o]) if pa.types.is_list(col.type)
                       else _onehot(col.to_numpy(), ks[o]))
        ids = tbl.column(id_col).to_numpy()
        w, s = given.flat().copy(), given.fit_state.copy()
        score = 0.0
        for bi, (a, b) in enumerate(zip(starts, ends)):
            fd = {k: m[a:b] for k, m in fmat.items()}
            ld = {k: m[a:b] for k, m in lmat.items()}
            w, s, score = _worker_step(model, spec, w, s, keys, fd, ld, _base + bi, ids[a:b])
        out = np.concatenate([w, s])
        rb = _chunks(out, 1, score)
        return pa.RecordBatch.from_arrays(
            list(rb.columns) + [pa.array(np.full(rb.num_rows, len(starts), dtype=np.int64))],
            names=rb.schema.names + ["nb"])

    return train


# ---------------------------------------------------------------- blocks of rounds in one task

_BLOCK_RESULT = T.StructType([T.StructField("chunk", T.IntegerType()), T.StructField("vals", T.ArrayType(T.DoubleType())),
                              T.StructField("round", T.IntegerType()), T.StructField("iteration", T.LongType()),
                              T.StructField("score", T.DoubleType()), T.StructField("ms", T.LongType())])


class _Copies:
    """The workers' copies of a net whose vertices are dense layers: one mini-batch step of all of them in array
    operations over a leading axis of copies, with the arithmetic of ``_worker_step``."""

    def __init__(self, net: Net, spec: FitSpec, n: int):
        self.net, self.spec, self.n = net, spec, n
        keys = net.param_keys()
        sizes = [int(np.prod(shp)) for _, _, shp in keys]
        ends = np.cumsum(sizes)
        self.w, self.g = np.zeros((n, net.n_params())), np.zeros((n, net.n_params()))
        at = [slice(e - s, e) for s, e in zip(sizes, ends)]
        self.p = {(a, b): self.w[:, i].reshape(n, *shp) for (a, b, shp), i in zip(keys, at)}
        self.gp = {(a, b): self.g[:, i].reshape(n, *shp) for (a, b, shp), i in zip(keys, at)}
        self.is_weight = np.concatenate([np.full(s, float(b == "W")) for (_, b, _), s in zip(keys, sizes)])
        self.is_bias = np.concatenate([np.full(s, b == "b") for (_, b, _), s in zip(keys, sizes)])

    @staticmethod
    def able(net: Net, spec: FitSpec) -> bool:
        layers = [v.layer for v in net.vertices if v.layer is not None]
        return (not spec.renorm_l2 and all(v.op in ("layer", "merge") for v in net.vertices)
                and all(lay.kind in ("dense", "output") and lay.keep >= 1.0 for lay in layers)
                and all(len(s) == 1 for s in net.inputs.values()) and set(net.params) == {(a, b) for a, b, _ in net.param_keys()})

    def start(self, w: np.ndarray, s: np.ndarray):
        self.w[:] = w
        self.s = np.broadcast_to(s, (self.n, s.size))

    def step(self, feeds: dict, labels: dict, iteration: int, scored: bool):
        """One step on (copies, rows, width) arrays; the copies' scores where asked for."""
        n, spec, p = self.n, self.spec, self.p
        rows = next(iter(feeds.values())).shape[1]
        vals, zs = {k: x.reshape(n * rows, -1) for k, x in feeds.items()}, {}
        for v in self.net.vertices:
            if v.op == "merge":
                vals[v.name] = np.concatenate([vals[i] for i in v.inputs], axis=1)
                continue
            z = np.matmul(vals[v.inputs[0]].reshape(n, rows, -1), p[(v.name, "W")]) + p[(v.name, "b")][:, None, :]
            zs[v.name] = z.reshape(n * rows, -1)
            vals[v.name] = K.activate(zs[v.name], v.layer.activation)
        grads, score = {}, 0.0
        for o in self.net.outputs:
            lay, y = self.net._vertex(o).layer, labels[o].reshape(n * rows, -1)
            if scored:
                score = score + K.loss_rows(vals[o], y, lay.loss or "mse")
            grads[o] = ("z", K.loss_grad_z(zs[o], vals[o], y, lay.loss or "mse", lay.activation) / rows)
        if scored:
            score = score.reshape(n, rows).mean(axis=1)
            if spec.l1 or spec.l2:
                ww = self.w * self.is_weight
                score = score + spec.l1 * np.abs(ww).sum(axis=1) + 0.5 * spec.l2 * (ww * ww).sum(axis=1)
        for v in reversed(self.net.vertices):
            if v.name not in grads:
                continue
            kind, g = grads.pop(v.name)
            if v.op == "merge":
                off = 0
                for i in v.inputs:
                    width = vals[i].shape[1]
                    if i not in self.net.inputs:
                        Net._acc(grads, i, g[:, off:off + width])
                    off += width
                continue
            dz = g if kind == "z" else K.activate_grad(zs[v.name], vals[v.name], g, v.layer.activation)
            dz, src = dz.reshape(n, rows, -1), v.inputs[0]
            np.matmul(vals[src].reshape(n, rows, -1).transpose(0, 2, 1), dz, out=self.gp[(v.name, "W")])
            np.sum(dz, axis=1, out=self.gp[(v.name, "b")])
            if src not in self.net.inputs:
                Net._acc(grads, src, np.matmul(dz, p[(v.name, "W")].transpose(0, 2, 1)).reshape(n * rows, -1))
        g = self.g
        if spec.l1 or spec.l2:
            g = g + self.is_weight * (spec.l2 * self.w + spec.l1 * np.sign(self.w))
        rate = spec.updater.rate(iteration)
        if spec.updater.bias_lr is not None:
            rate = np.where(self.is_bias, spec.updater.rate(iteration, True), rate)
        self.w[:], self.s = spec.updater.step(self.w, g, self.s, rate)
        return score


def _make_block(get, iteration, span, n_rounds, spec, id_col, feats, labs, ks, widths):
    """mapInArrow body: the rows of the rounds ``span`` of all workers in, parameters, state and metrics rows out.

    A worker's rows lie in rank order, so batch b of round r is a slice. Rounds in which all workers have full batches
    run on arrays of all copies where the net allows it, others worker by worker."""

    def run(batches):
        t0 = time.time()
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        tbl = pa.Table.from_batches(parts)
        tbl = tbl.take(np.lexsort((tbl.column("_rank").to_numpy(), tbl.column("worker_id").to_numpy()))).combine_chunks()
        worker, rank = tbl.column("worker_id").to_numpy(), tbl.column("_rank").to_numpy()
        begin = np.flatnonzero(np.r_[True, worker[1:] != worker[:-1]])
        stop = np.r_[begin[1:], len(worker)]
        zero = begin - rank[begin]  # where rank 0 of each worker would lie
        fmat = {name: to_matrix(tbl.column(c), widths[name]) for name, c in feats.items()}
        lmat = {}
        for o, c in labs.items():
            col = tbl.column(c)
            lmat[o] = to_matrix(col, ks[o]) if pa.types.is_list(col.type) else _onehot(col.to_numpy(), ks[o])
        ids = tbl.column(id_col).to_numpy()
        given = get()
        model, keys = given.copy(), given.param_keys()
        w, s, n_par = given.flat(), given.fit_state, given.n_params()
        per_round, it, out = spec.batch * spec.frequency, iteration, []
        copies = _Copies(given, spec, len(begin)) if _Copies.able(given, spec) else None
        for r in range(*span):
            lo, hi = zero + r * per_round, np.minimum(zero + (r + 1) * per_round, stop)
            before, full = it, bool((hi - lo == per_round).all())
            if full and copies is not None:
                it += spec.frequency
                due = _due(spec, r, n_rounds, before, it)
                fd = {k: np.stack([m[a:b] for a, b in zip(lo, hi)]) for k, m in fmat.items()}
                ld = {k: np.stack([m[a:b] for a, b in zip(lo, hi)]) for k, m in lmat.items()}
                copies.start(w, s)
                for b in range(spec.frequency):
                    i = slice(b * spec.batch, (b + 1) * spec.batch)
                    score = copies.step({k: m[:, i] for k, m in fd.items()}, {k: m[:, i] for k, m in ld.items()},
                                        before + b, due and b == spec.frequency - 1)
                w, s = copies.w.mean(axis=0), copies.s.mean(axis=0)
                score = float(np.mean(score))
            else:
                voters, scores = [], []
                for a, end in zip(lo, hi):
                    if a >= end:
                        continue
                    ww, ss, last = w, s, 0.0
                    for b, i in enumerate(range(a, end, spec.batch)):
                        j = min(i + spec.batch, end)
                        ww, ss, last = _worker_step(model, spec, ww, ss, keys, {k: m[i:j] for k, m in fmat.items()},
                                                    {k: m[i:j] for k, m in lmat.items()}, before + b, ids[i:j])
                        it = max(it, before + b + 1)
                    voters.append(np.concatenate([ww, ss]))
                    scores.append(last)
                avg = np.mean(voters, axis=0)
                w, s = avg[:n_par], avg[n_par:]
                score = float(np.mean(scores))
                due = _due(spec, r, n_rounds, before, it)
            if due:
                out.append((r, it, score, int((time.time() - t0) * 1000)))
        vec = np.concatenate([w, s])
        vals = [vec[i:i + CHUNK] for i in range(0, max(vec.size, 1), CHUNK)]
        table = pa.Table.from_pylist([{"chunk": -1, "vals": None, "round": m[0], "iteration": m[1], "score": m[2], "ms": m[3]} for m in out]
                                     + [{"chunk": i, "vals": v, "round": None, "iteration": it, "score": None, "ms": None}
                                        for i, v in enumerate(vals)], schema=_BLOCK_ARROW)
        yield from table.to_batches()

    return run


_BLOCK_ARROW = pa.schema([("chunk", pa.int32()), ("vals", pa.list_(pa.float64())), ("round", pa.int32()), ("iteration", pa.int64()),
                          ("score", pa.float64()), ("ms", pa.int64())])


# ---------------------------------------------------------------- table forms of the options (OPT-3, OPT-6)

def schedule_expr(iteration, schedule: dict | None, base: float):
    """OPT-3 as a column expression of an iteration column (same rule as ``schedule_rate``)."""
    it = F.col(iteration) if isinstance(iteration, str) else iteration
    if not schedule:
        return F.lit(base)
    if schedule["type"] == "step":
        return F.lit(base) * F.pow(F.lit(float(schedule["decay"])), F.floor(it / F.lit(schedule["step"])))
    expr = F.lit(base)
    for k in sorted(int(k) for k in schedule["values"]):
        val = schedule["values"][k] if k in schedule["values"] else schedule["values"][str(k)]
        expr = F.when(it >= F.lit(k), F.lit(float(val))).otherwise(expr)
    return expr


def dropout_expr(arr, id_col: str, seed: int, iteration: int, vertex: str, keep: float):
    """OPT-6 on an array column: unit u kept when the coin of (seed, iteration, vertex, id, u) < keep, scaled 1/keep."""
    a = F.col(arr) if isinstance(arr, str) else arr
    m = F.lit(0xFFFFFFFF).cast("bigint")
    head = (seed * COIN[0] + iteration * COIN[1] + _vertex_code(vertex)) % (1 << 32)
    # the low 32 bits of a product of 32-bit numbers, split so that it stays below 2^63
    times = lambda v, k: (((F.shiftright(v, 16) * k).bitwiseAND(0xFFFF)) * 65536 + v.bitwiseAND(0xFFFF) * k)
    row = times(F.col(id_col).cast("bigint").bitwiseAND(m), COIN[2])

    def coin(u):
        x = (F.lit(head).cast("bigint") + row + times(u.cast("bigint"), COIN[3])).bitwiseAND(m)
        for _ in range(2):
            x = (x.bitwiseXOR(F.shiftright(x, 16)) * COIN_MIX).bitwiseAND(m)
        return x.bitwiseXOR(F.shiftright(x, 16)) / F.lit(4294967296.0)
    return F.transform(a, lambda x, u: F.when(coin(u) < F.lit(keep), x / F.lit(keep)).otherwise(F.lit(0.0)))


def init_table(spark, n_in: int, n_out: int, seed: int, layer: int = 0, scheme: str = "xavier",
               std: float = 0.01) -> DataFrame:
    """OPT-1 table form: a weight matrix generated on the executors as rows (i, j, w).

    Two md5 uniforms per cell, coin(seed|layer|cell|0) and coin(seed|layer|cell|1), feed
    Box-Muller; Xavier scales by sqrt(2 / (n_in + n_out)). For matrices too large to build
    on the driver; the result pairs with ``scoring.dense_blocked``.
    """
    from ..functions.hashing import hash01
    sd = math.sqrt(2.0 / (n_in + n_out)) if scheme == "xavier" else std
    cells = spark.range(n_in * n_out)
    u1 = F.greatest(hash01(seed, F.lit(layer), "id", F.lit(0)), F.lit(1e-12))
    u2 = hash01(seed, F.lit(layer), "id", F.lit(1))
    gauss = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)
    return cells.select((F.col("id") / F.lit(n_out)).cast("int").alias("i"),
                        (F.col("id") % F.lit(n_out)).cast("int").alias("j"),
                        (gauss * F.lit(sd)).alias("w"))
