"""Operators over ordered series per key (SCR-10..12).

1-D convolution and pooling read their windows by ``lag`` inside (key, block of positions), with the
border rows of a block copied to the next, after a skew-proof per-key position (time-bucket
histogram + row_number inside a bucket).
The recurrent layer needs state carried from
step to step: rows are hash-partitioned by key and sorted inside partitions, then
one ``mapInArrow`` streams them batch by batch, carrying (h, c) across batch
borders. A long series is never materialised as one group: memory per task is
one Arrow batch plus the state of one key.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K


SERIES_BUCKET_SECONDS = 3600
MIN_BUCKET_SECONDS = 1e-6
BLOCK_ROWS = 1 << 14   # positions of a series that share a window partition


def _time_bucket(col_name: str, dtype, granularity: float):
    c = F.col(col_name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(granularity * 1e6)).cast("bigint")
    if isinstance(dtype, T.DateType):
        return F.floor(F.unix_date(c) * F.lit(86400.0) / F.lit(granularity)).cast("bigint")
    return F.floor(c.cast("double") / F.lit(float(granularity))).cast("bigint")


def positions(df: DataFrame, key: str, order: Sequence[str], pos_col: str = "pos",
              granularity: float = SERIES_BUCKET_SECONDS, with_length: bool = False) -> DataFrame:
    """0-based position of each row in its key's series, ordered by ``order``.

    No window holds a whole series: rows are bucketed by (key, floor(order[0] / granularity));
    the per-key histogram of buckets (bounded by the series' time span / granularity, not by
    its row count) gives each bucket's offset, and row_number runs only inside one
    (key, bucket). A key holding a third of all rows is spread over its buckets; when one
    (key, bucket) cell still exceeds ``spark.layerwise.hotRows`` the buckets are narrowed
    and counted again; a burst at one value of order[0], which no narrowing parts, is cut by a range exchange
    over the whole order. Rows with a null order value stand first in their series; a null key
    is a series of its own.
    """
    order = list(order)
    from .splits import hot_rows
    limit = hot_rows(df.sparkSession)
    dtype = df.schema[order[0]].dataType
    while True:
        d = df.withColumn("_tb", _time_bucket(order[0], dtype, granularity))
        hist = d.groupBy(key, "_tb").agg(F.count(F.lit(1)).alias("_cnt"))
        biggest = hist.agg(F.max("_cnt")).first()[0] or 0
        # a burst inside one bucket: narrow the buckets until no (key, bucket) cell is hot
        if biggest <= limit or granularity <= MIN_BUCKET_SECONDS:
            break
        granularity = max(MIN_BUCKET_SECONDS, granularity / (2 * -(-biggest // limit)))
    if biggest > limit:
        return _ranged_positions(df, key, order, pos_col, with_length)
    w_hist = Window.partitionBy(key).orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    offs = hist.select(key, "_tb", F.coalesce(F.sum("_cnt").over(w_hist), F.lit(0)).alias("_off"),
                       F.sum("_cnt").over(Window.partitionBy(key)).alias("_len"))
    w = Window.partitionBy(key, "_tb").orderBy(*order)
    offs = offs.select(F.col(key).alias("_ok"), F.col("_tb").alias("_otb"), "_off", "_len")
    out = (d.join(offs, F.col(key).eqNullSafe(F.col("_ok")) & F.col("_tb").eqNullSafe(F.col("_otb")))
           .withColumn(pos_col, (F.col("_off") + F.row_number().over(w) - 1).cast("bigint")))
    out = out.drop("_tb", "_off", "_ok", "_otb")
    return out if with_length else out.drop("_len")


def _ranged_positions(df: DataFrame, key: str, order: Sequence[str], pos_col: str, with_length: bool) -> DataFrame:
    """``positions`` by ranges of (key, order, row hash): numbers inside a range plus the key's rows in ranges before it.

    Rows that agree in key and order follow the hash of the whole row, so a burst is cut like any other rows. The
    ranges are written once, since two evaluations could draw different borders."""
    from ..session import scratch_path
    path = scratch_path(df.sparkSession, "series-ranges")
    (df.withColumn("_h", F.xxhash64(*df.columns)).repartitionByRange(key, *order, "_h")
     .withColumn("_p", F.spark_partition_id()).write.parquet(path))
    ranged = df.sparkSession.read.parquet(path)
    sizes = ranged.groupBy(F.col(key).alias("_ok"), F.col("_p").alias("_op")).agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy("_ok").orderBy("_op").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select("_ok", "_op", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                        F.sum("_cnt").over(Window.partitionBy("_ok")).alias("_len"))
    w = Window.partitionBy("_p", key).orderBy(*order, "_h")
    out = ranged.withColumn("_rn", F.row_number().over(w)).join(offs, F.col(key).eqNullSafe(F.col("_ok")) & (F.col("_p") == F.col("_op")))
    out = out.select(*df.columns, (F.col("_off") + F.col("_rn") - 1).cast("bigint").alias(pos_col), "_len")
    return out if with_length else out.drop("_len")


def _taps(df: DataFrame, key: str, order: Sequence[str], value_col: str, k: int, stride: int, pad: int,
          granularity: float) -> DataFrame:
    """(key, pos, x0 .. x{k-1}): the k values under output step ``pos``, null outside the series.

    Rows are dealt out by (key, block of positions); the last k-1 rows of a block are copied to the next
    one, so every window lies in one block and ``lag`` reads it there: one exchange of about the
    rows themselves, and a hot key is spread over its blocks.
    """
    d = positions(df.select(key, *order, value_col), key, order, granularity=granularity, with_length=True)
    d = d.select(key, "pos", "_len", F.col(value_col).alias("_x"))
    if pad:  # the row that ends a series brings the padding behind it
        tail = F.when(F.col("pos") == F.col("_len") - 1, F.sequence(F.lit(0), F.lit(pad))).otherwise(F.array(F.lit(0)))
        d = d.select(key, "_len", "_x", "pos", F.explode(tail).alias("_t")) \
            .select(key, "_len", (F.col("pos") + F.col("_t")).alias("pos"), F.when(F.col("_t") == 0, F.col("_x")).alias("_x"))
    block = F.floor(F.col("pos") / F.lit(BLOCK_ROWS)).cast("bigint")
    border = F.col("pos") % F.lit(BLOCK_ROWS) >= F.lit(BLOCK_ROWS - (k - 1))
    d = d.select(key, "_len", "pos", "_x", block.alias("_own"), F.explode(F.when(border, F.array(block, block + 1)).otherwise(F.array(block))).alias("_block"))
    w = Window.partitionBy(key, "_block").orderBy("pos")
    first = F.col("pos") + F.lit(pad - (k - 1))  # = t * stride
    d = d.select(key, "_len", "_own", "_block", first.alias("_first"),
                 *[(F.lag("_x", k - 1 - j).over(w) if j < k - 1 else F.col("_x")).alias(f"x{j}") for j in range(k)])
    steps = F.floor((F.col("_len") + F.lit(2 * pad - k)) / F.lit(stride)) + 1
    t = (F.col("_first") / stride).cast("bigint")
    keep = (F.col("_own") == F.col("_block")) & (F.col("_first") >= 0) & (F.col("_first") % stride == 0) & (t < steps)
    return d.filter(keep).select(key, t.alias("pos"), *[f"x{j}" for j in range(k)])


def conv1d(df: DataFrame, key: str, order: Sequence[str], value_col: str, weights: np.ndarray,
           bias: np.ndarray, padding: int | None = None, stride: int = 1, out_col: str = "out",
           granularity: float = SERIES_BUCKET_SECONDS) -> DataFrame:
    """weights (n_out, k): out[t, o] = sum_d w[o, d] * x[t*stride + d - padding] + b[o], zeros outside and for nulls.

    Output length per key = floor((n + 2p - k) / stride) + 1.
    """
    n_out, k = weights.shape
    pad = k // 2 if padding is None else padding
    d = _taps(df, key, order, value_col, k, stride, pad, granularity)
    x = [F.coalesce(F.col(f"x{j}").cast("double"), F.lit(0.0)) for j in range(k)]
    outs = []
    for o in range(n_out):
        z = x[0] * F.lit(float(weights[o, 0]))
        for j in range(1, k):
            z = z + x[j] * F.lit(float(weights[o, j]))
        outs.append(z + F.lit(float(bias[o])))
    return d.select(key, "pos", F.array(*outs).alias(out_col))


def pool1d(df: DataFrame, key: str, order: Sequence[str], value_col: str, kernel: int = 3, stride: int = 2,
           padding: int = 1, kind: str = "max", out_col: str = "value",
           granularity: float = SERIES_BUCKET_SECONDS) -> DataFrame:
    """Window k, stride s, padding p: out[t] = agg(x[t*s - p .. t*s - p + k - 1]), padding and nulls ignored."""
    d = _taps(df, key, order, value_col, kernel, stride, padding, granularity)
    cells = F.filter(F.array(*[F.col(f"x{j}") for j in range(kernel)]), lambda v: v.isNotNull())
    if kind == "max":
        out = F.array_max(cells)
    else:
        total = F.aggregate(cells, F.lit(0.0), lambda acc, v: acc + v.cast("double"))
        out = F.when(F.size(cells) > 0, total / F.size(cells))
    return d.select(key, "pos", out.alias(out_col))


def wide_pool1d(df: DataFrame, key: str, order: Sequence[str], value_col: str, kernel: int, stride: int = 1,
                padding: int = 0, kind: str = "max", out_col: str = "value",
                granularity: float = SERIES_BUCKET_SECONDS) -> DataFrame:
    """``pool1d`` for windows of any width, in work and plan size that do not grow with ``kernel``.

    The padded series is cut in blocks of ``kernel`` positions. A window is the end of one block and the start of
    the next, so its largest value (or sum and count) is the block's value from the window's first position on, together
    with the next block's up to the window's last one. Two running aggregates give both, and a row sends each to
    the window that begins or ends there: at most two small states a row, grouped by (key, window).
    A group of a running aggregate holds ``kernel`` rows, streamed, whatever share of the rows its key has."""
    if padding > kernel:
        raise ValueError(f"padding {padding} exceeds the window of {kernel}")
    d = positions(df.select(key, *order, value_col), key, order, granularity=granularity, with_length=True)
    d = d.select(key, "_len", F.col("pos"), F.col(value_col).alias("_x"))
    if padding:  # the first and the last row of a series bring the padding beside it
        front = F.when(F.col("pos") == 0, F.sequence(F.lit(-padding), F.lit(-1))).otherwise(F.array().cast("array<int>"))
        tail = F.when(F.col("pos") == F.col("_len") - 1, F.sequence(F.lit(1), F.lit(padding))).otherwise(F.array().cast("array<int>"))
        d = d.select(key, "_len", "pos", "_x", F.explode(F.concat(front, F.array(F.lit(0)), tail)).alias("_t")) \
            .select(key, "_len", (F.col("pos") + F.col("_t")).alias("pos"), F.when(F.col("_t") == 0, F.col("_x")).alias("_x"))
    d = d.select(key, "_len", "_x", (F.col("pos") + padding).alias("_u")).withColumn("_block", F.floor(F.col("_u") / F.lit(kernel)))
    up, down = Window.partitionBy(key, "_block").orderBy("_u"), Window.partitionBy(key, "_block").orderBy(F.desc("_u"))

    def state(w):
        w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if kind == "max":
            return F.struct(F.max("_x").over(w).alias("v"))
        return F.struct(F.sum(F.col("_x").cast("double")).over(w).alias("v"), F.count("_x").over(w).alias("n"))
    d = d.select(key, "_len", "_u", state(up).alias("_up"), state(down).alias("_down"))
    first = F.col("_u") - F.lit(kernel - 1)   # of the window that ends here
    # a window that is a whole block is known from its first row alone
    ends = F.when((first >= 0) & (first % kernel != 0), F.struct(first.alias("s"), F.col("_up").alias("state")))
    begins = F.struct(F.col("_u").alias("s"), F.col("_down").alias("state"))
    sent = d.select(key, "_len", F.explode(F.array(begins, ends)).alias("_w")).filter(F.col("_w").isNotNull())
    s = F.col("_w.s")
    fits = (s % stride == 0) & (s + kernel <= F.col("_len") + 2 * padding)
    sent = sent.filter(fits).select(key, F.floor(s / F.lit(stride)).cast("bigint").alias("pos"), "_w.state.*")
    if kind == "max":
        return sent.groupBy(key, "pos").agg(F.max("v").alias(out_col))
    total = sent.groupBy(key, "pos").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    return total.select(key, "pos", F.when(F.col("n") > 0, F.col("v") / F.col("n")).alias(out_col))


def lstm_params(n_in: int, units: int, n_out: int, seed: int | None = None) -> dict:
    """Parameters of a peephole LSTM + per-step output layer over concat(input, h)."""
    if seed is None:
        from .model import fixed_weight
        ii, jj = np.meshgrid(np.arange(n_in), np.arange(4 * units), indexing="ij")
        Wx = fixed_weight(0, ii, jj)
        ii, jj = np.meshgrid(np.arange(units), np.arange(4 * units), indexing="ij")
        Wh = fixed_weight(1, ii, jj)
        ii, jj = np.meshgrid(np.arange(n_in + units), np.arange(n_out), indexing="ij")
        Wo = fixed_weight(2, ii, jj)
        b = np.zeros(4 * units)
        b[units:2 * units] = 1.0  # forget-gate bias
        return {"Wx": Wx, "Wh": Wh, "b": b, "peep": np.full((3, units), 1 / 64), "Wo": Wo, "bo": np.zeros(n_out)}
    rng = np.random.default_rng(seed)
    s = np.sqrt(2.0 / (n_in + units))
    b = np.zeros(4 * units)
    b[units:2 * units] = 1.0
    return {"Wx": rng.normal(0, s, (n_in, 4 * units)), "Wh": rng.normal(0, s, (units, 4 * units)), "b": b,
            "peep": rng.normal(0, s, (3, units)), "Wo": rng.normal(0, s, (n_in + units, n_out)),
            "bo": np.zeros(n_out)}


def lstm_score(df: DataFrame, key: str, order: Sequence[str], features_col: str, params: dict,
               units: int, out_activation: str = "softmax", keep: Sequence[str] = (),
               num_partitions: int | None = None, out_col: str = "out") -> DataFrame:
    """SCR-10: recurrent layer over each key's ordered steps, then an output layer on [x, h]."""
    keep = [c for c in keep if c not in (key,)]
    n_in = params["Wx"].shape[0]
    parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = list(dict.fromkeys([key, *order, *keep, features_col]))
    src = (df.select(*cols).repartition(parts, key)
           .sortWithinPartitions(key, *order))
    fields = [df.schema[key]] + [df.schema[c] for c in keep] + [
        T.StructField("step", T.LongType()), T.StructField(out_col, T.ArrayType(T.DoubleType()))]
    schema = T.StructType(fields)
    p = {k: np.asarray(v, dtype=float) for k, v in params.items()}

    n_out = p["Wo"].shape[1]

    def run(batches):
        from .scoring import to_list_array, to_matrix
        carry = None  # (key, h, c, next step) of the series that may continue in the next batch
        for rb in batches:
            n = rb.num_rows
            if n == 0:
                continue
            keys = np.asarray(rb.column(key).to_pylist(), dtype=object)
            x = to_matrix(rb.column(features_col), n_in)
            change = np.ones(n, dtype=bool)
            change[1:] = keys[1:] != keys[:-1]
            starts = np.flatnonzero(change)
            lens = np.diff(np.append(starts, n))
            H = np.zeros((len(starts), units))
            C = np.zeros((len(starts), units))
            step0 = np.zeros(len(starts), dtype=np.int64)
            if carry is not None and keys[0] == carry[0]:
                H[0], C[0], step0[0] = carry[1], carry[2], carry[3]
            outs = np.empty((n, n_out))
            steps = np.empty(n, dtype=np.int64)
            # all series of the batch advance one step together (vectorised across keys)
            for t in range(int(lens.max())):
                act = np.flatnonzero(lens > t)
                rows = starts[act] + t
                h, c = K.lstm_step(x[rows], H[act], C[act], p["Wx"], p["Wh"], p["b"], p["peep"])
                H[act], C[act] = h, c
                z = np.concatenate([x[rows], h], axis=1) @ p["Wo"] + p["bo"]
                outs[rows] = K.activate(z, out_activation)
                steps[rows] = step0[act] + t
            carry = (keys[-1], H[-1].copy(), C[-1].copy(), int(step0[-1] + lens[-1]))
            arrays = [rb.column(key)] + [rb.column(k) for k in keep] + [pa.array(steps), to_list_array(outs)]
            yield pa.RecordBatch.from_arrays(arrays, names=[key] + keep + ["step", out_col])

    return src.mapInArrow(run, schema)


def lstm_score_segments(df: DataFrame, key: str, order: Sequence[str], features_col: str, params: dict,
                        units: int, segment: int = 1 << 16, out_activation: str = "softmax", keep: Sequence[str] = (),
                        out_col: str = "out", path: str | None = None, rounds: int | None = None) -> DataFrame:
    """``lstm_score`` by segments of ``segment`` steps: one job scores segment r of all series at once and writes, with the
    outputs, the state (h, c) of each series that ends the segment; the next job starts from those states.

    A key that holds a third of all rows is ``segment`` rows of a job, beside the other keys' rows, and what a lost executor
    costs is its part of one segment. With ``path`` (a folder of the shared storage) a later call goes on after the last
    segment that is written there; ``rounds`` stops a call after so many segments. Steps follow ``positions``."""
    from ..session import path_exists, scratch_path
    from .scoring import to_list_array, to_matrix
    spark = df.sparkSession
    path = path or scratch_path(spark, "lstm-segments")
    keep = [c for c in keep if c != key]
    if not path_exists(spark, f"{path}/series/_SUCCESS"):
        cols = list(dict.fromkeys([key, *order, *keep, features_col]))
        placed = positions(df.select(*cols), key, order, pos_col="step").select(key, *keep, features_col, "step")
        placed = placed.withColumn("_segment", F.floor(F.col("step") / F.lit(segment)).cast("int"))
        placed.repartition("_segment", key).sortWithinPartitions("_segment").write.mode("overwrite").partitionBy("_segment").parquet(f"{path}/series")
    names = [key, *keep, "step", out_col, "state"]
    schema = T.StructType([df.schema[key], *[df.schema[c] for c in keep], T.StructField("step", T.LongType()),
                           T.StructField(out_col, T.ArrayType(T.DoubleType())), T.StructField("state", T.ArrayType(T.DoubleType()))])
    if df.isEmpty():
        return spark.createDataFrame([], schema).drop("state")
    read = T.StructType([df.schema[key], *[df.schema[c] for c in keep], df.schema[features_col],
                         T.StructField("step", T.LongType()), T.StructField("_segment", T.IntegerType())])
    series = spark.read.schema(read).parquet(f"{path}/series")
    p = {k: np.asarray(v, dtype=float) for k, v in params.items()}
    n_in, n_out = p["Wx"].shape[0], p["Wo"].shape[1]

    def run(batches):
        held = {}  # states of series whose next rows are still to come
        for rb in batches:
            if rb.num_rows == 0:
                continue
            last = rb.column(key)[rb.num_rows - 1].as_py()
            given = rb.column("state").is_valid().to_numpy(zero_copy_only=False)
            states = rb.filter(pa.array(given))
            for k, s in zip(states.column(key).to_pylist(), states.column("state").to_pylist()):
                held[k] = (np.array(s[:units]), np.array(s[units:]))
            rb = rb.filter(pa.array(~given))
            n = rb.num_rows
            if n:
                keys = np.asarray([*rb.column(key).to_pylist(), None], dtype=object)[:-1]
                x = to_matrix(rb.column(features_col), n_in)
                change = np.ones(n, dtype=bool)
                change[1:] = keys[1:] != keys[:-1]
                starts = np.flatnonzero(change)
                lens = np.diff(np.append(starts, n))
                zero = (np.zeros(units), np.zeros(units))
                H = np.array([held.get(keys[i], zero)[0] for i in starts])
                C = np.array([held.get(keys[i], zero)[1] for i in starts])
                outs, step = np.empty((n, n_out)), rb.column("step").to_numpy()
                ends, after = (step + 1) % segment == 0, [None] * n
                for t in range(int(lens.max())):
                    act = np.flatnonzero(lens > t)
                    rows = starts[act] + t
                    h, c = K.lstm_step(x[rows], H[act], C[act], p["Wx"], p["Wh"], p["b"], p["peep"])
                    H[act], C[act] = h, c
                    outs[rows] = K.activate(np.concatenate([x[rows], h], axis=1) @ p["Wo"] + p["bo"], out_activation)
                    for j in np.flatnonzero(ends[rows]):
                        after[rows[j]] = [*h[j], *c[j]]
                for i, k in enumerate(keys[starts]):
                    held[k] = (H[i].copy(), C[i].copy())
                yield pa.RecordBatch.from_arrays([rb.column(key), *[rb.column(k) for k in keep], pa.array(step), to_list_array(outs),
                                                  pa.array(after, pa.list_(pa.float64()))], names=names)
            held = {k: v for k, v in held.items() if k == last}  # rows are sorted by key

    n_segments = series.agg(F.max("_segment")).first()[0] + 1
    none = F.lit(None)
    for r in range(n_segments if rounds is None else min(rounds, n_segments)):
        if path_exists(spark, f"{path}/steps/_segment={r}/_SUCCESS"):
            continue
        rows = series.filter(F.col("_segment") == r).drop("_segment").withColumn("state", none.cast("array<double>"))
        if r:
            before = spark.read.schema(schema).parquet(f"{path}/steps/_segment={r - 1}").filter("state is not null")
            rows = rows.unionByName(before.select(key, *[none.cast(df.schema[c].dataType).alias(c) for c in keep],
                                                  none.cast(df.schema[features_col].dataType).alias(features_col), "step", "state"))
        rows.repartition(key).sortWithinPartitions(key, "step").mapInArrow(run, schema).write.mode("overwrite").parquet(f"{path}/steps/_segment={r}")
    return spark.read.schema(schema).parquet(f"{path}/steps").drop("state")


def lstm_reference(xs: np.ndarray, params: dict, units: int, out_activation: str = "softmax") -> np.ndarray:
    """Step-by-step NumPy reference for one series (tests)."""
    h, c = np.zeros((1, units)), np.zeros((1, units))
    outs = []
    for t in range(xs.shape[0]):
        h, c = K.lstm_step(xs[t:t + 1], h, c, params["Wx"], params["Wh"], params["b"], params["peep"])
        z = np.concatenate([xs[t:t + 1], h], axis=1) @ params["Wo"] + params["bo"]
        outs.append(K.activate(z, out_activation)[0])
    return np.array(outs)
