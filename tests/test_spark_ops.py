"""Spark operators: properties, sequences, images, models, training semantics."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF
from layerwise.operators import image_ops, prep, sequence, splits, statistics
from layerwise.operators import training as TR
from layerwise.operators.evaluation import confusion, merge_confusions
from layerwise.operators.model import Net, dense, output
from layerwise.plans import fixtures as fx
from layerwise.session import scratch_path


@settings(max_examples=5, deadline=None)
@given(n=st.integers(min_value=1, max_value=300), a=st.integers(1, 9), seed=st.integers(0, 1000))
def test_weighted_split_exact_disjoint_complete(spark, n, a, seed):
    df = spark.range(n)
    parts = splits.weighted_split(df, "id", [a, 10 - a], seed).toPandas()
    assert sorted(parts["id"]) == list(range(n))
    assert (parts["part"] == 0).sum() == n * a // 10


def test_ranks_equal_python_sort_and_independent_of_partitions(spark):
    df = spark.range(0, 3000, numPartitions=7)
    r1 = {r["id"]: r["pos"] for r in splits.seeded_order(df, "id", 5).collect()}
    r2 = {r["id"]: r["pos"] for r in splits.seeded_order(df.repartition(3), "id", 5).collect()}
    order = sorted(range(3000), key=lambda i: (hashlib.md5(f"5|{i}".encode()).hexdigest(), i))
    assert r1 == r2 == {i: p for p, i in enumerate(order)}


def test_batches_per_worker_cover_all_rows(spark):
    df = spark.range(1000).withColumn("w", (F.col("id") % 3).cast("int"))
    b = splits.assign_batches(df, "id", 16, 1, partition_cols=["w"]).toPandas()  # groups counted
    for w, g in b.groupby("w"):
        counts = g.groupby("batch_id").size()
        assert counts.iloc[:-1].eq(16).all() and counts.iloc[-1] <= 16
        assert counts.sum() == len(g)


def test_stride_sample_overlap_option(spark):
    df = spark.range(100).withColumn("batch_id", (F.col("id") / 10).cast("bigint"))
    no_leak = splits.stride_sample(df, every=3, exclude=True)
    leak = splits.stride_sample(df, every=3, exclude=False)
    assert no_leak.count() == 100
    assert leak.filter("part = 'train'").count() == 100


def test_flip_twice_is_identity_and_resize_identity(spark):
    img = fx.image8(spark, SF)
    twice = img.select("px", prep.flip_horizontal(prep.flip_horizontal("px", 1, 8, 8), 1, 8, 8).alias("f"))
    assert twice.filter(F.col("px") != F.col("f")).count() == 0
    same = img.select(F.transform("px", lambda p: p.cast("double")).alias("px"),
                      prep.resize("px", 1, 8, 8, 8, 8).alias("r"))
    assert same.filter(F.col("px") != F.col("r")).count() == 0


def test_strict_label_check_raises(spark):
    df = spark.createDataFrame([(0,), (13,)], "label int")
    with pytest.raises(Exception):
        prep.check_labels(df, "label", 13, strict=True).collect()


def test_confusion_total_and_merge(spark):
    df = spark.range(500).select((F.col("id") % 4).alias("label"), (F.col("id") % 3).alias("pred"), "id")
    whole = confusion(df, 4).toPandas()
    assert whole["n"].sum() == 500 and len(whole) == 16
    halves = merge_confusions([confusion(df.filter("id < 200"), 4), confusion(df.filter("id >= 200"), 4)])
    merged = halves.toPandas().sort_values(["actual", "predicted"]).reset_index(drop=True)
    assert merged["n"].tolist() == whole.sort_values(["actual", "predicted"])["n"].tolist()


def test_lstm_on_spark_matches_step_by_step(spark):
    s = fx.user_series(spark, SF)
    params = sequence.lstm_params(5, 5, 5)
    out = sequence.lstm_score(s, "user_id", ["ts", "event_id"], "features", params, 5, keep=["event_id"],
                              num_partitions=3).toPandas()
    pdf = s.toPandas().sort_values(["user_id", "ts", "event_id"])
    for uid, g in list(pdf.groupby("user_id"))[:5]:
        ref = sequence.lstm_reference(np.stack(g["features"].to_numpy()), params, 5)
        got = np.stack(out[out.user_id == uid].sort_values("step")["out"].to_numpy())
        assert np.allclose(ref, got)


def test_lstm_state_crosses_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        s = fx.user_series(spark, SF)
        params = sequence.lstm_params(5, 5, 5)
        out = sequence.lstm_score(s, "user_id", ["ts", "event_id"], "features", params, 5, num_partitions=2)
        pdf = s.toPandas().sort_values(["user_id", "ts", "event_id"])
        uid, g = next(iter(pdf.groupby("user_id")))
        ref = sequence.lstm_reference(np.stack(g["features"].to_numpy()), params, 5)
        got = np.stack(out.filter(F.col("user_id") == uid).toPandas().sort_values("step")["out"].to_numpy())
        assert np.allclose(ref, got)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_lstm_segments_equal_the_whole_and_go_on_after_a_stop(spark):
    import os
    from layerwise.session import local_fs_path, scratch_path
    s = fx.user_series(spark, SF).withColumn("user_id", F.when(F.col("user_id") % 5 != 0, F.col("user_id")))
    params, path = sequence.lstm_params(5, 5, 5), scratch_path(spark, "segments-test")
    args = (s, "user_id", ["ts", "event_id"], "features", params, 5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        want = {r.event_id: (r.step, r.out) for r in sequence.lstm_score(*args, keep=["event_id"]).collect()}
        part = sequence.lstm_score_segments(*args, segment=20, keep=["event_id"], path=path, rounds=2).collect()
        assert {r.step for r in part} == set(range(40))
        first = f"{local_fs_path(path)}/steps/_segment=0"
        files = sorted(os.listdir(first))
        got = {r.event_id: (r.step, r.out) for r in sequence.lstm_score_segments(*args, segment=20, keep=["event_id"], path=path).collect()}
        assert sorted(os.listdir(first)) == files  # what was written is not scored again
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and np.allclose(got[k][1], want[k][1]) for k in want)
    assert sequence.lstm_score_segments(s.limit(0), *args[1:]).count() == 0


@pytest.mark.parametrize("shape,tile,out_tile,kernel,stride,padding,mode", [
    ((2, 7, 5), (3, 2), (2, 3), (3, 3), (1, 1), (1, 1), "truncate"), ((1, 9, 9), (2, 2), (1, 4), (2, 2), (3, 3), (0, 0), "truncate"),
    ((3, 6, 8), (4, 8), None, (5, 3), (2, 1), (0, 0), "same")])
def test_tiled_layers_equal_whole_images(spark, shape, tile, out_tile, kernel, stride, padding, mode):
    from layerwise.operators import image_ops, image_tiles
    c, h, w = shape
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=c * h * w).tolist()) for i in range(3)] + [(None, rng.normal(size=c * h * w).tolist()), (9, None)]
    df = spark.createDataFrame(rows, "id long, px array<double>")
    weights, bias = rng.normal(size=(2, c, *kernel)), rng.normal(size=2)
    tiles = image_tiles.cut_tiles(df, "id", "px", image_tiles.Grid(*shape, *tile))
    for (got, grid), want in (
            (image_tiles.conv2d_tiles(tiles, "id", image_tiles.Grid(*shape, *tile), weights, bias, stride, padding, mode, out_tile),
             image_ops.conv2d("px", c, h, w, weights, bias, stride, padding, mode)),
            (image_tiles.pool2d_tiles(tiles, "id", image_tiles.Grid(*shape, *tile), kernel, stride, padding, mode, "max", out_tile),
             image_ops.pool2d("px", c, h, w, kernel, stride, padding, mode))):
        found = {(r.id, r.i): r.value for r in image_tiles.tile_values(got, "id", grid).collect()}
        whole = {(r.id, i): v for r in df.select("id", want.alias("o")).collect() if r.o is not None for i, v in enumerate(r.o)}
        assert found.keys() == whole.keys()
        assert all(np.isclose(found[k], whole[k]) for k in whole)


def _numpy_averaging(x, y, ids, seed, W, b, F_, updater, n_params_net, spec=None):
    """Independent NumPy simulation of the averaging semantics (survey 7.4)."""
    keyed = [(hashlib.md5(f"{seed}|{i}".encode()).hexdigest(), i, r) for r, i in enumerate(ids)]
    workers = {}
    for k, i, r in sorted(keyed):
        workers.setdefault(int(k[:8], 16) % W, []).append(r)
    batches = {w: [rows[j:j + b] for j in range(0, len(rows), b)] for w, rows in workers.items()}
    net = n_params_net.copy()
    keys = net.param_keys()
    w_vec = net.flat()
    s_vec = np.zeros(updater.state_size(w_vec.size))
    spec = spec or TR.FitSpec(workers=W, batch=b, frequency=F_, updater=updater, seed=seed, l2=1e-4)
    it = 0
    rnd = 0
    while True:
        voters = []
        nbs = 0
        for w, bl in batches.items():
            mine = bl[rnd * F_:(rnd + 1) * F_]
            if not mine:
                continue
            ww, ss = w_vec.copy(), s_vec.copy()
            for bi, rows in enumerate(mine):
                ww, ss, _ = TR._worker_step(net, spec, ww, ss, keys, {"input": x[rows]},
                                            {net.outputs[0]: TR._onehot(y[rows], 10)}, it + bi, ids[rows])
            voters.append(np.concatenate([ww, ss]))
            nbs = max(nbs, len(mine))
        if not voters:
            break
        avg = np.mean(voters, axis=0)
        w_vec, s_vec = avg[:w_vec.size], avg[w_vec.size:]
        it += nbs
        rnd += 1
    return net.set_flat(w_vec)


@pytest.mark.parametrize("W,F_,kind", [(1, 1, "sgd"), (3, 2, "nesterovs"), (2, 3, "rmsprop")])
def test_fit_averaging_matches_numpy_simulation(spark, W, F_, kind):
    v = fx.vectors64(spark, SF)
    pdf = v.toPandas()
    x = np.stack(pdf["features"].to_numpy())
    y = pdf["label"].to_numpy()
    ids = pdf["id"].to_numpy()
    net0 = Net.sequential((64,), [dense(8, "leakyrelu"), output(10, "softmax", "nll")]).init(seed=3)
    upd = TR.Updater(kind, lr=0.05)
    spec = TR.FitSpec(workers=W, batch=16, frequency=F_, epochs=1, seed=11, updater=upd, l2=1e-4)
    got, metrics, _ = TR.fit_averaging(v, net0, "id", "features", "label", 10, spec)
    ref = _numpy_averaging(x, y, ids, 11, W, 16, F_, TR.Updater(kind, lr=0.05), net0)
    assert np.allclose(got.flat(), ref.flat(), atol=1e-9)
    assert metrics.count() > 0


def test_epochs_reduce_the_score(spark):
    v = fx.vectors64(spark, SF)
    net0 = Net.sequential((64,), [output(10, "softmax", "nll")]).init(scheme="zero")
    spec = TR.FitSpec(workers=2, batch=32, frequency=2, epochs=3, seed=1, updater=TR.Updater("sgd", lr=0.5))
    _, metrics, _ = TR.fit_averaging(v, net0, "id", "features", "label", 10, spec)
    m = metrics.toPandas()
    first = m[m.epoch == 0]["score"].iloc[0]
    last = m[m.epoch == 2]["score"].iloc[-1]
    assert last < first


def test_model_round_trip_with_updater_state(spark):
    from layerwise.sources.model_store import read_model, write_model
    net = Net.sequential((64,), [dense(16, "leakyrelu"), output(10, "softmax", "nll")]).init(seed=4)
    state = np.arange(net.n_params(), dtype=float)
    path = scratch_path(spark, "model-test")
    write_model(spark, net, path, state=state)
    back, st2 = read_model(spark, path, with_state=True)
    assert np.array_equal(back.flat(), net.flat())
    assert np.array_equal(st2, state)


def test_init_moments():
    net = Net.sequential((200,), [dense(300, "relu")]).init(seed=0, scheme="xavier")
    w = net.params[("0", "W")]
    assert abs(w.mean()) < 1e-3
    assert abs(w.std() - np.sqrt(2 / 500)) < 2e-3
    tn = Net.sequential((200,), [dense(300, "relu")]).init(seed=0, scheme="truncated_normal", std=0.5)
    assert np.abs(tn.params[("0", "W")]).max() <= 1.0


def test_schedules():
    assert TR.schedule_rate({"type": "step", "decay": 0.1, "step": 100}, 0.01, 250) == pytest.approx(1e-4)
    m = {"type": "map", "values": {0: 0.01, 1000: 0.005, 3000: 0.001}}
    assert [TR.schedule_rate(m, 0.01, i) for i in (0, 999, 1000, 5000)] == [0.01, 0.01, 0.005, 0.001]


def test_scaling_fit_and_image_scale(spark):
    t = spark.createDataFrame([(1.0,), (3.0,), (5.0,)], "x double")
    stats = prep.fit_range(t, ["x"])
    out = [r[0] for r in prep.apply_range(t, stats, 0, 1).select("x_scaled").collect()]
    assert out == [0.0, 0.5, 1.0]


def test_fit_averaging_shared_storage_path_equals_co_located(spark):
    """Large round tables take the grouped path; both paths give the same parameters."""
    v = fx.vectors64(spark, SF)
    net0 = Net.sequential((64,), [output(10, "softmax", "nll")]).init(scheme="zero")
    spec = TR.FitSpec(workers=3, batch=16, frequency=2, epochs=1, seed=5, updater=TR.Updater("nesterovs", lr=0.1))
    a, _, _ = TR.fit_averaging(v, net0, "id", "features", "label", 10, spec)
    spark.conf.set("spark.layerwise.cacheRoundsBytes", "0")
    try:
        b, _, _ = TR.fit_averaging(v, net0, "id", "features", "label", 10, spec)
    finally:
        spark.conf.unset("spark.layerwise.cacheRoundsBytes")
    assert np.allclose(a.flat(), b.flat(), atol=1e-12)


def test_blocked_product_equals_mapinarrow_scoring(spark):
    from layerwise.operators.scoring import dense_blocked, score
    v = fx.vectors64(spark, SF)
    net = Net.sequential((64,), [dense(10, "identity")]).fixed_init()
    a = {r["id"]: r["out"] for r in score(v, net, "features", keep=["id"]).collect()}
    W = net.params[("0", "W")]
    wdf = spark.createDataFrame([(i, j, float(W[i, j])) for i in range(64) for j in range(10)], "i int, j int, w double")
    bdf = spark.createDataFrame([(j, float(x)) for j, x in enumerate(net.params[("0", "b")])], "j int, b double")
    for inner, cols, blocks in ((512, 512, 3), (13, 4, 2), (65, 10, 1), (64, 1, None)):
        b = {r["id"]: r["z"] for r in dense_blocked(v, "id", "features", wdf, bdf, 64, 10, inner=inner, cols=cols, row_blocks=blocks).collect()}
        assert a.keys() == b.keys()
        assert all(np.allclose(a[k], b[k]) for k in a)


def test_blocked_product_of_null_features_missing_weights_and_no_rows(spark):
    from layerwise.operators.scoring import dense_blocked
    x = spark.createDataFrame([("a", [1.0, 2.0, 3.0]), ("b", None)], "id string, f array<double>")
    W = spark.createDataFrame([(0, 0, 2.0), (2, 1, -1.0)], "i int, j int, w double")
    b = spark.createDataFrame([(1, 0.5)], "j int, b double")
    got = {r.id: r.z for r in dense_blocked(x, "id", "f", W, b, 3, 4, inner=2, cols=2, row_blocks=2).collect()}
    assert got == {"a": [2.0, -2.5, 0.0, 0.0], "b": None}
    assert dense_blocked(x.limit(0), "id", "f", W, b, 3, 4).count() == 0


def test_channel_moments_in_one_pass_are_stable(spark):
    from layerwise.operators.scoring import channel_moments
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 2, 6)) + np.array([1e8, -3.0])[None, :, None]
    df = spark.createDataFrame([(r.ravel().tolist(), r[0].tolist()) for r in x], "px array<double>, one array<double>").repartition(7)
    (mean, var), (mean1, var1) = channel_moments(df, [("px", 2, 6), ("one", 1, 6)])
    assert np.allclose(mean, x.mean(axis=(0, 2)), rtol=1e-12) and np.allclose(var, x.var(axis=(0, 2)), rtol=1e-6)
    assert np.isclose(mean1[0], mean[0]) and np.isclose(var1[0], var[0])


def test_large_model_goes_by_broadcast_and_size_bound_is_enforced(spark):
    from layerwise.operators.scoring import score
    v = fx.vectors64(spark, SF)
    big = Net.sequential((64,), [dense(4096, "relu"), output(10, "softmax", "nll")]).init(seed=1)
    assert big.nbytes() > 1 << 20
    out = score(v, big, "features", keep=["id"]).first()["out"]
    assert abs(sum(out) - 1.0) < 1e-9
    spark.conf.set("spark.layerwise.maxModelBytes", str(1 << 20))
    try:
        with pytest.raises(ValueError):
            score(v, big, "features", keep=["id"])
    finally:
        spark.conf.unset("spark.layerwise.maxModelBytes")


@pytest.mark.parametrize("program", ["people_mlp", "digits_mlp", "animals_mlp", "image_lenet"])
def test_programs_run_end_to_end(spark, program):
    from layerwise.plans import programs
    from layerwise.operators.evaluation import summary
    kwargs = {"epochs": 1} if program != "animals_mlp" else {"epochs": 1, "workers": 64}
    net, metrics, conf = getattr(programs, program)(spark, SF, **kwargs)
    s = summary(conf).first()
    assert s["total"] > 0 and 0.0 <= s["accuracy"] <= 1.0
    assert metrics.count() > 0


def test_series_ops_with_a_hot_key_match_brute_force(spark):
    """One user holds a third of all rows; positions, conv1d and pool1d stay exact."""
    ev = fx.table(spark, SF, "events").select(
        F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("user_id"),
        "ts", "event_id", fx.quantise(F.col("value")).alias("value"))
    w = np.array([[0.25, -0.5, 0.125], [0.0625, 0.75, -0.25]])
    b = np.array([0.5, -0.125])
    conv = {(r["user_id"], r["pos"]): r["out"] for r in
            sequence.conv1d(ev, "user_id", ["ts", "event_id"], "value", w, b, padding=1, granularity=600).collect()}
    pool = {(r["user_id"], r["pos"]): r["value"] for r in
            sequence.pool1d(ev, "user_id", ["ts", "event_id"], "value", 3, 2, 1, "max", granularity=600).collect()}
    pdf = ev.toPandas().sort_values(["user_id", "ts", "event_id"])
    n_conv = n_pool = 0
    for uid, g in pdf.groupby("user_id"):
        x = g["value"].to_numpy()
        xp = np.concatenate([[0.0], x, [0.0]])
        for t in range(len(x)):
            ref = w @ xp[t:t + 3] + b
            assert np.allclose(conv[(uid, t)], ref)
            n_conv += 1
        for t in range((len(x) + 2 - 3) // 2 + 1):
            lo, hi = max(0, 2 * t - 1), min(len(x), 2 * t + 2)
            assert pool[(uid, t)] == x[lo:hi].max()
            n_pool += 1
    assert n_conv == len(conv) and n_pool == len(pool)


def test_scoring_applies_unchanged_to_a_streaming_frame(spark, tmp_path):
    """The streaming package's note: scoring is a mapInArrow job, so a readStream frame works."""
    from layerwise.operators.scoring import score
    from layerwise.plans.queries_scoring import scorer_net
    v = fx.vectors64(spark, SF)
    src = str(tmp_path / "emb")
    spark.read.parquet(f"{SF}/embeddings.parquet").write.parquet(src)  # a folder the stream can watch
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    feats = stream.select(F.col("vec_id").alias("id"),
                          F.transform("embedding", lambda e: fx.quantise(e)).alias("features"))
    q = (score(feats, scorer_net(), "features", keep=["id"]).writeStream.format("memory")
         .queryName("scored_stream").option("checkpointLocation", str(tmp_path / "ck")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r["id"]: r["out"] for r in spark.sql("SELECT * FROM scored_stream").collect()}
    ref = {r["id"]: r["out"] for r in score(v, scorer_net(), "features", keep=["id"]).collect()}
    assert got.keys() == ref.keys()
    assert all(np.allclose(got[k], ref[k]) for k in ref)


def test_gradient_is_independent_of_partitioning(spark):
    """16 partitions take the two-level chunk reduction; 1 partition the single level."""
    v = fx.vectors64(spark, SF)
    net = Net.sequential((64,), [dense(300, "relu"), output(10, "softmax", "nll")]).init(seed=2)  # > 1 chunk
    g1, s1, n1 = TR.gradient(v.repartition(1), net, "features", "label", 10)
    g16, s16, n16 = TR.gradient(v.repartition(16), net, "features", "label", 10)
    assert n1 == n16 == v.count()
    assert abs(s1 - s16) < 1e-9
    for k in g1:
        assert np.allclose(g1[k], g16[k], atol=1e-12)


def test_summary_leaves_out_classes_without_predictions(spark):
    from layerwise.operators.evaluation import class_metrics, summary
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 2)], "label int, pred int")
    conf = confusion(df, 3)
    per = {r["cls"]: r for r in class_metrics(conf).collect()}
    assert per[1]["precision"] is None and per[1]["recall"] == 0.0
    s = summary(conf).first()
    assert s["total"] == 4 and s["correct"] == 3
    assert s["macro_precision"] == pytest.approx((2 / 3 + 1.0) / 2)


def test_metrics_every_n_rounds(spark):
    v = fx.vectors64(spark, SF)
    net0 = Net.sequential((64,), [output(10, "softmax", "nll")]).init(scheme="zero")
    spec = TR.FitSpec(workers=2, batch=16, frequency=1, epochs=1, seed=3, score_every=3)
    _, every, _ = TR.fit_averaging(v, net0, "id", "features", "label", 10, spec)
    spec.score_every = 1
    _, all_rounds, _ = TR.fit_averaging(v, net0, "id", "features", "label", 10, spec)
    n = all_rounds.count()
    assert every.count() == len({r for r in range(n) if r % 3 == 0} | {n - 1})


def test_collate_batches_keeps_every_row_once(spark):
    o = fx.table(spark, SF, "orders").select("o_orderkey", "o_totalprice")
    b = splits.assign_batches(o, "o_orderkey", 64, 1)
    col = splits.collate_batches(b, "batch_id", ["o_orderkey", "o_totalprice"]).toPandas()
    keys = [r["o_orderkey"] for rows in col["rows"] for r in rows]
    assert sorted(keys) == sorted(r[0] for r in o.collect())
    assert max(len(rows) for rows in col["rows"]) == 64


def test_ranks_and_split_with_a_heavily_repeated_id(spark):
    """A third of the rows share one id: ranks stay a permutation in (md5, id) order, split sizes stay exact."""
    n = 3000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                               F.col("id").alias("payload"))
    spark.conf.set("spark.layerwise.hotRows", "64")
    try:
        r = splits.ranked(df, "k", 5, rank_col="r").toPandas()
        parts = splits.weighted_split(df, "k", [7, 3], 5).toPandas()
        plan = splits.ranked(df, "k", 5, rank_col="r")._jdf.queryExecution().executedPlan().toString()
        units = splits._rank_units(df, "k", 5, [], None)
        sizes = units.groupBy(F.col("k") == 7, *splits.UNIT).count().toPandas()
    finally:
        spark.conf.unset("spark.layerwise.hotRows")
    assert sorted(r["r"]) == list(range(n))
    r["key"] = [hashlib.md5(f"5|{k}".encode()).hexdigest() for k in r["k"]]
    ordered = r.sort_values("r")
    keys = list(zip(ordered["key"], ordered["k"]))
    assert keys == sorted(keys)
    assert (parts["part"] == 0).sum() == n * 7 // 10 and len(parts) == n
    parts["key"] = [hashlib.md5(f"5|{k}".encode()).hexdigest() for k in parts["k"]]
    top = max(zip(parts[parts.part == 0]["key"], parts[parts.part == 0]["k"]))
    bottom = min(zip(parts[parts.part == 1]["key"], parts[parts.part == 1]["k"]))
    assert top <= bottom
    assert "Window" in plan
    tie_units = sizes[sizes["(k = 7)"]]
    assert len(tie_units) > 1 and sizes["count"].max() <= 64  # the tie group was split


def test_series_positions_narrow_buckets_for_a_burst(spark):
    """All rows in one huge time bucket: buckets are narrowed until no cell exceeds hotRows."""
    ev = fx.table(spark, SF, "events").select(F.lit(1).alias("user_id"), "ts", "event_id")
    spark.conf.set("spark.layerwise.hotRows", "50")
    try:
        pos = sequence.positions(ev, "user_id", ["ts", "event_id"], granularity=1e9).toPandas()
    finally:
        spark.conf.unset("spark.layerwise.hotRows")
    ref = ev.toPandas().sort_values(["ts", "event_id"]).reset_index(drop=True)
    got = pos.sort_values("pos").reset_index(drop=True)
    assert got["pos"].tolist() == list(range(len(ref)))
    assert got["event_id"].tolist() == ref["event_id"].tolist()


def test_fit_batchnorm_layers_normalises_each_channel(spark):
    from layerwise.operators.model import Vertex, batchnorm_layer, conv2d
    from layerwise.operators.scoring import fit_batchnorm_layers, score
    v = fx.vectors64(spark, SF)
    vs = [Vertex("c1", "layer", ["input"], conv2d(3, (3, 3), mode="same")),
          Vertex("b1", "layer", ["c1"], batchnorm_layer())]
    net = Net({"input": (4, 4, 4)}, vs, ["b1"]).init(seed=1)
    fitted = fit_batchnorm_layers(v, net, "features")
    out = np.stack(score(v, fitted, "features").toPandas()["out"].to_numpy()).reshape(-1, 3, 16)
    per_channel = out.transpose(1, 0, 2).reshape(3, -1)
    assert np.allclose(per_channel.mean(axis=1), 0.0, atol=1e-9)
    fitted_var = fitted.params[("b1", "var")]
    assert np.allclose(per_channel.var(axis=1), fitted_var / (fitted_var + 1e-5), atol=1e-9)


def test_graph_model_round_trip(spark):
    from layerwise.plans.queries_scoring import conv_block_net, two_input_net
    from layerwise.sources.model_store import read_model, write_model
    for net in (conv_block_net(), two_input_net()):
        path = scratch_path(spark, "graph-model")
        write_model(spark, net, path)
        back = read_model(spark, path)
        assert [v.name for v in back.vertices] == [v.name for v in net.vertices]
        assert [v.op for v in back.vertices] == [v.op for v in net.vertices]
        assert back.outputs == net.outputs and back.inputs == net.inputs
        assert np.array_equal(back.flat(), net.flat())
        rng = np.random.default_rng(0)
        feeds = {k: rng.normal(size=(3, int(np.prod(s)))) for k, s in net.inputs.items()}
        a, b = net.predict_proba(feeds), back.predict_proba(feeds)
        assert all(np.allclose(a[o], b[o]) for o in net.outputs)


def test_init_table_moments_and_sql_twin(spark, duck):
    w = TR.init_table(spark, 200, 300, seed=9).toPandas()
    assert len(w) == 60000
    assert abs(w["w"].mean()) < 2e-3 and abs(w["w"].std() - np.sqrt(2 / 500)) < 2e-3
    sql = """SELECT (id // 300)::INTEGER AS i, (id % 300)::INTEGER AS j,
                    sqrt(-2 * ln(greatest(('0x' || substr(md5(concat_ws('|', '9', '0', id::VARCHAR, '0')), 1, 8))::BIGINT
                                          / 4294967296.0, 1e-12)))
                    * cos(2 * pi() * ('0x' || substr(md5(concat_ws('|', '9', '0', id::VARCHAR, '1')), 1, 8))::BIGINT
                          / 4294967296.0) * sqrt(2.0 / 500) AS w FROM range(60000) t(id)"""
    d = duck.execute(sql).df().sort_values(["i", "j"]).reset_index(drop=True)
    s = w.sort_values(["i", "j"]).reset_index(drop=True)
    assert np.allclose(d["w"], s["w"], atol=1e-12)


def test_confusion_wide_and_string_indexer_cross_check(spark):
    from pyspark.ml.feature import StringIndexer
    from layerwise.operators.evaluation import confusion_wide
    df = spark.range(300).select((F.col("id") % 3).alias("label"), (F.col("id") % 2).alias("pred"))
    wide = confusion_wide(confusion(df, 3), 3).toPandas()
    assert wide.shape == (3, 4) and int(wide[["0", "1", "2"]].to_numpy().sum()) == 300
    c = fx.table(spark, SF, "customer").select("c_custkey", "c_mktsegment")
    ours = {r["c_custkey"]: r["label"] for r in prep.index_labels(c, "c_mktsegment").collect()}
    model = StringIndexer(inputCol="c_mktsegment", outputCol="ix", stringOrderType="alphabetAsc").fit(c)
    theirs = {r["c_custkey"]: int(r["ix"]) for r in model.transform(c).collect()}
    assert ours == theirs


def test_fit_with_a_broadcast_sized_model(spark):
    """Parameters above the closure size go by broadcast, released after each round."""
    v = fx.vectors64(spark, SF)
    net0 = Net.sequential((64,), [dense(2100, "relu"), output(10, "softmax", "nll")]).init(seed=4)
    assert net0.nbytes() > 1 << 20
    spec = TR.FitSpec(workers=2, batch=64, frequency=2, epochs=1, seed=1, updater=TR.Updater("sgd", lr=0.01))
    net, metrics, _ = TR.fit_averaging(v, net0, "id", "features", "label", 10, spec)
    assert metrics.count() > 0 and not np.allclose(net.flat(), net0.flat())


def test_null_feature_arrays_raise_a_clear_error(spark):
    from layerwise.operators.scoring import score
    df = spark.createDataFrame([(1, [0.5, 0.25]), (2, None)], "id long, features array<double>")
    net = Net.sequential((2,), [dense(3, "identity")]).fixed_init()
    with pytest.raises(Exception, match="null feature arrays"):
        score(df, net, "features", keep=["id"]).collect()


def test_training_dropout_mask_equals_the_column_mask(spark):
    v = fx.vectors64(spark, SF).limit(40)
    spark_mask = {r["id"]: r["d"] for r in v.select("id", TR.dropout_expr("features", "id", 11, 3, "0", 0.5)
                                                        .alias("d")).collect()}
    pdf = v.toPandas()
    x = np.stack(pdf["features"].to_numpy())
    m = TR.dropout_mask(11, 3, pdf["id"].to_numpy(), "0", x.shape, 0.5)
    for row, i in enumerate(pdf["id"]):
        assert np.allclose(np.asarray(spark_mask[i]), x[row] * m[row] / 0.5)


def test_fit_with_dropout_matches_numpy_simulation(spark):
    v = fx.vectors64(spark, SF)
    pdf = v.toPandas()
    x, y, ids = np.stack(pdf["features"].to_numpy()), pdf["label"].to_numpy(), pdf["id"].to_numpy()
    net0 = Net.sequential((64,), [dense(8, "relu", keep=0.5), output(10, "softmax", "nll")]).init(seed=5)
    spec = TR.FitSpec(workers=2, batch=16, frequency=2, epochs=1, seed=11, updater=TR.Updater("sgd", lr=0.05), l2=1e-4)
    got, _, _ = TR.fit_averaging(v, net0, "id", "features", "label", 10, spec)
    ref = _numpy_averaging(x, y, ids, 11, 2, 16, 2, TR.Updater("sgd", lr=0.05), net0)
    assert np.allclose(got.flat(), ref.flat(), atol=1e-9)


def test_fit_options_match_numpy_simulation(spark):
    """Renormalised gradients, step schedule, separate bias rate and L1 inside the averaging fit."""
    v = fx.vectors64(spark, SF)
    pdf = v.toPandas()
    x, y, ids = np.stack(pdf["features"].to_numpy()), pdf["label"].to_numpy(), pdf["id"].to_numpy()
    net0 = Net.sequential((64,), [dense(8, "tanh"), output(10, "softmax", "nll")]).init(seed=8)
    upd = TR.Updater("nesterovs", lr=0.05, momentum=0.9, bias_lr=0.1,
                     schedule={"type": "step", "decay": 0.5, "step": 3})
    spec = TR.FitSpec(workers=3, batch=16, frequency=2, epochs=1, seed=13, updater=upd, l1=1e-3, l2=1e-4,
                      renorm_l2=True)
    got, _, _ = TR.fit_averaging(v, net0, "id", "features", "label", 10, spec)
    ref = _numpy_averaging(x, y, ids, 13, 3, 16, 2, upd, net0, spec=spec)
    assert np.allclose(got.flat(), ref.flat(), atol=1e-9)


def test_driver_side_tables_work_without_arrow(spark):
    """Sessions without spark.sql.execution.arrow.pyspark.enabled (the Spark default)."""
    import __spark_entry__ as entry
    from layerwise.sources.model_store import read_model, write_model
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    try:
        assert entry.entry(spark).count() == 100
        parts = splits.weighted_split(fx.table(spark, SF, "orders").select("o_orderkey"), "o_orderkey", [7, 3], 1)
        assert parts.count() == fx.table(spark, SF, "orders").count()
        df = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("k"))
        spark.conf.set("spark.layerwise.hotRows", "32")
        assert sorted(r[0] for r in splits.ranked(df, "k", 2, rank_col="r").select("r").collect()) == list(range(900))
        spark.conf.unset("spark.layerwise.hotRows")
        net = Net.sequential((64,), [dense(4, "relu"), output(10, "softmax", "nll")]).init(seed=1)
        path = scratch_path(spark, "noarrow-model")
        write_model(spark, net, path, state=np.ones(net.n_params()))
        back, st = read_model(spark, path, with_state=True)
        assert np.array_equal(back.flat(), net.flat()) and np.array_equal(st, np.ones(net.n_params()))
        spec = TR.FitSpec(workers=2, batch=32, frequency=2, epochs=1, seed=1)
        _, metrics, _ = TR.fit_averaging(fx.vectors64(spark, SF), net, "id", "features", "label", 10, spec)
        assert metrics.count() > 0
    finally:
        spark.conf.unset("spark.layerwise.hotRows")
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")


# ---------------------------------------------------------------- nulls, many groups, strict inputs

def test_ranked_many_groups_and_a_null_group(spark):
    df = spark.range(70_000).select(F.col("id"), F.when(F.col("id") < 69_000, F.col("id")).alias("grp"))
    got = splits.ranked(df, "id", 5, partition_cols=["grp"])
    assert got.count() == 70_000
    assert got.filter("grp is not null and rank <> 0").count() == 0
    null = [r["rank"] for r in got.filter("grp is null").select("rank").collect()]
    assert sorted(null) == list(range(1000))


def test_positions_keep_null_orders_and_keys(spark):
    rows = [("a", None, 1.0), ("a", 10, 2.0), ("a", 12, 3.0), (None, 5, 4.0), (None, None, 5.0)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    got = {(r["k"], r["t"]): r["pos"] for r in sequence.positions(df, "k", ["t"]).collect()}
    assert got == {("a", None): 0, ("a", 10): 1, ("a", 12): 2, (None, None): 0, (None, 5): 1}


def test_fits_refuse_bad_labels(spark):
    net = Net.sequential((2,), [output(3, "softmax", "nll")]).init(seed=1)
    for bad in (-1, 3, None):
        df = spark.createDataFrame([(1, [0.1, 0.2], 0), (2, [0.3, 0.4], bad)], "id long, x array<double>, label int")
        with pytest.raises(Exception, match="label outside"):
            TR.gradient(df, net, "x", "label", 3)
        with pytest.raises(Exception, match="label outside"):
            TR.fit_averaging(df, net, "id", "x", "label", 3, TR.FitSpec(workers=1, batch=2))


def test_resize_reads_its_own_shape_or_raises(spark):
    df = spark.createDataFrame([(1, list(range(16)))], "id long, px array<int>")
    with pytest.raises(Exception, match="16 values where 4"):
        df.select(prep.resize("px", 1, 2, 2, 1, 1)).collect()
    assert df.select(prep.resize("px", 1, 4, 4, 1, 1).alias("r")).first()["r"] == [7.5]
    big = spark.range(2).select(F.sequence(F.lit(0), F.lit(3 * 32 * 48 - 1)).alias("px"))
    out = big.select(prep.resize("px", 3, 32, 48, 224, 224).alias("r")).first()["r"]
    assert len(out) == 3 * 224 * 224 and out[0] == 0.0 and out[-1] == 3 * 32 * 48 - 1


def test_align_channels(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [1, 2, 9, 9]), (3, [1, 2, 3, 4, 5, 6]), (4, [1, 2, 3, 4, 5, 6, 9, 9])], "c int, px array<int>")
    rgb = {r["c"]: r["p"] for r in df.select("c", prep.align_channels("px", "c", 1, 2, 3).alias("p")).collect()}
    assert rgb == {1: [1, 2] * 3, 2: [1, 2] * 3, 3: [1, 2, 3, 4, 5, 6], 4: [1, 2, 3, 4, 5, 6]}
    grey = {r["c"]: r["p"] for r in df.select("c", prep.align_channels("px", "c", 1, 2, 1).alias("p")).collect()}
    assert grey == {1: [1, 2], 2: [1, 2], 3: [3, 4], 4: [3, 4]}


def test_undecodable_images_are_kept_or_fail(spark, tmp_path):
    import numpy as np

    from layerwise.sources.images import invalid_images, png_bytes, scan_images
    (tmp_path / "cats").mkdir()
    (tmp_path / "cats" / "a.png").write_bytes(png_bytes(np.zeros((2, 2), dtype=np.uint8)))
    (tmp_path / "cats" / "b.png").write_bytes(b"no image")
    kept = scan_images(spark, str(tmp_path), invalid="keep", channels=3)
    assert sorted((r["h"], None if r["px"] is None else len(r["px"])) for r in kept.collect()) == [(-1, None), (2, 12)]
    assert [tuple(r) for r in invalid_images(kept).collect()] == [("cats", 1)]
    with pytest.raises(Exception, match="not an image"):
        scan_images(spark, str(tmp_path)).collect()


def test_split_by_path_opens_only_the_files_of_a_part(spark, tmp_path):
    from layerwise.sources.images import png_bytes, scan_images, split_images
    root = tmp_path / "set one"
    for i in range(40):
        d = root / f"c{i % 3}"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"{i}.png").write_bytes(png_bytes(np.full((2, 2), i)))
    (root / "c0" / "notes.txt").write_text("no image")
    names = lambda df: sorted(r.origin.rsplit("/", 1)[1] for r in df.collect())
    a, b = split_images(spark, str(root), [7, 3], seed=3)
    assert len(names(a)) == 28 and len(names(b)) == 12 and sorted(names(a) + names(b)) == names(scan_images(spark, str(root)))
    victim = names(b)[0]
    (root / f"c{int(victim[:-4]) % 3}" / victim).write_bytes(b"broken")  # b holds a file that does not decode
    a, b = split_images(spark, str(root), [7, 3], seed=3)
    assert len(names(a)) == 28
    with pytest.raises(Exception, match="not an image"):
        b.collect()


def test_bias_rate_follows_the_schedule():
    u = TR.Updater("sgd", lr=0.01, bias_lr=0.02, schedule={"type": "map", "values": {0: 0.01, 5: 0.001}})
    assert abs(u.rate(0, True) - 0.02) < 1e-15 and abs(u.rate(5, True) - 0.002) < 1e-15 and u.rate(5) == 0.001


def test_index_labels_in_one_path(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "name string")
    got = sorted(((r["name"], r["label"]) for r in prep.index_labels(df, "name").collect()), key=str)
    assert got == [("a", 0), ("a", 0), ("b", 1), ("c", 2), (None, None)]


def test_metrics_every_n_iterations_and_batched_scoring(spark):
    from layerwise.operators.scoring import score
    v = fx.vectors64(spark, SF)
    net = Net.sequential((64,), [output(10, "softmax", "nll")]).init(seed=1)
    spec = TR.FitSpec(workers=2, batch=4, frequency=2, seed=3, score_every_iterations=6)
    _, metrics, _ = TR.fit_averaging(v.limit(100), net, "id", "features", "label", 10, spec)
    got = [r["iteration"] for r in metrics.orderBy("iteration").collect()]
    steps = [b // 6 - a // 6 for a, b in zip([0] + got, got)]
    assert all(s >= 1 for s in steps[:-1]) and all(b - a <= 8 for a, b in zip([0] + got, got))
    whole = {r["id"]: r["out"] for r in score(v, net, "features", keep=["id"]).collect()}
    parts = {r["id"]: r["out"] for r in score(v, net, "features", keep=["id"], batch_rows=7).collect()}
    assert whole.keys() == parts.keys() and all(np.allclose(whole[k], parts[k], atol=1e-12) for k in whole)


@pytest.mark.parametrize("k,stride,pad", [(3, 1, 1), (5, 2, 2), (4, 3, 0), (1, 1, 0), (2, 2, 1)])
def test_series_windows_across_blocks(spark, monkeypatch, k, stride, pad):
    monkeypatch.setattr(sequence, "BLOCK_ROWS", 5)
    series = {"a": [float(i * i % 7) if i % 6 else None for i in range(33)], "b": [1.0], "c": [float(i) for i in range(6)]}
    df = spark.createDataFrame([(key, i, v) for key, vs in series.items() for i, v in enumerate(vs)], "k string, t int, v double")
    w = np.arange(2 * k, dtype=float).reshape(2, k) - 2
    conv = {(r["k"], r["pos"]): r["out"] for r in sequence.conv1d(df, "k", ["t"], "v", w, np.array([0.5, -1.0]), padding=pad, stride=stride).collect()}
    top = {(r["k"], r["pos"]): r["value"] for r in sequence.pool1d(df, "k", ["t"], "v", k, stride, pad).collect()}
    mean = {(r["k"], r["pos"]): r["value"] for r in sequence.pool1d(df, "k", ["t"], "v", k, stride, pad, kind="avg").collect()}
    want = {}
    for key, vs in series.items():
        cells = [None] * pad + vs + [None] * pad
        for t in range((len(vs) + 2 * pad - k) // stride + 1):
            want[key, t] = cells[t * stride:t * stride + k]
    assert conv.keys() == top.keys() == mean.keys() == want.keys()
    for key, cells in want.items():
        x = np.array([0.0 if c is None else c for c in cells])
        assert np.allclose(conv[key], w @ x + [0.5, -1.0])
        real = [c for c in cells if c is not None]
        assert top[key] == (max(real) if real else None)
        assert (mean[key] is None) if not real else abs(mean[key] - sum(real) / len(real)) < 1e-12


def test_column_scoring_equals_batch_scoring(spark):
    from layerwise.operators.model import Vertex, activation_layer, batchnorm_layer, conv2d, lrn_layer, pool2d, zeropad_layer
    from layerwise.operators.scoring import score, score_columns
    v = fx.vectors64(spark, SF).limit(40)
    L = lambda name, ins, lay: Vertex(name, "layer", ins, lay)
    vs = [L("pad", ["input"], zeropad_layer(1)), L("c1", ["pad"], conv2d(3, (3, 3), (2, 2))), L("b1", ["c1"], batchnorm_layer()),
          L("r1", ["b1"], activation_layer("leakyrelu")), L("n1", ["r1"], lrn_layer()), L("p1", ["n1"], pool2d((2, 2), (1, 1), mode="same")),
          L("sc", ["input"], conv2d(3, (1, 1), (2, 2), mode="same")), Vertex("add", "add", ["p1", "sc"]), L("d", ["add"], dense(5, "tanh")),
          L("e", ["add"], dense(4, "sigmoid")), Vertex("m", "merge", ["d", "e"]), L("out", ["m"], output(3, "softmax", "nll"))]
    net = Net({"input": (4, 4, 4)}, vs, ["out"]).init(seed=4)
    a = {r["id"]: r for r in score(v, net, "features", keep=["id"], outputs={"out": "o", "d": "d"}).collect()}
    b = {r["id"]: r for r in score_columns(v, net, "features", keep=["id"], outputs={"out": "o", "d": "d"}).collect()}
    assert a.keys() == b.keys()
    assert all(np.allclose(a[k]["o"], b[k]["o"]) and np.allclose(a[k]["d"], b[k]["d"]) for k in a)
    plan = score_columns(v, net, "features", keep=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    null = spark.createDataFrame([(1, None)], "id long, features array<double>")
    assert score_columns(null, net, "features", keep=["id"]).first()["out"] is None


@pytest.mark.parametrize("k, stride, pad", [(1, 1, 0), (4, 3, 0), (5, 2, 2), (7, 1, 7), (40, 5, 3), (16, 4, 8)])
def test_wide_pool1d_matches_brute_force(spark, k, stride, pad):
    series = {"a": [float(i * i % 7) if i % 6 else None for i in range(33)], "b": [1.0], "c": [float(i) for i in range(6)],
              None: [None, None, 2.0, -1.0, None], "d": [None] * 9}
    df = spark.createDataFrame([(key, i, v) for key, vs in series.items() for i, v in enumerate(vs)], "k string, t int, v double")
    top = {(r["k"], r["pos"]): r["value"] for r in sequence.wide_pool1d(df, "k", ["t"], "v", k, stride, pad).collect()}
    mean = {(r["k"], r["pos"]): r["value"] for r in sequence.wide_pool1d(df, "k", ["t"], "v", k, stride, pad, kind="avg").collect()}
    want = {}
    for key, vs in series.items():
        cells = [None] * pad + vs + [None] * pad
        for t in range((len(vs) + 2 * pad - k) // stride + 1):
            want[key, t] = [c for c in cells[t * stride:t * stride + k] if c is not None]
    assert top.keys() == mean.keys() == want.keys()
    for at, real in want.items():
        assert top[at] == (max(real) if real else None)
        assert (mean[at] is None) if not real else abs(mean[at] - sum(real) / len(real)) < 1e-12


def test_wide_pool1d_plan_does_not_grow_with_the_window(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS t", "id * 1.0D AS v")
    plans = [sequence.wide_pool1d(df, "k", ["t"], "v", k)._jdf.queryExecution().optimizedPlan().toString() for k in (3, 3000)]
    assert abs(len(plans[0]) - len(plans[1])) < 200
    assert sequence.wide_pool1d(df.limit(0), "k", ["t"], "v", 3).count() == 0


@pytest.mark.parametrize("kernel, stride, pad, mode", [((7, 6), (1, 1), (0, 0), "truncate"), ((5, 3), (2, 1), (2, 1), "truncate"),
                                                        ((1, 1), (1, 2), (0, 0), "truncate"), ((4, 7), (3, 3), (0, 0), "same")])
@pytest.mark.parametrize("kind", ["max", "avg"])
def test_wide_pool2d_matches_pool2d(spark, kernel, stride, pad, mode, kind):
    c, h, w = 2, 9, 11
    rows = [(i, [float((i * 31 + j * j * 7) % 101 - 50) for j in range(c * h * w)]) for i in range(4)] + [(9, None)]
    df = spark.createDataFrame(rows, "id int, x array<double>")
    out = df.select("id", image_ops.pool2d("x", c, h, w, kernel, stride, pad, mode, kind).alias("a"),
                    image_ops.wide_pool2d("x", c, h, w, kernel, stride, pad, mode, kind).alias("b")).collect()
    for r in out:
        assert (r["a"] is None) == (r["b"] is None)
        assert r["a"] is None or np.allclose(np.array(r["a"], dtype=float), np.array(r["b"], dtype=float), equal_nan=True)


def test_positions_of_a_burst_at_one_time(spark):
    """All rows at one timestamp: no bucket parts them, the range exchange does; equal rows get places of their own."""
    ev = fx.table(spark, SF, "events").select(F.when(F.col("event_id") % 3 > 0, 1).alias("user_id"), F.lit(7.0).alias("ts"), "event_id")
    ev = ev.union(ev.filter("event_id < 40"))
    spark.conf.set("spark.layerwise.hotRows", "50")
    try:
        plan = sequence.positions(ev, "user_id", ["ts", "event_id"], with_length=True)
        pos = plan.toPandas()
    finally:
        spark.conf.unset("spark.layerwise.hotRows")
    for is_null, g in pos.groupby(pos["user_id"].isna()):
        g = g.sort_values("pos")
        assert g["pos"].tolist() == list(range(len(g))) and set(g["_len"]) == {len(g)}
        assert g["event_id"].tolist() == sorted(g["event_id"])
    assert len(pos) == ev.count()


def test_shuffled_table_is_read_by_ranges_of_ranks(spark, tmp_path):
    path = str(tmp_path / "shuffled")
    df = spark.createDataFrame([(i if i % 10 else None, f"r{i % 50}") for i in range(1000)], "id int, x string")
    splits.write_shuffled(df, "id", 5, path, block_rows=100)
    assert splits.shuffled_size(spark, path) == 1000
    whole = [tuple(r) for r in splits.read_ranks(spark, path, 0, 1000).orderBy("rank").collect()]
    assert [r[2] for r in whole] == list(range(1000))
    assert sorted((str(r[0]), r[1]) for r in whole) == sorted((str(r[0]), r[1]) for r in df.collect())
    part = splits.read_ranks(spark, path, 250, 420)
    assert sorted(r["rank"] for r in part.collect()) == list(range(250, 420))
    scan = part._jdf.queryExecution().executedPlan().collectLeaves().head()
    part._jdf.queryExecution().toRdd().count()
    assert scan.metrics().apply("numFiles").value() == 3  # of ten
    assert splits.read_ranks(spark, path, 1000, 2000).count() == splits.read_ranks(spark, path, 5, 5).count() == 0
    with pytest.raises(ValueError):
        splits.write_shuffled(df.withColumn("rank", F.lit(1)), "id", 5, path + "2")
    splits.write_shuffled(df.limit(0), "id", 5, path + "3")
    assert splits.shuffled_size(spark, path + "3") == 0 and splits.read_ranks(spark, path + "3", 0, 9).count() == 0


def test_layer_statistics_of_parameters_updates_and_missing_values(spark):
    rng = np.random.default_rng(3)
    old, new = rng.normal(0, 1, 500), rng.normal(0, 2, 500)
    frames = [spark.createDataFrame([(i % 2, "W", i, float(v)) for i, v in enumerate(vec)], "layer int, name string, idx long, value double")
              for vec in (old, new)]
    keys = ["layer", "name"]
    sketch = statistics.update_histograms(frames[0], frames[1], 0.25)
    bins = {(r["layer"], r["bin"]): r["n"] for r in sketch.collect()}
    want = Counter((i % 2, int(np.floor(d / 0.25))) for i, d in enumerate(new - old))
    assert bins == want
    both = statistics.merge_histograms([statistics.parameter_histograms(f, 0.25) for f in frames], keys)
    for r in statistics.summarise(both, keys).collect():
        x = np.concatenate([old[r["layer"]::2], new[r["layer"]::2]])
        assert r["n"] == 500 and r["missing"] == 0 and r["low"] == x.min() and r["high"] == x.max()
        assert abs(r["mean"] - x.mean()) < 1e-9 and abs(r["deviation"] - x.std()) < 1e-9
    odd = spark.createDataFrame([("a", None), ("a", float("nan")), ("a", -0.5), ("b", None)], "k string, v double")
    got = {r["k"]: r for r in statistics.summarise(statistics.value_histograms(odd, ["k"], "v", 0.25), ["k"]).collect()}
    assert (got["a"]["n"], got["a"]["missing"], got["a"]["mean"], got["a"]["low"]) == (1, 2, -0.5, -0.5)
    assert (got["b"]["n"], got["b"]["missing"], got["b"]["mean"], got["b"]["deviation"]) == (0, 1, None, None)
    assert statistics.summarise(statistics.value_histograms(odd.limit(0), ["k"], "v", 1.0), ["k"]).count() == 0


def test_activation_statistics_agree_between_column_and_task_scoring(spark):
    v = fx.vectors64(spark, SF)
    net = Net.sequential((64,), [dense(4, "relu"), output(3, "softmax", "nll")]).fixed_init()
    a, b = (sorted(tuple(r)[:3] for r in statistics.activation_histograms(v, net, "features", 0.5, columns=c).collect()) for c in (True, False))
    assert a == b and sum(r[2] for r in a) == v.count() * 7


def _fit_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=3).tolist(), rng.normal(size=2).tolist(), int(rng.integers(0, 3)), rng.normal(size=2).tolist()) for i in range(101)]
    return spark.createDataFrame(rows, "id long, a array<double>, b array<double>, label int, target array<double>")


def _fit_graph(**spec):
    from layerwise.operators.model import Vertex
    vs = [Vertex("l1", "layer", ["a"], dense(4, "relu")), Vertex("l2", "layer", ["b"], dense(3, "tanh")), Vertex("m", "merge", ["l1", "l2"]),
          Vertex("o1", "layer", ["m"], output(3, "softmax", "nll")), Vertex("o2", "layer", ["m"], output(2, "identity", "mse"))]
    net = Net({"a": (3,), "b": (2,)}, vs, ["o1", "o2"]).init(seed=2)
    spec = TR.FitSpec(workers=2, batch=4, frequency=3, epochs=2, reshuffle_each_epoch=True, seed=9, l1=1e-3, l2=1e-2, score_every=2,
                      updater=TR.Updater("nesterovs", lr=0.05, bias_lr=0.02, schedule={"type": "map", "values": {0: 0.05, 10: 0.02}}), **spec)
    return net, spec


@pytest.mark.parametrize("renorm", [False, True])
def test_blocks_of_rounds_equal_a_job_per_round(spark, monkeypatch, renorm):
    """Two inputs and outputs, short last batches, blocks of two rounds: one job a block, the same weights, state and metrics."""
    df, (net, spec) = _fit_rows(spark), _fit_graph(renorm_l2=renorm)
    args = ("id", {"a": "a", "b": "b"}, {"o1": "label", "o2": "target"}, {"o1": 3, "o2": 2}, spec)
    jobs, seen, found = {}, {}, {}
    for name, products, block in (("round", 0, 1), ("block", 1 << 30, 2 * 24 * 8 * 10)):
        monkeypatch.setattr(TR, "ROUND_PRODUCTS", products)
        monkeypatch.setattr(TR, "BLOCK_BYTES", block)
        spark.sparkContext.setJobGroup(f"fit-{name}-{renorm}", name)
        seen[name] = []
        found[name] = TR.fit_averaging(df, net, *args, listener=seen[name].append)
        jobs[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit-{name}-{renorm}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    (a, ma, sa), (b, mb, sb) = found["round"], found["block"]
    assert np.allclose(a.flat(), b.flat(), atol=1e-12) and np.allclose(sa, sb, atol=1e-12)
    cols = ["run", "epoch", "round", "iteration"]
    assert ma.select(*cols).collect() == mb.select(*cols).collect() == [tuple(x[:4]) for x in seen["block"]]
    assert np.allclose([x[4] for x in seen["round"]], [x[4] for x in seen["block"]], atol=1e-12)
    assert jobs["block"] < jobs["round"]


def test_blocks_of_rounds_resume_inside_a_block(spark, monkeypatch):
    df, (net, spec) = _fit_rows(spark), _fit_graph()
    monkeypatch.setattr(TR, "BLOCK_BYTES", 2 * 24 * 8 * 10)
    args = ("id", {"a": "a", "b": "b"}, {"o1": "label", "o2": "target"}, {"o1": 3, "o2": 2}, spec)
    whole, _, _ = TR.fit_averaging(df, net, *args)
    n, m, s = TR.fit_averaging(df, net, *args, stop_round=3)
    it = 9
    for start, stop in ((3, 7), (7, None)):
        n, m, s = TR.fit_averaging(df, n, *args, state=s, iteration=it, start_round=start, stop_round=stop)
        it = m.agg({"iteration": "max"}).first()[0] if stop is None else {7: 9 + 6 + 3 * 2}[stop]
    assert np.allclose(whole.flat(), n.flat(), atol=1e-12)


def test_a_fit_of_few_products_runs_fewer_jobs_than_rounds(spark):
    """F1 to F10: a job per round took the time, and the parameters of every round went to the driver."""
    net = Net.sequential((3,), [output(3, "softmax", "nll")]).init(scheme="zero")
    spec = TR.FitSpec(workers=2, batch=1, frequency=1, seed=9)
    spark.sparkContext.setJobGroup("fit-few", "fit")
    _, metrics, _ = TR.fit_averaging(_fit_rows(spark), net, "id", "a", "label", 3, spec)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("fit-few"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert metrics.count() > 40 > jobs


def test_augment_computes_each_step_once(spark):
    """the resize was written into the flip's formula and computed again for every row of every image."""
    df = spark.createDataFrame([(i, [float(10 * i + k) for k in range(4)]) for i in range(20)] + [(20, None)], "id long, px array<double>")
    steps = [(lambda c: prep.resize(c, 1, 2, 2, 2, 2), 1.0), (lambda c: prep.flip_horizontal(c, 1, 2, 2), 0.5)]
    out = prep.augment(df, "px", "id", steps, seed=3)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("image of") == 1
    rows = {r["id"]: r["px"] for r in out.collect()}
    flips = {i for i in range(20) if int(hashlib.md5(f"3|1|0|{i}".encode()).hexdigest()[:8], 16) / 2**32 < 0.5}
    assert 0 < len(flips) < 20 and rows[20] is None
    for i in range(20):
        a = [10.0 * i + k for k in range(4)]
        assert rows[i] == ([a[1], a[0], a[3], a[2]] if i in flips else a)


def test_image_program_opens_each_file_once(spark, monkeypatch):
    """the distinct labels, the cuts of the split and both parts each decoded the whole folder again."""
    from layerwise.plans import programs
    reads = []
    kept = programs.scan_images

    def counted(spark, path):
        seen = spark.sparkContext.accumulator(0)
        reads.append(seen)

        def count(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        scanned = kept(spark, path)
        return scanned.mapInArrow(count, scanned.schema)
    monkeypatch.setattr(programs, "scan_images", counted)
    _, _, conf = programs.image_lenet(spark, SF)
    assert conf.agg(F.sum("n")).first()[0] > 0
    assert [x.value for x in reads] == [fx.image8(spark, SF).count()]
