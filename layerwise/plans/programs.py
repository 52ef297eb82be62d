"""End-to-end training programs: the reference's three kinds of main, as Spark jobs.

Each program reads driver tables (through the fixtures), prepares examples with
column expressions, trains by parameter averaging, scores and evaluates with
grouped counts, and returns DataFrames plus the trained net. Nothing row-sized
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prep, splits
from ..operators import training as TR
from ..operators.evaluation import class_metrics, confusion, summary
from ..operators.model import Net, conv2d, dense, output, pool2d
from ..operators.scoring import predict
from ..session import scratch_path
from ..sources.delimited import scan_delimited
from ..sources.images import scan_images, write_png_folder
from ..sources.model_store import read_model, write_model
from . import fixtures as fx
from . import sql_fit as SF
from .registry import V64, md5_int, order_key, register


def people_mlp(spark, sf_dir, workers=3, epochs=2, seed=3):
    """8-40-30-13 leaky-ReLU MLP, Nesterov(0.1), l2 1e-4; batches of 10 read, every third
    batch held out (without the reference's train/test overlap), 16 rows per worker step,
    averaging every 10 steps."""
    fields = ["id", "label"] + [f"f{i}" for i in range(8)]
    people = fx.people13(spark, sf_dir).select("id", "label", *[F.element_at("features", i + 1).alias(f"f{i}") for i in range(8)])
    path = scratch_path(spark, "people-csv")
    people.write.csv(path)
    rows = scan_delimited(spark, path, "id bigint, label int, " + ", ".join(f"{c} double" for c in fields[2:]))
    data = prep.check_labels(prep.split_label(rows, fields[1:], label_index=0, keep=["id"]), "label", 13)
    batched = splits.assign_batches(data, "id", 10, seed)
    parts = splits.stride_sample(batched, "batch_id", every=3, exclude=True)
    train = parts.filter(F.col("part") == "train").drop("part", "batch_id")
    test = parts.filter(F.col("part") == "test").drop("part", "batch_id")
    net = Net.sequential((8,), [dense(40, "leakyrelu"), dense(30, "leakyrelu"),
                                output(13, "softmax", "nll")]).init(seed=seed)
    spec = TR.FitSpec(workers=workers, batch=16, frequency=10, epochs=epochs, seed=seed, l2=1e-4,
                      updater=TR.Updater("nesterovs", lr=0.1, momentum=0.9))
    net, metrics, _ = TR.fit_averaging(train, net, "id", "features", "label", 13, spec, run="people")
    conf = confusion(predict(test, net, "features", keep=["id", "label"]), 13)
    return net, metrics, conf


PEOPLE_WIDTHS = [8, 40, 30, 13]


def _people_sql(workers=3, epochs=2, seed=3) -> str:
    start = Net.sequential((8,), [dense(40, "leakyrelu"), dense(30, "leakyrelu"), output(13, "softmax", "nll")]).init(seed=seed)
    ctes = f"""v AS ({V64}), f AS (SELECT id, x[1:8] AS x, (id % 13)::INTEGER AS label, {order_key(seed)} AS k FROM v),
t AS (SELECT *, (row_number() OVER (ORDER BY k, id) - 1) // 10 AS batch_id FROM f),
d AS (SELECT id, {md5_int(seed, 'id')} % {workers} AS worker, k, x, label FROM t WHERE batch_id % 3 <> 0)"""
    fit = SF.fit_ctes(ctes, PEOPLE_WIDTHS, ["leakyrelu", "leakyrelu"], SF.dense_rows(start), SF.softmax_delta(13), workers, 16, 10,
                      epochs, 0.1, 0.9, 1e-4)
    return fit + "\n" + SF.dense_select(PEOPLE_WIDTHS)


def digits_mlp(spark, sf_dir, workers=3, epochs=2, seed=12345, hidden=(500, 100)):
    """64-500-100-10 on the vector table (the reference's 784-500-100-10 on digits):
    train/test split, averaging every 5 batches of 16, model written and restored."""
    v = fx.vectors64(spark, sf_dir)
    train, test = splits.split_frames(v, "id", [7, 3], seed)
    net = Net.sequential((64,), [dense(hidden[0], "leakyrelu"), dense(hidden[1], "leakyrelu"),
                                 output(10, "softmax", "nll")]).init(seed=seed)
    spec = TR.FitSpec(workers=workers, batch=16, frequency=5, epochs=epochs, seed=seed,
                      updater=TR.Updater("nesterovs", lr=0.1, momentum=0.9))
    net, metrics, state = TR.fit_averaging(train, net, "id", "features", "label", 10, spec, run="digits")
    path = scratch_path(spark, "digits-model")
    write_model(spark, net, path, state=state)
    restored = read_model(spark, path)
    conf = confusion(predict(test, restored, "features", keep=["id", "label"]), 10)
    return restored, metrics, conf


def animals_mlp(spark, sf_dir, workers=8, epochs=2, seed=42):
    """4-4-3-3 on the line-item features (label = return flag), batches of 16, average every 5."""
    # line items have no unique key: a content hash is a deterministic id (identical rows tie)
    a = fx.animals3(spark, sf_dir)
    a = a.withColumn("id", F.xxhash64(*a.columns))
    ex = prep.split_label(a, ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "flag_id"], 4, keep=["id"])
    train, test = splits.split_frames(ex, "id", [7, 3], seed)
    # the range comes from the training rows only; a constant column becomes 0
    n = range(4)
    wide = train.select(*[F.element_at("features", i + 1).alias(f"f{i}") for i in n])
    stats = prep.fit_range(wide, [f"f{i}" for i in n])
    lo = F.array(*[F.lit(stats[f"f{i}"][0]) for i in n])
    span = F.array(*[F.lit((stats[f"f{i}"][1] - stats[f"f{i}"][0]) or 1.0) for i in n])
    scaled = F.transform("features", lambda x, i: (x - F.element_at(lo, i + 1)) / F.element_at(span, i + 1))
    train, test = train.withColumn("features", scaled), test.withColumn("features", scaled)
    net = Net.sequential((4,), [dense(4, "leakyrelu"), dense(3, "leakyrelu"), output(3, "softmax", "nll")]).init(seed=6)
    spec = TR.FitSpec(workers=workers, batch=16, frequency=5, epochs=epochs, seed=seed,
                      updater=TR.Updater("nesterovs", lr=0.1, momentum=0.9))
    net, metrics, _ = TR.fit_averaging(train, net, "id", "features", "label", 3, spec, run="animals")
    return net, metrics, confusion(predict(test, net, "features", keep=["id", "label"]), 3)


def image_lenet(spark, sf_dir, workers=3, epochs=1, seed=42):
    """Photo-folder path: PNG folder per class -> scan -> 70/30 split -> resize 16x16 + flip 0.5
    on train only -> scale to [0, 1] (fixed pixel range) -> LeNet-shaped net -> evaluation."""
    img = fx.image8(spark, sf_dir)
    root = scratch_path(spark, "photos")
    write_png_folder(img, root, "id", "px", "label", 8, 8)
    scanned = scan_images(spark, root).select(
        F.regexp_extract("origin", r"/(\d+)\.png$", 1).cast("bigint").alias("id"), "px", "label")
    # one small file an image: opened once, labels, cuts and both parts read the decoded copy
    decoded = scratch_path(spark, "photos-decoded")
    scanned.write.parquet(decoded)
    scanned = spark.read.parquet(decoded)
    labelled = prep.index_labels(scanned.withColumnRenamed("label", "cls"), "cls", "label")
    train, test = splits.split_frames(labelled, "id", [7, 3], seed)
    steps = [(lambda c: prep.resize(c, 1, 8, 8, 16, 16), 1.0), (lambda c: prep.flip_horizontal(c, 1, 16, 16), 0.5)]
    train = prep.augment(train, "px", "id", steps, seed, epoch=0)
    test = test.withColumn("px", prep.resize("px", 1, 8, 8, 16, 16))
    train = train.withColumn("x", prep.scale_pixels("px"))
    test = test.withColumn("x", prep.scale_pixels("px"))
    net = Net.sequential((1, 16, 16), [conv2d(6, (5, 5)), pool2d((2, 2), (2, 2)), conv2d(8, (3, 3)),
                                       pool2d((2, 2), (2, 2)), dense(32, "relu"),
                                       output(10, "softmax", "nll")]).init(seed=seed)
    spec = TR.FitSpec(workers=workers, batch=32, frequency=3, epochs=epochs, seed=seed, l2=5e-4,
                      updater=TR.Updater("nesterovs", lr=0.01, momentum=0.9,
                                         schedule={"type": "map", "values": {0: 0.01, 1000: 0.005, 3000: 0.001}}))
    net, metrics, _ = TR.fit_averaging(train, net, "id", "x", "label", 10, spec, run="lenet-images")
    return net, metrics, confusion(predict(test, net, "x", keep=["id", "label"]), 10)


@register("program_people_mlp")
def people_program_query(spark, sf_dir):
    _, _, conf = people_mlp(spark, sf_dir)
    return class_metrics(conf)


@register("program_people_params", _people_sql())
def people_params_query(spark, sf_dir):
    """The weights the same program ends with: scan, split into batches, held-out batches, averaging fit."""
    from .queries_training import params_frame
    net, _, _ = people_mlp(spark, sf_dir)
    return params_frame(spark, net).withColumn("value", F.round("value", 6))


@register("program_digits_mlp")
def digits_program_query(spark, sf_dir):
    _, _, conf = digits_mlp(spark, sf_dir)
    return summary(conf)


@register("program_animals_mlp")
def animals_program_query(spark, sf_dir):
    _, _, conf = animals_mlp(spark, sf_dir)
    return class_metrics(conf)


@register("program_image_lenet")
def image_program_query(spark, sf_dir):
    _, _, conf = image_lenet(spark, sf_dir)
    return class_metrics(conf)
