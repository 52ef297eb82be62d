"""SNK-01/02/03: models and training metrics as Parquet tables.

model_layers(layer, kind, n_in, n_out, activation, options), model_params(layer, name, idx, value),
updater_state(layer, name, slot, idx, value) with a one-row updater(options) of its kind, rates and
iteration, and a one-row model_config(config).
"""

from __future__ import annotations

import dataclasses
import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..operators.model import Net, net_from_rows
from ..session import path_exists

LAYERS_SCHEMA = "layer int, kind string, n_in int, n_out int, activation string, options string"


def _param_frame(net: Net, vec: np.ndarray | None = None) -> pd.DataFrame:
    names = {v.name: i for i, v in enumerate(net.vertices)}
    parts, off = [], 0
    for vname, pname, shp in net.param_keys():
        size = int(np.prod(shp))
        vals = net.params[(vname, pname)].ravel() if vec is None else vec[off:off + size]
        parts.append(pd.DataFrame({"layer": np.full(size, names[vname], dtype=np.int32), "name": pname,
                                   "idx": np.arange(size, dtype=np.int64), "value": np.asarray(vals, dtype=float)}))
        off += size
    if not parts:
        return pd.DataFrame({"layer": np.zeros(0, np.int32), "name": [], "idx": np.zeros(0, np.int64),
                             "value": np.zeros(0)})
    return pd.concat(parts, ignore_index=True)


def write_model(spark: SparkSession, net: Net, path: str, state: np.ndarray | None = None,
                save_updater: bool = True, slot: str = "v", updater=None, iteration: int = 0) -> None:
    spark.createDataFrame(net.layer_rows(), LAYERS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/model_layers")
    spark.createDataFrame([(net.config_json(),)], "config string").coalesce(1).write.mode("overwrite") \
        .parquet(f"{path}/model_config")
    params = _param_frame(net)
    spark.createDataFrame(_rows(params, ["layer", "name", "idx", "value"]),
                          "layer int, name string, idx bigint, value double") \
        .write.mode("overwrite").parquet(f"{path}/model_params")
    if save_updater and updater is not None:
        options = json.dumps({"iteration": iteration, **dataclasses.asdict(updater)})
        spark.createDataFrame([(options,)], "options string").coalesce(1).write.mode("overwrite").parquet(f"{path}/updater")
    if save_updater and state is not None and state.size:
        st = _param_frame(net, state).assign(slot=slot)
        spark.createDataFrame(_rows(st, ["layer", "name", "slot", "idx", "value"]),
                              "layer int, name string, slot string, idx bigint, value double") \
            .write.mode("overwrite").parquet(f"{path}/updater_state")


def _rows(pdf: pd.DataFrame, cols) -> list:
    """Plain Python tuples (model-sized), independent of the session's Arrow setting."""
    return list(zip(*[pdf[c].tolist() for c in cols]))


def read_model(spark: SparkSession, path: str, with_state: bool = False):
    """Restore the Net (model-sized collect, bounded by the model)."""
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/model_layers").collect()]
    cfg = spark.read.parquet(f"{path}/model_config").first()["config"]
    net = net_from_rows(rows, cfg)
    p = spark.read.parquet(f"{path}/model_params").toPandas()
    names = {i: v.name for i, v in enumerate(net.vertices)}
    for (layer, pname), g in p.groupby(["layer", "name"]):
        vname = names[int(layer)]
        shp = net.param_shapes(net._vertex(vname))[pname]
        net.params[(vname, pname)] = g.sort_values("idx")["value"].to_numpy().reshape(shp)
    if not with_state:
        return net
    if not path_exists(spark, f"{path}/updater_state"):
        return net, None
    st = spark.read.parquet(f"{path}/updater_state").toPandas()
    number = {n: i for i, n in names.items()}
    vec = [st[(st["layer"] == number[vname]) & (st["name"] == pname)].sort_values("idx")["value"].to_numpy()
           for vname, pname, _ in net.param_keys()]
    return net, np.concatenate(vec) if vec else None


def read_updater(spark: SparkSession, path: str):
    """(Updater, iteration) stored with the model, or (None, 0) where none was saved."""
    from ..operators.training import Updater
    if not path_exists(spark, f"{path}/updater"):
        return None, 0
    options = json.loads(spark.read.parquet(f"{path}/updater").first()["options"])
    iteration = options.pop("iteration")
    return Updater(**options), iteration


def write_metrics(df: DataFrame, path: str) -> None:
    """SNK-03: append training metrics rows (run, epoch, round, iteration, score, elapsed_ms)."""
    df.write.mode("append").parquet(path)
