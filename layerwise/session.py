"""Session and shared-folder helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "layerwise",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings the library assumes (UTC, AQE, Arrow, no UI)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and must be on shared storage.
    Only when it is unset on a local master (tests) a fresh folder is created, registered as
    the context's checkpoint directory and removed at exit; elsewhere a missing setting raises.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset
            root = None
    if not root:
        try:
            root = sc.getCheckpointDir()
        except Exception:  # noqa: BLE001
            root = None
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="layerwise-ckpt-")
        atexit.register(shutil.rmtree, root, True)
        sc.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a sub-folder of the shared checkpoint folder once nothing reads it any more."""
    if not path.startswith(checkpoint_root(spark) + "/"):
        raise ValueError(f"{path} is no scratch folder")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop))


def local_fs_path(path: str) -> str:
    """Path usable by Python file APIs inside tasks (shared POSIX mount)."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
        return path
    if "://" in path:
        raise NotImplementedError(
            f"{path}: Python-side file writes need the shared folder mounted as a POSIX path")
    return os.path.abspath(path)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``layerwise`` importable in every Python worker (``addPyFile`` of a zip), once per context.

    Task closures refer to functions of this package; on a cluster the executors only see it
    when it is shipped with the job.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = checkpoint_root(spark)
    try:
        folder = local_fs_path(root)
    except NotImplementedError:
        folder = tempfile.mkdtemp(prefix="layerwise-pkg-")  # read by the driver only, then served by Spark
    os.makedirs(folder, exist_ok=True)
    target = os.path.join(folder, f"layerwise-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(key)
