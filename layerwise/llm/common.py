"""Shared helpers of the corpus operators: tables, written intermediate results, null-safe ids."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwise.session import scratch_path, ship_package

FILES_PER_CORE, FEW_PER_CORE = 16, 4
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def freeing_shuffles(spark: SparkSession):
    """Shuffle files of an execution inside this block go when the execution ends, not when the
    driver next collects garbage."""
    was = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN, was)


def materialise(spark: SparkSession, df: DataFrame, name: str, small: bool = False) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: a short lineage that
    survives lost executors. ``small``: a table without texts, for which few files do."""
    path = scratch_path(spark, name)
    with freeing_shuffles(spark):
        few_files(df, FEW_PER_CORE if small else FILES_PER_CORE).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few_files(df: DataFrame, per_core: int = FILES_PER_CORE) -> DataFrame:
    """At most ``per_core`` partitions, and so files, for each core of the cluster."""
    return df.coalesce(per_core * df.sparkSession.sparkContext.defaultParallelism)


def prepare(spark: SparkSession) -> None:
    ship_package(spark)


def id_text(docs: DataFrame) -> DataFrame:
    """Only the two columns the text operators read, whatever else the table carries."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def keep_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is in ``ids`` (one column, nulls match nulls); one plan at any size."""
    key = ids.columns[0]
    ids = ids.select(F.col(key).alias("__kept_id")).hint("merge")
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["__kept_id"]), "left_semi")


EDGE_BLOCK = 512     # edges of a node that one task joins with the node's label
JUMP_SALTS = 16      # parts of the nodes that share a label


def components(spark: SparkSession, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows (node, label), label the smallest node reachable.

    Each round every node takes the smallest label among its own and its neighbours', then the label
    of its label (pointer jumping), so long chains halve.  Every round is a written table; the stop
    test is one changed-row check, no label reaches the driver.

    No node's edges meet in one task: a hub's edges are dealt over blocks and its label is copied to each of them, and
    the nodes that share a label are dealt over ``JUMP_SALTS`` copies of it; minima are taken in two steps by the aggregation."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialise(spark, both, "cc-pairs", small=True)
    nodes = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"), F.ceil(F.count(F.lit(1)) / EDGE_BLOCK).cast("int").alias("blocks")) \
        .select("node", F.least("node", "m").alias("label"), "blocks")
    labels = materialise(spark, nodes, "cc-labels", small=True)
    # an edge learns the blocks of its hub from one of the hub's copies, and takes one of them
    salts = F.explode(F.sequence(F.lit(0), F.lit(JUMP_SALTS - 1))).alias("salt")
    hubs = labels.filter("blocks > 1").select(F.col("node").alias("b"), "blocks", salts)
    both = both.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(JUMP_SALTS)).cast("int")).join(hubs, ["b", "salt"], "left")
    both = both.select("a", "b", F.pmod(F.xxhash64("a", F.lit(1)), F.coalesce("blocks", F.lit(1))).cast("int").alias("block"))
    both = materialise(spark, both, "cc-edges", small=True)
    for _ in range(max_rounds):
        dealt = labels.select(F.col("node").alias("b"), "label", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        seen = both.join(dealt, ["b", "block"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(seen, "node").select("node", "blocks", F.col("label").alias("old"), F.least("label", "near").alias("hop")) \
            .withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(JUMP_SALTS)).cast("int"))
        jump = labels.filter("node <> label").select(F.col("node").alias("hop"), F.col("label").alias("far"), salts)
        step = step.join(jump, ["hop", "salt"], "left").select("node", "blocks", "old", F.least("hop", "far").alias("label"))
        step = materialise(spark, step, "cc-labels", small=True)
        labels = step.select("node", "label", "blocks")
        if step.filter("old <> label").isEmpty():
            return labels.select("node", "label")
    raise RuntimeError("components did not settle")  # 2^60 long chains only
