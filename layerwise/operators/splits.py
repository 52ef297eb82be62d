"""Seeded ordering, exact weighted splits, stride samples and mini-batch ranks.

Global ranks are computed without a single-partition window: rows are keyed by
md5(seed|id); the first bits of that key form an order-preserving bucket. Bucket
counts and their running sums (computed in Spark) give every bucket its starting
offset, and only rows inside one bucket are ranked together. The weighted split
looks up the rows at its cuts and labels all others by comparison, in one scan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hex_prefix_int, md5_key

MAX_BUCKETS = 1 << 16  # bound of every histogram collected here (4 hex digits)
HOT_ROWS = 1 << 22     # a rank unit above this size (and far above the average) is split


ROWS_PER_BUCKET = 1 << 14


def with_order_key(df: DataFrame, id_col: str, seed) -> DataFrame:
    return df.withColumn("_key", md5_key(seed, id_col))


def hot_rows(spark) -> int:
    try:
        return int(spark.conf.get("spark.layerwise.hotRows"))
    except Exception:  # noqa: BLE001 - unset
        return HOT_ROWS


def ranked(df: DataFrame, id_col: str, seed, partition_cols: Sequence[str] = (),
           n_groups: int | None = None, rank_col: str = "rank") -> DataFrame:
    """0-based rank of each row in (md5(seed|id), id) order, per ``partition_cols`` (null is a group).

    Rows are cut into order-preserving units: the first bits of the md5 key, and inside a cell of
    more than ``hot_rows`` rows (a heavily repeated id) also the key, the id and the top bits of a row
    hash. Spark counts the units and sums them up per group; row_number runs inside one unit only.
    Nothing but the list of over-full cells (at most rows / ``hot_rows`` of them) reaches the
    driver, and there is no limit on groups. Rows that tie on the id follow a hash of the whole row.
    """
    pcols = list(partition_cols)
    keyed = _rank_units(df, id_col, seed, pcols, n_groups)
    unit = list(UNIT)
    before = Window.partitionBy(*pcols).orderBy(*unit).rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy(*pcols, *unit).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(*[F.col(c).alias(f"_o{c}") for c in [*pcols, *unit]],
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    on = [F.col(c).eqNullSafe(F.col(f"_o{c}")) for c in [*pcols, *unit]]
    w = Window.partitionBy(*pcols, *unit).orderBy("_key", id_col, "_h")
    out = keyed.withColumn("_rn", F.row_number().over(w)).join(offsets, on)
    return out.select(*df.columns, (F.col("_off") + F.col("_rn") - 1).cast("bigint").alias(rank_col))


UNIT = ("_b", "_uk", "_ui", "_uh")


def _rank_units(df: DataFrame, id_col: str, seed, pcols: list, n_groups: int | None) -> DataFrame:
    """Rows with their key, row hash and the columns of their order-preserving unit (UNIT)."""
    bits = _rank_bits(df, n_groups)
    keyed = (with_order_key(df, id_col, seed).withColumn("_h", F.xxhash64(*df.columns))
             .withColumn("_b", F.shiftright(hex_prefix_int(F.col("_key"), 8), 32 - bits)))
    limit = hot_rows(df.sparkSession)
    cells = keyed.groupBy(*pcols, "_b").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > F.lit(limit))
    hot = cells.select(*pcols, "_b").collect()
    is_hot = F.lit(False)
    if hot:
        lk = df.sparkSession.createDataFrame([tuple(r) for r in hot], cells.select(*pcols, "_b").schema)
        lk = lk.select(*[F.col(c).alias(f"_hot_{c}") for c in [*pcols, "_b"]], F.lit(True).alias("_hot"))
        on = [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in [*pcols, "_b"]]
        keyed = keyed.join(F.broadcast(lk), on, "left").drop(*[f"_hot_{c}" for c in [*pcols, "_b"]])
        is_hot = F.coalesce(F.col("_hot"), F.lit(False))
    return (keyed.withColumn("_uk", F.when(is_hot, F.col("_key")).otherwise(F.lit("")))
             .withColumn("_ui", F.when(is_hot, F.col(id_col)))
             .withColumn("_uh", F.when(is_hot, F.shiftright("_h", 52)).otherwise(F.lit(0)))
             .drop("_hot"))


def _rank_bits(df: DataFrame, n_groups: int | None) -> int:
    """Unit bits for about ROWS_PER_BUCKET rows a unit by the plan's size estimate (16 bytes a row);
    an estimate that is far off changes the unit sizes, never the ranks."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no estimate
        size = 1 << 40
    per_group = size / 16 / ROWS_PER_BUCKET / max(n_groups or 1, 1)
    return int(min(28, max(0 if n_groups else 4, math.ceil(math.log2(max(per_group, 1.0))))))


def sorted_numbers(df: DataFrame, col: str, out_col: str) -> DataFrame:
    """(col, out_col): 0-based place of each distinct value in sorted order.

    A range exchange sorts the values; a partition's rows are numbered in place and get the
    offset of the partitions before it (one row per partition is summed up). The ranges are
    written once, since two evaluations could draw different borders."""
    from ..session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, "sorted-values")
    df.select(col).repartitionByRange(col).withColumn("_p", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    w = Window.partitionBy("_p").orderBy(col)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (ranged.withColumn("_rn", F.row_number().over(w)).join(offsets, "_p")
            .select(col, (F.col("_off") + F.col("_rn") - 1).alias(out_col)))


def seeded_order(df: DataFrame, id_col: str, seed, pos_col: str = "pos") -> DataFrame:
    """SPL-01: the seeded shuffle order as an explicit 0-based position column."""
    return ranked(df, id_col, seed, rank_col=pos_col)


def split_sizes(n: int, weights: Sequence[float]) -> list[int]:
    """Exact part sizes: cut_j = floor(n * cumw_j / total) in exact rational arithmetic
    (weights read as decimals); the last part takes the rest."""
    from fractions import Fraction
    ws = [Fraction(str(w)) for w in weights]
    total = sum(ws)
    cuts, acc = [], Fraction(0)
    for w in ws[:-1]:
        acc += w
        cuts.append(int(n * acc // total))
    cuts.append(n)
    return cuts


def weighted_split(df: DataFrame, id_col: str, weights: Sequence[float], seed,
                   part_col: str = "part", tie_cols: Sequence[str] | None = None) -> DataFrame:
    """SPL-02: assign each row to part j with exact sizes in seeded order.

    The row at each cut is looked up first: a histogram of key prefixes (at most ``MAX_BUCKETS`` counts), once
    more inside a prefix that is still too full, then an ordering of the rows of one prefix. The
    result is one scan that compares each row's (key, id, row hash) with the cuts, without a
    shuffle. Only where equal rows lie on both sides of a cut are all rows ranked.
    ``tie_cols`` (default: all) order rows of one id; the look-up reads only these and the id.
    """
    keyed = with_order_key(df, id_col, seed).withColumn("_h", F.xxhash64(*(tie_cols or df.columns)))
    first = _prefix_counts(keyed, "")
    cuts = split_sizes(sum(c for _, c in first), weights)
    at = [_row_at(keyed, id_col, cut, first, hot_rows(df.sparkSession)) for cut in cuts[:-1]]
    if any(row == "tie" for row in at):
        place = ranked(df, id_col, seed, rank_col="_rank")
        after = [F.col("_rank") >= F.lit(cut) for cut in cuts[:-1]]
    else:
        place = keyed
        key = F.struct("_key", F.col(id_col).alias("id"), "_h")
        after = [F.lit(row == "start") if isinstance(row, str) else
                 key >= F.struct(F.lit(row[0]).alias("_key"), F.lit(row[1]).cast(df.schema[id_col].dataType).alias("id"), F.lit(row[2]).alias("_h"))
                 for row in at]
    part = sum((x.cast("bigint") for x in after), F.lit(0).cast("bigint"))
    return place.select(*df.columns, part.alias(part_col))


def _prefix_counts(keyed: DataFrame, prefix: str) -> list:
    """Sorted (prefix + 4 more hex digits, rows): at most MAX_BUCKETS entries."""
    rows = keyed.filter(F.col("_key").startswith(prefix)) if prefix else keyed
    counts = rows.groupBy(F.substring("_key", 1, len(prefix) + 4).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return sorted((r["p"], r["n"]) for r in counts.collect())


def _row_at(keyed: DataFrame, id_col: str, rank: int, counts: list, limit: int):
    """(key, id, hash) of the row at a 0-based rank; "start" for rank 0, "end" past the last row,
    "tie" when the row before it is equal or the equal keys are too many to order at once."""
    if rank == 0:
        return "start"
    if rank >= sum(n for _, n in counts):
        return "end"
    off = 0
    while True:
        for prefix, n in counts:
            if rank < off + n:
                break
            off += n
        if n <= limit:
            break
        if len(prefix) >= 32:
            return "tie"
        counts = _prefix_counts(keyed, prefix)
    w = Window.partitionBy(F.substring("_key", 1, len(prefix))).orderBy("_key", id_col, "_h")
    near = (keyed.filter(F.col("_key").startswith(prefix)).select("_key", id_col, "_h")
            .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn").isin(rank - off, rank - off + 1)))
    found = [tuple(r)[:3] for r in near.orderBy("_rn").collect()]
    return "tie" if len(found) == 2 and found[0] == found[1] else found[-1]


def split_frames(df: DataFrame, id_col: str, weights: Sequence[float], seed, tie_cols: Sequence[str] | None = None) -> list[DataFrame]:
    parts = weighted_split(df, id_col, weights, seed, tie_cols=tie_cols)
    return [parts.filter(F.col("part") == j).drop("part") for j in range(len(weights))]


def assign_batches(df: DataFrame, id_col: str, size: int, seed,
                   partition_cols: Sequence[str] = (), n_groups: int | None = None,
                   batch_col: str = "batch_id", rank_col: str | None = None) -> DataFrame:
    """PRE-09: batch_id = floor(rank / size) in seeded order; the last batch may be short. The rank stays as ``rank_col``."""
    r = ranked(df, id_col, seed, partition_cols=partition_cols, n_groups=n_groups, rank_col=rank_col or "_rank")
    r = r.withColumn(batch_col, F.floor(F.col(rank_col or "_rank") / F.lit(size)).cast("bigint"))
    return r if rank_col else r.drop("_rank")


BLOCK_ROWS = 1 << 20   # rows of a shuffled table's block, one file


def write_shuffled(df: DataFrame, id_col: str, seed, path: str, block_rows: int = BLOCK_ROWS) -> None:
    """The rows of ``df`` in seeded order with their 0-based ``rank``, for reading by ranges of ranks.

    Ranked and exchanged once: ``path``/rows holds one folder a block of ``block_rows`` ranks, sorted by rank inside;
    ``path``/index one row a block (block, first, n), ``path``/schema no rows. All blocks but the last are of one size, whatever the ids."""
    taken = {"rank", "block"} & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are taken by the shuffled table")
    r = ranked(df, id_col, seed, rank_col="rank").withColumn("block", F.floor(F.col("rank") / F.lit(block_rows)).cast("bigint"))
    r.limit(0).coalesce(1).write.parquet(f"{path}/schema")
    r.repartition("block").sortWithinPartitions("block", "rank").write.partitionBy("block").parquet(f"{path}/rows")
    blocks = df.sparkSession.read.schema(r.schema).parquet(f"{path}/rows").groupBy("block").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
    blocks.coalesce(1).write.parquet(f"{path}/index")


def shuffled_size(spark, path: str) -> int:
    """Rows of a shuffled table, from its index."""
    return spark.read.parquet(f"{path}/index").agg(F.sum("n")).first()[0] or 0


def read_ranks(spark, path: str, start: int, end: int) -> DataFrame:
    """Rows with start <= rank < end of a shuffled table: only the files of their blocks are opened, and of those the row groups they lie in.

    Mini-batch b of size m is the range (b * m, (b + 1) * m); part j of a weighted split is the range between its cuts."""
    index = spark.read.parquet(f"{path}/index")
    found = index.filter((F.col("first") < end) & (F.col("first") + F.col("n") > start)).agg(F.min("block").alias("a"), F.max("block").alias("b")).first()
    rows = spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/rows")
    if found["a"] is None or start >= end:
        return rows.drop("block").limit(0)
    return rows.filter(F.col("block").between(found["a"], found["b"]) & (F.col("rank") >= start) & (F.col("rank") < end)).drop("block")


def collate_batches(df: DataFrame, batch_col: str, cols, out_col: str = "rows") -> DataFrame:
    """PRE-09 collation: one row per batch holding its examples; a group is one batch (bounded
    by the batch size), never a whole table."""
    return df.groupBy(batch_col).agg(F.collect_list(F.struct(*cols)).alias(out_col))


def stride_sample(df: DataFrame, batch_col: str = "batch_id", every: int = 3,
                  exclude: bool = True, part_col: str = "part") -> DataFrame:
    """SPL-03: batches with batch_id % every == 0 are the test part.

    ``exclude=False`` reproduces the overlapping behaviour (those batches also
    stay in train): they are emitted twice, once per part.
    """
    is_test = (F.col(batch_col) % F.lit(every)) == 0
    labelled = df.withColumn(part_col, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))
    if exclude:
        return labelled
    return labelled.unionByName(df.filter(is_test).withColumn(part_col, F.lit("train")))


def batch_bounds(df: DataFrame, id_col: str, batch_col: str = "batch_id") -> DataFrame:
    return df.groupBy(batch_col).agg(F.count(F.lit(1)).alias("n"),
                                     F.min(id_col).alias("min_id"),
                                     F.max(id_col).alias("max_id"))

