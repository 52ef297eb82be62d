"""Balanced shards by label propagation under quotas, in DataFrame operations only.

Law ``rows``: the shards' document counts are at most one apart.  Linked documents are those with equal texts.
Members of a group are interchangeable, so propagation runs on weighted nodes (group, shard, members):
a group that holds a third of all rows is at most one node per shard.

1. A group's members start on consecutive shards (from a hash of the group), as a hash partitioner would
   scatter them.
2. Each round every group's nodes look at their neighbours: the target is the shard that holds most of the
   group and still has room; the other nodes move there, groups with more members at the
   target first, until the target's quota is used; a node at the border moves in part.
3. After the rounds, what still exceeds a quota moves to shards with room.  Documents without a copy have
   no links: they fill the shards to their exact quotas.

Only per-shard totals (one number per shard) reach the driver.  Ranks and running totals are built from bucket
counts, so none needs all rows, all copies of a text or all nodes of a shard in one task.

Defined results: a null text is the empty text (size 16); repeated rows are copies like others; null ids rank first;
fewer documents than shards leave shards empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from layerwise.llm.common import id_text, materialise, prepare

BUCKET_ROWS = 8192


def dense_rank(df: DataFrame, keys: list[str], order: list[str], buckets: Column, out: str) -> DataFrame:
    """Gapless numbers from 0 within ``keys``: offsets of hash buckets plus the number in the bucket."""
    df = df.withColumn("_sub", F.pmod(F.xxhash64(*order), F.greatest(buckets.cast("long"), F.lit(1).cast("long"))))
    before = W.partitionBy(*keys).orderBy("_sub").rowsBetween(W.unboundedPreceding, -1)
    offsets = df.groupBy(*keys, "_sub").agg(F.count(F.lit(1)).alias("_n")) \
        .select(*keys, "_sub", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    numbered = df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys, "_sub").orderBy(*order)))
    return numbered.join(offsets, [*keys, "_sub"]).withColumn(out, F.col("_off") + F.col("_rn") - 1).drop("_sub", "_rn", "_off")


def running_total(df: DataFrame, key: str, level: list[Column], order: list[str], out: str) -> DataFrame:
    """Sum of ``m`` over the rows of the same ``key`` that come before, by level, hash bucket and ``order``.

    A level fixes ``m``, so a row's sum is that of the (level, bucket) cells before its own plus its number in the cell
    times m; only the cells' counts are summed up per key."""
    buckets = df.count() // BUCKET_ROWS + 1
    names = [f"_l{i}" for i in range(len(level))]
    df = df.withColumns(dict(zip(names, level))).withColumn("_sub", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    cell = [key, *names, "_sub"]
    before = W.partitionBy(key).orderBy(*names, "_sub").rowsBetween(W.unboundedPreceding, -1)
    cells = df.groupBy(*cell).agg(F.sum("m").alias("_m")).select(*cell, F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_off"))
    numbered = df.withColumn("_rn", F.row_number().over(W.partitionBy(*cell).orderBy(*order)) - 1)
    return numbered.join(cells, cell).withColumn(out, F.col("_off") + F.col("_rn") * F.col("m")).drop(*names, "_sub", "_rn", "_off")


def _totals(nodes: DataFrame, shards: int) -> list[int]:
    got = {r["s"]: r["m"] for r in nodes.groupBy("s").agg(F.sum("m").alias("m")).collect()}  # one row per shard
    return [int(got.get(s, 0)) for s in range(shards)]


def _numbers(values: list[int]) -> Column:
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def _merge(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("g", "s").agg(F.sum("m").alias("m")).filter("m > 0")


def propagate_round(nodes: DataFrame, quotas: list[int]) -> DataFrame:
    """One round on nodes(g, s, m): rows (g, s, m, t, moved) of the moves that the quotas admit."""
    totals = _totals(nodes, len(quotas))
    room = nodes.withColumn("room", F.get(_numbers([q - t for q, t in zip(quotas, totals)]), F.col("s")))
    best = room.filter("room > 0").groupBy("g").agg(F.max(F.struct("m", F.xxhash64("g", "s").alias("tie"), "s", "room")).alias("b")) \
        .select("g", F.col("b.s").alias("t"), F.col("b.m").alias("mt"), F.col("b.tie").alias("tt"), F.col("b.room").alias("rt"))
    movers = nodes.join(best, "g").filter((F.col("s") != F.col("t")) & (F.struct("m", F.xxhash64("g", "s")) < F.struct("mt", "tt")))
    movers = materialise(nodes.sparkSession, movers.select("g", "s", "m", "t", "mt", "rt"), "shard-movers", small=True)
    movers = running_total(movers, "t", [-F.col("mt"), -F.col("m")], ["g", "s"], "before")
    moved = F.greatest(F.lit(0).cast("long"), F.least(F.col("m"), F.col("rt") - F.col("before")))
    return movers.select("g", "s", "m", "t", moved.alias("moved")).filter("moved > 0")


def _apply(nodes: DataFrame, moves: DataFrame) -> DataFrame:
    out = moves.select("g", "s", (-F.col("moved")).alias("m"))
    into = moves.select("g", F.col("t").alias("s"), F.col("moved").alias("m"))
    return _merge(nodes.select("g", "s", "m").unionByName(out).unionByName(into))


def shed_excess(nodes: DataFrame, quotas: list[int]) -> DataFrame:
    """Moves (g, s, t, moved) that bring every shard under its quota; the smallest nodes leave first."""
    totals = _totals(nodes, len(quotas))
    over = [max(0, t - q) for q, t in zip(quotas, totals)]
    room = [max(0, q - t) for q, t in zip(quotas, totals)]
    starts = [sum(over[:s]) for s in range(len(over))]
    ends = [sum(room[:s + 1]) for s in range(len(room))]
    leaving = nodes.withColumn("over", F.get(_numbers(over), F.col("s"))).filter("over > 0")
    leaving = running_total(leaving, "s", [F.col("m")], ["g"], "before")
    leaving = leaving.withColumn("n", F.least("m", F.col("over") - F.col("before"))).filter("n > 0") \
        .withColumn("p", F.get(_numbers(starts), F.col("s")) + F.col("before"))
    leaving = leaving.select("g", "s", "p", "n", F.explode(F.sequence(F.lit(0), F.lit(len(quotas) - 1))).alias("t"))
    hi, lo = F.get(_numbers(ends), F.col("t")), F.get(_numbers([0, *ends[:-1]]), F.col("t"))
    shared = F.least(F.col("p") + F.col("n"), hi) - F.greatest(F.col("p"), lo)
    return leaving.select("g", "s", "t", shared.alias("moved")).filter("moved > 0")


def assign_shards(docs: DataFrame, shards: int = 40, rounds: int = 12) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    spark = docs.sparkSession
    prepare(spark)
    text = F.coalesce("text", F.lit(""))
    rows = id_text(docs).select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"),
                                F.concat(F.hex(F.xxhash64(text)), F.lit("."), F.hex(F.crc32(text.cast("binary"))), F.lit("."), F.octet_length(text)).alias("g"))
    rows = materialise(spark, rows, "shard-rows")
    total = rows.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    groups = rows.groupBy("g").agg(F.count(F.lit(1)).alias("copies"))
    groups = materialise(spark, groups.filter("copies > 1"), "shard-groups", small=True)

    # nodes: member p of a group starts on shard (hash + p) mod shards
    first = F.pmod(F.xxhash64("g"), F.lit(shards)).cast("int")
    step = F.explode(F.sequence(F.lit(0), F.least(F.col("copies"), F.lit(shards)).cast("int") - 1)).alias("p")
    nodes = groups.select("g", "copies", first.alias("first"), step) \
        .select("g", F.pmod(F.col("first") + F.col("p"), F.lit(shards)).cast("int").alias("s"),
                F.floor((F.col("copies") - F.col("p") - 1) / shards + 1).cast("long").alias("m"))
    nodes = materialise(spark, nodes, "shard-nodes", small=True)
    for _ in range(rounds):
        moves = materialise(spark, propagate_round(nodes, quotas), "shard-moves", small=True)
        if moves.isEmpty():
            break
        nodes = materialise(spark, _apply(nodes, moves), "shard-nodes", small=True)
    totals = _totals(nodes, shards)
    if any(t > q for t, q in zip(totals, quotas)):
        nodes = materialise(spark, _apply(nodes, shed_excess(nodes, quotas)), "shard-nodes", small=True)
        totals = _totals(nodes, shards)

    cumulative = F.sum("m").over(W.partitionBy("g").orderBy("s"))
    places = nodes.withColumn("upto", cumulative).groupBy("g").agg(
        F.sort_array(F.collect_list(F.struct("upto", "s"))).alias("places"), F.sum("m").alias("copies"))  # one entry per shard at most
    marked = rows.join(places, "g", "left")
    linked = dense_rank(marked.filter("copies is not null"), ["g"], ["doc_id"], F.ceil(F.col("copies") / BUCKET_ROWS), "pos")
    linked = linked.withColumn("shard", F.filter("places", lambda x: x["upto"] > F.col("pos"))[0]["s"])
    free = [q - t for q, t in zip(quotas, totals)]
    bounds = _numbers([sum(free[:s + 1]) for s in range(shards)])
    single = dense_rank(marked.filter("copies is null"), [], ["doc_id", "g"], F.lit(total // BUCKET_ROWS + 1), "pos")
    single = single.withColumn("shard", F.size(F.filter(bounds, lambda b: b <= F.col("pos"))))
    columns = ["doc_id", "size", "crc", "shard"]
    placed = materialise(spark, linked.select(*columns).unionByName(single.select(*columns)), "shard-placed")
    slotted = dense_rank(placed, ["shard"], ["doc_id", "crc", "size"], F.lit(total // shards // BUCKET_ROWS + 1), "slot")
    return slotted.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
                          F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
