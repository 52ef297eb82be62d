"""Near-duplicate classes by circulant MinHash, banding and exact Jaccard verification.

Signature: a text's distinct k-word shingles (64-bit hashes) go through one permutation sigma of the
32-bit universe; coordinate j of the signature is ``min pi((sigma(x) + j) mod 2^32)``: the second
permutation pi is the same for all coordinates, circularly shifted by j.  ``bands`` groups of
``rows`` coordinates are the join keys.

Exact steps after banding:

1. Texts with the same shingle set (128-bit set fingerprint) are one node; copies are never paired.
2. Star links: in each band bucket all nodes are verified against one centre on their full sets.
   What a hot group of near copies mostly is falls into one component here, in linear work.
3. Buckets whose nodes still carry different labels are cut into blocks; every pair of blocks that can
   hold an unchecked pair is one unit of work, compared exactly in one task (nodes of the largest
   label are not compared among themselves).  Only links that join labels leave the task.

A link of similarity J shares no band with probability (1 - J^4)^bands: below 5e-8 at 0.8 with 32 bands, below
2e-8 at 0.85 with 24.

Defined results: null or wordless texts have no shingles, are linked with nothing and kept; fewer than
k words make one shingle; repeated rows are linked like other copies; a null doc_id never names a
component unless all its rows have null ids (then component_id is null and the row is kept).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwise.llm.common import components, id_text, materialise, prepare
from layerwise.llm.textnp import chunks, mix64, shingle_sets, text_buffer

U32, U64 = np.uint32, np.uint64
BLOCK = 256      # nodes in a block of a bucket
SLAB = 4096      # shingles compared at once


def _perm32(x: np.ndarray, seed: int) -> np.ndarray:
    """A permutation of the 32-bit universe (xor-shifts and odd multiplications)."""
    x = x ^ U32(seed)
    x = x ^ (x >> U32(16))
    x = x * U32(0x7FEB352D)
    x = x ^ (x >> U32(15))
    x = x * U32(0x846CA68B)
    return x ^ (x >> U32(16))


def circulant_signature(h: np.ndarray, starts: np.ndarray, n_coord: int, seed: int = 7) -> np.ndarray:
    """(texts, n_coord) minima; ``starts`` are the first shingles of texts with a non-empty set."""
    sig = np.empty((len(starts), n_coord), dtype=U32)
    if not len(starts):
        return sig
    sigma = _perm32((h ^ (h >> U64(32))).astype(U32), 0x2545F491 + seed)
    for j in range(n_coord):
        sig[:, j] = np.minimum.reduceat(_perm32(sigma + U32(j), 0x1B873593 + seed), starts)
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(sig), bands), dtype=U64)
    for b in range(bands):
        acc = np.full(len(sig), b + 1, dtype=U64)
        for r in range(rows):
            acc = mix64(acc * U64(0x9E3779B97F4A7C15) + sig[:, b * rows + r].astype(U64))
        keys[:, b] = acc
    return keys


def _fingerprints(h: np.ndarray, so: np.ndarray) -> np.ndarray:
    """(texts, 2) order-free 128-bit fingerprints of the sets."""
    out = np.zeros((len(so) - 1, 2), dtype=U64)
    for c, salt in enumerate((0x51ED270B, 0xB5297A4D)):
        s = np.zeros(len(h) + 1, dtype=U64)
        np.cumsum(mix64(h + U64(salt)), dtype=U64, out=s[1:])
        out[:, c] = mix64(s[so[1:]] - s[so[:-1]] + U64(salt))
    return out


def _binary16(fp: np.ndarray, valid: np.ndarray) -> pa.Array:
    n = len(fp)
    offs = np.arange(n + 1, dtype=np.int32) * 16
    arr = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offs), pa.py_buffer(np.ascontiguousarray(fp).tobytes())])
    return pa.compute.if_else(pa.array(valid), arr, pa.scalar(None, pa.binary()))


def _list_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def signatures(docs: DataFrame, k: int = 5, bands: int = 24, rows: int = 4) -> DataFrame:
    """(doc_id, n_shingles, node, keys): node is the set fingerprint, null for an empty set."""
    def run(batches):
        import pyarrow.compute  # noqa: F401
        for batch in batches:
            ids = batch.column(0)
            buf, off = text_buffer(batch.column(1))
            for a, b in chunks(off):
                h, so = shingle_sets(buf[off[a]:off[b]], off[a:b + 1] - off[a], k)
                n = np.diff(so)
                full = n > 0
                keys = np.zeros((b - a, bands), dtype=U64)
                keys[full] = band_keys(circulant_signature(h, so[:-1][full], bands * rows), bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(n.astype(np.int64)), _binary16(_fingerprints(h, so), full),
                     _list_array(keys.ravel(), np.arange(b - a + 1) * bands)],
                    names=["doc_id", "n_shingles", "node", "keys"])
    return id_text(docs).mapInArrow(run, "doc_id long, n_shingles long, node binary, keys array<long>")


def shingle_table(docs: DataFrame, k: int) -> DataFrame:
    """(node, shingles): each text's whole set of shingle hashes."""
    def run(batches):
        import pyarrow.compute  # noqa: F401
        for batch in batches:
            buf, off = text_buffer(batch.column(0))
            for a, b in chunks(off):
                h, so = shingle_sets(buf[off[a]:off[b]], off[a:b + 1] - off[a], k)
                yield pa.RecordBatch.from_arrays(
                    [_binary16(_fingerprints(h, so), np.diff(so) > 0), _list_array(h, so)], names=["node", "shingles"])
    return docs.select(F.col("text").cast("string")).mapInArrow(run, "node binary, shingles array<long>")


class _Forest:
    def __init__(self, names):
        self.up = {x: x for x in names}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _shared_counts(sets: list[np.ndarray], left: int) -> np.ndarray:
    """counts[i, j] = |set i & set j| for i < left and all j, by products of 0/1 slabs."""
    sizes = np.array([len(s) for s in sets])
    who = np.repeat(np.arange(len(sets)), sizes)
    values, cols, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = seen[cols] > 1
    number = np.cumsum(seen > 1) - 1
    cols, who = number[cols[keep]], who[keep]
    order = np.argsort(cols, kind="stable")
    cols, who = cols[order], who[order]
    out = np.zeros((left, len(sets)))
    top = int(cols[-1]) + 1 if len(cols) else 0
    for s in range(0, top, SLAB):
        a, b = np.searchsorted(cols, [s, s + SLAB])
        m = np.zeros((len(sets), min(SLAB, top - s)), dtype=np.float32)
        m[who[a:b], cols[a:b] - s] = 1
        out += m[:left] @ m.T
    return out


def _unit_links(members, num, den):
    """Links between different labels inside one unit: [(label, label)] that join them.

    members: (side, label, shingles); side 0 is compared with itself and with side 1."""
    members.sort(key=lambda m: m[0])
    left = sum(1 for m in members if m[0] == 0)
    if not left or len({m[1] for m in members}) < 2:
        return []
    sizes = np.array([len(m[2]) for m in members])
    shared = _shared_counts([m[2] for m in members], left)
    union = sizes[:left, None] + sizes[None, :] - shared
    forest, out = _Forest({m[1] for m in members}), []
    for i, j in zip(*np.nonzero(den * shared >= num * union)):
        if members[i][1] != members[j][1] and forest.join(members[i][1], members[j][1]):
            out.append((members[i][1], members[j][1]))
    return out


def _unit_runner(num, den):
    def run(batches):
        unit, members = None, []

        def done():
            links = _unit_links(members, num, den)
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.binary()),
                                               pa.array([x[1] for x in links], pa.binary())], names=["a", "b"])
        for batch in batches:
            cols = [batch.column(i) for i in range(5)]
            key, i_, j_, side, label = (c.to_pylist() for c in cols)
            sh = batch.column(5)
            values, offs = sh.values.to_numpy(zero_copy_only=False).view(np.uint64), sh.offsets.to_numpy()
            for r in range(batch.num_rows):
                now = (key[r], i_[r], j_[r])
                if now != unit:
                    if len(members) > 1:
                        yield done()
                    unit, members = now, []
                members.append((side[r], label[r], values[offs[r]:offs[r + 1]].copy()))
        if len(members) > 1:
            yield done()
    return run


def _exact_links(spark, members: DataFrame, sets: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """Label pairs linked inside band buckets that star links left with several labels."""
    m = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    per_label = m.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    per_key = per_label.groupBy("key").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("total"),
                                           F.count(F.lit(1)).alias("labels")).filter("labels > 1")
    per_key = per_key.select("key", F.col("top.label").alias("main"), F.col("top.n").alias("n_main"),
                             (F.col("total") - F.col("top.n")).alias("n_rest"))
    m = m.join(per_key, "key")
    rest_blocks = F.ceil(F.col("n_rest") / BLOCK).cast("int")
    main_blocks = F.ceil(F.col("n_main") / BLOCK).cast("int")
    is_main = F.col("label") == F.col("main")
    h = F.xxhash64("node")
    m = m.withColumn("rb", rest_blocks).withColumn("mb", main_blocks).withColumn("is_main", is_main) \
        .withColumn("blk", F.when(is_main, F.col("rb") + F.pmod(h, F.col("mb"))).otherwise(F.pmod(h, F.col("rb"))).cast("int"))
    # units (i, j), i a block of the rest, j >= i a block of the rest or of the main label
    own = F.when(F.col("is_main"), F.sequence(F.lit(0), F.col("rb") - 1)) \
        .otherwise(F.sequence(F.lit(0), F.col("rb") + F.col("mb") - 1))
    m = m.select("key", "node", "label", "blk", F.explode(own).alias("other"))
    m = m.select("key", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"),
                 F.when(F.col("blk") <= F.col("other"), 0).otherwise(1).alias("side"), "label", "node")
    m = m.join(sets, "node").select("key", "i", "j", "side", "label", "shingles")
    m = m.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return m.mapInArrow(_unit_runner(num, den), "a binary, b binary")


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, bands: int = 32, rows: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row: classes of texts linked by
    ``den * |A & B| >= num * |A | B|``, named by their smallest doc_id."""
    spark = docs.sparkSession
    prepare(spark)
    sig = materialise(spark, signatures(docs, k, bands, rows), "nd-sig")
    nodes = sig.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"))
    nodes = materialise(spark, nodes, "nd-nodes")
    keyed = nodes.select("node", "n", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("centre")).filter("c > 1")
    members = materialise(spark, keyed.join(shared, "key").select("key", "node", "n", "centre"), "nd-members", small=True)

    wanted = members.select("node").distinct().join(nodes.select("node", "rep"), "node").select("rep").distinct()
    texts = docs.select("doc_id", "text").join(wanted, docs["doc_id"].eqNullSafe(wanted["rep"]), "left_semi")
    sets = materialise(spark, shingle_table(texts, k).filter("node is not null").dropDuplicates(["node"]), "nd-sets")

    pairs = members.filter("node <> centre").select("node", "centre", "n").distinct() \
        .join(nodes.select(F.col("node").alias("centre"), F.col("n").alias("nc")), "centre") \
        .filter(den * F.least("n", "nc") >= num * F.greatest("n", "nc"))
    pairs = pairs.join(sets, "node").withColumnRenamed("shingles", "s") \
        .join(sets.select(F.col("node").alias("centre"), F.col("shingles").alias("sc")), "centre")
    both = F.size(F.array_intersect("s", "sc"))
    links = pairs.filter(den * both >= num * (F.col("n") + F.col("nc") - both)) \
        .select(F.col("node").alias("a"), F.col("centre").alias("b"))
    labels = materialise(spark, components(spark, materialise(spark, links, "nd-links", small=True)), "nd-labels", small=True)

    more = materialise(spark, _exact_links(spark, members.select("key", "node"), sets, labels, num, den).distinct(), "nd-more", small=True)
    merged = components(spark, more).select(F.col("node").alias("label"), F.col("label").alias("top"))
    every = members.select("node").distinct().join(labels, "node", "left") \
        .withColumn("label", F.coalesce("label", "node")).join(merged, "label", "left") \
        .select("node", F.coalesce("top", "label").alias("label")).join(nodes.select("node", "rep"), "node")
    smallest = every.groupBy("label").agg(F.min("rep").alias("component"))
    named = every.join(smallest, "label").select("node", "component")
    classes = nodes.select("node", "rep").join(named, "node", "left") \
        .select(F.col("node").alias("nd"), F.coalesce("component", "rep").alias("component"))
    out = sig.join(classes, sig["node"] == classes["nd"], "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))
