"""Jaccard join of n-gram sets in metric space: pivots, Voronoi regions, triangle-inequality windows, recursion.

Jaccard distance (1 - |A & B| / |A | B|) is a metric.  Most documents share nothing with a given document and lie at distance 1
from it, where a pivot separates nothing, so the levels of pivots differ:

1. Pivots of two shingles.  All shingles have one order, rare ones first; two shingles that follow each other in a document's order
   are a pivot, and all documents in whose order they follow each other are its region.  Documents that are not
   alike hardly share such pivots, though they share shingles.  A document goes to the regions of its first L - 1
   pivots, L = 2 (1 - t) n + 2 for n shingles and similarity t, and each link lies in some region: the two documents' common shingles
   are parted, in one order or the other, only by shingles that one of them lacks; as long as all pairs of
   neighbours among the common ones are parted, the i-th common shingle stands at place i + u or before, u being what the
   other one lacks, and the first pair that is not parted ends at place 2 u + v + 2 or before (v: what this one lacks), which is
   L at most.  (Rarity comes from counts in ``BUCKETS`` hash buckets; any order is exact, rare ones first keep regions small.)
2. The smallest document of each region is its pivot.  All distances to pivots of like size are computed on full sets and
   documents within the radius are linked: what a group of near copies mostly is becomes one component here, in linear
   work.  Regions whose documents are all in one component are done; the others' documents are gathered by pivot.
3. A region that still holds several components is left with its outsiders and those of its largest component whose
   distance to the pivot differs from an outsider's by at most the radius (triangle inequality), where both are known.  Copies of the
   same component need no comparison, they are linked already.
4. Above ``REGION`` outsiders, several of them become pivots and cut the region into Voronoi cells.  A document is copied into each cell
   whose pivot is at most two radii farther than its nearest: of a linked pair the one meets the other in its cell.
   Cells are regions again.  A region that its pivots do not part (a cell would keep almost all of it) is cut into blocks instead, each
   pair of blocks one unit.
5. Regions up to ``REGION`` are joined exactly in one task, by the same cells in memory.

Texts with equal sets (128-bit fingerprints) are one node throughout, named by 64 bits; where two sets share these, all names are
taken again with another salt.  Distances come from 64-bit shingle hashes.  What tasks exchange are texts, about a third of
their sets' hashes, and sets are hashed where they are compared; pivots are exchanged once, by a row of two numbers each.

Defined results: null or wordless texts have an empty set and are their own component; fewer than n words make one
shingle; repeated rows are linked like other copies; a null doc_id names a component only where all its rows have null ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwise.llm.common import components, id_text, materialise, prepare
from layerwise.llm.near_dup import _fingerprints, _Forest, _shared_counts
from layerwise.llm.textnp import chunks, mix64, shingle_sets, text_buffer

U64 = np.uint64
BUCKETS = 1 << 18
REGION = 512        # documents joined in one task
CUTS = 4            # pivots that cut a larger region
PIVOTS = 16         # pivots that cut a region in memory
LEAF = 96           # documents compared pair by pair in memory
STUCK = 0.8         # a region is cut into blocks where a cell would have more of it than this
SLACK = 1e-9
UNKNOWN = -9         # step of a distance that was not computed
ID_BITS = 1 << 26   # bits of the filter of doc_ids
NAME_BITS = (64,) * 8  # bits of a node's name, for each salt


# ------------------------------------------------------------------ level 1: pairs of shingles

def _bucket_of(h: np.ndarray) -> np.ndarray:
    return (h >> U64(46)).astype(np.int64)


def _bucket_runner(k):
    def run(batches):
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            buf, off = text_buffer(batch.column(0))
            for a, b in chunks(off):
                h, _ = shingle_sets(buf[off[a]:off[b]], off[a:b + 1] - off[a], k)
                counts += np.bincount(_bucket_of(h), minlength=BUCKETS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])
    return run


def rarity_levels(spark: SparkSession, docs: DataFrame, k: int):
    """A broadcast byte for each bucket: the logarithm of its count over the mean (0 up to the mean)."""
    rows = docs.select(F.col("text").cast("string")).mapInArrow(_bucket_runner(k), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = materialise(spark, rows, "nj-buckets", small=True).toArrow()  # at most BUCKETS rows
    counts = np.zeros(BUCKETS)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    mean = max(counts.sum() / BUCKETS, 1.0)
    level = np.minimum(np.floor(4 * np.log2(np.maximum(counts / mean, 1.0))), 255).astype(np.uint8)
    return spark.sparkContext.broadcast(level)


def region_keys(h: np.ndarray, so: np.ndarray, level: np.ndarray, num: int, den: int):
    """(keys, offsets): each text's first pivots, pairs of neighbours in the order of its shingles."""
    n = np.diff(so)
    text = np.repeat(np.arange(len(n)), n)
    key = (level[_bucket_of(h)].astype(U64) << U64(55)) | (h & U64((1 << 55) - 1))
    key = key[np.lexsort((key, text))]
    place = np.arange(len(h)) - np.repeat(so[:-1], n)
    last = np.minimum(2 * n * (den - num) // den + 2, n) - 1  # place of the last shingle that counts
    head = np.flatnonzero(place < last[text])
    keys = mix64(mix64(key[head]) + key[np.minimum(head + 1, len(key) - 1)])
    return keys, np.searchsorted(text[head], np.arange(len(n) + 1))


def node_names(h: np.ndarray, so: np.ndarray, salt: int, bits: int):
    """(names, others): 64 bits of each set's fingerprint (``bits`` of them kept), and what tells sets of one name apart."""
    fp = _fingerprints(h, so)
    name = fp[:, 0] ^ mix64(fp[:, 1] + U64(salt))
    return (name & U64((1 << bits) - 1)).view(np.int64), fp[:, 1].copy().view(np.int64)


def _node_runner(k, salt, bits):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            buf, off = text_buffer(batch.column(1))
            for a, b in chunks(off):
                h, so = shingle_sets(buf[off[a]:off[b]], off[a:b + 1] - off[a], k)
                n = np.diff(so)
                name, other = node_names(h, so, salt, bits)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(name, mask=n == 0), pa.array(other, mask=n == 0)],
                    names=["doc_id", "n_shingles", "node", "other"])
    return run


def named_nodes(spark: SparkSession, docs: DataFrame, k: int):
    """every(doc_id, n_shingles, node), node null for an empty set; nodes(node, rep, n), rep the smallest doc_id; (salt, bits) of the names."""
    for name in enumerate(NAME_BITS):
        every = id_text(docs).mapInArrow(_node_runner(k, *name), "doc_id long, n_shingles long, node long, other long")
        every = materialise(spark, every, "nj-sets", small=True)
        nodes = every.filter("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n"), (F.min("other") != F.max("other")).alias("mixed"))
        nodes = materialise(spark, nodes, "nj-nodes", small=True)
        if nodes.filter("mixed").isEmpty():
            return every.drop("other"), nodes.drop("mixed"), name
    raise RuntimeError("sets share their names with every salt")


def id_filter(spark: SparkSession, ids: DataFrame):
    """A broadcast filter of fixed size of the ids (column ``doc_id``); it lets few others pass."""
    rows = ids.select(_id_bit().alias("bit")).select(F.shiftright("bit", 6).alias("at"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("word")) \
        .groupBy("at").agg(F.bit_or("word").alias("word"))
    found = materialise(spark, rows, "nj-filter", small=True).toArrow()  # at most ID_BITS / 64 rows
    held = np.zeros(ID_BITS // 64, dtype=U64)
    held[found["at"].to_numpy()] = found["word"].to_numpy().view(U64)
    return spark.sparkContext.broadcast(held)


def _id_bit():
    return F.xxhash64("doc_id").bitwiseAND(F.lit(ID_BITS - 1))


def _picked_sets(batches, k, held, salt, bits):
    """(texts, hashes, offsets, names) of the non-empty sets of the rows (bit, text) that the filter lets pass, each once in a task."""
    seen = set()
    for batch in batches:
        bit = batch.column(0).to_numpy().view(U64)
        batch = batch.take(pa.array(np.flatnonzero((held.value[(bit >> U64(6)).astype(np.int64)] >> (bit & U64(63))) & U64(1))))
        buf, off = text_buffer(batch.column(1))
        for a, b in chunks(off):
            h, so = shingle_sets(buf[off[a]:off[b]], off[a:b + 1] - off[a], k)
            name, _ = node_names(h, so, salt, bits)
            new = np.zeros(b - a, dtype=bool)
            new[np.unique(name, return_index=True)[1]] = True
            new &= np.diff(so) > 0
            new[new] = [x not in seen for x in name[new].tolist()]
            seen.update(name[new].tolist())
            yield batch.column(1).slice(a, b - a), h, so, name, new


def _key_runner(k, num, den, level, held, salt, bits):
    def run(batches):
        for _, h, so, name, new in _picked_sets(batches, k, held, salt, bits):
            h, n = h[np.repeat(new, np.diff(so))], np.diff(so)[new]
            keys, off = region_keys(h, np.concatenate([[0], np.cumsum(n)]), level.value, num, den)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(name[new], np.diff(off))), pa.array(keys.view(np.int64))], names=["node", "region"])
    return run


def _text_runner(k, held, salt, bits):
    def run(batches):
        for text, _, _, name, new in _picked_sets(batches, k, held, salt, bits):
            yield pa.RecordBatch.from_arrays([pa.array(name[new]), text.filter(pa.array(new))], names=["node", "text"])
    return run


def _picked_rows(spark, docs: DataFrame, reps: DataFrame):
    """What the runners above read: the filter of the smallest doc_ids (``rep``) and the documents' rows (bit, text)."""
    held = id_filter(spark, reps.select(F.col("rep").alias("doc_id")))
    return held, id_text(docs).select(_id_bit().alias("bit"), "text")


def shared_pivots(spark: SparkSession, docs: DataFrame, nodes: DataFrame, k: int, num: int, den: int, name) -> DataFrame:
    """(node, region, pivot, c) for the pairs of shingles that several nodes have, the smallest node is the pivot, c the rows: one
    for each node, or more where a doc_id repeats.  The pairs are exchanged once; counts and rows are read from the same exchange."""
    level = rarity_levels(spark, docs, k)
    held, rows = _picked_rows(spark, docs, nodes)
    keyed = rows.mapInArrow(_key_runner(k, num, den, level, held, *name), "node long, region long").repartition("region")
    shared = keyed.groupBy("region").agg(F.min("node").alias("pivot"), F.max("node").alias("last"), F.count(F.lit(1)).alias("c")).filter("pivot <> last").drop("last")
    return materialise(spark, keyed.join(shared.hint("shuffle_hash"), "region"), "nj-regions", small=True)


def node_texts(spark: SparkSession, docs: DataFrame, wanted: DataFrame, k: int, name) -> DataFrame:
    """(node, text), one text of each wanted(node, rep)."""
    held, rows = _picked_rows(spark, docs, wanted)
    texts = rows.mapInArrow(_text_runner(k, held, *name), "node long, text string").repartition("node")
    return materialise(spark, texts.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "nj-texts")


# ------------------------------------------------------------------ distances

def _distance_runner(k):
    def run(batches):
        for batch in batches:
            (buf, off), (buf_p, off_p) = text_buffer(batch.column(2)), text_buffer(batch.column(3))
            for a, b in chunks(off + off_p):
                h, so = shingle_sets(buf[off[a]:off[b]], off[a:b + 1] - off[a], k)
                hp, sp = shingle_sets(buf_p[off_p[a]:off_p[b]], off_p[a:b + 1] - off_p[a], k)
                both = np.array([len(np.intersect1d(h[so[i]:so[i + 1]], hp[sp[i]:sp[i + 1]], assume_unique=True)) for i in range(b - a)], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(both),
                                                  pa.array(np.diff(so) + np.diff(sp) - both)], names=["node", "pivot", "both", "union"])
    return run


def distances(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(node, pivot, both, union) of pairs(node, pivot), from their full sets."""
    joined = pairs.join(texts, "node").join(texts.select(F.col("node").alias("pivot"), F.col("text").alias("text_p")), "pivot")
    return joined.select("node", "pivot", "text", "text_p").mapInArrow(_distance_runner(k), "node long, pivot long, both long, union long")


def open_regions(spark: SparkSession, regions: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of regions of more than two documents with several labels."""
    tagged = regions.filter("c > 2").select("region", "node", "pivot").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    several = tagged.groupBy("region").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least <> most").select("region")
    return tagged.join(several, "region")


def star_distances(spark: SparkSession, regions: DataFrame, nodes: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(node, pivot, both, union) of all documents and their regions' pivots of like size."""
    pairs = regions.filter("node <> pivot").select("node", "pivot").distinct().join(nodes.select("node", "n"), "node") \
        .join(nodes.select(F.col("node").alias("pivot"), F.col("n").alias("n_pivot")), "pivot")
    alike = den * F.least("n", "n_pivot") >= num * F.greatest("n", "n_pivot")
    return materialise(spark, distances(pairs.filter(alike).select("node", "pivot"), texts, k), "nj-distances", small=True)


# ------------------------------------------------------------------ level 3 and on

def _cells(sets, rows, dist_limit, rng):
    """Voronoi cells of the sets in ``rows``: lists of rows, each with the borders' copies."""
    pivots = rng.choice(rows, size=min(PIVOTS, len(rows)), replace=False)
    rest = np.setdiff1d(rows, pivots)
    every = np.concatenate([pivots, rest])
    shared = _shared_counts([sets[i] for i in every], len(pivots))
    size = np.array([len(sets[i]) for i in every])
    dist = 1 - shared / (size[:len(pivots), None] + size[None, :] - shared)
    near = dist <= dist.min(axis=0) + 2 * dist_limit + SLACK
    return [every[near[i]] for i in range(len(pivots))]


def region_links(sets, labels, side, num: int, den: int):
    """Links that join different labels of a region: [(label, label)].  Rows of side 1 are not compared with each other."""
    forest, out = _Forest(set(labels)), []
    radius, rng = 1 - num / den, np.random.default_rng(len(sets))

    def compare(rows):
        rows = rows[np.argsort(side[rows], kind="stable")]
        left = int((side[rows] == 0).sum())
        if not left or len(rows) < 2:
            return
        size = np.array([len(sets[i]) for i in rows])
        shared = _shared_counts([sets[i] for i in rows], left)
        for i, j in zip(*np.nonzero(den * shared >= num * (size[:left, None] + size[None, :] - shared))):
            a, b = labels[rows[i]], labels[rows[j]]
            if a != b and forest.join(a, b):
                out.append((a, b))

    def join(rows):
        if len({forest.find(labels[i]) for i in rows}) < 2 or not (side[rows] == 0).any():
            return
        if len(rows) <= LEAF:
            return compare(rows)
        cells = _cells(sets, rows, radius, rng)
        if max(len(c) for c in cells) > STUCK * len(rows):
            return compare(rows)
        for c in cells:
            join(c)
    join(np.arange(len(sets)))
    return out


def _region_runner(k, num, den):
    def run(batches):
        unit, members = None, []

        def done():
            side = np.array([m[0] for m in members])
            links = region_links([m[2] for m in members], [m[1] for m in members], side, num, den)
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            side, label = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            buf, off = text_buffer(batch.column(5))
            for a, b in chunks(off):
                h, so = shingle_sets(buf[off[a]:off[b]], off[a:b + 1] - off[a], k)
                for r in range(a, b):
                    if keys[r] != unit:
                        if len(members) > 1:
                            yield done()
                        unit, members = keys[r], []
                    members.append((side[r], label[r], h[so[r - a]:so[r - a + 1]].copy()))
        if len(members) > 1:
            yield done()
    return run


def several_labels(members: DataFrame, labels: DataFrame) -> DataFrame:
    """members(region, node, near) of regions with several labels, with label, whether it is the region's largest one,
    and the numbers of outsiders (``n_rest``) and of the rest (``n_main``)."""
    m = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    per_label = m.groupBy("region", "label").agg(F.count(F.lit(1)).alias("n"))
    regions = per_label.groupBy("region").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("labels")) \
        .filter("labels > 1").select("region", F.col("top.label").alias("main"), F.col("top.n").alias("n_main"), (F.col("total") - F.col("top.n")).alias("n_rest"))
    return m.join(regions, "region").withColumn("is_main", F.col("label") == F.col("main")).drop("main")


def windowed(m: DataFrame, radius: float) -> DataFrame:
    """Of a region's largest component only what an outsider may link with: its distance to the pivot (``near``) differs from
    an outsider's by at most the radius, or one of them is not known.  Outsiders' distances are kept in steps of the radius."""
    step = F.coalesce(F.floor(F.col("near") / (radius + 1e-6)), F.lit(UNKNOWN))  # distances that differ by the radius are in one step or in neighbours
    out = m.filter("not is_main").groupBy("region").agg(F.collect_set(step).alias("steps"))  # at most 1 / radius + 1 numbers
    kept = m.join(out, "region").withColumn("at", step)
    window = F.arrays_overlap("steps", F.array(F.col("at") - 1, F.col("at"), F.col("at") + 1, F.lit(UNKNOWN))) | (F.col("at") == UNKNOWN)
    return kept.filter(~F.col("is_main") | window).drop("steps", "at")


def split_regions(spark, large: DataFrame, texts: DataFrame, k: int, radius: float) -> DataFrame:
    """members(region, node, near, stuck): Voronoi cells of regions with many outsiders, or the region itself where no cell is smaller."""
    drawn = F.pmod(F.xxhash64("node", "region"), F.greatest(F.lit(1), F.floor(F.col("n_rest") / (16 * CUTS)))) == 0  # about 16 * CUTS
    pivots = large.filter("not is_main").groupBy("region").agg(F.min("node").alias("first"), F.collect_set(F.when(drawn, F.col("node"))).alias("drawn"))
    pivots = pivots.select("region", F.array_union(F.array("first"), F.slice(F.array_sort("drawn"), 1, CUTS - 1)).alias("pivots"))
    pairs = large.join(pivots, "region").select("region", "node", "near", F.explode("pivots").alias("pivot"))
    pairs = materialise(spark, pairs, "nj-pivots", small=True)
    dist = distances(pairs.select("node", "pivot").distinct(), texts, k).select("node", "pivot", (1 - F.col("both") / F.col("union")).alias("d"))
    known = pairs.join(dist, ["node", "pivot"])
    home = known.groupBy("region", "node").agg(F.min("d").alias("home"))
    cells = known.join(home, ["region", "node"]).filter(F.col("d") <= F.col("home") + 2 * radius + SLACK).select("region", "node", "pivot", "d", "near")
    cells = materialise(spark, cells, "nj-cells", small=True)
    size = cells.groupBy("region", "pivot").agg(F.count(F.lit(1)).alias("n")).groupBy("region").agg(F.max("n").alias("most"))
    parted = size.join(home.groupBy("region").agg(F.count(F.lit(1)).alias("n")), "region").select("region", (F.col("most") > STUCK * F.col("n")).alias("stuck"))
    parted = materialise(spark, parted, "nj-parted", small=True)
    return cells.join(parted.filter("not stuck"), "region").select(F.concat_ws(" ", "region", "pivot").alias("region"), "node", F.col("d").alias("near"), "stuck") \
        .unionByName(large.select("region", "node", "near").join(parted.filter("stuck"), "region"))


def units(m: DataFrame) -> DataFrame:
    """(region, i, j, side, label, node): each region's outsiders in blocks i, compared with themselves and with blocks j."""
    rest_blocks, main_blocks = F.ceil(F.col("n_rest") / REGION).cast("int"), F.ceil(F.col("n_main") / REGION).cast("int")
    h = F.xxhash64("node")
    block = F.when(F.col("is_main"), rest_blocks + F.pmod(h, main_blocks)).otherwise(F.pmod(h, rest_blocks)).cast("int")
    other = F.when(F.col("is_main"), F.sequence(F.lit(0), rest_blocks - 1)).otherwise(F.sequence(F.lit(0), rest_blocks + main_blocks - 1))
    m = m.select("region", "node", "label", block.alias("own"), F.explode(other).alias("other"))
    return m.select("region", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "label", "node")


def recursive_links(spark, members: DataFrame, texts: DataFrame, labels: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Label pairs linked inside regions that hold several labels."""
    radius, found = 1 - num / den, []
    while True:
        m = materialise(spark, windowed(several_labels(members, labels), radius), "nj-open", small=True)
        now = m.filter((F.col("n_rest") <= REGION) | F.col("stuck"))
        u = units(now).join(texts, "node").select("region", "i", "j", "side", "label", "text")
        u = u.repartition("region", "i", "j").sortWithinPartitions("region", "i", "j").mapInArrow(_region_runner(k, num, den), "a long, b long")
        found.append(materialise(spark, u.distinct(), "nj-more", small=True))
        large = m.filter((F.col("n_rest") > REGION) & ~F.col("stuck"))
        if large.isEmpty():
            break
        members = split_regions(spark, large, texts, k, radius)
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out.distinct()


# ------------------------------------------------------------------ result

def ngram_join(docs: DataFrame, k: int = 4, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: components of texts linked by ``den * |A & B| >= num * |A | B|``,
    named by their smallest doc_id."""
    spark = docs.sparkSession
    prepare(spark)
    every, nodes, name = named_nodes(spark, docs, k)
    regions = shared_pivots(spark, docs, nodes, k, num, den, name)
    texts = node_texts(spark, docs, regions.select("node").distinct().join(nodes.select("node", "rep"), "node"), k, name)

    known = star_distances(spark, regions, nodes, texts, k, num, den)
    labels = components(spark, known.filter(den * F.col("both") >= num * F.col("union")).select(F.col("node").alias("a"), F.col("pivot").alias("b")))
    # the pivot has been compared with all of its region and is not needed any more
    members = open_regions(spark, regions, labels).filter("node <> pivot").select("pivot", "node").distinct().join(known, ["node", "pivot"], "left").select(
        F.col("pivot").cast("string").alias("region"), "node", (1 - F.col("both") / F.col("union")).alias("near"), F.lit(False).alias("stuck"))
    more = recursive_links(spark, members, texts, labels, k, num, den)
    merged = components(spark, more).select(F.col("node").alias("label"), F.col("label").alias("top"))
    final = regions.select("node").distinct().join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")) \
        .join(merged, "label", "left").select("node", F.coalesce("top", "label").alias("label")).join(nodes.select("node", "rep"), "node")
    smallest = final.groupBy("label").agg(F.min("rep").alias("component"))
    named = final.join(smallest, "label").select("node", "component")
    classes = nodes.select("node", "rep").join(named, "node", "left").select(F.col("node").alias("nd"), F.coalesce("component", "rep").alias("component"))
    out = every.join(classes, every["node"] == classes["nd"], "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))
