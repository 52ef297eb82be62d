"""Removal of every byte covered by a ``length``-byte string that also starts elsewhere in the corpus.

1. Anchors.  Every window of ``length`` bytes is owned by its smallest gram (a 32-byte gram hash, leftmost on
   ties), so equal windows have their owners at the same offset.  An anchor is a gram position with the run of
   consecutive windows it owns; there are about two per 170 bytes.  Only (document, position, gram
   hash, hash of the owned bytes) is shuffled.
2. Gram groups are counted with partial aggregation.  An anchor alone in its group repeats nothing.  Where all
   owned byte strings of a group are equal, all its bytes repeat.  The others are undecided.
3. Undecided anchors bring their owned bytes together by gram.  In a task, the suffixes that start at the owned
   windows are sorted by a mergesort whose comparisons take the common extension of two suffixes from
   prefix polynomial hashes by binary search; neighbours that share ``length`` bytes are repeats, and
   every one is verified byte by byte (a collision sorts the batch again under another base).
   Groups above ``hot_group`` anchors never meet in one task: their windows are counted by a
   128-bit hash with partial aggregation instead.
4. Intervals are joined back to the documents and merged.

Defined results: a null text is empty; texts shorter than ``length`` bytes lose nothing; repeated rows are
elsewhere to each other, so they lose everything that long; null ids are joined like others.  A row is known by its id and
128 bits of its text's SHA-256, and rows that share both by one set of anchors, so their work grows with their number.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwise.llm.common import id_text, materialise, prepare
from layerwise.llm.textnp import BASE, byte_codes, chunks, mix64, prefix_hash, range_hash, spread, text_buffer

U64 = np.uint64
LENGTH = 200
GRAM = 32
HOT_GROUP = 20_000
SEGMENT = 4 << 20           # longest stretch of one text handled at once
BASES = [BASE, U64(0xD1B54A32D192ED03), U64(0x8CB92BA72F3D8DD7), U64(0xAEF17502108EF2D9)]
BATCH_ROWS = 8000


# ------------------------------------------------------------------ anchors

def gram_hashes(buf: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes (a power of two) from each position, by doubling."""
    h, step, base = byte_codes()[buf], 1, int(BASE)
    while step < k:
        h = h[:-step] * U64(base) + h[step:]
        step, base = step * 2, base * base % (1 << 64)
    return mix64(h)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i : i + w]) for each i."""
    step = 1
    while step * 2 <= w:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[:len(x) - (w - step)], x[w - step:]) if w > step else x


def anchor_runs(buf: np.ndarray, off: np.ndarray, length: int, k: int):
    """(text, anchor, first window, last window, gram hash, owned-bytes hash) of every anchor.

    Positions are those of ``buf``; texts are cut at ``off``."""
    lens = np.diff(off)
    starts = spread(off[:-1], np.maximum(lens - length + 1, 0))
    if not len(starts):
        z = np.zeros(0, np.int64)
        return z, z, z, z, z.astype(U64), z.astype(U64)
    text = np.repeat(np.arange(len(lens)), np.maximum(lens - length + 1, 0))
    h = gram_hashes(buf, k)
    low = U64((1 << 24) - 1)
    key = (h & ~low) | np.arange(len(h), dtype=U64)  # leftmost on ties
    q = (sliding_min(key, length - k + 1)[starts] & low).astype(np.int64)
    new = np.ones(len(q), dtype=bool)
    new[1:] = (q[1:] != q[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    q, text, first = q[at], text[at], starts[at]
    last = starts[np.append(at[1:], len(starts)) - 1]
    owned = range_hash(prefix_hash(buf), first, last + length) ^ mix64((q - first).astype(U64) + U64(1))
    return text, q, first, last, h[q], owned


def segments(off: np.ndarray, length: int):
    """(row, start, stop) stretches of at most SEGMENT windows; only long texts have several."""
    for a, b in chunks(off):
        if b - a > 1 or off[b] - off[a] <= SEGMENT:
            yield a, b, int(off[a]), int(off[b])
        else:
            for s in range(int(off[a]), max(int(off[b]) - length + 1, int(off[a]) + 1), SEGMENT):
                yield a, b, s, min(s + SEGMENT + length - 1, int(off[b]))


def _pack(q, first, last):
    """Window start and stop and the anchor in one long: first (40 bits), anchor and last from it (12 bits each)."""
    return (first << 24) | ((q - first) << 12) | (last - first)


def _unpack(at: np.ndarray):
    first = at >> 24
    return first + ((at >> 12) & 4095), first, first + (at & 4095)


def _anchor_runner(length, k):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            mark = batch.column(1)
            buf, off = text_buffer(batch.column(2))
            id_np = np.array([0 if x is None else x for x in ids], dtype=np.int64)
            null = np.array([x is None for x in ids], dtype=bool)
            for a, b, lo, hi in segments(off, length):
                cuts = np.clip(off[a:b + 1], lo, hi) - lo
                text, q, first, last, g, e = anchor_runs(buf[lo:hi], cuts, length, k)
                row, base = a + text, lo - off[a + text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(id_np[row], mask=null[row]), mark.take(pa.array(row)), pa.array(_pack(q + base, first + base, last + base)),
                     pa.array(g.view(np.int64)), pa.array(e.view(np.int64))], names=["doc_id", "mark", "at", "g", "e"])
    return run


# ------------------------------------------------------------------ suffix sort

class Suffixes:
    """Suffixes of a buffer compared on their first ``length`` bytes by prefix hashes."""

    def __init__(self, buf: np.ndarray, length: int, base: np.uint64):
        from layerwise.llm.textnp import inverse, powers
        self.buf, self.length = buf, length
        self.prefix = prefix_hash(buf, base)
        self.inv = powers(inverse(base), len(self.prefix))
        raw = np.concatenate([buf, np.zeros(8, np.uint8)]).tobytes()
        self.word = np.ndarray(shape=len(buf) + 1, dtype=">u8", buffer=raw, strides=(1,)).astype(U64)

    def _same(self, x, y, n):
        return (self.prefix[x + n] - self.prefix[x]) * self.inv[x] == (self.prefix[y + n] - self.prefix[y]) * self.inv[y]

    def same(self, x, y):
        return self._same(x, y, self.length)

    def extension(self, x, y):
        """Longest common prefix below ``length`` of suffixes known to differ: binary search on prefix hashes."""
        lo, hi = np.zeros(len(x), np.int64), np.full(len(x), self.length - 1)
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            ok = self._same(x, y, mid)
            lo, hi = np.where(ok, mid, lo), np.where(ok, hi, mid - 1)
        return lo

    def less(self, x, y, or_equal):
        """x < y, or x <= y where ``or_equal``."""
        out = or_equal.copy()
        d = np.flatnonzero(~self.same(x, y))
        n = self.extension(x[d], y[d])
        out[d] = self.buf[x[d] + n] < self.buf[y[d] + n]
        return out

    def equal_bytes(self, x, y):
        ok = np.ones(len(x), dtype=bool)
        for j in range(0, self.length - 7, 8):
            ok &= self.word[x + j] == self.word[y + j]
        return ok & (self.word[x + self.length - 8] == self.word[y + self.length - 8])

    def merge_sort(self, items: np.ndarray, seg_start: np.ndarray, seg_size: np.ndarray) -> np.ndarray:
        """Sort each segment of ``items`` (suffix starts): runs of 1, 2, 4, ... are merged, all pairs of runs at once,
        an item's place being its own plus the number of smaller items in the sibling run."""
        place = np.arange(len(items)) - seg_start
        width = 1
        top = int(seg_size.max()) if len(items) else 0
        while width < top:
            i = np.flatnonzero(seg_size > width)
            p, size, base = place[i], seg_size[i], seg_start[i]
            block = p // (2 * width) * (2 * width)
            left = p - block < width
            lo = base + np.where(left, np.minimum(block + width, size), block)
            hi = base + np.where(left, np.minimum(block + 2 * width, size), block + width)
            run0, x = lo.copy(), items[i]
            while True:
                open_ = np.flatnonzero(lo < hi)
                if not len(open_):
                    break
                mid = (lo[open_] + hi[open_]) >> 1
                before = self.less(items[mid], x[open_], ~left[open_])  # equal items keep the left run first
                lo[open_] = np.where(before, mid + 1, lo[open_])
                hi[open_] = np.where(before, hi[open_], mid)
            own = p - block - np.where(left, 0, width)
            out = items.copy()
            out[base + block + own + (lo - run0)] = x
            items = out
            width *= 2
        return items


def repeated_windows(flat: np.ndarray, off: np.ndarray, group: np.ndarray, rel: np.ndarray, length: int) -> np.ndarray:
    """For rows of owned bytes (row i is flat[off[i]:off[i + 1]], its anchor at ``rel[i]``): a flag for every window
    of every row, row after row, True where an equal window stands in another row or copy."""
    n_win = np.diff(off) - length + 1
    win_off = np.concatenate([[0], np.cumsum(n_win)])
    for base in BASES:
        suf = Suffixes(flat, length, base)
        flags = np.zeros(int(win_off[-1]), dtype=bool)
        # equal rows of a group are one: all their windows repeat
        h = range_hash(suf.prefix, off[:-1], off[1:], base) ^ mix64(rel.astype(U64) + U64(7))
        order = np.lexsort((h, group))
        same = (group[order][1:] == group[order][:-1]) & (h[order][1:] == h[order][:-1])
        head = np.concatenate([[True], ~same])
        rep = np.empty(len(h), dtype=np.int64)
        rep[order] = order[np.flatnonzero(head)][np.cumsum(head) - 1]
        lens = np.diff(off)
        if not (np.array_equal(lens, lens[rep]) and np.array_equal(rel, rel[rep])
                and np.array_equal(flat[spread(off[:-1], lens)], flat[spread(off[:-1][rep], lens)])):
            continue
        copies = np.bincount(rep, minlength=len(h))
        distinct = np.flatnonzero(copies > 0)
        crowd = np.bincount(np.unique(group, return_inverse=True)[1][distinct])
        gi = np.unique(group, return_inverse=True)[1]
        todo = distinct[crowd[gi[distinct]] > 1]
        # suffixes at the owned windows; only those at one distance from the anchor can be equal
        starts = spread(off[:-1][todo], n_win[todo])
        row = np.repeat(todo, n_win[todo])
        part = (gi[row] << 13) | (rel[row] - (starts - off[row]))
        order = np.lexsort((suf.word[starts], part))
        tie = (part[order][1:] == part[order][:-1]) & (suf.word[starts[order]][1:] == suf.word[starts[order]][:-1])
        head = np.flatnonzero(np.concatenate([[True], ~tie])) if len(order) else np.zeros(0, np.int64)
        size = np.diff(np.append(head, len(order)))
        keep = np.repeat(size > 1, size)
        items, size = order[keep], size[size > 1]
        seg = np.cumsum(size) - size
        number = np.empty(len(flat) + 1, dtype=np.int64)
        number[starts] = np.arange(len(starts))
        sorted_ = suf.merge_sort(starts[items], np.repeat(seg, size), np.repeat(size, size))
        inner = np.ones(len(sorted_), dtype=bool)
        inner[seg] = False
        j = np.flatnonzero(inner)
        j = j[suf.same(sorted_[j - 1], sorted_[j])]
        if not suf.equal_bytes(sorted_[j - 1], sorted_[j]).all():
            continue
        hit = np.zeros(len(starts), dtype=bool)
        hit[number[sorted_[j - 1]]] = True
        hit[number[sorted_[j]]] = True
        flags[spread(win_off[:-1][todo], n_win[todo])] = hit
        full = copies[rep] > 1
        flags = flags[spread(win_off[:-1][rep], n_win)]
        return flags | np.repeat(full, n_win)
    raise RuntimeError("every base collided")


# ------------------------------------------------------------------ undecided anchors

def _body_runner(length):
    """Owned bytes of undecided anchors; 128-bit window hashes instead for those of hot groups."""
    def run(batches):
        for batch in batches:
            buf, off = text_buffer(batch.column(2))
            ids, mark = batch.column(0), batch.column(1)
            parts = []
            for column in (3, 4):
                lists = batch.column(column)
                n = np.diff(lists.offsets.to_numpy())
                at = lists.flatten().to_numpy(zero_copy_only=False)
                parts.append((np.repeat(np.arange(batch.num_rows), n), at))
            (row, at), (hot_row, hot_at) = parts
            for s in range(0, len(at), BATCH_ROWS):
                r, (q, first, last) = row[s:s + BATCH_ROWS], _unpack(at[s:s + BATCH_ROWS])
                lens = last + length - first
                body = buf[spread(off[r] + first, lens)]
                bo = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
                gram = range_hash(prefix_hash(body), bo[:-1] + q - first, bo[:-1] + q - first + GRAM)
                arr = pa.Array.from_buffers(pa.binary(), len(r), [None, pa.py_buffer(bo), pa.py_buffer(np.ascontiguousarray(body))])
                yield _body_batch(ids, mark, r, gram.view(np.int64), np.zeros(len(r), np.int64), at[s:s + BATCH_ROWS], arr)
            for s in range(0, len(hot_at), BATCH_ROWS):
                r, (q, first, last) = hot_row[s:s + BATCH_ROWS], _unpack(hot_at[s:s + BATCH_ROWS])
                lens = last + length - first
                body = buf[spread(off[r] + first, lens)]
                bo = np.cumsum(lens) - lens
                n = last - first + 1
                w = spread(bo, n)
                h1, h2 = (range_hash(prefix_hash(body, b), w, w + length, b).view(np.int64) for b in BASES[:2])
                start = spread(first, n)
                yield _body_batch(ids, mark, np.repeat(r, n), h1, h2, start, pa.nulls(len(w), pa.binary()))
    return run


def _body_batch(ids, mark, row, key1, key2, at, body):
    take = pa.array(row)
    return pa.RecordBatch.from_arrays([ids.take(take), mark.take(take), pa.array(key1), pa.array(key2), pa.array(at), body],
                                      names=["doc_id", "mark", "key1", "key2", "at", "body"])


def _window_runner(length):
    """Rows sorted by gram: whole groups together -> repeated intervals."""
    def solve(table):
        flat, off = text_buffer(table.column("body"))
        at = table.column("at").to_numpy()
        q, first, last = _unpack(at)
        group = table.column("key1").to_numpy()
        flags = repeated_windows(flat, off, group, q - first, length)
        n = last - first + 1
        row = np.repeat(np.arange(len(at)), n)[flags]
        start = spread(first, n)[flags]
        new = np.ones(len(start), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (start[1:] > start[:-1] + length)
        i = np.flatnonzero(new)
        stop = start[np.append(i[1:], len(start)) - 1] + length if len(i) else start
        take = pa.array(row[i])
        return pa.RecordBatch.from_arrays([pa.concat_arrays(table.column(c).chunks).take(take) if len(i) else pa.array([], table.schema.field(c).type)
                                           for c in ("doc_id", "mark")] + [pa.array(start[i]), pa.array(stop)],
                                          names=["doc_id", "mark", "start", "stop"])

    def run(batches):
        held = None
        for batch in batches:
            for s in range(0, batch.num_rows, BATCH_ROWS):
                part = pa.Table.from_batches([batch.slice(s, BATCH_ROWS)])
                held = part if held is None else pa.concat_tables([held, part])
                key = held.column("key1").to_numpy()
                whole = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
                if whole >= BATCH_ROWS:
                    yield solve(held.slice(0, whole))
                    held = held.slice(whole)
        if held is not None and held.num_rows:
            yield solve(held)
    return run


# ------------------------------------------------------------------ result

def _cut_runner():
    def run(batches):
        for batch in batches:
            buf, off = text_buffer(batch.column(1))
            spans = batch.column(2).to_pylist()
            out = [[], [], [], [], []]
            for d in range(batch.num_rows):
                raw = buf[off[d]:off[d + 1]].tobytes()
                runs = []
                for s, e in sorted((x["start"], x["stop"]) for x in spans[d] or ()):
                    if runs and s <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], e)
                    else:
                        runs.append([s, e])
                kept, at = [], 0
                for s, e in runs:
                    kept.append(raw[at:s])
                    at = e
                kept = b"".join([*kept, raw[at:]])
                for c, v in zip(out, (len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), [x for r in runs for x in r])):
                    c.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(c, t) for c, t in zip(out, types)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])
    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot_group: int = HOT_GROUP) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed) of every row; ``removed`` holds the
    borders of the removed byte runs."""
    spark = docs.sparkSession
    prepare(spark)
    texts = id_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .select("doc_id", F.substring(F.unhex(F.sha2("text", 256)), 1, 16).alias("mark"), "text")
    anchors = texts.mapInArrow(_anchor_runner(length, GRAM), "doc_id long, mark binary, at long, g long, e long")
    groups = anchors.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("e").alias("e0"), F.max("e").alias("e1")).filter("n > 1")
    groups = groups.select(F.col("g").alias("gg"), F.when(F.col("e0") == F.col("e1"), 0).when(F.col("n") <= hot_group, 1).otherwise(2).alias("kind"))
    decided = anchors.join(groups, F.col("g") == F.col("gg")).groupBy("doc_id", "mark").agg(
        *[F.collect_set(F.when(F.col("kind") == k, F.col("at"))).alias(c) for k, c in enumerate(("whole", "open", "hot"))])
    decided = materialise(spark, decided, "sd-anchors")

    todo = decided.filter("size(open) + size(hot) > 0").select(F.col("doc_id").alias("t_id"), F.col("mark").alias("t_mark"), "open", "hot")
    bodies = texts.join(todo, texts["doc_id"].eqNullSafe(todo["t_id"]) & (texts["mark"] == todo["t_mark"])) \
        .select("doc_id", "mark", "text", "open", "hot") \
        .mapInArrow(_body_runner(length), "doc_id long, mark binary, key1 long, key2 long, at long, body binary")
    bodies = materialise(spark, bodies, "sd-bodies")
    spans = bodies.filter("body is not null").repartition("key1").sortWithinPartitions("key1") \
        .mapInArrow(_window_runner(length), "doc_id long, mark binary, start long, stop long")
    hot = bodies.filter("body is null")
    seen = hot.groupBy("key1", "key2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    hot = hot.join(seen, ["key1", "key2"]).select("doc_id", "mark", F.col("at").alias("start"), (F.col("at") + length).alias("stop"))
    first = F.shiftright("x", 24)
    whole = decided.select("doc_id", "mark", F.explode("whole").alias("x")) \
        .select("doc_id", "mark", first.alias("start"), (first + F.col("x").bitwiseAND(4095) + length).alias("stop"))
    spans = spans.unionByName(hot).unionByName(whole).groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    spans = materialise(spark, spans, "sd-spans").select(F.col("doc_id").alias("s_id"), F.col("mark").alias("s_mark"), "spans")
    joined = texts.join(spans, texts["doc_id"].eqNullSafe(spans["s_id"]) & (texts["mark"] == spans["s_mark"]), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        _cut_runner(), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<long>")
