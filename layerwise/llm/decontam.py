"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is a set of windows (``n`` consecutive words; a shorter item is one window).  Each
window's tokens are its ``s``-word shingles, ordered by rarity: how often each occurs in all documents
(one counting pass).  Since a window must be contained whole, its necessary prefix is a single token,
the rarest.  The join pass looks for those prefix tokens in the documents; the token's offset in
the window gives the position bound (the window's start and end must fall inside the document:
the length bound), and surviving candidates are verified word by word.  A text never leaves its row:
no shuffle of documents.

The benchmark is joined in blocks of at most ``block_bytes`` of item text, one broadcast index at a
time, each pass carrying the hits found so far, so a benchmark of any size is joined whole.

Defined results: a null or wordless text has no words and no hits (the hash of the empty string); null or
wordless items have no windows; an item with a null id marks words but is not counted or listed;
rows with equal item_id are one item; repeated documents each get their row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwise.llm.common import id_text, materialise, prepare
from layerwise.llm.textnp import ALNUM_WORDS, LOWER, chunks, shingle_hashes, text_buffer, word_hashes, words

BLOCK_BYTES = 8 << 20


def item_words(text: str | None) -> list[bytes]:
    buf = LOWER[np.frombuffer((text or "").encode(), dtype=np.uint8)]
    st, en, _ = words(buf, np.array([0, len(buf)]), ALNUM_WORDS)
    raw = buf.tobytes()
    return [raw[a:b] for a, b in zip(st, en)]


def _hashes_of(ws: list[bytes]) -> np.ndarray:
    buf = np.frombuffer(b" ".join(ws), dtype=np.uint8)
    lens = np.array([len(w) for w in ws])
    ends = np.cumsum(lens + 1) - 1
    return word_hashes(buf, ends - lens, ends)


class WindowIndex:
    """The distinct windows of one block of items and, after ``choose``, their prefix tokens."""

    def __init__(self, items, n: int, s: int):
        self.n, self.s = n, s
        found: dict[bytes, set] = {}
        self.window_words: list[list[bytes]] = []
        for item_id, text in items:
            ws = item_words(text)
            for i in range(max(1, len(ws) - n + 1) if ws else 0):
                w = ws[i:i + n]
                key = b" ".join(w)
                if key not in found:
                    found[key] = set()
                    self.window_words.append(w)
                if item_id is not None:
                    found[key].add(str(item_id))
        self.keys = list(found)
        self.items = [sorted(v) for v in found.values()]
        self.length = np.array([len(w) for w in self.window_words], dtype=np.int64)
        self.whole = np.zeros(len(self.keys), dtype=np.uint64)
        self.tokens: list[np.ndarray] = []
        for i, w in enumerate(self.window_words):
            wh = _hashes_of(w)
            self.whole[i] = shingle_hashes(wh, len(w))[0]
            self.tokens.append(shingle_hashes(wh, min(s, len(w))))
        sizes = sorted({min(s, int(x)) for x in self.length})
        self.by_size = {m: np.unique(np.concatenate([t for t, x in zip(self.tokens, self.length) if min(s, int(x)) == m]))
                        for m in sizes}
        del self.window_words
        self.prefix = {}

    def choose(self, counts: dict[int, np.ndarray]) -> "WindowIndex":
        """Order tokens by rarity (ties by hash) and keep each window's first one with its offset."""
        for m, vocab in self.by_size.items():
            rows = [i for i, x in enumerate(self.length) if min(self.s, int(x)) == m]
            first, offset = [], []
            for i in rows:
                t = self.tokens[i]
                c = counts[m][np.searchsorted(vocab, t)]
                o = int(np.lexsort((t, c))[0])
                first.append(t[o])
                offset.append(o)
            h = np.array(first, dtype=np.uint64)
            order = np.argsort(h, kind="stable")
            h, win, off = h[order], np.array(rows)[order], np.array(offset)[order]
            uniq, start = np.unique(h, return_index=True)
            self.prefix[m] = (uniq, np.append(start, len(h)), win, off)
        del self.tokens, self.by_size
        return self


def _member(vocab: np.ndarray, gate: np.ndarray, h: np.ndarray):
    """(positions in h, positions in vocab) of the hashes that are in the sorted vocabulary."""
    at = np.flatnonzero(gate[h >> np.uint64(44)])
    where = np.searchsorted(vocab, h[at])
    ok = vocab[np.minimum(where, len(vocab) - 1)] == h[at]
    return at[ok], where[ok]


def _gate(vocab: np.ndarray) -> np.ndarray:
    g = np.zeros(1 << 20, dtype=bool)
    g[vocab >> np.uint64(44)] = True
    return g


def _document_words(buf, off):
    low = LOWER[buf]
    st, en, wo = words(low, off, ALNUM_WORDS)
    return low, st, en, wo, word_hashes(low, st, en)


def _inside(n_words: int, wo: np.ndarray, m: int) -> np.ndarray:
    """True for the word positions whose next m words are in the same text."""
    ok = np.ones(max(n_words - m + 1, 0), dtype=bool)
    for e in wo[1:-1]:
        ok[max(e - m + 1, 0):e] = False
    return ok


def _count_runner(vocabs):
    def run(batches):
        counts = {m: np.zeros(len(v), dtype=np.int64) for m, v in vocabs.value.items()}
        gates = {m: _gate(v) for m, v in vocabs.value.items()}
        for batch in batches:
            buf, off = text_buffer(batch.column(0))
            for a, b in chunks(off):
                _, _, _, wo, wh = _document_words(buf[off[a]:off[b]], off[a:b + 1] - off[a])
                for m, v in vocabs.value.items():
                    sh = shingle_hashes(wh, m)
                    at, where = _member(v, gates[m], sh)
                    inside = np.searchsorted(wo, at, side="right") == np.searchsorted(wo, at + m - 1, side="right")
                    counts[m] += np.bincount(where[inside], minlength=len(v))
        for m, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), m)), pa.array(at), pa.array(c[at])], names=["m", "at", "c"])
    return run


def _shared(docs: DataFrame, value):
    return docs.sparkSession.sparkContext.broadcast(value)


def _rarity(docs: DataFrame, index: WindowIndex) -> dict[int, np.ndarray]:
    """Occurrences in all documents of each token of the block (at most the block's tokens return)."""
    counts = {m: np.zeros(len(v), dtype=np.int64) for m, v in index.by_size.items()}
    if counts:
        vocabs = _shared(docs, index.by_size)
        rows = docs.select("text").mapInArrow(_count_runner(vocabs), "m long, at long, c long") \
            .groupBy("m", "at").agg(F.sum("c").alias("c")).collect()
        for r in rows:
            counts[r["m"]][r["at"]] = r["c"]
        vocabs.unpersist()
    return counts


def _window_hits(idx: WindowIndex, gates, raw: bytes, st, en, wo, wh):
    """(window, first word) of every verified window occurrence, in the chunk's word numbers."""
    wins, firsts = [], []
    for m, (vocab, start, win, off) in idx.prefix.items():
        at, where = _member(vocab, gates[m], shingle_hashes(wh, m))
        n = start[where + 1] - start[where]
        p = np.repeat(at, n)
        j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[where], n)
        w, first = win[j], p - off[j]
        doc = np.searchsorted(wo, p, side="right") - 1
        ok = (first >= wo[doc]) & (first + idx.length[w] <= wo[np.minimum(doc + 1, len(wo) - 1)])
        w, first = w[ok], first[ok]
        for size in np.unique(idx.length[w]):
            same = np.flatnonzero(idx.length[w] == size)
            h = shingle_hashes_at(wh, first[same], int(size))
            same = same[h == idx.whole[w[same]]]
            for k in same.tolist():
                f, x = int(first[k]), int(w[k])
                if b" ".join([raw[a:b] for a, b in zip(st[f:f + size].tolist(), en[f:f + size].tolist())]) == idx.keys[x]:
                    wins.append(x)
                    firsts.append(f)
    return wins, firsts


def shingle_hashes_at(wh: np.ndarray, first: np.ndarray, m: int) -> np.ndarray:
    rows = wh[first[:, None] + np.arange(m)[None, :]]
    return shingle_hashes_rows(rows)


def shingle_hashes_rows(rows: np.ndarray) -> np.ndarray:
    from layerwise.llm.textnp import SHINGLE_BASE, mix64
    acc = rows[:, 0].copy()
    for j in range(1, rows.shape[1]):
        acc = acc * SHINGLE_BASE + rows[:, j]
    return mix64(acc + np.uint64(rows.shape[1]))


STATE = "hit_from array<int>, hit_to array<int>, items array<string>"
RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _join_runner(shared, last: bool):
    def run(batches):
        idx = shared.value
        gates = {m: _gate(v[0]) for m, v in idx.prefix.items()}
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            old = [c.to_pylist() for c in batch.columns[2:5]]
            buf, off = text_buffer(text)
            out = [[], [], [], [], []]
            for a, b in chunks(off):
                low, st, en, wo, wh = _document_words(buf[off[a]:off[b]], off[a:b + 1] - off[a])
                wins, firsts = _window_hits(idx, gates, low.tobytes(), st, en, wo, wh)
                per_doc: dict[int, list] = {}
                for w, f in zip(wins, firsts):
                    per_doc.setdefault(int(np.searchsorted(wo, f, side="right")) - 1, []).append((w, f))
                n_words = np.diff(wo)
                for d in range(b - a):
                    hits = per_doc.get(d, ())
                    lo = old[0][a + d] + [f - int(wo[d]) for _, f in hits]
                    hi = old[1][a + d] + [f - int(wo[d]) + int(idx.length[w]) for w, f in hits]
                    items = old[2][a + d]
                    if hits:
                        items = sorted(set(items).union(*(idx.items[w] for w in {w for w, _ in hits})))
                    if not last:
                        out[0].append(lo), out[1].append(hi), out[2].append(items)
                        continue
                    n_hit = 0
                    if lo:
                        edge = np.zeros(int(n_words[d]) + 1, dtype=np.int64)
                        np.add.at(edge, lo, 1)
                        np.add.at(edge, hi, -1)
                        n_hit = int((np.cumsum(edge) > 0).sum())
                    out[0].append(int(n_words[d])), out[1].append(n_hit), out[2].append(len(items))
                    out[3].append(hashlib.sha256(",".join(items).encode()).hexdigest()), out[4].append(n_hit > 0)
            if last:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
                yield pa.RecordBatch.from_arrays([ids] + [pa.array(c, t) for c, t in zip(out, types)],
                                                 names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
            else:
                types = (pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([ids, text] + [pa.array(c, t) for c, t in zip(out[:3], types)],
                                                 names=["doc_id", "text", "hit_from", "hit_to", "items"])
    return run


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES):
    """The benchmark in blocks of about ``block_bytes`` of text: yields lists of (item_id, text).

    Rows that repeat an item_id and text count once, so repeats do not swell one block; they are found once and written."""
    rows = items.select("item_id", F.col("text").cast("string").alias("text")).filter("text is not null").distinct()
    rows = materialise(items.sparkSession, rows, "benchmark-items", small=True)
    total = rows.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    n = int(total // block_bytes) + 1
    at = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for b in range(n):
        yield [(r["item_id"], r["text"]) for r in rows.filter(at == b).collect()]


def contamination(docs: DataFrame, items: DataFrame, n: int = 10, s: int = 5, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of ``docs``."""
    prepare(docs.sparkSession)
    base = id_text(docs)
    empty = [F.array().cast(t) for t in ("array<int>", "array<int>", "array<string>")]
    state = base.select("doc_id", "text", empty[0].alias("hit_from"), empty[1].alias("hit_to"), empty[2].alias("items"))
    shared = None
    for block in item_blocks(items, block_bytes):
        if shared is not None:
            state = state.mapInArrow(_join_runner(shared, False), f"doc_id long, text string, {STATE}")
        index = WindowIndex(block, n, s)
        shared = _shared(docs, index.choose(_rarity(base, index)))
    return state.mapInArrow(_join_runner(shared, True), RESULT)
