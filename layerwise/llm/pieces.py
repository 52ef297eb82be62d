"""SentencePiece (BPE) encoding and decoding by suffix-array matching.

A batch's text is cut at word borders (no piece crosses from a non-blank to a blank), its distinct units are
concatenated and indexed by a suffix array (ordered by eight bytes, the rest is compared), and every
piece of the vocabulary is binary-searched for its range of occurrences.  The ranges, sorted by position, are the edges of all units at once.

Relaxation: the model is a BPE model, so a unit starts as its characters and the best-scored edge
that spans two neighbouring tokens (leftmost on ties) replaces them, until no edge spans any two; this
is done for all units of a length together.  Characters without a piece become byte pieces.
Long units go through the same steps with a heap.  The ids equal the library's for the model.

Decoding concatenates the pieces' bytes and drops the blank that encoding puts in front.

Defined results: a null text gives null ids, an empty one no ids; the round trip is exact but for the character U+2581,
which the model itself reads as a blank; repeated rows each get their row.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwise.llm.common import id_text, prepare
from layerwise.llm.textnp import CHUNK_BYTES, chunks, prefix_hash, range_hash, spread, text_buffer

U64 = np.uint64
BLANK = "▁"
NO_RANK = np.iinfo(np.int64).max
MATRIX_CHARS = 40
DEPTH = 16          # bytes compared as words; longer pieces compare the rest one by one
DISTINCT_CHUNK = CHUNK_BYTES
NEW_BYTES = 1 << 17         # unknown units indexed at once: each byte has several edges of five words


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Piece bytes, merge ranks and the sorted search keys of a SentencePiece model file."""

    def __init__(self, path: str | None = None):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path or default_model())
        self.size = sp.get_piece_size()
        self.bytes: list[bytes] = [b""] * self.size
        self.byte_id = np.zeros(256, dtype=np.int32)
        normal = []
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.bytes[i] = piece.replace(BLANK, " ").encode()
                normal.append(i)
        score = np.array([sp.get_score(i) for i in normal])
        rank = np.searchsorted(np.unique(-score), -score)  # equal scores share a rank
        order = sorted(range(len(normal)), key=lambda j: self.bytes[normal[j]])
        self.ids = np.array([normal[j] for j in order], dtype=np.int32)
        self.rank = rank[order].astype(np.int64)
        self.length = np.array([len(self.bytes[i]) for i in self.ids], dtype=np.int64)
        cut = lambda b, at, fill: int.from_bytes((b[at:at + 8] + fill * 8)[:8], "big")
        every = [self.bytes[i] for i in self.ids]
        self.low = np.array([cut(b, 0, b"\0") for b in every], dtype=U64)
        self.high = np.array([cut(b, 0, b"\xff") for b in every], dtype=U64)
        self.next_word = np.array([cut(b, 8, b"\0") for b in every], dtype=U64)
        self.next_mask = np.array([cut(b"\xff" * (len(b) - 8), 0, b"\0") if len(b) > 8 else 0 for b in every], dtype=U64)
        self.digest = hashlib.sha256(repr((self.bytes, score.tolist())).encode()).hexdigest()
        self.max_len = int(self.length.max())


class Edges:
    """Occurrences of all pieces in a buffer, sorted by position and length."""

    def __init__(self, vocab: Vocabulary, buf: np.ndarray):
        """buf: bytes in which 0xFF separates units."""
        n = len(buf)
        raw = np.concatenate([buf, np.full(vocab.max_len + 16, 0xFF, np.uint8)]).tobytes()
        sa = np.flatnonzero((buf & 0xC0) != 0x80)
        sa = sa[buf[sa] != 0xFF]
        word = np.ndarray(shape=n + 8, dtype=">u8", buffer=raw, strides=(1,)).astype(U64)
        sa = sa[np.argsort(word[sa])]
        first = word[sa]
        lo = np.searchsorted(first, vocab.low, side="left")
        hi = np.searchsorted(first, vocab.high, side="right")
        count = np.maximum(hi - lo, 0)
        piece = np.repeat(np.arange(len(count)), count)
        pos = sa[spread(lo, count)]
        deep = vocab.length[piece] > 8
        if deep.any():
            ok = (word[pos + 8] & vocab.next_mask[piece]) == (vocab.next_word[piece] & vocab.next_mask[piece])
            piece, pos = piece[ok], pos[ok]
        long_ones = np.flatnonzero(vocab.length[piece] > DEPTH)
        if len(long_ones):
            drop = [k for k in long_ones.tolist() if not raw.startswith(vocab.bytes[vocab.ids[piece[k]]], int(pos[k]))]
            keep = np.ones(len(piece), dtype=bool)
            keep[drop] = False
            piece, pos = piece[keep], pos[keep]
        key = (pos << 6) | vocab.length[piece]
        order = np.argsort(key)  # keys are distinct
        self.key, self.piece = key[order], piece[order]

    def find(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Piece number of each byte range, -1 where it is no piece."""
        if not len(self.key):
            return np.full(np.shape(start), -1, dtype=np.int64)
        want = (start << 6) | np.minimum(end - start, 63)
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where((self.key[at] == want) & (end - start < 63), self.piece[at], -1)


def split_units(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of the units of texts that each begin with a blank: a blank after a non-blank opens one."""
    blank = buf == 0x20
    prev = np.empty(len(buf), dtype=bool)
    if len(buf):
        prev[0], prev[1:] = False, blank[:-1]
        prev[off[:-1][off[:-1] < len(buf)]] = False
    return np.flatnonzero(blank & ~prev)


def distinct_units(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(first occurrence of each distinct unit, number of the distinct unit of each unit); bytes are compared."""
    h = range_hash(prefix_hash(buf), starts, ends)
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    lens = ends - starts
    within = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
    twin = first[inverse]
    same = np.array_equal(lens, lens[twin]) and np.array_equal(
        buf[np.repeat(starts, lens) + within], buf[np.repeat(starts[twin], lens) + within])
    if not same:  # two different units share a hash: treat every unit as its own
        return np.arange(len(starts)), np.arange(len(starts))
    return first, inverse


def joined_units(buf, starts, ends):
    """The units' bytes, 0xFF after each, and their new starts."""
    lens = ends - starts
    new = np.cumsum(lens + 1) - (lens + 1)
    out = np.full(int((lens + 1).sum()), 0xFF, dtype=np.uint8)
    within = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
    out[np.repeat(new, lens) + within] = buf[np.repeat(starts, lens) + within]
    return out, new


def _relax_matrix(edges: Edges, vocab: Vocabulary, bounds: np.ndarray):
    """bounds: (units, L + 1) token borders of units of L characters -> [(unit rows, borders)] when settled."""
    rows = np.arange(len(bounds))

    def ranks(b0, b2):
        p = edges.find(b0, b2)
        return np.where(p >= 0, vocab.rank[p], NO_RANK)
    score = ranks(bounds[:, :-2], bounds[:, 2:])
    while True:
        at = np.argmin(score, axis=1) if score.shape[1] else np.zeros(len(rows), dtype=np.int64)
        live = score[np.arange(len(rows)), at] < NO_RANK if score.shape[1] else np.zeros(len(rows), dtype=bool)
        if not live.all():
            yield rows[~live], bounds[~live]
        if not live.any():
            return
        rows, bounds, score, at = rows[live], bounds[live], score[live], at[live]
        cols = np.arange(bounds.shape[1] - 1)[None, :]
        bounds = np.take_along_axis(bounds, cols + (cols >= at[:, None] + 1), axis=1)
        cols = np.arange(score.shape[1] - 1)[None, :]
        score = np.take_along_axis(score, cols + (cols >= at[:, None] + 1), axis=1)
        if not score.shape[1]:
            continue
        last = score.shape[1] - 1
        i = np.arange(len(rows))
        left, right = np.maximum(at - 1, 0), np.minimum(at, last)
        for j in (left, right):
            score[i, j] = ranks(bounds[i, j], bounds[i, j + 2])


def _relax_long(edges: Edges, vocab: Vocabulary, bounds: np.ndarray) -> np.ndarray:
    """The same for one long unit: a heap of (rank, left token) over linked tokens."""
    b = bounds.tolist()
    n = len(b) - 1
    nxt, prv, end = list(range(1, n + 1)), list(range(-1, n - 1)), b[1:]
    found = edges.find(bounds[:-2], bounds[2:])
    heap = [(int(vocab.rank[p]), i, b[i + 2]) for i, p in enumerate(found.tolist()) if p >= 0]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or nxt[i] >= n or end[nxt[i]] != stop:
            continue
        j = nxt[i]
        alive[j], end[i], nxt[i] = False, end[j], nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
        for left in (prv[i], i):
            if left >= 0 and nxt[left] < n:
                e = end[nxt[left]]
                p = int(edges.find(np.array([b[left]]), np.array([e]))[0])
                if p >= 0:
                    heapq.heappush(heap, (int(vocab.rank[p]), left, e))
    return np.array([b[i] for i in range(n) if alive[i]] + [b[n]])


def encode_units(vocab: Vocabulary, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(ids, offsets): the ids of each unit; ``buf`` is the output of ``joined_units``."""
    edges = Edges(vocab, buf)
    chars = np.flatnonzero((buf & 0xC0) != 0x80)
    c0, c1 = np.searchsorted(chars, starts), np.searchsorted(chars, ends)
    n_chars = c1 - c0
    unit_of, token_start, token_end = [], [], []

    def done(units, b):
        unit_of.append(np.repeat(units, b.shape[1] - 1))
        token_start.append(b[:, :-1].ravel())
        token_end.append(b[:, 1:].ravel())
    for size in np.unique(n_chars[n_chars <= MATRIX_CHARS]):
        units = np.flatnonzero(n_chars == size)
        b = np.concatenate([chars[c0[units][:, None] + np.arange(size)[None, :]], ends[units][:, None]], axis=1)
        for rows, settled in _relax_matrix(edges, vocab, b):
            done(units[rows], settled)
    for u in np.flatnonzero(n_chars > MATRIX_CHARS).tolist():
        done(np.array([u]), _relax_long(edges, vocab, np.append(chars[c0[u]:c1[u]], ends[u]))[None, :])
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    unit, ts, te = cat(unit_of), cat(token_start), cat(token_end)
    piece = edges.find(ts, te)
    n_ids = np.where(piece >= 0, 1, te - ts)  # a character without a piece: one id a byte
    order = np.lexsort((ts, unit))
    unit, ts, piece, n_ids = unit[order], ts[order], piece[order], n_ids[order]
    t = np.repeat(np.arange(len(ts)), n_ids)
    within = np.arange(len(t)) - np.repeat(np.cumsum(n_ids) - n_ids, n_ids)
    ids = np.where(piece[t] >= 0, vocab.ids[piece[t]], vocab.byte_id[buf[ts[t] + within]]).astype(np.int32)
    per_unit = np.bincount(unit, weights=n_ids, minlength=len(starts)).astype(np.int64)
    return ids, np.concatenate([[0], np.cumsum(per_unit)])


def with_blank(col: pa.Array) -> pa.Array:
    """Nulls as empty texts; others with the blank in front that the model adds."""
    col = pc.fill_null(col, "")
    col = pc.replace_substring(col, BLANK, " ")
    return pc.if_else(pc.equal(pc.binary_length(col), 0), "", pc.binary_join_element_wise(" ", col, ""))


class UnitCache:
    """Units already worked out in this partition: bytes and ids (or other values) by hash, emptied at ``LIMIT`` bytes."""

    LIMIT = 16 << 20

    def __init__(self, dtype=np.int32):
        self.dtype = dtype
        self.clear()

    @property
    def n_bytes(self) -> int:
        return sum(x.nbytes for x in (self.hash, self.row, self.text, self.text_off, self.ids, self.ids_off))

    def clear(self):
        self.hash = np.zeros(0, dtype=U64)
        self.row = np.zeros(0, dtype=np.int64)
        self.text, self.text_off = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.ids_off = np.zeros(0, self.dtype), np.zeros(1, np.int64)

    def find(self, h: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Row of each unit, -1 for unknown ones; bytes are compared behind equal hashes."""
        out = np.full(len(h), -1, dtype=np.int64)
        if not len(self.hash):
            return out
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        hit = np.flatnonzero(self.hash[at] == h)
        row = self.row[at[hit]]
        lens = (ends - starts)[hit]
        same = lens == self.text_off[row + 1] - self.text_off[row]
        hit, row, lens = hit[same], row[same], lens[same]
        differs = buf[spread(starts[hit], lens)] != self.text[spread(self.text_off[row], lens)]
        unequal = np.add.reduceat(differs, np.cumsum(lens) - lens) > 0 if len(hit) else np.zeros(0, bool)
        out[hit[~unequal]] = row[~unequal]
        return out

    def add(self, h, buf, starts, ends, ids, ids_off):
        rows = len(self.text_off) - 1 + np.arange(len(h))
        lens = ends - starts
        self.text = np.concatenate([self.text, buf[spread(starts, lens)]])
        self.text_off = np.concatenate([self.text_off, self.text_off[-1] + np.cumsum(lens)])
        self.ids_off = np.concatenate([self.ids_off, self.ids_off[-1] + ids_off[1:]])
        self.ids = np.concatenate([self.ids, ids])
        every, row = np.concatenate([self.hash, h]), np.concatenate([self.row, rows])
        order = np.argsort(every, kind="stable")
        self.hash, self.row = every[order], row[order]
        return rows


def blocks(lens: np.ndarray, limit: int):
    """Ranges of at most ``limit`` bytes (one unit at least)."""
    return chunks(np.concatenate([[0], np.cumsum(lens)]), limit)


def encode_chunk(vocab: Vocabulary, buf: np.ndarray, off: np.ndarray, cache: UnitCache | None = None):
    """(ids, offsets) of the texts in a chunk; each non-empty text begins with its blank."""
    starts = split_units(buf, off)
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
    cache = cache or UnitCache()
    ends = np.append(starts[1:], len(buf))
    first, inverse = distinct_units(buf, starts, ends)
    us, ue = starts[first], ends[first]
    h = range_hash(prefix_hash(buf), us, ue)
    if cache.n_bytes > cache.LIMIT:
        cache.clear()
    row = cache.find(h, buf, us, ue)
    unknown = np.flatnonzero(row < 0)
    for a, b in blocks((ue - us)[unknown], NEW_BYTES):
        new = unknown[a:b]
        joined, at = joined_units(buf, us[new], ue[new])
        row[new] = cache.add(h[new], buf, us[new], ue[new], *encode_units(vocab, joined, at, at + ue[new] - us[new]))
    row = row[inverse]
    n = cache.ids_off[row + 1] - cache.ids_off[row]
    token_off = np.concatenate([[0], np.cumsum(n)])
    return cache.ids[spread(cache.ids_off[row], n)], token_off[np.searchsorted(starts, off)]


def piece_bytes(vocab: Vocabulary):
    flat = np.frombuffer(b"".join(vocab.bytes), dtype=np.uint8)
    lens = np.array([len(b) for b in vocab.bytes])
    return flat, np.cumsum(lens) - lens, lens


def decode_ids(table, ids: np.ndarray, off: np.ndarray):
    """(bytes, offsets) of the texts that id lists stand for."""
    flat, at, lens = table
    n = lens[ids]
    out = flat[np.repeat(at[ids], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    bo = np.concatenate([[0], np.cumsum(n)])[off]
    keep = np.ones(len(out), dtype=bool)
    heads = bo[:-1][np.diff(bo) > 0]
    heads = heads[out[heads] == 0x20]
    keep[heads] = False
    return out[keep], bo - np.searchsorted(heads, bo)


def _string_array(buf: np.ndarray, off: np.ndarray) -> pa.Array:
    arr = pa.Array.from_buffers(pa.large_binary(), len(off) - 1, [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(buf))])
    return arr.cast(pa.binary())


def _encode_runner(shared):
    def run(batches):
        vocab = shared.value
        table = piece_bytes(vocab)
        cache = UnitCache()
        for batch in batches:
            ids, every = batch.column(0), batch.column(1)
            _, size = text_buffer(every)
            for a, b in chunks(size, DISTINCT_CHUNK):
                text = every.slice(a, b - a)
                want = text_buffer(pc.replace_substring(pc.fill_null(text, ""), BLANK, " "))
                tok, to = encode_chunk(vocab, *text_buffer(with_blank(text)), cache)
                lists = pa.ListArray.from_arrays(pa.array(to.astype(np.int32)), pa.array(tok))
                ok = pc.equal(_string_array(*decode_ids(table, tok, to)), _string_array(*want))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pc.if_else(text.is_null(), pa.scalar(None, lists.type), lists), ok], names=["doc_id", "ids", "round_trip"])
    return run


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids, round_trip) of every row; ``round_trip`` says that decoding gives the text again."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(model))  # bounded by the model file
    return id_text(docs).mapInArrow(_encode_runner(shared), "doc_id long, ids array<int>, round_trip boolean")


def _decode_runner(shared):
    def run(batches):
        table = piece_bytes(shared.value)
        for batch in batches:
            lists = batch.column(1)
            flat = pc.fill_null(lists.flatten(), 0).to_numpy(zero_copy_only=False)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            off = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            text = _string_array(*decode_ids(table, flat, off))
            text = pc.if_else(lists.is_null(), pa.scalar(None, pa.binary()), text)
            yield pa.RecordBatch.from_arrays([batch.column(0), text], names=["doc_id", "text"])
    return run


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, text) of every row of encoded(doc_id, ids); null ids give a null text."""
    prepare(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(model))
    return encoded.select("doc_id", "ids").mapInArrow(_decode_runner(shared), "doc_id long, text binary") \
        .select("doc_id", F.col("text").cast("string").alias("text"))
