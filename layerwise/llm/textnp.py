"""Numpy helpers on UTF-8 text columns of Arrow batches: words, word hashes, shingles.

Everything here works on one bounded chunk of a batch at a time (``chunks``), so a task's
memory follows ``CHUNK_BYTES`` and the longest single text, never the partition.
Hashes are polynomials mod 2^64 over random 64-bit byte codes, finished by a bit mixer; they are
the same in every task and run.  Callers that need exactness compare the bytes behind equal hashes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15 | 1)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and odd multiplications)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


@lru_cache(maxsize=1)
def byte_codes() -> np.ndarray:
    """A fixed random-looking 64-bit code for each byte value."""
    return mix64(np.arange(1, 257, dtype=np.uint64) * U64(0xA0761D6478BD642F))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) mod 2^64, kept and grown as needed."""
    key = int(base)
    p = _POWERS.get(key)
    if p is None or len(p) < n:
        size = max(n, 2 * CHUNK_BYTES)
        p = np.full(size, base, dtype=np.uint64)
        p[0] = 1
        p = np.cumprod(p, dtype=np.uint64)
        if size <= 4 * CHUNK_BYTES:  # an unusually long text does not stay in memory
            _POWERS[key] = p
    return p[:n]


def inverse(base: np.uint64) -> np.uint64:
    return U64(pow(int(base), -1, 1 << 64))


def text_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary()) if not pa.types.is_large_binary(col.type) else col
    if col.null_count:
        col = col.fill_null(b"")
    n = len(col)
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], dtype=np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Row ranges [a, b) of at most ``limit`` bytes each (one row at least)."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


def spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    return np.repeat(starts - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def class_table(excluded: list[tuple[int, int]]) -> np.ndarray:
    """True for the bytes that belong to words: all but the given inclusive ranges."""
    t = np.ones(256, dtype=bool)
    for a, b in excluded:
        t[a:b + 1] = False
    return t


LOWER = lower_table()
SPACE_WORDS = class_table([(0x20, 0x20), (0x09, 0x0D)])
ALNUM_WORDS = class_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def words(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """(starts, ends, word_offsets): byte ranges of the words of each text, and the range of word
    numbers of each text.  ``offsets`` start at 0; words never cross texts."""
    n = len(buf)
    mask = table[buf]
    prev = np.empty(n, dtype=bool)
    nxt = np.empty(n, dtype=bool)
    if n:
        prev[0], prev[1:] = False, mask[:-1]
        nxt[-1], nxt[:-1] = False, mask[1:]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        prev[inner] = False
        nxt[inner - 1] = False
    starts = np.flatnonzero(mask & ~prev)
    ends = np.flatnonzero(mask & ~nxt) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_hash(buf: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """P[i] = sum of code(byte j) * base^j for j < i, mod 2^64."""
    out = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(byte_codes()[buf] * powers(base, len(buf)), dtype=np.uint64, out=out[1:])
    return out


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """Hash of each byte range; equal bytes give equal hashes wherever they stand."""
    inv = powers(inverse(base), len(prefix))
    return mix64((prefix[ends] - prefix[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hash(prefix_hash(buf), starts, ends)


def exact_names(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray | None = None) -> np.ndarray:
    """A number for each byte range, the same for equal bytes and only for those (hashes, then bytes)."""
    if not len(starts):
        return np.zeros(0, np.int64)
    hashes = word_hashes(buf, starts, ends) if hashes is None else hashes
    _, first, name = np.unique(hashes, return_index=True, return_inverse=True)
    lens, twin = ends - starts, first[name]
    if np.array_equal(lens, lens[twin]) and np.array_equal(buf[spread(starts, lens)], buf[spread(starts[twin], lens)]):
        return name
    seen: dict[bytes, int] = {}  # two different words share a hash
    return np.array([seen.setdefault(buf[a:b].tobytes(), len(seen)) for a, b in zip(starts, ends)], dtype=np.int64)


SHINGLE_BASE = U64(0xC2B2AE3D27D4EB4F | 1)


def shingle_hashes(wh: np.ndarray, k: int) -> np.ndarray:
    """Hash of words i..i+k-1 for every i (text borders are the caller's matter)."""
    m = len(wh) - k + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    acc = wh[:m].copy()
    for j in range(1, k):
        acc = acc * SHINGLE_BASE + wh[j:j + m]
    return mix64(acc + U64(k))


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int, table: np.ndarray = SPACE_WORDS):
    """(hashes, set_offsets): each text's distinct k-word shingle hashes, ascending, and its range.

    A text of fewer words (but not none) has its whole word sequence as one shingle."""
    low = LOWER[buf]
    starts, ends, wo = words(low, offsets, table)
    wh = word_hashes(low, starts, ends)
    n_words = np.diff(wo)
    n_sh = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
    so = np.zeros(len(n_sh) + 1, dtype=np.int64)
    np.cumsum(n_sh, out=so[1:])
    doc = np.repeat(np.arange(len(n_sh)), n_sh)
    at = np.arange(so[-1]) - so[doc] + wo[doc]
    sh = shingle_hashes(wh, k)
    h = np.empty(len(at), dtype=np.uint64)
    full = n_words[doc] >= k
    h[full] = sh[at[full]]
    for d in np.flatnonzero((n_words > 0) & (n_words < k)):
        m = int(n_words[d])
        h[so[d]] = shingle_hashes(wh[wo[d]:wo[d] + m], m)[0]
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), dtype=bool)
    if len(h) > 1:
        keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[keep], doc[keep]
    return h, np.searchsorted(doc, np.arange(len(n_sh) + 1))
