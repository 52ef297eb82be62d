import hashlib

import numpy as np
import pytest

from helpers import AWKWARD, collect, frame, sentence
from layerwise.llm import suffix_dedup as sd

PASSAGE = sentence(70, 42)
ROWS = AWKWARD + [(100 + i, sentence(30 + i, 200 + i) + " " + PASSAGE[i:] + " " + sentence(20, 300 + i)) for i in range(8)] + [
    (120, "ab" * 400), (121, PASSAGE[:199]), (122, "z" + PASSAGE[:200] + "y"), (123, PASSAGE[:250] + PASSAGE[:250])]


def brute(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    count = {}
    for _, b in texts:
        for p in range(len(b) - length + 1):
            k = b[p:p + length]
            count[k] = count.get(k, 0) + 1
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if count[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        runs = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [sd.HOT_GROUP, 2])
def test_awkward_rows(spark, hot):
    got = collect(sd.remove_repeats(frame(spark, ROWS), hot_group=hot), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute(ROWS, 200)


def test_empty_table(spark):
    assert sd.remove_repeats(frame(spark, []).limit(0)).count() == 0


def test_long_texts_are_cut_into_segments(monkeypatch):
    buf = np.frombuffer(sentence(3000, 8).encode(), np.uint8)
    off = np.array([0, len(buf)])
    whole = {(int(q), h) for q, h in zip(*[sd.anchor_runs(buf, off, 200, 32)[i] for i in (1, 4)])}
    monkeypatch.setattr(sd, "SEGMENT", 1000)
    monkeypatch.setattr(sd, "chunks", lambda o: [(0, 1)])
    cut, windows = set(), []
    for _, _, lo, hi in sd.segments(off, 200):
        _, q, first, last, g, _ = sd.anchor_runs(buf[lo:hi], np.array([0, hi - lo]), 200, 32)
        cut |= {(int(x) + lo, h) for x, h in zip(q, g)}
        windows += [w + lo for f, t in zip(first, last) for w in range(f, t + 1)]
    assert cut == whole and windows == list(range(len(buf) - 199))


def test_suffix_mergesort_orders_by_bytes():
    rng = np.random.default_rng(0)
    buf = rng.integers(97, 99, 4000).astype(np.uint8)
    raw = buf.tobytes()
    suf = sd.Suffixes(buf, 200, sd.BASES[0])
    items = rng.permutation(3700)[:900]
    got = suf.merge_sort(items, np.repeat([0, 400], [400, 500]), np.repeat([400, 500], [400, 500]))
    for a, b in ((0, 400), (400, 900)):
        want = sorted(items[a:b].tolist(), key=lambda i: raw[i:i + 200])
        assert [raw[i:i + 200] for i in got[a:b]] == [raw[i:i + 200] for i in want]
    x, y = items[:300], items[300:600]
    for i, j, n in zip(x, y, suf.extension(x, y)):
        assert raw[i:i + n] == raw[j:j + n] and raw[i + n] != raw[j + n]


def test_texts_of_equal_checksum_under_null_ids(spark):
    """Two texts with one crc32 and no id: only the one that stands elsewhere too is removed."""
    import zlib
    seen, i = {}, 0
    while True:
        t = sentence(2, i) + f" {i:07d} " + "abc " * 65
        c = zlib.crc32(t.encode())
        if c in seen and seen[c] != t:
            break
        seen[c], i = t, i + 1
    rows = [(None, t[:12] + str(zlib.crc32(t.encode())) * 25), (None, t), (None, seen[c]), (5, t)]
    got = collect(sd.remove_repeats(frame(spark, rows)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute(rows, 200)


def test_repeated_rows_grow_linearly(spark):
    text = sentence(60, 77)
    rows = [(None, text)] * 1500 + [(3, text)] * 1500 + [(4, sentence(60, 78))]
    out = sd.remove_repeats(frame(spark, rows)).groupBy("doc_id", "n_removed").count().collect()
    assert {(r.doc_id, r.n_removed > 0): r["count"] for r in out} == {(None, True): 1500, (3, True): 1500, (4, False): 1}
