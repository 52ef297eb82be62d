import pytest

from helpers import AWKWARD, SPACE_WORD, UP, collect, frame, sentence
from layerwise.llm import near_dup


def sets(rows, k=5):
    out = []
    for _, t in rows:
        w = SPACE_WORD.findall((t or "").translate(UP))
        out.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    return out


def brute(rows, num):
    s = sets(rows)
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            both = len(s[i] & s[j])
            if s[i] and s[j] and 100 * both >= num * (len(s[i]) + len(s[j]) - both):
                up[find(i)] = find(j)
    name = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            name[r] = min(name.get(r, d), d)
    return sorted(((d, len(s[i]), name.get(find(i)), name.get(find(i)) is None or d == name[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("num", [80, 85])
def test_awkward_rows(spark, num):
    got = collect(near_dup.near_duplicates(frame(spark), num=num), "doc_id", "n_shingles", "component_id", "kept")
    assert got == brute(AWKWARD, num)


def test_hot_group_of_near_copies_in_blocks(spark, monkeypatch):
    """Chains of copies at and around the threshold, with blocks so small that a bucket needs many units."""
    base = sentence(60, 9).split()
    rows = []
    for i in range(90):
        w = list(base)
        for j in range(i % 5):
            w[(7 * i + 11 * j) % 60] = f"edit{i}_{j}"
        rows.append((1000 - i, " ".join(w)))
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    got = collect(near_dup.near_duplicates(frame(spark, rows), num=85), "doc_id", "n_shingles", "component_id", "kept")
    assert got == brute(rows, 85)


def test_empty_table(spark):
    assert near_dup.near_duplicates(frame(spark, []).limit(0)).count() == 0


def test_circulant_signature_shifts_one_permutation():
    import numpy as np
    h = np.arange(1, 50, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sig = near_dup.circulant_signature(h, np.array([0, 20]), 6)
    sigma = near_dup._perm32((h ^ (h >> np.uint64(32))).astype(np.uint32), 0x2545F491 + 7)
    for j in range(6):
        pi = near_dup._perm32(sigma + np.uint32(j), 0x1B873593 + 7)
        assert sig[0, j] == pi[:20].min() and sig[1, j] == pi[20:].min()
