"""The join against a comparison of all pairs, with regions so small that every level of the recursion is reached."""

import random

import numpy as np
import pytest

from helpers import AWKWARD, collect, frame, sentence
from layerwise.llm import ngram_join as J
from test_near_dup import brute, sets


def expected(rows, num):
    """(doc_id, size of its 4-word set, component)."""
    import test_near_dup
    five = test_near_dup.sets
    test_near_dup.sets = lambda r: five(r, 4)
    try:
        return sorted((x[:3] for x in brute(rows, num)), key=str)
    finally:
        test_near_dup.sets = five


def edited(base, seed, share):
    rnd = random.Random(seed)
    return " ".join(f"new{rnd.randint(0, 10 ** 9)}" if rnd.random() < share else x for x in base.split())


@pytest.mark.parametrize("num", [80, 85])
def test_awkward_rows(spark, num):
    got = collect(J.ngram_join(frame(spark), num=num), "doc_id", "n_shingles", "component_id")
    assert got == expected(AWKWARD, num)


def test_large_regions_are_cut_into_cells_and_blocks(spark, monkeypatch):
    for name, value in (("REGION", 6), ("CUTS", 3), ("PIVOTS", 3), ("LEAF", 4)):
        monkeypatch.setattr(J, name, value)
    calls = []
    split = J.split_regions
    monkeypatch.setattr(J, "split_regions", lambda *a: calls.append(1) or split(*a))
    base = sentence(90, 4)
    rows = [(500 - i, edited(base, i, (0, .005, .01, .02, .04)[i % 5])) for i in range(120)]
    rows += [(1000 + i, "licence line " * 3 + sentence(14, 100) + " " + sentence(12, i)) for i in range(40)]
    got = collect(J.ngram_join(frame(spark, rows), num=85), "doc_id", "n_shingles", "component_id")
    want = expected(rows, 85)
    assert got == want and calls
    assert 20 < len({c for _, _, c in want}) < 150


def test_links_in_memory():
    """All links between labels of a region, through cells, equal those of all pairs."""
    base = sentence(150, 7)
    rows = [(i, edited(base if i % 3 else sentence(150, 8), i, (0, .003, .01, .02)[i % 4])) for i in range(260)]
    hashed = [np.array(sorted(hash(g) & (2 ** 63 - 1) for g in s), dtype=np.uint64) for s in sets(rows, 4)]
    for left in (260, 40):
        side = np.array([0] * left + [1] * (260 - left))
        links = J.region_links(hashed, list(range(260)), side, 85, 100)
        forest, want = J._Forest(range(260)), J._Forest(range(260))
        for a, b in links:
            forest.join(a, b)
        for i in range(left):
            for j in range(260):
                both = len(np.intersect1d(hashed[i], hashed[j]))
                if 100 * both >= 85 * (len(hashed[i]) + len(hashed[j]) - both):
                    want.join(i, j)
        assert [forest.find(i) for i in range(260)] == [want.find(i) for i in range(260)]


def test_pivots_of_linked_sets_meet():
    rnd = np.random.default_rng(1)
    level = rnd.integers(0, 9, J.BUCKETS).astype(np.uint8)
    linked = 0
    for _ in range(3000):
        n = int(rnd.integers(1, 80))
        a = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rnd.random(len(a)) > .08], rnd.integers(0, 1 << 63, int(rnd.integers(0, 4))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(a) != both or len(b) != both:
            linked += 100 * both >= 85 * (len(a) + len(b) - both)
        else:
            continue  # equal sets are one node
        if len(b) and 100 * both >= 85 * (len(a) + len(b) - both):
            keys, off = J.region_keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), level, 85, 100)
            assert len(np.intersect1d(keys[:off[1]], keys[off[1]:]))
    assert linked > 300


def test_empty_table(spark):
    assert J.ngram_join(frame(spark, []).limit(0)).count() == 0


def written(monkeypatch):
    """(name, column types, rows, plan) of the tables that a join writes from here on."""
    tables, write = [], J.materialise

    def noted(spark, df, name, small=False):
        out = write(spark, df, name, small)
        if name in ("nj-sets", "nj-nodes", "nj-regions", "nj-texts"):
            tables.append((name, {t for _, t in out.dtypes}, out.count(), df._jdf.queryExecution().executedPlan().toString()))
        return out
    monkeypatch.setattr(J, "materialise", noted)
    return tables


def test_what_is_written_and_exchanged(spark, monkeypatch):
    """No table keeps the pivots or sets of all texts, pivots are exchanged once, and only texts that share a pivot are read again."""
    tables = written(monkeypatch)
    rows = [(i, sentence(200, 50 + i)) for i in range(60)]
    rows += [(200 + i, edited(sentence(200, 50 + i), i, .01)) for i in range(6)]
    got = collect(J.ngram_join(frame(spark, rows), num=85), "doc_id", "n_shingles", "component_id")
    assert got == expected(rows, 85)
    assert not [name for name, types, _, _ in tables if any(t.startswith("array") for t in types)]
    found = {name: (n, plan) for name, _, n, plan in tables}
    assert found["nj-texts"][0] < 30
    plan = found["nj-regions"][1].split("Initial Plan")[-1]
    assert "MapInArrow" in plan and "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_repeated_ids_and_shared_names(spark, monkeypatch):
    """Copies under one id, ids with several texts, nodes whose rows all lack an id; a filter that lets all pass, names of two bits first."""
    tables = written(monkeypatch)
    monkeypatch.setattr(J, "ID_BITS", 64)
    monkeypatch.setattr(J, "NAME_BITS", (2, 64))
    base = [sentence(100, s) for s in (21, 22, 23)]
    rows = [(5, base[0])] * 9 + [(5, base[1]), (5, edited(base[1], 1, .01)), (7, edited(base[0], 2, .01)), (3, base[0].upper())]
    rows += [(None, base[2])] * 4 + [(None, edited(base[2], 3, .01))] + [(9, base[2] + " more")] + [(None, None), (None, "")]
    got = collect(J.ngram_join(frame(spark, rows), num=85), "doc_id", "n_shingles", "component_id")
    assert got == expected(rows, 85)
    assert sum(name == "nj-nodes" for name, *_ in tables) == 2
