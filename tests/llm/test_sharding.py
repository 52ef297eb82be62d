import zlib
from collections import Counter, defaultdict

import pytest

from helpers import AWKWARD, frame, sentence
from layerwise.llm import sharding


def check(rows, out, shards):
    size = Counter(r.shard for r in out)
    total = [size.get(s, 0) for s in range(shards)]
    assert sum(total) == len(rows) and max(total) - min(total) <= 1
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = sorted((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows if d is not None)
    assert want == sorted((r.doc_id, r.size, r.text_crc32) for r in out if r.doc_id is not None)
    assert {r.law for r in out} <= {"rows"} and {r.grown_shard for r in out} <= {None}


@pytest.mark.parametrize("shards", [3, 40])
def test_awkward_rows(spark, shards):
    check(AWKWARD, sharding.assign_shards(frame(spark), shards).collect(), shards)


def test_groups_stay_together_and_a_hot_group_fills_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 16)
    rows = [(i, "hot") for i in range(100)] + [(1000 + i, sentence(5, i // 4)) for i in range(80)] + [(5000 + i, sentence(9, 500 + i)) for i in range(120)]
    out = sharding.assign_shards(frame(spark, rows), 10).collect()
    check(rows, out, 10)
    text = dict(rows)
    where = defaultdict(set)
    for r in out:
        where[text[r.doc_id]].add(r.shard)
    assert len(where["hot"]) <= 5  # 100 rows, 30 to a shard
    assert sum(len(where[sentence(5, j)]) for j in range(20)) <= 24


def test_running_totals_follow_levels(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 8)
    rows = [(i % 3, f"g{i}", (i * 7) % 5 + 1) for i in range(200)]
    from pyspark.sql import functions as F
    got = sharding.running_total(spark.createDataFrame(rows, "t int, g string, m long"), "t", [-F.col("m")], ["g"], "before").collect()
    for t in range(3):
        line = sorted((r.before, r.m) for r in got if r.t == t)
        assert [m for _, m in line] == sorted((m for k, _, m in rows if k == t), reverse=True)
        assert [b for b, _ in line] == [sum(m for _, m in line[:i]) for i in range(len(line))]


def test_only_groups(spark):
    """No single documents to fill with: the excess is shed exactly."""
    rows = [(i, f"g{i % 7}") for i in range(100)]
    check(rows, sharding.assign_shards(frame(spark, rows), 9).collect(), 9)


def test_empty_table(spark):
    assert sharding.assign_shards(frame(spark, []).limit(0)).count() == 0
