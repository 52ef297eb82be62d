import hashlib

import pytest

from helpers import ALNUM_WORD, AWKWARD, UP, collect, frame, sentence
from layerwise.llm.decontam import contamination, item_blocks

ITEMS = [(1, " ".join(AWKWARD[0][1].split()[20:45])), (2, "four words ONLY"), (3, None), (4, "..."), (None, AWKWARD[10][1][:200]), (5, "one"),
         (6, sentence(12, 77)), (1, sentence(15, 5)), (7, "only here")]


def brute(rows, items, n=10):
    wins = {}
    for i, t in items:
        w = ALNUM_WORD.findall((t or "").translate(UP))
        for j in range(max(1, len(w) - n + 1) if w else 0):
            wins.setdefault(tuple(w[j:j + n]), set()).update([] if i is None else [str(i)])
    out = []
    for d, t in rows:
        w = ALNUM_WORD.findall((t or "").translate(UP))
        hit, ids = set(), set()
        for k, v in wins.items():
            for p in range(len(w) - len(k) + 1):
                if tuple(w[p:p + len(k)]) == k:
                    hit.update(range(p, p + len(k)))
                    ids |= v
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("block", [8 << 20, 200])
def test_awkward_rows_in_one_and_many_blocks(spark, block):
    items = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, doc_id int")
    got = collect(contamination(frame(spark), items, block_bytes=block), *COLUMNS)
    assert got == brute(AWKWARD, ITEMS)


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contamination(frame(spark, []).limit(0), items).count() == 0
    got = collect(contamination(frame(spark), items.limit(0)), *COLUMNS)
    assert got == brute(AWKWARD, [])


def test_repeated_items_do_not_swell_a_block(spark):
    items = spark.createDataFrame(ITEMS + [(6, ITEMS[6][1])] * 500 + [(None, None)] * 20, "item_id long, text string")
    assert collect(contamination(frame(spark), items), *COLUMNS) == brute(AWKWARD, ITEMS)
    blocks = list(item_blocks(items, 200))
    assert sorted(map(str, (x for b in blocks for x in b))) == sorted(str(x) for x in ITEMS if x[1] is not None)
