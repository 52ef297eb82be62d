"""Counts of the trie against a plain counter, and whole results against plain rules."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from helpers import AWKWARD, SCHEMA, UP, collect, sentence
from layerwise.llm import collocations as C
from layerwise.llm.textnp import text_buffer


def grams(text, sizes=(1, 2, 3, 4)):
    for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UP)):
        w = re.findall(r"[^ \t]+", piece)
        for m in sizes:
            for i in range(len(w) - m + 1):
                yield " ".join(w[i:i + m])


def brute(rows, least, top, cover=80):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        f.update((lang, g) for g in grams(text))
        n.update(lang for _ in grams(text, (1,)))
    often = {k: a for k, a in f.items() if a >= least}
    longest = Counter()
    for (lang, p), a in often.items():
        w = p.split(" ")
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                key = (lang, " ".join(w[i:i + m]))
                longest[key] = max(longest[key], a)
    out = {}
    for (lang, p), a in often.items():
        w = p.split(" ")
        if len(w) < 2 or 100 * longest[lang, p] >= cover * a:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, p.encode(), left, right))
    return sorted(((lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                   for lang, found in out.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])), key=str)


def texts(n, seed):
    rnd = random.Random(seed)
    vocab = ["a", "B", "cé", "d", "日本", "e-f", "ggggggggggggggggggggg1", "ggggggggggggggggggggg2", "h"]
    return ["".join(rnd.choice(vocab) + rnd.choice([" ", " ", " ", "\t ", ". ", "\n", ","]) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


EVERYTHING = np.full(1, ~np.uint64(0))


def in_process(counter, rows):
    buf, off = text_buffer(pa.array([t for _, t in rows]))
    return list(counter.add([g for g, _ in rows], buf, off)) + list(counter.rest())


def counted(batches):
    got = Counter()
    for b in batches:
        for g, _, p, n in zip(*(c.to_pylist() for c in b.columns)):
            got[g, p] += n
    return got


def test_counts_with_bursts_and_spills(monkeypatch):
    """Containers of 4 paths, tasks of 60 paths, 7 words a lexicon, blocks of 50 words."""
    for name, value in (("BURST", 4), ("HELD", 60), ("LEXICON", 7), ("BLOCK", 50), ("SPILL_ROWS", 16)):
        monkeypatch.setattr(C, name, value)
    rows = [(("en", "fr", "日")[i % 3], t) for i, t in enumerate(texts(60, 3))]
    want = Counter()
    for g, t in rows:
        want.update((g, p) for p in grams(t))
        want[g, ""] += sum(1 for _ in grams(t, (1,)))
    batches = in_process(C.Counter(EVERYTHING, EVERYTHING), rows)
    assert counted(batches) == +want and len(batches) > 20


def test_counts_by_hash(monkeypatch):
    rows = [(("en", "fr")[i % 2], t) for i, t in enumerate(texts(60, 3))]
    for value in (4, 1 << 16):
        monkeypatch.setattr(C, "BURST", value)
        monkeypatch.setattr(C, "HELD", 10 * value)
        for m, known in (((1,), None), ((2,), EVERYTHING), ((3, 4), EVERYTHING)):
            got = Counter()
            for b in in_process(C.HashCounter(m, known), rows):
                assert b.column(0).to_pylist() == sorted(b.column(0).to_pylist())
                for k, n in zip(*(c.to_pylist() for c in b.columns)):
                    got[k] += n
            assert sorted(got.values()) == sorted(Counter((g, p) for g, t in rows for p in grams(t, m)).values())


def test_runs_are_sorted_and_the_trie_grows_deep(monkeypatch):
    monkeypatch.setattr(C, "BURST", 8)
    rows = [("en", t) for t in texts(40, 4)]
    counter = C.Counter(EVERYTHING, EVERYTHING)
    buf, off = text_buffer(pa.array([t for _, t in rows]))
    assert not list(counter.add(["en"] * len(rows), buf, off))

    def depth(node):
        return 1 + max((depth(k) for k in node.kids if isinstance(k, C.Node)), default=0)
    assert depth(counter.trie) >= 3
    short = [p for b in counter._run(counter.trie.items()) for p in b.column(2).to_pylist() if "ggg" not in p]
    assert [p.split(" ") for p in short] == sorted((p.split(" ") for p in short), key=lambda w: [x.encode() for x in w]) and len(short) > 50


def test_filters_drop_only_phrases_of_rare_parts(spark):
    rows = [("en", "x y z. x y z. rare x y"), ("fr", "x y z")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    known = spark.sparkContext.broadcast(C.frequent_filter(spark, docs, (1,), 2, 1 << 16))
    phrases = np.bitwise_or.reduce([C.frequent_filter(spark, docs, m, 2, 1 << 16, known) for m in ((2,), (3, 4))])
    got = counted(in_process(C.Counter(known.value, phrases), rows))
    assert got == Counter({("en", "x"): 3, ("en", "y"): 3, ("en", "z"): 2, ("en", "x y"): 3, ("en", "y z"): 2, ("en", "x y z"): 2, ("en", ""): 9, ("fr", ""): 3})


def documents(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", None, "x", 3) for i, (g, t) in enumerate(rows)], SCHEMA + ", phrase string, n long").repartition(3)


def test_whole_results(spark):
    rows = [(("en", None, "und", "")[i % 4], t) for i, t in enumerate(texts(300, 8))] + [("en", t) for _, t in AWKWARD] + [(None, sentence(300, 3))] * 4
    docs = documents(spark, rows)
    for least, top in ((3, 40), (30, 2000)):
        got = C.collocations(docs, min_count=least, top=top, bloom_bits=1 << 16)
        want = brute(rows, least, top)
        assert collect(got, *got.columns) == want and len(want) > 20


def test_products_beyond_64_bits(spark):
    got = spark.sql("SELECT (cast(a as decimal(20, 0)) * cast(2000000 as decimal(7, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0))) AS s "
                    "FROM VALUES (9000000000000000000L, 9100000000000000000L, 9200000000000000000L) AS t(a, l, r)").first().s
    assert got == 2000000 * 9 * 10 ** 18 // (183 * 10 ** 17)


def test_empty_table(spark):
    assert C.collocations(documents(spark, [("en", "a b")]).limit(0)).count() == 0
    assert C.collocations(documents(spark, [("en", None), (None, "")])).count() == 0
