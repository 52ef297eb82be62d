"""The run finder against a brute-force search over all periods, and whole rows against plain rules."""

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import AWKWARD, SPACE_WORD, collect, frame, sentence
from layerwise.llm import periodic_runs as P
from layerwise.llm import textnp

ROWS = AWKWARD + [(40, "a " * 700), (41, "x y " * 9 + "z " * 6), (42, "p q r " * 4 + "p q"), (43, ("u v " * 4 + "w ") * 5), (44, sentence(30, 8) + " " + (sentence(7, 9) + "\n") * 5),
                  (44, "tie tie tie tie tie tie - so so so so so so"), (50, "é日 " * 40), (None, "k " * 6), (45, "k " * 5), (46, "one two " * 3)]


def brute(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            m = j - i + q
            if m >= max(6, 4 * q) and not any(all(w[x] == w[x + p] for x in range(i, i + m - p)) for p in range(1, q)):
                out.append((i, m, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(w, runs):
    gone = {x for s, m, q in runs for x in range(s + q, s + m)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def test_all_runs_of_random_texts():
    rnd = random.Random(5)
    for _ in range(300):
        texts = []
        for _ in range(rnd.randint(1, 5)):
            w = []
            for _ in range(rnd.randint(0, 6)):
                w += [rnd.randint(0, rnd.choice([1, 2, 5])) for _ in range(rnd.randint(1, 9))] * rnd.randint(1, 8)
                w = w[:len(w) - rnd.randint(0, 3)]
            texts.append(w)
        off = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
        found = P.text_runs(np.array([x for w in texts for x in w], dtype=np.int64), off)
        got = [[] for _ in texts]
        for t, *run in zip(*(x.tolist() for x in found)):
            got[t].append(tuple(run))
        assert got == [brute(w) for w in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab", max_size=60))
def test_binary_words(w):
    found = P.text_runs(np.frombuffer(w.encode(), np.uint8).astype(np.int64), np.array([0, len(w)]))
    assert list(zip(*(x.tolist() for x in found[1:]))) == brute(w)


def test_rows(spark):
    out = P.periodic_runs(frame(spark, ROWS))
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect()), key=str)
    want = []
    for d, t in ROWS:
        w = SPACE_WORD.findall(t or "")
        runs = brute(w) if len(w) < 1000 else [r for r in brute(w[:200])]  # the very long rows hold no runs
        want.append((d, runs, kept(w, runs)))
    assert got == sorted(want, key=str)


def test_query_on_planted_rows(spark, tmp_path):
    from layerwise.llm import queries
    rows = [(d, t) for d in range(0, 400, 7) for t in (sentence(d % 90, d),)] + ROWS
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    want = []
    for d, t in rows:
        w = planted(d, SPACE_WORD.findall(t or ""))
        runs = brute(w) if len(w) < 1000 else []
        best = max(runs, key=lambda r: (r[1] * 10 ** 9 // r[2], -r[0], -r[2]), default=(None, None, None))
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((d, len(runs), *best, best[1] and 1000 * best[1] // best[2], sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(kept(w, runs))))
    assert collect(out, *out.columns) == sorted(want, key=str)
    assert any(planted(d, SPACE_WORD.findall(t or "")) != SPACE_WORD.findall(t or "") for d, t in rows)


def test_empty_table(spark):
    assert P.periodic_runs(frame(spark, []).limit(0)).count() == 0


def test_words_that_share_a_hash_keep_their_names(monkeypatch):
    monkeypatch.setattr(textnp, "word_hashes", lambda buf, s, e: np.zeros(len(s), np.uint64))
    buf = np.frombuffer(b"a b a cc", np.uint8)
    names = textnp.exact_names(buf, np.array([0, 2, 4, 6]), np.array([1, 3, 5, 8]))
    assert names[0] == names[2] and len(set(names.tolist())) == 3
