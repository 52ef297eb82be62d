"""Periodic runs of words by a dictionary of basic factors.

Every stretch of 2^k words of a text gets a name (equal stretches, equal names): level 0 names the words, level
k + 1 names pairs of level-k names.  At each level a stretch's successor is its next occurrence in the text, if that is
at most twice the stretch's length away.  Three occurrences in arithmetic progression propose their distance as
a period of that text.  A run of smallest period q and at least 4 q words has such a progression at the level of the smallest
power of two >= q: a stretch that long holds the run's primitive root and recurs at distance q first.

Each proposed (text, period) is extended to all maximal stretches where words that far apart are equal; what is long
enough and lies in no run of a smaller period is a run.  (A stretch of period d and length >= 4 d whose
smallest period is p < d lies in the run of p, so this also leaves the smallest periods.)

Names are exact: words that share a hash are compared byte by byte, pairs of names are never hashed.  Only stretches
that occur twice in their text are named at the next level, so ordinary prose ends after a few levels.

Defined results: a null, empty or wordless text has no runs and collapses to the empty string; repeated rows and null
ids each get their own row; a text is handled whole, so a task's memory follows the longest single text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwise.functions.columns import let
from layerwise.llm.common import id_text, prepare
from layerwise.llm.textnp import CHUNK_BYTES, SPACE_WORDS, chunks, exact_names, spread, text_buffer, words

MIN_WORDS, MIN_PERIODS = 6, 4
RUNS = "array<struct<start:long,length:long,period:long>>"


# ------------------------------------------------------------------ proposals

def proposed_periods(name: np.ndarray, off: np.ndarray, min_periods: int = MIN_PERIODS):
    """Distinct (text, period) pairs proposed by progressions; ``name`` holds the words' names, text after text."""
    n = len(name)
    text = np.repeat(np.arange(len(off) - 1), np.diff(off))
    room = np.diff(off)[text] // min_periods  # longest period that fits often enough
    stop = off[1:][text]
    pos, width, found = np.arange(n), 1, []
    while len(pos):
        order = np.argsort(name, kind="stable")  # positions ascend within a name
        p, nm = pos[order], name[order]
        again = (nm[1:] == nm[:-1]) & (text[p[1:]] == text[p[:-1]])
        gap = np.diff(p)
        near = again & (gap <= np.minimum(2 * width, room[p[1:]]))
        step = np.zeros(n + 1, dtype=np.int64)
        step[p[:-1][near]] = gap[near]
        at = np.flatnonzero(step)
        at = at[step[at + step[at]] == step[at]]  # three in progression
        if len(at):
            found.append(np.unique(text[at] * (n + 1) + step[at]))
        twice = np.zeros(len(p), dtype=bool)
        twice[1:] |= again
        twice[:-1] |= again
        code = np.full(n + width, -1, dtype=np.int64)
        code[p[twice]] = nm[twice]
        pos = np.flatnonzero(code[:n] >= 0)
        pos = pos[(pos + 2 * width <= stop[pos]) & (code[pos + width] >= 0)]
        _, name = np.unique(code[pos] * (n + 1) + code[pos + width], return_inverse=True)
        width *= 2
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs // (n + 1), pairs % (n + 1)


# ------------------------------------------------------------------ extension

def stretches(name: np.ndarray, period: int, min_words: int, min_periods: int):
    """(starts, lengths) of the maximal stretches of one text in which words ``period`` apart are equal."""
    equal = np.zeros(len(name) - period + 2, dtype=np.int8)
    equal[1:-1] = name[:-period] == name[period:]
    edge = np.flatnonzero(np.diff(equal))
    start, length = edge[::2], edge[1::2] - edge[::2] + period
    ok = length >= max(min_words, min_periods * period)
    return start[ok], length[ok]


def text_runs(name: np.ndarray, off: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS):
    """(text, start, length, period) of every run, by text, start and period; starts count from the text's first word."""
    out = []
    held, runs = -1, []
    for t, d in zip(*(x.tolist() for x in proposed_periods(name, off, min_periods))):  # periods of a text ascend
        if t != held:
            held, runs = t, []
        s, length = stretches(name[off[t]:off[t + 1]], d, min_words, min_periods)
        if runs and len(s):
            inner = np.zeros(len(s), dtype=bool)
            for rs, rl in runs:
                j = np.searchsorted(rs, s, side="right") - 1  # of those that start no later, the last one ends last
                inner |= (j >= 0) & (rs[j] + rl[j] >= s + length)
            s, length = s[~inner], length[~inner]
        if len(s):
            runs.append((s, length))
            out.append(np.stack([np.full(len(s), t), s, length, np.full(len(s), d)]))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    found = np.concatenate(out, axis=1)
    return tuple(found[:, np.lexsort((found[3], found[1], found[0]))])


def dropped_words(text, start, length, period, off: np.ndarray) -> np.ndarray:
    """True for the words that lie in some run after that run's first period."""
    edge = np.zeros(int(off[-1]) + 1, dtype=np.int64)
    np.add.at(edge, off[text] + start + period, 1)
    np.add.at(edge, off[text] + start + length, -1)
    return np.cumsum(edge[:-1]) > 0


# ------------------------------------------------------------------ tasks

def joined_words(buf, starts, ends, kept, off):
    """(bytes, offsets) of each text's kept words, joined by one space."""
    row = np.searchsorted(off, np.flatnonzero(kept), side="right") - 1
    s, lens = starts[kept], (ends - starts)[kept]
    out = np.full(int((lens + 1).sum()), 0x20, dtype=np.uint8)
    at = np.cumsum(lens + 1) - (lens + 1)
    out[spread(at, lens)] = buf[spread(s, lens)]
    last = np.ones(len(row), dtype=bool)
    last[:-1] = row[1:] != row[:-1]
    keep = np.ones(len(out), dtype=bool)
    keep[(at + lens)[last]] = False
    size = np.bincount(row, weights=lens + 1 - last, minlength=len(off) - 1).astype(np.int64)
    return out[keep], np.concatenate([[0], np.cumsum(size)])


def _runner(min_words, min_periods):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            buf, off = text_buffer(batch.column(1))
            for a, b in chunks(off, CHUNK_BYTES):
                part, po = buf[off[a]:off[b]], off[a:b + 1] - off[a]
                starts, ends, wo = words(part, po, SPACE_WORDS)
                found = text_runs(exact_names(part, starts, ends), wo, min_words, min_periods)
                kept = ~dropped_words(*found, wo)
                flat, fo = joined_words(part, starts, ends, kept, wo)
                runs = pa.StructArray.from_arrays([pa.array(x) for x in found[1:]], names=["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(found[0], np.arange(b - a + 1)).astype(np.int32)), runs)
                text = pa.Array.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(fo), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), lists, text.cast(pa.binary()).cast(pa.string())],
                                                 names=["doc_id", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """(doc_id, runs, collapsed) of every row: its runs by start and period, and its words without the repetitions
    (all but the first period of every run), joined by one space.  ``min_periods`` is 4 or more."""
    if min_periods < 4:
        raise ValueError("shorter runs need not hold a progression at their level")
    prepare(docs.sparkSession)
    return id_text(docs).mapInArrow(_runner(min_words, min_periods), f"doc_id long, runs {RUNS}, collapsed string")


def best_run(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; ties: smallest start, then period; null without runs."""
    def order(x, y):
        more = y["length"] * x["period"] - x["length"] * y["period"]
        return F.when(more != 0, F.signum(more)).when(x["start"] != y["start"], F.signum(x["start"] - y["start"])) \
            .otherwise(F.signum(x["period"] - y["period"])).cast("int")
    return F.get(F.array_sort(runs, order), F.lit(0))


def repeat_planted(doc_id: Column, text: Column) -> Column:
    """The texts with periods planted: where crc32 of the decimal id is divisible by 10, word i >= a becomes
    word a + (i - a) % p; other texts and those under a null id stay as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(w):
        n = F.size(w)
        return let(g % n, lambda a: let(1 + F.floor((n - a) / (3 + g % 8)), lambda p: F.array_join(
            F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + (i - a) % p).cast("int")))), " ")))
    spaced = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.when(h % 10 == 0, let(spaced, lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(text))).otherwise(text)
