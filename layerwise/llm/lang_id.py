"""Language identification by segmentation-marginalised unigram models.

The pieces of a fixed public vocabulary have one probability per language.  A text's likelihood in a language is the
product over its units (runs from one blank to the next) of the sum over *all* segmentations of the unit into
pieces, computed by the forward algorithm for all distinct units and languages of a batch at once.  The
prediction is the language of the largest likelihood; its score is the posterior under equal priors.

Fit: expectation-maximisation.  Unit counts of a bounded sample of labelled rows (about ``per_lang`` distinct rows a
language, whole texts) are counted in Spark; each round the tasks run forward and backward passes and only
expected piece counts (languages x vocabulary) come back.  Scoring reads every whole text and needs no
shuffle.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text when there is no
training row; ties go to the first language by name; rows with a null language are not learned from;
characters outside the vocabulary weigh the same in all languages, in runs of any length (the passes carry a
power of two a byte, so no sum underflows); units above 48 bytes are scored in
parts; repeated rows each get their row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwise.llm.common import id_text, materialise, prepare
from layerwise.llm.pieces import (BLANK, DISTINCT_CHUNK, NEW_BYTES, Edges, UnitCache, Vocabulary, blocks, distinct_units,
                                  joined_units, split_units)
from layerwise.llm.textnp import chunks, prefix_hash, range_hash, text_buffer

UNIT_BYTES = 48
SCALE_BITS = 20      # the passes work on probabilities times 2^20 a byte; 48 bytes stay far inside a float64
UNKNOWN = 1e-8       # probability of a character without a piece, in every language
PER_LANG = 1000
ROUNDS = 3
SMOOTH = 0.1
COUNT_UNIT = 1 << 20  # expected counts travel as integers, so their sums do not depend on order


def normalised(col: pa.Array) -> pa.Array:
    """Lower-cased texts with a blank in front; nulls are empty."""
    col = pc.utf8_lower(pc.replace_substring(pc.fill_null(col.cast(pa.string()), ""), BLANK, " "))
    return pc.if_else(pc.equal(pc.binary_length(col), 0), "", pc.binary_join_element_wise(" ", col, ""))


def short_units(buf: np.ndarray, off: np.ndarray):
    """(starts, ends) of the units, those above UNIT_BYTES cut at character borders."""
    starts = split_units(buf, off)
    ends = np.append(starts[1:], len(buf)) if len(starts) else starts
    extra = []
    for u in np.flatnonzero(ends - starts > UNIT_BYTES).tolist():
        p, e = int(starts[u]), int(ends[u])
        while e - p > UNIT_BYTES:
            p += UNIT_BYTES
            while (buf[p] & 0xC0) == 0x80:
                p -= 1
            extra.append(p)
    if extra:
        starts = np.sort(np.append(starts, extra))
        ends = np.append(starts[1:], len(buf))
    return starts, ends


class Lattice:
    """All pieces inside the units of a ``joined_units`` buffer, ready for passes in either direction."""

    def __init__(self, vocab: Vocabulary, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        edges = Edges(vocab, buf)
        chars = np.flatnonzero(((buf & 0xC0) != 0x80) & (buf != 0xFF))
        after = np.searchsorted(chars, chars, side="right")
        stop = np.append(chars, len(buf))[after]
        unit = np.searchsorted(starts, chars, side="right") - 1
        stop = np.minimum(stop, ends[unit])
        unknown = edges.find(chars, stop) < 0
        n_pieces = len(vocab.ids)
        self.start = np.concatenate([edges.key >> 6, chars[unknown]])
        self.end = np.concatenate([(edges.key >> 6) + (edges.key & 63), stop[unknown]])
        self.piece = np.concatenate([edges.piece, np.full(int(unknown.sum()), n_pieces)])
        self.unit = np.searchsorted(starts, self.start, side="right") - 1
        self.size, self.starts, self.ends = len(buf) + 1, starts, ends

    def _steps(self, depth, target):
        """Edge numbers grouped by depth, inside by target, with the borders of equal targets."""
        order = np.lexsort((target, depth))
        depth, target = depth[order], target[order]
        border = np.flatnonzero(np.append(True, (target[1:] != target[:-1]) | (depth[1:] != depth[:-1])))
        level = np.append(np.flatnonzero(np.append(True, depth[1:] != depth[:-1])), len(order))
        for a, b in zip(level[:-1], level[1:]):
            lo, hi = np.searchsorted(border, [a, b])
            yield order[a:b], border[lo:hi] - a, target[border[lo:hi]]

    def scaled(self, prob: np.ndarray) -> np.ndarray:
        """Edge weights of both passes: the probabilities times 2^SCALE_BITS for each byte of the edge."""
        return np.ldexp(prob, (SCALE_BITS * (self.end - self.start))[:, None])

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Sums over all segmentations of the unit up to each position; weight: (edges, columns), scaled."""
        alpha = np.zeros((self.size, weight.shape[1]))
        alpha[self.starts] = 1.0
        if len(self.start):
            for e, cut, target in self._steps(self.end - self.starts[self.unit], self.end):
                alpha[target] = np.add.reduceat(alpha[self.start[e]] * weight[e], cut, axis=0)
        return alpha

    def backward(self, weight: np.ndarray) -> np.ndarray:
        beta = np.zeros((self.size, weight.shape[1]))
        beta[self.ends] = 1.0
        if len(self.start):
            for e, cut, target in self._steps(self.ends[self.unit] - self.start, self.start):
                beta[target] = np.add.reduceat(beta[self.end[e]] * weight[e], cut, axis=0)
        return beta


def with_unknown(prob: np.ndarray) -> np.ndarray:
    """(pieces + 1, languages): the last row stands for characters without a piece."""
    return np.concatenate([prob, np.full((1, prob.shape[1]), UNKNOWN)])


def unit_loglik(vocab: Vocabulary, prob: np.ndarray, buf, starts, ends) -> np.ndarray:
    """(units, languages) log likelihoods; ``buf`` is the output of ``joined_units``."""
    lattice = Lattice(vocab, buf, starts, ends)
    total = np.log(lattice.forward(lattice.scaled(prob[lattice.piece]))[ends])
    return total - ((ends - starts) * (SCALE_BITS * np.log(2.0)))[:, None]


# ------------------------------------------------------------------ fit

def _count_runner():
    def run(batches):
        for batch in batches:
            lang = batch.column(1).to_pylist()
            buf, off = text_buffer(normalised(batch.column(0)))
            seen: dict = {}
            for a, b in chunks(off, DISTINCT_CHUNK):
                part, po = buf[off[a]:off[b]], off[a:b + 1] - off[a]
                starts, ends = short_units(part, po)
                doc = np.searchsorted(po, starts, side="right") - 1
                raw = part.tobytes()
                for s, e, d in zip(starts.tolist(), ends.tolist(), doc.tolist()):
                    key = (lang[a + d], raw[s:e])
                    seen[key] = seen.get(key, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.binary()),
                                              pa.array(list(seen.values()), pa.int64())], names=["lang", "unit", "n"])
    return run


def _expect_runner(shared, langs: list[str]):
    def run(batches):
        vocab, prob = shared.value
        number = {x: i for i, x in enumerate(langs)}
        total = np.zeros((len(vocab.ids) + 1, len(langs)))
        for batch in batches:
            flat, off = text_buffer(batch.column(1))
            which = np.array([number[x] for x in batch.column(0).to_pylist()], dtype=np.int64)
            n = batch.column(2).to_numpy(zero_copy_only=False)
            for a, b in chunks(off):
                buf, starts = joined_units(flat, off[a:b], off[a + 1:b + 1])
                ends = starts + np.diff(off[a:b + 1])
                lattice = Lattice(vocab, buf, starts, ends)
                column = which[a:b][lattice.unit]
                w = lattice.scaled(prob[lattice.piece, column][:, None])
                alpha, beta = lattice.forward(w)[:, 0], lattice.backward(w)[:, 0]
                post = alpha[lattice.start] * w[:, 0] * beta[lattice.end] / alpha[ends][lattice.unit] * n[a:b][lattice.unit]
                np.add.at(total, (lattice.piece, column), post)
        count = np.rint(total[:-1] * COUNT_UNIT).astype(np.int64)
        piece, column = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(column), pa.array(count[piece, column])], names=["piece", "lang", "c"])
    return run


def fit(labelled: DataFrame, key: str = "doc_id", per_lang: int = PER_LANG, rounds: int = ROUNDS, model: str | None = None):
    """(languages, probabilities) from labelled(key, text, lang); distinct rows are sampled by a hash of ``key`` and text."""
    spark = labelled.sparkSession
    prepare(spark)
    vocab = Vocabulary(model)
    rows = labelled.filter("lang is not null and text is not null").select(F.col(key).alias("k"), F.col("text").cast("string"), F.col("lang").cast("string"))
    size = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    langs = sorted(size)
    if not langs:
        return [], np.zeros((len(vocab.ids) + 1, 0))
    share = F.create_map(*[x for g in langs for x in (F.lit(g), F.lit(max(size[g], per_lang)).cast("long"))])[F.col("lang")]
    # by a hash of key and text: rows without a key, or with the same one, are sampled one by one; equal rows count once
    sample = rows.filter(F.pmod(F.xxhash64("k", "text"), share) < per_lang).dropDuplicates(["k", "text", "lang"])
    units = sample.select("text", "lang").mapInArrow(_count_runner(), "lang string, unit binary, n long").groupBy("lang", "unit").agg(F.sum("n").alias("n"))
    units = materialise(spark, units, "lang-units")
    prob = with_unknown(np.full((len(vocab.ids), len(langs)), 1.0 / len(vocab.ids)))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((vocab, prob))  # languages x vocabulary
        got = units.mapInArrow(_expect_runner(shared, langs), "piece long, lang long, c long").groupBy("piece", "lang").agg(F.sum("c").alias("c")).collect()
        count = np.full((len(vocab.ids), len(langs)), SMOOTH)
        for r in got:
            count[r["piece"], r["lang"]] += r["c"] / COUNT_UNIT
        prob = with_unknown(count / count.sum(axis=0))
        shared.unpersist()
    return langs, prob


# ------------------------------------------------------------------ predict

def text_loglik(vocab, prob, buf, off, cache: UnitCache) -> np.ndarray:
    """(texts, languages) log likelihoods of the texts in a chunk."""
    k = prob.shape[1]
    out = np.zeros((len(off) - 1, k))
    starts, ends = short_units(buf, off)
    if not len(starts):
        return out
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
        value = unit_loglik(vocab, prob, joined, at, at + ue[new] - us[new])
        row[new] = cache.add(h[new], buf, us[new], ue[new], value.ravel(), np.arange(len(new) + 1) * k)
    per_unit = cache.ids.reshape(-1, k)[row[inverse]]
    at = np.searchsorted(starts, off)
    full = np.flatnonzero(np.diff(at) > 0)
    out[full] = np.add.reduceat(per_unit, at[:-1][full], axis=0)
    return out


def _predict_runner(shared):
    def run(batches):
        vocab, langs, prob = shared.value
        cache = UnitCache(np.float64)
        names = np.array([*langs, "und"], dtype=object)
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            lettered = pc.fill_null(pc.match_substring_regex(text, r"\pL"), False).to_numpy(zero_copy_only=False)
            best, score = np.full(len(ids), len(langs)), np.zeros(len(ids))
            if langs:
                _, size = text_buffer(text)
                for a, b in chunks(size, DISTINCT_CHUNK):
                    ll = text_loglik(vocab, prob, *text_buffer(normalised(text.slice(a, b - a))), cache)
                    top = ll.argmax(axis=1)
                    share = 1.0 / np.exp(ll - ll.max(axis=1, keepdims=True)).sum(axis=1)
                    best[a:b] = np.where(lettered[a:b], top, len(langs))
                    score[a:b] = np.where(lettered[a:b], share, 0.0)
            yield pa.RecordBatch.from_arrays([ids, pa.array(names[best], pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, fitted, model: str | None = None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row; reads nothing but ``text``."""
    prepare(docs.sparkSession)
    langs, prob = fitted
    shared = docs.sparkSession.sparkContext.broadcast((Vocabulary(model), langs, prob))
    return id_text(docs).mapInArrow(_predict_runner(shared), "doc_id long, lang_pred string, score double")
