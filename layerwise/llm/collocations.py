"""Collocations of two to four words, counted in HAT-tries of word ids.

Every part of a frequent phrase is frequent, so counts by hash go first: of all words, then of all pairs, and of all triples
and quadruples of frequent words.  The hashes found frequent enter Bloom filters of fixed size (``bloom_bits``).  Then
the words and phrases that pass the filters are counted exactly.  A hash collision or a full filter lets more phrases
through, which costs time and changes no count.

In a task phrases are paths (language, word, word, ...) in a HAT-trie: its upper nodes branch on ranges of word ids, its
leaves are hash containers (open addressing) with the counts of all paths in their range.  A container that holds more than
``BURST`` paths bursts: its range is halved, or, when it is one word's, a node for the next word takes its place.
When a task holds more than ``HELD`` paths, its largest subtrees are spilled whole, each as one run sorted by path.
Runs leave the task and are dealt out by (language, prefix), the prefix being at most three words, and merged there.  No
group holds more than a task's one count per phrase (and the quadruples that extend a triple).  The counts by
hash use the same trie, its paths being the digits of the hash.

The counts of frequent phrases are then joined: each cut of a phrase with the counts of its two parts, each phrase with the largest
count of the longer phrases that hold it.

Defined results: null texts and texts without words hold no phrase; a null language counts as ``und``; repeated rows and
ids count as often as they stand there; a language without candidates has no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerwise.llm.common import few_files, materialise, prepare
from layerwise.llm.textnp import LOWER, chunks, class_table, exact_names, mix64, spread, text_buffer, word_hashes, words

U64 = np.uint64
CHUNK = 1 << 20             # bytes of text cut into words at once
BLOCK = 1 << 17             # words counted at once
BURST = 1 << 16             # paths in a container before it bursts
HELD = 3 << 18              # paths a task holds before it spills
LEXICON = 300_000           # words a task numbers before it spills everything and starts anew
SPILL_ROWS = 1 << 15        # rows of a run sent at once
BLOOM_BITS = 1 << 26
TASKS_PER_CORE = 2          # in the exact count: each task sends each of its phrases once
SALTS = 32
ID_BITS = 21
ID_MASK = (1 << ID_BITS) - 1

STOPS = ".,;:!?"
PIECE_WORDS = class_table([(0x20, 0x20), (0x09, 0x0D)] + [(ord(c), ord(c)) for c in STOPS])
BREAKS = ~class_table([(0x0A, 0x0D)] + [(ord(c), ord(c)) for c in STOPS])


# ------------------------------------------------------------------ trie

class Container:
    """Counts of 128-bit paths (two words each) by open addressing."""

    def __init__(self, slots: int = 256):
        self.size = 0
        self._new(slots)

    def _new(self, slots):
        self.hi, self.lo, self.n = np.zeros(slots, U64), np.zeros(slots, U64), np.zeros(slots, np.int64)

    def items(self):
        used = np.flatnonzero(self.n)
        return self.hi[used], self.lo[used], self.n[used]

    def add(self, hi, lo, n):
        """Distinct paths and their counts."""
        slots = len(self.n)
        while 2 * (self.size + len(hi)) > slots:
            slots *= 2
        if slots > len(self.n):
            held = self.items()
            self._new(slots)
            self._place(*held)
        self._place(hi, lo, n, count=True)

    def _place(self, hi, lo, n, count=False):
        mask = U64(len(self.n) - 1)
        slot = (mix64(hi * U64(0x9E3779B97F4A7C15) + lo) & mask).astype(np.int64)
        at = np.arange(len(hi))
        while len(at):
            free = self.n[slot] == 0
            self.hi[slot[free]], self.lo[slot[free]] = hi[at[free]], lo[at[free]]  # the last of those that want a slot has it
            mine = (self.hi[slot] == hi[at]) & (self.lo[slot] == lo[at])
            self.n[slot[mine]] += n[at[mine]]
            self.size += int((mine & free).sum()) if count else 0
            at, slot = at[~mine], (slot[~mine] + 1) & int(mask)


def path_field(hi, lo, depth: int):
    """The id at a depth of each path: language, then words; 0 where the path has ended."""
    word, shift = (hi, 2 - depth) if depth < 3 else (lo, 4 - depth)
    return (word >> U64(shift * ID_BITS)) & U64(ID_MASK)


class Node:
    """A trie node: from each of ``cuts`` on, ids at this depth belong to the kid of the same number."""

    def __init__(self, depth: int, ranges: int = 1):
        self.depth, self.cuts = depth, np.arange(ranges, dtype=U64) * U64((ID_MASK + 1) // ranges)
        self.kids = [Container() for _ in range(ranges)]

    @property
    def size(self):
        return sum(k.size for k in self.kids)

    def add(self, hi, lo, n):
        """Distinct paths, sorted."""
        kid = np.searchsorted(self.cuts, path_field(hi, lo, self.depth), side="right") - 1
        heads = np.flatnonzero(np.concatenate([[True], kid[1:] != kid[:-1]])) if len(kid) else []
        for a, b in zip(heads, [*heads[1:], len(kid)]):
            self.kids[kid[a]].add(hi[a:b], lo[a:b], n[a:b])
        i = 0
        while i < len(self.kids):
            if isinstance(self.kids[i], Node) or self.kids[i].size <= BURST or not self._burst(i):
                i += 1

    def _burst(self, i) -> bool:
        hi, lo, n = self.kids[i].items()
        order = np.lexsort((lo, hi))
        hi, lo, n = hi[order], lo[order], n[order]
        ids = path_field(hi, lo, self.depth)
        if ids[0] == ids[-1]:
            if self.depth == 4:  # one path alone cannot burst
                return False
            kid = Node(self.depth + 1)
            kid.add(hi, lo, n)
            self.kids[i] = kid
            return True
        middle = ids[len(ids) // 2]
        cut = middle if middle > ids[0] else ids[np.searchsorted(ids, middle, side="right")]
        at = int(np.searchsorted(ids, cut))
        kids = [Container(), Container()]
        kids[0].add(hi[:at], lo[:at], n[:at])
        kids[1].add(hi[at:], lo[at:], n[at:])
        self.kids[i:i + 1] = kids
        self.cuts = np.insert(self.cuts, i + 1, cut)
        return True

    def items(self):
        parts = [k.items() for k in self.kids]
        return tuple(np.concatenate(c) for c in zip(*parts))

    def take_largest(self):
        """The paths of the largest subtree of a few containers, which is emptied."""
        i = max(range(len(self.kids)), key=lambda j: self.kids[j].size)
        if isinstance(self.kids[i], Node) and self.kids[i].size > 4 * BURST:
            return self.kids[i].take_largest()
        out = self.kids[i].items()
        self.kids[i] = Container()
        return out


class Lexicon:
    """Numbers (from 1) of the words a task has met; a word may get a second number where hashes collide."""

    def __init__(self):
        self.hash, self.row = np.zeros(0, U64), np.zeros(0, np.int64)
        self.text, self.off, self.word_hash = np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, U64)

    def __len__(self):
        return len(self.word_hash)

    def ids(self, h, buf, starts, ends):
        """Numbers of distinct words."""
        out = np.zeros(len(h), dtype=np.int64)
        lens = ends - starts
        if len(self.hash):
            at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
            hit = np.flatnonzero(self.hash[at] == h)
            row = self.row[at[hit]]
            same = lens[hit] == self.off[row + 1] - self.off[row]
            hit, row = hit[same], row[same]
            differs = buf[spread(starts[hit], lens[hit])] != self.text[spread(self.off[row], lens[hit])]
            equal = np.add.reduceat(differs, np.cumsum(lens[hit]) - lens[hit]) == 0 if len(hit) else np.zeros(0, bool)
            out[hit[equal]] = row[equal] + 1
        new = np.flatnonzero(out == 0)
        if len(new):
            rows = len(self) + np.arange(len(new))
            out[new] = rows + 1
            self.text = np.concatenate([self.text, buf[spread(starts[new], lens[new])]])
            self.off = np.concatenate([self.off, self.off[-1] + np.cumsum(lens[new])])
            self.word_hash = np.concatenate([self.word_hash, h[new]])
            every, row = np.concatenate([self.hash, h[new]]), np.concatenate([self.row, rows])
            order = np.argsort(every, kind="stable")
            self.hash, self.row = every[order], row[order]
        return out

    def order(self):
        """A rank for each number by the word's first sixteen bytes."""
        raw = np.concatenate([self.text, np.zeros(16, np.uint8)]).tobytes()
        word = np.ndarray(shape=len(self.text) + 9, dtype=">u8", buffer=raw, strides=(1,)).astype(U64)
        lens = np.diff(self.off)
        cut = lambda at, n: word[np.minimum(at, len(word) - 1)] & np.where(
            n >= 8, ~U64(0), ~(~U64(0) >> (U64(8) * np.clip(n, 0, 7).astype(U64))))
        rank = np.zeros(len(self) + 1, dtype=np.int64)
        rank[1 + np.lexsort((cut(self.off[:-1] + 8, lens - 8), cut(self.off[:-1], lens)))] = 1 + np.arange(len(self))
        return rank


# ------------------------------------------------------------------ tasks

def extended(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase (or language) and one word more."""
    return mix64(h * U64(0x9E3779B97F4A7C15) + word)


def bloom_key(h: np.ndarray) -> np.ndarray:
    return h >> U64(1)


def passes(bloom: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = bloom_key(h) & U64(len(bloom) * 64 - 1)
    return (bloom[(bit >> U64(6)).astype(np.int64)] >> (bit & U64(63))) & U64(1) > 0


@lru_cache(maxsize=4096)
def lang_hash(name: str) -> np.uint64:
    raw = np.frombuffer(name.encode(), dtype=np.uint8)
    return word_hashes(raw, np.array([0]), np.array([len(raw)]))[0]


def cut_words(lang: list, buf: np.ndarray, off: np.ndarray):
    """(lower-case bytes, starts, ends, text, hash, language hash, joined) of the words of a chunk; joined[i]: words i and
    i + 1 stand in one piece."""
    buf = LOWER[buf]
    starts, ends, wo = words(buf, off, PIECE_WORDS)
    text = np.repeat(np.arange(len(lang)), np.diff(wo))
    hl = np.array([lang_hash(x) for x in lang], dtype=U64)[text]
    stops = np.cumsum(BREAKS[buf], dtype=np.int32)
    joined = np.zeros(len(starts), dtype=bool)
    joined[:-1] = (stops[starts[1:] - 1] == stops[ends[:-1] - 1]) & (text[1:] == text[:-1])
    return buf, starts, ends, text, word_hashes(buf, starts, ends), hl, joined


def phrase_starts(g, h, joined, allowed, most: int):
    """(m, word numbers, hashes) of the phrases of m = 2 to ``most`` allowed words; g: hashes of the words with their language."""
    link = joined[:-1] & allowed[:-1] & allowed[1:]
    at = np.flatnonzero(link)
    key = extended(g[at], h[at + 1])
    for m in range(2, most + 1):
        yield m, at, key
        more = np.flatnonzero(link[np.minimum(at + m - 1, len(link) - 1)] & (at + m < len(h)))
        at = at[more]
        key = extended(key[more], h[at + m])


class HashCounter:
    """Counts by hash of all words (size 1), or of the phrases of the given sizes whose words pass ``known``."""

    def __init__(self, sizes: tuple[int, ...], known: np.ndarray | None):
        self.sizes, self.known, self.trie = sizes, known, Node(0, 16)  # hashes are spread evenly

    def add(self, lang: list, buf: np.ndarray, off: np.ndarray):
        """Count the texts of a chunk; yields the runs that had to be spilled."""
        _, _, _, _, h, hl, joined = cut_words(lang, buf, off)
        g = extended(hl, h)
        keys = [g] if self.known is None else [
            key for m, _, key in phrase_starts(g, h, joined, passes(self.known, g), self.sizes[-1]) if m in self.sizes]
        for key in keys:
            for a in range(0, len(key), BLOCK):
                part, n = np.unique(bloom_key(key[a:a + BLOCK]), return_counts=True)
                self.trie.add(part, np.zeros(len(part), U64), n)
                yield from self.spill(HELD)

    def spill(self, above):
        if self.trie.size > above:
            while self.trie.size > above // 2:
                key, _, n = self.trie.take_largest()
                order = np.argsort(key)
                yield pa.RecordBatch.from_arrays([pa.array(key[order].view(np.int64)), pa.array(n[order])], names=["key", "n"])

    def rest(self):
        yield from self.spill(0)


class Counter:
    """The trie, words and languages of one task: words that pass ``known``, phrases of 2 to 4 of them that pass ``phrases``."""

    def __init__(self, known: np.ndarray, phrases: np.ndarray):
        self.known, self.phrases = known, phrases
        self.totals: dict[str, int] = {}
        self._reset()

    def _reset(self):
        self.trie, self.words = Node(0), Lexicon()
        self.langs: dict[str, int] = {}
        self.names: list[str] = []

    def _lang(self, name):
        if name not in self.langs:
            self.langs[name] = len(self.names) + 1
            self.names.append(name)
        return self.langs[name]

    def add(self, lang: list, buf: np.ndarray, off: np.ndarray):
        """Count the texts of a chunk; yields the runs that had to be spilled."""
        buf, starts, ends, text, h, hl, joined = cut_words(lang, buf, off)
        g = extended(hl, h)
        good = passes(self.known, g)
        for name, n in zip(lang, np.bincount(text, minlength=len(lang)).tolist()):
            if n:
                self.totals[name] = self.totals.get(name, 0) + n
        spots = [(1, np.flatnonzero(good))] + [(m, at[passes(self.phrases, key)]) for m, at, key in phrase_starts(g, h, joined, good, 4)]
        for a in range(0, len(starts), BLOCK):
            b = min(a + BLOCK + 3, len(starts))  # phrases that begin in the block may end behind it
            heads, name = np.unique(text[a:b], return_inverse=True)
            code = np.array([self._lang(lang[t]) for t in heads.tolist()], dtype=np.int64)[name]
            own = [(m, at[np.searchsorted(at, a):np.searchsorted(at, a + BLOCK)] - a) for m, at in spots]
            self._block(own, code, buf, starts[a:b], ends[a:b], h[a:b])
            yield from self.spill()

    def _block(self, spots, code, buf, starts, ends, h):
        n = len(starts)
        used = np.zeros(n, dtype=bool)
        for m, at in spots:
            for j in range(m):
                used[at + j] = True
        need = np.flatnonzero(used)
        if not len(need):
            return
        name = exact_names(buf, starts[need], ends[need], h[need])
        first = np.empty(int(name.max()) + 1, dtype=np.int64)
        first[name] = need
        number = np.zeros(n, dtype=U64)
        number[need] = self.words.ids(h[first], buf, starts[first], ends[first])[name].astype(U64)
        for m, at in spots:
            hi = (code[at].astype(U64) << U64(2 * ID_BITS)) | (number[at] << U64(ID_BITS))
            if m < 3:
                hi |= number[at + 1] if m == 2 else U64(0)
                hi, count = np.unique(hi, return_counts=True)
                self.trie.add(hi, np.zeros(len(hi), U64), count)
                continue
            hi |= number[at + 1]
            lo = (number[at + 2] << U64(ID_BITS)) | (number[at + 3] if m == 4 else U64(0))
            order = np.lexsort((lo, hi))
            hi, lo = hi[order], lo[order]
            head = np.flatnonzero(np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])])) if len(hi) else order
            self.trie.add(hi[head], lo[head], np.diff(np.append(head, len(hi))))

    def _run(self, paths):
        """Record batches of the paths, sorted."""
        hi, lo, n = paths
        rank = self.words.order()
        ids = np.stack([path_field(hi, lo, d).astype(np.int64) for d in range(5)])
        order = np.lexsort((rank[ids[4]], rank[ids[3]], rank[ids[2]], rank[ids[1]], ids[0]))
        ids, n = ids[:, order], n[order]
        hashes = np.concatenate([np.zeros(1, U64), self.words.word_hash])
        text, start = self.words.text, self.words.off
        for a in range(0, len(n), SPILL_ROWS):
            part = ids[:, a:a + SPILL_ROWS]
            w = part[1:].T
            flat = w[w > 0] - 1
            lens = start[flat + 1] - start[flat]
            body = np.full(int((lens + 1).sum()), 0x20, dtype=np.uint8)
            at = np.cumsum(lens + 1) - (lens + 1)
            body[spread(at, lens)] = text[spread(start[flat], lens)]
            last = np.cumsum((w > 0).sum(axis=1)) - 1
            keep = np.ones(len(body), dtype=bool)
            keep[(at + lens)[last]] = False
            off = np.concatenate([[0], (at + lens + 1)[last]]) - np.arange(len(last) + 1)
            phrase = pa.Array.from_buffers(pa.large_binary(), len(last), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(body[keep])])
            prefix = extended(extended(hashes[w[:, 0]], hashes[w[:, 1]]), hashes[w[:, 2]])
            lang = pa.array(self.names).take(pa.array(part[0] - 1))
            yield pa.RecordBatch.from_arrays([lang, pa.array((prefix >> U64(32)).astype(np.uint32).view(np.int32)), phrase.cast(pa.binary()).cast(pa.string()),
                                              pa.array(n[a:a + SPILL_ROWS])], names=["lang", "prefix", "phrase", "n"])

    def spill(self, everything=False):
        if everything or max(len(self.words), len(self.names)) > LEXICON:
            while self.trie.size:
                yield from self._run(self.trie.take_largest())
            self._reset()
        elif self.trie.size > HELD:
            while self.trie.size > HELD // 2:
                yield from self._run(self.trie.take_largest())

    def rest(self):
        yield from self.spill(everything=True)
        if self.totals:
            names, n = zip(*self.totals.items())
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.zeros(len(n), np.int32)), pa.array([""] * len(n)), pa.array(n, pa.int64())],
                                             names=["lang", "prefix", "phrase", "n"])


def _runner(make, *filters):
    def run(batches):
        counter = make(*(f.value for f in filters))
        for batch in batches:
            buf, off = text_buffer(batch.column(1))
            lang = batch.column(0).to_pylist()
            for a, b in chunks(off, CHUNK):
                yield from counter.add(lang[a:b], buf[off[a]:off[b]], off[a:b + 1] - off[a])
        yield from counter.rest()
    return run


# ------------------------------------------------------------------ levels

def frequent_filter(spark: SparkSession, texts: DataFrame, sizes: tuple[int, ...], min_count: int, bits: int, known=None) -> np.ndarray:
    """A bit set with the hashes of the words (of the phrases of these sizes of words in ``known``) counted ``min_count`` times or more."""
    counter = _runner(lambda *k: HashCounter(sizes, *(k or (None,))), *([known] if known else []))
    hashed = texts.mapInArrow(counter, "key long, n long")
    often = hashed.repartition("key").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    bit = F.col("key").bitwiseAND(F.lit(bits - 1))
    rows = often.select(F.shiftright(bit, 6).alias("at"), F.expr("shiftleft(1L, cast(key & 63 as int))").alias("word")) \
        .groupBy("at").agg(F.bit_or("word").alias("word"))
    found = materialise(spark, rows, "phrase-filter", small=True).toArrow()  # at most bits / 64 rows
    held = np.zeros(bits // 64, dtype=U64)
    held[found["at"].to_numpy()] = found["word"].to_numpy().view(U64)
    return held


def frequent_phrases(docs: DataFrame, min_count: int = 30, bloom_bits: int = BLOOM_BITS) -> DataFrame:
    """(lang, phrase, m, n): all phrases of m = 1 to 4 words with n >= min_count, and (lang, '', 0, number of words)."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    known = spark.sparkContext.broadcast(frequent_filter(spark, texts, (1,), min_count, bloom_bits))
    phrases = np.zeros(bloom_bits // 64, dtype=U64)
    for sizes in ((2,), (3, 4)):
        phrases |= frequent_filter(spark, texts, sizes, min_count, bloom_bits, known)
    runs = few_files(texts, TASKS_PER_CORE).mapInArrow(_runner(Counter, known, spark.sparkContext.broadcast(phrases)), "lang string, prefix int, phrase string, n long")
    merged = runs.repartition("lang", "prefix").groupBy("lang", "prefix", "phrase").agg(F.sum("n").alias("n"))
    merged = merged.filter((F.col("n") >= min_count) | (F.col("phrase") == ""))
    m = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return materialise(spark, merged.select("lang", "phrase", m.alias("m"), "n"), "phrases", small=True)


# ------------------------------------------------------------------ scores

def _inner_phrases(phrase, m):
    """All contiguous phrases of two words or more inside one of m words."""
    w = F.split(phrase, " ")
    return F.flatten(F.transform(F.sequence(F.lit(2), m - 1), lambda size: F.transform(
        F.sequence(F.lit(1), m - size + 1), lambda i: F.array_join(F.slice(w, i, size), " "))))


def collocations(docs: DataFrame, min_count: int = 30, top: int = 2000, cover: int = 80, bloom_bits: int = BLOOM_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of two to four words by score
    (floor(2000000 a / (l + r)) of the lowest-scoring cut), then count, then bytes; without those that lie inside a longer
    candidate with at least ``cover`` percent of their count."""
    spark = docs.sparkSession
    counts = frequent_phrases(docs, min_count, bloom_bits)
    several = counts.filter("m >= 2")
    longer = counts.filter("m >= 3").select("lang", F.explode(_inner_phrases(F.col("phrase"), F.col("m"))).alias("phrase"), F.col("n").alias("c")) \
        .groupBy("lang", "phrase").agg(F.max("c").alias("c"))
    cand = several.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("c") < cover * F.col("n"), F.lit(True)))
    cuts = cand.select("lang", "phrase", F.col("n").alias("a"), "m", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")) \
        .withColumn("left", F.expr("substring_index(phrase, ' ', k)")).withColumn("right", F.expr("substring_index(phrase, ' ', k - m)"))
    part = counts.filter("m between 1 and 3")
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"]) \
        .join(part.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    exact = F.expr("(cast(a as decimal(20, 0)) * cast(2000000 as decimal(7, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    scored = cuts.withColumn("score", exact).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")) \
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    scored = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = counts.filter("m = 0").select("lang", F.col("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
