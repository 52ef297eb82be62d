"""Quality rules and a hashed n-gram log-likelihood ratio, in DataFrame expressions only.

Model: word unigrams and bigrams are hashed into ``buckets``; two multinomials are counted over whole
tables, one over the trusted texts and one over all texts, the raw counts scaled to the trusted total, so
that ``alpha`` added to both is the same prior and rare n-grams stay near 0.  A document's
score is the sum over its n-grams of ln(trusted / raw), divided by their number.  Bucket weights are
integers (2^-20 units), so sums do not depend on the order of addition, and the threshold gives every
document the same verdict on every run.

Few toxic words in an ordinary text do not move that mean, so toxicity is judged apart and by passage: a word
bucket is toxic where it stands in clearly more of the documents labelled toxic than of the trusted ones
(document frequencies, log ratio of ``TOXIC_RATIO``), and a text is rejected when any passage of it (two
neighbouring blocks of ``PASSAGE`` words) holds ``TOXIC_WORDS`` of them, however long the rest is.

Defined results: a null text has no words (all counts 0, base_failed, not kept); lines compare as
whole strings; repeated rows each get their row and each count in the raw corpus; a trusted id that
occurs twice counts once; without any trusted text
every score is 0; without trusted texts or without toxic ones no word is toxic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwise.llm.common import id_text, materialise, prepare

BUCKETS = 1 << 18
ALPHA = 4.0
UNIT = 1 << 20
THRESHOLD = -0.15
TOXIC_RATIO, TOXIC_ALPHA = 1.8, 1.0
TOXIC_WORDS, PASSAGE = 2, 500
BROADCAST_IDS = 4_000_000
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


def word_array(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \t-\r]+"))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def _positions(words: Column, k: int) -> Column:
    """0 .. size - k, empty when there are fewer than k words."""
    return F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k)).otherwise(F.array().cast("array<int>"))


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the text.

    Windows are sorted as longs that hold a hash above and the position below; neighbours with equal
    hashes are compared word by word."""
    hashes = F.transform(_positions(words, 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def with_twins(wins: Column, bits: Column, mask: Column) -> Column:
        def twin(s: Column, x: Column, j: Column) -> Column:
            y = F.get(s, j)
            p, q = x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int")
            return F.coalesce((F.call_function("shiftright", x, bits) == F.call_function("shiftright", y, bits))
                              & (F.slice(words, p + 1, 3) == F.slice(words, q + 1, 3)), F.lit(False))

        def positions(s: Column) -> Column:
            return F.sort_array(F.transform(F.filter(s, lambda x, i: twin(s, x, i + 1) | twin(s, x, i - 1)), lambda x: x.bitwiseAND(mask)))
        packed = F.transform(wins, lambda h, i: F.call_function("shiftleft", h, bits).bitwiseOR(i.cast("long")))
        return F.aggregate(let(F.sort_array(packed), positions), F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("end")),
                           lambda acc, x: F.struct((acc["n"] + x + 3 - F.greatest(x, acc["end"])).alias("n"), (x + 3).alias("end")),
                           lambda acc: acc["n"])

    def counted(wins: Column) -> Column:
        bits = F.length(F.bin(F.size(wins).cast("long")))
        twins = let(bits, lambda b: let(F.call_function("shiftleft", F.lit(1).cast("long"), b) - 1, lambda m: with_twins(wins, b, m)))
        return F.when(F.size(F.array_distinct(wins)) < F.size(wins), twins).otherwise(F.lit(0).cast("long"))
    return let(hashes, counted)


def base_columns(text: Column, words: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    bare = text
    for s in SYMBOLS:
        bare = F.replace(bare, F.lit(s), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    repeated = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(bare)).cast("long"),
        "n_dup_lines": repeated.cast("long"),
        "n_repeat_words": let(words, repeated_words),
    }


def word_bucket(word: str, buckets: int) -> Column:
    return F.when(F.col(word).isNotNull(), F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int"))


def gram_rows(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """keys, ``block`` (of ``PASSAGE`` words), ``order`` (0 a word, 1 a bigram) and ``bucket`` of every unigram and bigram of rows(*keys, words).

    A row without words gives one null bucket, and a last word gives one for the bigram it does not open."""
    pairs = F.posexplode_outer(F.arrays_zip(F.col("words").alias("one"), F.slice("words", 2, F.size("words")).alias("two"))).alias("at", "pair")
    two = F.when(F.col("two").isNotNull(), F.pmod(F.xxhash64("one", "two"), F.lit(buckets)).cast("int"))
    rows = rows.select(*keys, pairs).select(*keys, F.floor(F.col("at") / PASSAGE).cast("int").alias("block"), F.col("pair.one"), F.col("pair.two"))
    return rows.select(*keys, "block", F.posexplode(F.array(word_bucket("one", buckets), two)).alias("order", "bucket"))


def broadcast_ids(spark, ids: DataFrame, name: str) -> DataFrame:
    """The written ids, broadcast up to ``BROADCAST_IDS`` of them; beyond that the texts are shuffled to meet them."""
    ids = materialise(spark, ids, name, small=True)
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def toxic_buckets(docs: DataFrame, trusted: DataFrame, toxic: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket) of the words that mark toxic documents; counts are documents, so one text's own words weigh little."""
    spark = docs.sparkSession
    ids = trusted.select(F.col("doc_id").cast("long").alias("l_id"), F.lit(False).alias("bad")) \
        .union(toxic.select(F.col("doc_id").cast("long"), F.lit(True))).filter("l_id is not null") \
        .groupBy("l_id").agg(F.max("bad").alias("bad"))
    ids = broadcast_ids(spark, ids, "quality-labelled")
    base = id_text(docs)
    words = base.join(ids, base["doc_id"] == ids["l_id"]).select("bad", F.explode(F.array_distinct(word_array(F.col("text")))).alias("word"))
    counts = words.select("bad", word_bucket("word", buckets).alias("bucket")).groupBy("bucket") \
        .agg(F.count_if("bad").alias("toxic"), F.count_if(~F.col("bad")).alias("clean"))
    counts = materialise(spark, counts, "quality-toxic", small=True)
    total = counts.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
    if not total["t"] or not total["c"]:
        return counts.select("bucket").limit(0)
    ratio = (F.col("toxic") + TOXIC_ALPHA) / (F.col("clean") * F.lit(float(total["t"]) / float(total["c"])) + TOXIC_ALPHA)
    return counts.filter(F.log(ratio) >= TOXIC_RATIO).select("bucket")


def worst_passage(blocks: Column) -> Column:
    """Most toxic words in two neighbouring blocks, from an array of (block, n) of the blocks that hold some."""
    blocks = F.sort_array(blocks)

    def pair(s: Column, x: Column, i: Column) -> Column:
        after = F.get(s, i + 1)
        return x["n"] + F.when(after["block"] == x["block"] + 1, after["n"]).otherwise(0)
    return F.coalesce(F.array_max(let(blocks, lambda s: F.transform(s, lambda x, i: pair(s, x, i)))), F.lit(0)).cast("long")


def fit_weights(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, alpha: float = ALPHA) -> DataFrame:
    """(bucket, w): round(2^20 * ln(p_trusted / p_raw)) of every bucket, at most ``buckets`` rows.

    ``trusted`` holds the doc_ids of the target texts."""
    spark = docs.sparkSession
    ids = trusted.select(F.col("doc_id").cast("long").alias("t_id")).filter("t_id is not null").distinct()
    ids = broadcast_ids(spark, ids, "quality-trusted")
    base = id_text(docs)
    marked = base.join(ids, base["doc_id"] == ids["t_id"], "left").select(F.col("t_id").isNotNull().alias("trusted"), word_array(F.col("text")).alias("words"))
    counts = gram_rows(marked, ["trusted"], buckets).filter("bucket is not null").groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count_if("trusted").alias("target"))
    counts = materialise(spark, counts, "quality-counts")
    total = counts.agg(F.sum("raw").alias("r"), F.sum("target").alias("t")).first()
    share = float(total["t"] or 0) / float(total["r"] or 1)
    ratio = (F.col("target") + alpha) / (F.col("raw") * F.lit(share) + alpha)
    return counts.select("bucket", F.round(F.log(ratio) * UNIT).cast("long").alias("w"))


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS, alpha: float = ALPHA,
          toxic: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, llr, n_toxic) of every row.

    ``toxic`` holds the doc_ids of texts labelled toxic; n_toxic counts the toxic words of the worst passage."""
    prepare(docs.sparkSession)
    weights = fit_weights(docs, trusted, buckets, alpha)
    if toxic is None:
        weights = weights.withColumn("toxic", F.lit(False))
    else:
        marked = toxic_buckets(docs, trusted, toxic, buckets).withColumn("toxic", F.lit(True))
        weights = weights.join(F.broadcast(marked), "bucket", "left").withColumn("toxic", F.coalesce("toxic", F.lit(False)))
    weights = F.broadcast(weights)  # at most ``buckets`` rows
    rows = id_text(docs).withColumn("row", F.monotonically_increasing_id()).withColumn("words", word_array(F.col("text")))
    base = base_columns(F.col("text"), F.col("words"))
    keys = ["row", "doc_id", *base]
    rows = rows.select("row", "doc_id", *[c.alias(n) for n, c in base.items()], "words")
    scored = gram_rows(rows, keys, buckets).join(weights, "bucket", "left") \
        .groupBy(*keys, "block").agg(F.sum("w").alias("s"), F.count("bucket").alias("n"), F.count_if(F.col("toxic") & (F.col("order") == 0)).alias("t")) \
        .groupBy(*keys).agg(F.sum("s").alias("s"), F.sum("n").alias("n"),
                            F.collect_list(F.when(F.col("t") > 0, F.struct("block", F.col("t").alias("n")))).alias("hits"))  # one entry a block with hits
    llr = F.coalesce(F.col("s") / F.lit(float(UNIT)) / F.col("n"), F.lit(0.0))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = scored.withColumn("n_toxic", worst_passage(F.col("hits")))
    kept = ~failed & (llr >= threshold) & (F.col("n_toxic") < TOXIC_WORDS)
    return scored.select("doc_id", *base, failed.alias("base_failed"), kept.alias("kept"), llr.alias("llr"), "n_toxic")
