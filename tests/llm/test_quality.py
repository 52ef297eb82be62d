from collections import Counter

from helpers import AWKWARD, SPACE_WORD, collect, frame, sentence
from layerwise.llm import quality

ROWS = AWKWARD + [(50, "a b c a b c d\nx\n\n x\nx\n#*$%&|<>é"), (51, "w " * 30), (52, (sentence(30, 4) + " ") * 4), (53, sentence(60, 11) + " | # bad") ]


def base(t):
    t = t or ""
    w = SPACE_WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if SPACE_WORD.search(line):
            dup += line in seen
            seen.add(line)
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    cover = {j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(cover), len(w) < 50 or 100 * len(cover) > 50 * len(w)


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_columns(spark):
    trusted = spark.createDataFrame([(1,), (1,), (10,), (None,)], "doc_id long")
    assert collect(quality.judge(frame(spark, ROWS), trusted), *COLUMNS) == sorted(((d, *base(t)) for d, t in ROWS), key=str)


def test_verdict_follows_the_trusted_corpus(spark):
    good = [(i, sentence(80, 100 + i)) for i in range(30)]
    bad = [(100 + i, " ".join(f"{w}%%%" for w in sentence(80, 200 + i).split())) for i in range(10)]
    out = quality.judge(frame(spark, good + bad), spark.createDataFrame([(i,) for i in range(20)], "doc_id long"))
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[i].kept for i, _ in good)
    assert not any(got[i].kept for i, _ in bad) and not any(got[i].base_failed for i, _ in bad)
    again = {r.doc_id: (r.llr, r.kept) for r in quality.judge(frame(spark, bad + good).repartition(7), spark.createDataFrame([(i,) for i in range(20)], "doc_id long")).collect()}
    assert again == {k: (r.llr, r.kept) for k, r in got.items()}


def test_llr_against_python(spark):
    """Same buckets and counts in plain Python."""
    import math
    from pyspark.sql import functions as F
    rows = [(i, sentence(55 + i, i)) for i in range(12)]
    df, trusted, buckets = frame(spark, rows), {0, 2, 3, 7}, 64
    rows = df.select("doc_id", quality.word_array(F.col("text")).alias("words"))
    grams = {r.doc_id: r.g for r in quality.gram_rows(rows, ["doc_id"], buckets).groupBy("doc_id").agg(F.collect_list("bucket").alias("g")).collect()}
    raw, good = Counter(), Counter()
    for d, g in grams.items():
        assert len(g) == 2 * (55 + d) - 1
        raw.update(g)
        if d in trusted:
            good.update(g)
    share = sum(good.values()) / sum(raw.values())
    w = {b: round(quality.UNIT * math.log((good[b] + quality.ALPHA) / (raw[b] * share + quality.ALPHA))) for b in raw}
    out = quality.judge(df, spark.createDataFrame([(i,) for i in trusted], "doc_id long"), buckets=buckets)
    for r in out.collect():
        assert abs(r.llr - sum(w[b] for b in grams[r.doc_id]) / quality.UNIT / len(grams[r.doc_id])) < 1e-9


def test_empty_table(spark):
    assert quality.judge(frame(spark, []).limit(0), spark.createDataFrame([], "doc_id long")).count() == 0


def test_toxic_words_in_long_texts_reject(spark):
    """Two insults in a text of ordinary or great length, labelled or not, which the mean score does not see."""
    def insulted(n, seed):
        w = sentence(n, seed).split()
        return " ".join([*w[:n // 2], "idiot", *w[n // 2:n // 2 + 20], "scum", *w[n // 2 + 20:]])
    clean, bad = [(i, sentence(150, i)) for i in range(40)], [(100 + i, insulted(150, 100 + i)) for i in range(12)]
    rows = clean + bad + [(200, insulted(6000, 200)), (201, sentence(6000, 201)), (202, sentence(90, 202) + " idiot")]
    labels = spark.createDataFrame([(i,) for i in range(20)], "doc_id long"), spark.createDataFrame([(100 + i,) for i in range(8)], "doc_id long")
    got = {r.doc_id: r for r in quality.judge(frame(spark, rows), labels[0], toxic=labels[1]).collect()}
    assert {i for i, r in got.items() if not r.kept} == {*(i for i, _ in bad), 200}
    assert got[200].n_toxic == 2 and got[200].llr > quality.THRESHOLD
    assert all(r.kept for r in quality.judge(frame(spark, rows), labels[0]).collect())
    none = labels[0].limit(0)
    assert all(r.n_toxic == 0 for r in quality.judge(frame(spark, rows), none, toxic=labels[1]).collect())


def test_labelled_toxic_documents_fall(spark):
    """Of the labelled documents that pass the base rules; a quarter of the toxic ones holds no shared marker at this size."""
    from conftest import SF01

    from layerwise.llm.queries import QUERIES
    label = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    got = [(label[r.doc_id], r.kept) for r in QUERIES["op7_quality_rules"](spark, SF01).collect() if r.doc_id in label and not r.base_failed]
    toxic, clean = [k for x, k in got if x == (1, 1)], [k for x, k in got if x == (1, 0)]
    assert toxic.count(False) >= 0.7 * len(toxic) > 0 and clean.count(True) >= 0.99 * len(clean)
