import itertools

import numpy as np

from helpers import AWKWARD, frame
from layerwise.llm import lang_id, pieces
from layerwise.llm.textnp import text_buffer


def test_forward_sums_all_segmentations():
    import pyarrow as pa
    vocab = pieces.Vocabulary()
    rng = np.random.default_rng(1)
    prob = lang_id.with_unknown(rng.random((len(vocab.ids), 2)) / 1000)
    number = {vocab.bytes[i]: n for n, i in enumerate(vocab.ids.tolist())}
    units = [" the", " tion", " naïve", " 日x"]
    buf, starts = pieces.joined_units(*(lambda b, o: (b, o[:-1], o[1:]))(*text_buffer(pa.array(units))))
    ends = starts + [len(u.encode()) for u in units]
    got = lang_id.unit_loglik(vocab, prob, buf, starts, ends)
    for u, g in zip(units, got):
        total = np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=len(u) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(u)]
            p = np.ones(2)
            for a, b in zip(at, at[1:]):
                s = u[a:b].encode()
                p *= prob[number[s]] if s in number else (lang_id.UNKNOWN if b - a == 1 else 0)
            total += p
        assert np.allclose(np.log(total), g)


def test_awkward_rows_and_long_units(spark):
    learn = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "fr"), (4, "x", None)], "doc_id long, text string, lang string")
    fitted = lang_id.fit(learn)
    assert fitted[0] == ["en", "fr"] and np.allclose(fitted[1][:-1].sum(axis=0), 1)
    rows = AWKWARD + [(70, "the dog"), (71, "LE CHIEN"), (72, "123 --- !!"), (73, "é" * 5000)]
    got = lang_id.predict(frame(spark, rows), fitted).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[70].lang_pred == "en" and by[71].lang_pred == "fr"
    assert {by[i].lang_pred for i in (3, 4, 5, 72)} == {"und"} and {by[i].score for i in (3, 4, 5, 72)} == {0.0}
    assert all(0 <= r.score <= 1 for r in got)


def test_held_out_accuracy(spark):
    from conftest import SF01

    from layerwise.llm.queries import QUERIES
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = [r for r in QUERIES["op1_language_id"](spark, SF01).collect() if r.held_out]
    assert len(got) > 100 and sum(r.lang_pred == truth[r.doc_id] for r in got) > 0.98 * len(got)


def test_nothing_learned_and_empty_table(spark):
    none = lang_id.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in lang_id.predict(frame(spark), none).collect()} == {"und"}
    assert lang_id.predict(frame(spark, []).limit(0), none).count() == 0


def test_long_runs_without_pieces(spark):
    """Newlines, tabs and NULs have no piece: long runs leave fit finite and the rest of a text decides."""
    runs = ["\n" * 44, "\t" * 48, "\x00" * 200, "\r\n" * 300]
    rows = [(i, f"{w} word{r}{w}", g) for i, (r, (g, w)) in enumerate((r, x) for r in runs for x in (("en", "the cat and the dog"), ("fr", "le chat et le chien")))]
    fitted = lang_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert np.isfinite(fitted[1]).all() and (fitted[1] > 0).all() and np.allclose(fitted[1][:-1].sum(axis=0), 1)
    texts = [(200 + i, f"{r}le chien et le chat {r} x") for i, r in enumerate(runs)] + [(300 + i, f"the dog{r}") for i, r in enumerate(runs)]
    got = {r.doc_id: r for r in lang_id.predict(frame(spark, texts), fitted).collect()}
    assert all(got[200 + i].lang_pred == "fr" and got[300 + i].lang_pred == "en" for i in range(len(runs)))
    assert all(0.5 < r.score <= 1 for r in got.values())


def test_sample_stays_bounded_without_ids_and_with_repeated_rows(spark, monkeypatch):
    seen = []
    keep = lang_id.materialise
    monkeypatch.setattr(lang_id, "materialise", lambda s, df, name, **k: seen.append(keep(s, df, name, **k)) or seen[-1])
    rows = [(None, f"word{i} the", "en") for i in range(3000)] + [(7, f"mot{i} le", "fr") for i in range(3000)] + [(1, "same row", "de")] * 3000
    lang_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_lang=200, rounds=1)
    n = {r.lang: r.n for r in seen[0].filter("unit in (' the', ' le', ' same')").select("lang", "n").collect()}
    assert 120 < n["en"] < 280 and 120 < n["fr"] < 280 and n.get("de", 1) == 1
