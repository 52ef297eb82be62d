import numpy as np
import pyarrow as pa

from helpers import ALNUM_WORD, AWKWARD, SPACE_WORD, UP
from layerwise.llm import textnp
from layerwise.llm.common import components, keep_rows, materialise


def test_components_of_chains_stars_and_pairs(spark):
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    star = [("hub", f"s{i}") for i in range(300)]
    pairs = [("x1", "x0"), ("y0", "y1"), ("y1", "y0"), ("z", "z")]
    got = {r.node: r.label for r in components(spark, spark.createDataFrame(chain + star + pairs, "a string, b string")).collect()}
    assert {got[f"c{i:03d}"] for i in range(61)} == {"c000"}
    assert {got[x] for e in star for x in e} == {"hub"}
    assert got["x0"] == got["x1"] == "x0" and got["y1"] == "y0" and got["z"] == "z"
    assert components(spark, spark.createDataFrame([], "a string, b string")).count() == 0


def test_hub_edges_are_dealt_over_blocks(spark, monkeypatch):
    from layerwise.llm import common
    monkeypatch.setattr(common, "EDGE_BLOCK", 16)
    star = [("m", f"s{i:03d}") for i in range(200)]
    chain = [(f"s{i:03d}", f"t{i:03d}") for i in range(0, 200, 3)] + [("t003", "a")]
    got = {r.node: r.label for r in components(spark, spark.createDataFrame(star + chain, "a string, b string")).collect()}
    assert set(got.values()) == {"a"} and len(got) == 1 + 200 + 67 + 1


def test_keep_rows_matches_nulls_and_leaves_columns(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (None, "b", "y"), (2, "c", "z"), (1, "d", "x")], "doc_id long, text string, __kept string")
    out = keep_rows(docs, spark.createDataFrame([(1,), (None,), (1,)], "doc_id long"))
    assert out.columns == docs.columns and sorted(r.text for r in out.collect()) == ["a", "b", "d"]


def test_written_tables_have_few_files(spark):
    out = materialise(spark, spark.range(1000).repartition(400), "few", small=True)
    assert out.count() == 1000 and len(out.inputFiles()) <= 4 * spark.sparkContext.defaultParallelism


def test_words_and_hashes_do_not_cross_texts():
    texts = [t for _, t in AWKWARD] + ["ab", "b", "a", "", "a"]
    buf, off = textnp.text_buffer(pa.array(texts, pa.string()))
    low = textnp.LOWER[buf]
    for table, pattern in ((textnp.SPACE_WORDS, SPACE_WORD), (textnp.ALNUM_WORDS, ALNUM_WORD)):
        st, en, wo = textnp.words(low, off, table)
        raw = low.tobytes()
        got = [[raw[a:b].decode() for a, b in zip(st[wo[i]:wo[i + 1]], en[wo[i]:wo[i + 1]])] for i in range(len(texts))]
        assert got == [pattern.findall((t or "").translate(UP)) for t in texts]
        h = textnp.word_hashes(low, st, en)
        by_word = {}
        for w, x in zip((w for ws in got for w in ws), h.tolist()):
            assert by_word.setdefault(w, x) == x
        assert len(set(by_word.values())) == len(by_word)


def test_chunks_cover_all_rows_in_bounded_pieces():
    off = np.cumsum([0, 5, 0, 700, 3, 3, 3, 0, 900, 1])
    got = list(textnp.chunks(off, 10))
    assert [a for a, _ in got] == [0] + [b for _, b in got[:-1]] and got[-1][1] == len(off) - 1
    assert all(off[b] - off[a] <= 10 or b - a == 1 for a, b in got)
