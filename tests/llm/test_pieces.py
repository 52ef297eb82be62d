import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import AWKWARD, collect, frame
from layerwise.llm import pieces

ROWS = AWKWARD + [(30, "  two  blanks "), (31, "▁literal a▁b"), (32, "tab\tline\n\nend "), (33, "😀 ñandú <s> <0x41>"), (34, "w" * 3000 + " end")]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


def test_ids_and_round_trip_match_the_library(spark, library):
    out = pieces.encode(frame(spark, ROWS))
    assert collect(out, "doc_id", "ids") == sorted(((d, None if t is None else library.encode(t)) for d, t in ROWS), key=str)
    assert {r.doc_id for r in out.collect() if not r.round_trip} == set()
    back = pieces.decode(out)
    assert collect(back, "doc_id", "text") == sorted(((d, None if t is None else t.replace("▁", " ")) for d, t in ROWS), key=str)


def test_empty_table(spark):
    assert pieces.encode(frame(spark, []).limit(0)).count() == 0
    assert pieces.decode(spark.createDataFrame([], "doc_id long, ids array<int>")).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40), max_size=6))
def test_any_text_encodes_like_the_library(library, texts):
    import pyarrow as pa
    vocab = test_any_text_encodes_like_the_library.__dict__.setdefault("vocab", pieces.Vocabulary())
    buf, off = pieces.text_buffer(pieces.with_blank(pa.array(texts, pa.string())))
    ids, to = pieces.encode_chunk(vocab, buf, off)
    assert [ids[to[i]:to[i + 1]].tolist() for i in range(len(texts))] == [library.encode(t) for t in texts]
