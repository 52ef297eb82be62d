"""Every registered corpus query: against its SQL where there is one, and the pipeline against plain rules."""

import math

import pandas as pd
import pytest

import __spark_entry__ as entry
from conftest import SF
from helpers import ALNUM_WORD, UP
from layerwise.llm import queries
from test_near_dup import brute
from test_quality import base


def rows_of(pdf):
    cols = sorted(pdf.columns)

    def norm(v):
        v = v.item() if hasattr(v, "item") else v
        return None if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)) else round(v, 5) + 0.0 if isinstance(v, float) else v
    return cols, sorted((tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=str)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, duck, name):
    assert rows_of(queries.QUERIES[name](spark, SF).toPandas()) == rows_of(duck.execute(queries.ORACLES[name]).df())


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op") and x.split("_")[0][2:].isdigit()}
    assert "pipeline" in names


def test_pipeline_stages(spark):
    import corpus_pipeline as cp
    from layerwise.llm.common import materialise
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = docs
    kept = []
    for name, stage in cp.STAGES:
        out = materialise(spark, stage(spark, at, SF), "test-stage")
        if name != "SentencePiece":
            assert out.columns == docs.columns
        kept.append((name, at, out))
        at = out
    rows = [[(r.doc_id, r.text) for r in a.collect()] for _, a, _ in kept[:4]]
    ids = [{d for d, _ in r} for r in rows] + [{r.doc_id for r in kept[4][1].collect()}]
    assert all(not base(t)[5] for d, t in rows[0] if d in ids[1])
    assert ids[2] == {d for d, _, _, keep in brute(rows[1], 80) if keep}
    wins = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = ALNUM_WORD.findall((r.text or "").translate(UP))
        wins |= {" " + " ".join(w[i:i + 10]) + " " for i in range(max(1, len(w) - 9) if w else 0)}
    hit = {d for d, t in rows[2] if any(k in " " + " ".join(ALNUM_WORD.findall((t or "").translate(UP))) + " " for k in wins)}
    assert ids[3] == ids[2] - hit and ids[4] == ids[3]
    assert kept[4][2].count() == len(ids[4]) and kept[4][2].filter("not round_trip").count() == 0


def test_near_duplicate_stage_leaves_one_of_repeated_rows(spark):
    import corpus_pipeline as cp
    from helpers import AWKWARD, frame
    out = cp.near_duplicates(spark, frame(spark), SF)
    want = brute([r for i, r in enumerate(AWKWARD) if r not in AWKWARD[:i]], 80)
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(d) for d, _, _, keep in want if keep)
    assert out.columns == frame(spark).columns


def test_stages_on_empty_tables(spark):
    import corpus_pipeline as cp
    from helpers import frame
    docs = frame(spark, []).limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_pipeline_runs_from_the_entry(spark):
    assert entry.queries()["pipeline"](spark, SF).count() > 0
