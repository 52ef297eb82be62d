"""Every registered query against its DuckDB oracle on sf0.001 (the driver gate, smaller)."""

import math

import pytest

import __spark_entry__ as entry
from conftest import SF
from layerwise.plans import load_all, registry

load_all()
QUERIES = {n: f for n, f in entry.queries().items() if n in registry.QUERIES}
ORACLES = dict(registry.ORACLES)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_registered_with_oracle_or_documented():
    assert set(QUERIES) - set(ORACLES) == {"trn04_fit_conv_net", "trn05_fit_graph", "program_people_mlp", "program_digits_mlp",
                                           "program_animals_mlp", "program_image_lenet"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    sp = QUERIES[name](spark, SF).toPandas()
    dd = duck.execute(ORACLES[name]).df()
    c1, r1 = _rows(sp)
    c2, r2 = _rows(dd)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_schema_is_stable(spark):
    a = entry.entry(spark)
    assert [f.name for f in a.schema.fields] == ["actual", "predicted", "n"]
    assert a.count() == 100
