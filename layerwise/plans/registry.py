"""Registry of named queries and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- SQL building blocks (DuckDB)
# FIXED VALUES mirrored from layerwise.plans.fixtures and layerwise.operators.model.

V64 = ("SELECT vec_id AS id, list_transform(embedding, lambda e: round(e::DOUBLE * 256) / 256) AS x, label "
       "FROM embeddings")
IMG8 = ("SELECT vec_id AS id, list_transform(embedding, lambda e: floor((e::DOUBLE + 1) * 127.5)::INTEGER) AS px, "
        "label FROM embeddings")


def order_key(seed, id_expr="id") -> str:
    return f"md5(concat_ws('|', '{seed}', ({id_expr})::VARCHAR))"


def hash01(seed, *parts) -> str:
    inner = ", ".join([f"'{seed}'"] + [f"({p})::VARCHAR" for p in parts])
    return f"(('0x' || substr(md5(concat_ws('|', {inner})), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def md5_int(seed, *parts) -> str:
    inner = ", ".join([f"'{seed}'"] + [f"({p})::VARCHAR" for p in parts])
    return f"(('0x' || substr(md5(concat_ws('|', {inner})), 1, 8))::BIGINT)"


def w_sql(layer: int, i="i", j="j") -> str:
    return f"(((({i}) * 7 + ({j}) * 13 + {layer * 3}) % 17) - 8)::DOUBLE / 64"


def b_sql(layer: int, j="j") -> str:
    return f"(((({j}) * 5 + {layer}) % 9) - 4)::DOUBLE / 64"


def explode(src: str, arr: str, keys: str = "id", idx: str = "i", val: str = "v") -> str:
    return f"SELECT {keys}, generate_subscripts({arr}, 1) - 1 AS {idx}, unnest({arr}) AS {val} FROM {src}"


def dense_sql(src: str, layer: int, n_out: int, keys: str = "id") -> str:
    """src(keys..., i, v) -> (keys..., j, z) with the fixed weights of ``layer``."""
    return (f"SELECT {keys}, t.j AS j, sum(v * {w_sql(layer, 'i', 't.j')}) + {b_sql(layer, 't.j')} AS z "
            f"FROM {src}, range({n_out}) t(j) GROUP BY {keys}, t.j")


def act_sql(kind: str, z: str = "z") -> str:
    if kind == "identity":
        return z
    if kind == "relu":
        return f"greatest({z}, 0.0::DOUBLE)"
    if kind == "leakyrelu":
        return f"CASE WHEN {z} > 0 THEN {z} ELSE {z} * 0.01::DOUBLE END"
    if kind == "sigmoid":
        return f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-({z}))))"
    if kind == "tanh":
        return f"tanh({z})"
    raise ValueError(kind)


def softmax_sql(src: str, keys: str = "id", z: str = "z", out: str = "p") -> str:
    return (f"SELECT *, e / sum(e) OVER (PARTITION BY {keys}) AS {out} FROM "
            f"(SELECT *, exp({z} - max({z}) OVER (PARTITION BY {keys})) AS e FROM {src})")
