"""SQL (DuckDB) building blocks over pixel tables (id, c, y, x, v) for the oracles.

Each function returns a SELECT over a named source relation; layer numbers select
the fixed parameters (see FIXED VALUES in layerwise.operators.model).
"""

from __future__ import annotations

from .registry import b_sql, w_sql


def pixels(src: str, arr: str, h: int, w: int, keys: str = "id") -> str:
    """(keys, arr) with a channel-major array -> (keys, c, y, x, v)."""
    return (f"SELECT {keys}, (k // {h * w})::BIGINT AS c, ((k % {h * w}) // {w})::BIGINT AS y, "
            f"(k % {w})::BIGINT AS x, v FROM (SELECT {keys}, generate_subscripts({arr}, 1) - 1 AS k, "
            f"unnest({arr})::DOUBLE AS v FROM {src})")


def flat(src: str, h: int, w: int, keys: str = "id", val: str = "v") -> str:
    return f"SELECT {keys}, (c * {h * w} + y * {w} + x)::BIGINT AS i, {val} AS value FROM {src}"


def conv(src: str, layer: int, cout: int, kh: int, kw: int, s: int, pt: int, pl: int, oh: int, ow: int) -> str:
    """2-D convolution with the fixed weights of ``layer``; zero padding by omission."""
    wi = f"(t.c * {kh} + ky.ky) * {kw} + kx.kx"
    return f"""SELECT id, o.o AS c, (t.y + {pt} - ky.ky) // {s} AS y, (t.x + {pl} - kx.kx) // {s} AS x,
  sum(t.v * {w_sql(layer, wi, 'o.o')}) + {b_sql(layer, 'o.o')} AS v
FROM {src} t, range({kh}) ky(ky), range({kw}) kx(kx), range({cout}) o(o)
WHERE t.y + {pt} - ky.ky >= 0 AND t.x + {pl} - kx.kx >= 0
  AND (t.y + {pt} - ky.ky) % {s} = 0 AND (t.x + {pl} - kx.kx) % {s} = 0
  AND (t.y + {pt} - ky.ky) // {s} < {oh} AND (t.x + {pl} - kx.kx) // {s} < {ow}
GROUP BY id, o.o, (t.y + {pt} - ky.ky) // {s}, (t.x + {pl} - kx.kx) // {s}"""


def pool(src: str, k: int, s: int, oh: int, ow: int, kind: str = "max") -> str:
    agg = "max" if kind == "max" else "avg"
    return f"""SELECT id, c, (t.y - ky.ky) // {s} AS y, (t.x - kx.kx) // {s} AS x, {agg}(t.v) AS v
FROM {src} t, range({k}) ky(ky), range({k}) kx(kx)
WHERE t.y - ky.ky >= 0 AND t.x - kx.kx >= 0 AND (t.y - ky.ky) % {s} = 0 AND (t.x - kx.kx) % {s} = 0
  AND (t.y - ky.ky) // {s} < {oh} AND (t.x - kx.kx) // {s} < {ow}
GROUP BY id, c, (t.y - ky.ky) // {s}, (t.x - kx.kx) // {s}"""


def batchnorm_fixed(src: str, layer: int, eps: float = 1e-5) -> str:
    gamma = f"(1.0::DOUBLE + (((c * 3 + {layer}) % 5) - 2)::DOUBLE / 8)"
    beta = f"((((c * 7 + {layer}) % 5) - 2)::DOUBLE / 16)"
    mean = f"((((c * 5 + {layer}) % 7) - 3)::DOUBLE / 16)"
    var = f"((1 + (c + {layer}) % 3)::DOUBLE / 4)"
    return (f"SELECT id, c, y, x, (v - {mean}) / sqrt({var} + {eps}::DOUBLE) * {gamma} + {beta} AS v "
            f"FROM {src}")


def relu(src: str) -> str:
    return f"SELECT id, c, y, x, greatest(v, 0.0::DOUBLE) AS v FROM {src}"


def add(a: str, b: str) -> str:
    return f"SELECT a.id, a.c, a.y, a.x, a.v + b.v AS v FROM {a} a JOIN {b} b USING (id, c, y, x)"
