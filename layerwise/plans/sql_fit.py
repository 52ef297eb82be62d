"""DuckDB SQL of whole parameter-averaging fits of dense nets: one recursion step per mini-batch.

The recursion carries (step, worker, l, i, j, w, vel): every worker's weights and Nesterov velocity. A bias is
the weight of input number ``n_in``, whose value is 1. Workers without a batch at a step keep their values;
at the end of a round the workers that had rows in it are averaged and all continue from the mean.
"""

from __future__ import annotations

ACTIVATION = {"relu": ("greatest({z}, 0.0::DOUBLE)", "CASE WHEN {z} > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"),
              "leakyrelu": ("CASE WHEN {z} > 0 THEN {z} ELSE {z} * 0.01::DOUBLE END", "CASE WHEN {z} > 0 THEN 1.0::DOUBLE ELSE 0.01::DOUBLE END")}


def values(rows) -> str:
    """(l, i, j, w) rows as literals that keep every bit of the weights."""
    return "(VALUES " + ", ".join(f"({l}, {i}, {j}, {w:.17e})" for l, i, j, w in rows) + ") t(l, i, j, w)"


def fit_ctes(ctes: str, widths: list[int], acts: list[str], start_rows, out_delta: str, workers: int, batch: int, frequency: int,
             epochs: int, lr: float, mu: float, l2: float = 0.0) -> str:
    """``ctes`` define d(id, worker, k, x, ...): the training rows in order key k. ``widths`` are the layer inputs and
    the output. ``out_delta``: SQL of the loss gradient at output j, over o(id, worker, j, z, p) joined with d, where
    p is the softmax over the outputs below ``n_soft`` named there. Leaves ``fitted(l, i, j, w)``."""
    n = len(widths) - 1
    step = []
    for layer in range(n):
        step.append(f"z{layer} AS (SELECT a.worker, a.id, c.j, sum(a.v * c.w) AS z FROM a{layer} a JOIN cur c ON c.worker = a.worker "
                    f"AND c.l = {layer} AND c.i = a.i GROUP BY a.worker, a.id, c.j)")
        if layer < n - 1:
            act = ACTIVATION[acts[layer]][0].format(z="z")
            step.append(f"a{layer + 1} AS (SELECT worker, id, j AS i, {act} AS v FROM z{layer} UNION ALL "
                        f"SELECT worker, id, {widths[layer + 1]} AS i, 1.0::DOUBLE AS v FROM rows_now)")
    step.append(f"d{n - 1} AS ({out_delta.format(z=f'z{n - 1}')})")
    for layer in range(n - 2, -1, -1):
        slope = ACTIVATION[acts[layer]][1].format(z="z.z")
        step.append(f"d{layer} AS (SELECT z.worker, z.id, z.j, sum(up.d * c.w) * {slope} AS d FROM z{layer} z JOIN cur c ON c.worker = z.worker "
                    f"AND c.l = {layer + 1} AND c.i = z.j JOIN d{layer + 1} up ON up.worker = z.worker AND up.id = z.id AND up.j = c.j "
                    f"GROUP BY z.worker, z.id, z.j, z.z)")
    grads = " UNION ALL ".join(f"SELECT a.worker, {layer} AS l, a.i, d.j, sum(a.v * d.d) AS g FROM a{layer} a JOIN d{layer} d "
                               f"ON d.worker = a.worker AND d.id = a.id GROUP BY a.worker, a.i, d.j" for layer in range(n))
    bias = "CASE " + " ".join(f"WHEN cur.l = {layer} THEN cur.i < {widths[layer]}" for layer in range(n)) + " END"
    return f"""
WITH RECURSIVE {ctes},
b AS (SELECT *, (row_number() OVER (PARTITION BY worker ORDER BY k, id) - 1) // {batch} AS bt FROM d),
span AS (SELECT (max(bt) // {frequency} + 1) * {frequency} AS n FROM b),
xe AS (SELECT id, worker, bt, generate_subscripts(x, 1) - 1 AS i, unnest(x) AS v FROM b
       UNION ALL SELECT id, worker, bt, {widths[0]} AS i, 1.0::DOUBLE AS v FROM b),
p(step, worker, l, i, j, w, vel) AS (
  SELECT 0::BIGINT, k.worker, t.l, t.i, t.j, t.w, 0.0::DOUBLE FROM {values(start_rows)}, range({workers}) k(worker)
  UNION ALL
  SELECT * FROM (
    WITH cur AS (SELECT * FROM p WHERE step < {epochs} * (SELECT n FROM span)),
    now AS (SELECT max(step) AS s, max(step) % (SELECT n FROM span) AS bt FROM cur),
    rows_now AS (SELECT b.* FROM b JOIN now ON b.bt = now.bt),
    size AS (SELECT worker, count(*)::DOUBLE AS m FROM rows_now GROUP BY worker),
    a0 AS (SELECT xe.worker, xe.id, xe.i, xe.v FROM xe JOIN now ON xe.bt = now.bt),
    {(", ").join(step)},
    g AS ({grads}),
    v2 AS (SELECT cur.*, m, {mu}::DOUBLE * cur.vel - {lr}::DOUBLE * (g.g / m + CASE WHEN {bias} THEN {l2}::DOUBLE * cur.w ELSE 0.0::DOUBLE END) AS nv
           FROM cur LEFT JOIN size ON size.worker = cur.worker LEFT JOIN g ON g.worker = cur.worker AND g.l = cur.l AND g.i = cur.i AND g.j = cur.j),
    w2 AS (SELECT worker, l, i, j, CASE WHEN m IS NULL THEN w ELSE w + (1 + {mu}::DOUBLE) * nv - {mu}::DOUBLE * vel END AS w,
                  CASE WHEN m IS NULL THEN vel ELSE nv END AS vel FROM v2),
    active AS (SELECT DISTINCT b.worker FROM b, now WHERE b.bt // {frequency} = now.bt // {frequency}),
    mean AS (SELECT l, i, j, avg(w) AS w, avg(vel) AS vel FROM w2 JOIN active ON active.worker = w2.worker GROUP BY l, i, j)
    SELECT now.s + 1, w2.worker, w2.l, w2.i, w2.j,
           CASE WHEN (now.bt + 1) % {frequency} = 0 THEN mean.w ELSE w2.w END,
           CASE WHEN (now.bt + 1) % {frequency} = 0 THEN mean.vel ELSE w2.vel END
    FROM w2 JOIN mean ON mean.l = w2.l AND mean.i = w2.i AND mean.j = w2.j, now)
),
fitted AS (SELECT l, i, j, w FROM p WHERE worker = 0 AND step = {epochs} * (SELECT n FROM span))"""


def softmax_delta(classes: int) -> str:
    """Gradient of the negative log-likelihood under softmax, label column ``label``."""
    return ("SELECT o.worker, o.id, o.j, o.p - CASE WHEN r.label = o.j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS d FROM "
            "(SELECT *, e / sum(e) OVER (PARTITION BY id) AS p FROM (SELECT *, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM {z})) o "
            "JOIN rows_now r ON r.id = o.id")


def dense_rows(net) -> list:
    """(l, i, j, w) of a sequential dense net, biases as input n_in."""
    out = []
    for layer, v in enumerate(net.vertices):
        w, b = net.params[(v.name, "W")], net.params[(v.name, "b")]
        out += [(layer, i, j, float(w[i, j])) for i in range(w.shape[0]) for j in range(w.shape[1])]
        out += [(layer, w.shape[0], j, float(b[j])) for j in range(b.shape[0])]
    return out


def dense_select(widths: list[int]) -> str:
    """fitted as the rows of the parameter table."""
    n_in = "CASE l " + " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(widths[:-1])) + " END"
    n_out = "CASE l " + " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(widths[1:])) + " END"
    return (f"SELECT l::INTEGER AS layer, CASE WHEN i < {n_in} THEN 'W' ELSE 'b' END AS name, "
            f"(CASE WHEN i < {n_in} THEN i * {n_out} + j ELSE j END)::BIGINT AS idx, round(w, 6) AS value FROM fitted")
