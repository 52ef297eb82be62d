"""Layered models as small driver-side objects: layer list or graph of vertices.

A ``Net`` holds the configuration and the parameters (NumPy arrays). It is
shipped to tasks by closure or broadcast (see ``scoring.ship``); all row data
stays in Spark.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

import numpy as np

from . import kernels as K


@dataclass
class Layer:
    kind: str                      # dense output conv2d pool2d lrn batchnorm zeropad activation
    n_out: int = 0
    activation: str = "identity"
    loss: str | None = None
    kernel: tuple = (1, 1)
    stride: tuple = (1, 1)
    padding: tuple = (0, 0)        # zeropad: (top, bottom, left, right)
    mode: str = "truncate"         # truncate | same
    pool: str = "max"
    keep: float = 1.0              # dropout keep probability on the layer input while training
    opts: dict = field(default_factory=dict)


def dense(n_out, activation="sigmoid", keep=1.0):
    return Layer("dense", n_out=n_out, activation=activation, keep=keep)


def output(n_out, activation="softmax", loss="nll", keep=1.0):
    return Layer("output", n_out=n_out, activation=activation, loss=loss, keep=keep)


def conv2d(n_out, kernel=(5, 5), stride=(1, 1), padding=(0, 0), mode="truncate", activation="identity"):
    return Layer("conv2d", n_out=n_out, kernel=tuple(kernel), stride=tuple(stride), padding=tuple(padding),
                 mode=mode, activation=activation)


def pool2d(kernel=(2, 2), stride=(2, 2), padding=(0, 0), mode="truncate", pool="max"):
    return Layer("pool2d", kernel=tuple(kernel), stride=tuple(stride), padding=tuple(padding), mode=mode, pool=pool)


def lrn_layer(k=K.LRN_K, n=K.LRN_N, alpha=K.LRN_ALPHA, beta=K.LRN_BETA):
    return Layer("lrn", opts={"k": k, "n": n, "alpha": alpha, "beta": beta})


def batchnorm_layer(eps=K.BN_EPS):
    return Layer("batchnorm", opts={"eps": eps})


def zeropad_layer(top, bottom=None, left=None, right=None):
    bottom = top if bottom is None else bottom
    left = top if left is None else left
    right = left if right is None else right
    return Layer("zeropad", padding=(top, bottom, left, right))


def activation_layer(kind):
    return Layer("activation", activation=kind)


@dataclass
class Vertex:
    name: str
    op: str                        # layer | merge | add
    inputs: list
    layer: Layer | None = None


PARAM_NAMES = {"dense": ("W", "b"), "output": ("W", "b"), "conv2d": ("W", "b"),
               "batchnorm": ("gamma", "beta", "mean", "var")}


class Net:
    """Directed acyclic graph of vertices; a layer list is the chain special case."""

    def __init__(self, inputs: dict, vertices: list, outputs: list):
        self.inputs = {k: tuple(v) for k, v in inputs.items()}
        self.vertices = vertices
        self.outputs = list(outputs)
        self.params: dict = {}
        self.shapes = self._infer_shapes()

    # ------------------------------------------------------------ construction
    @classmethod
    def sequential(cls, input_shape, layers):
        vs, prev = [], "input"
        for i, lay in enumerate(layers):
            vs.append(Vertex(str(i), "layer", [prev], lay))
            prev = str(i)
        return cls({"input": tuple(input_shape)}, vs, [prev])

    def _infer_shapes(self):
        """Driver-side shape check: every vertex's output shape (without the row axis)."""
        sh = dict(self.inputs)
        for v in self.vertices:
            ins = [sh[i] for i in v.inputs]
            if v.op == "merge":
                if all(len(s) == 1 for s in ins):
                    sh[v.name] = (sum(s[0] for s in ins),)
                else:
                    c = sum(s[0] for s in ins)
                    sh[v.name] = (c,) + tuple(ins[0][1:])
                continue
            if v.op == "add":
                if any(s != ins[0] for s in ins):
                    raise ValueError(f"add {v.name}: shapes differ {ins}")
                sh[v.name] = ins[0]
                continue
            s, lay = ins[0], v.layer
            if lay.kind in ("dense", "output"):
                sh[v.name] = (lay.n_out,)
            elif lay.kind == "conv2d":
                if len(s) != 3:
                    raise ValueError(f"conv2d {v.name} needs (c,h,w) input, got {s}")
                _, oh, ow = K.conv_geometry(s[1], s[2], *lay.kernel, *lay.stride, *lay.padding, lay.mode)
                sh[v.name] = (lay.n_out, oh, ow)
            elif lay.kind == "pool2d":
                _, oh, ow = K.conv_geometry(s[1], s[2], *lay.kernel, *lay.stride, *lay.padding, lay.mode)
                sh[v.name] = (s[0], oh, ow)
            elif lay.kind == "zeropad":
                t, b, l, r = lay.padding
                sh[v.name] = (s[0], s[1] + t + b, s[2] + l + r)
            else:
                sh[v.name] = s
        return sh

    def n_in(self, v: Vertex) -> int:
        s = self.shapes[v.inputs[0]]
        return int(s[0]) if v.layer.kind == "conv2d" else int(np.prod(s))

    def param_shapes(self, v: Vertex) -> dict:
        lay = v.layer
        if lay is None or lay.kind not in PARAM_NAMES:
            return {}
        if lay.kind in ("dense", "output"):
            return {"W": (self.n_in(v), lay.n_out), "b": (lay.n_out,)}
        if lay.kind == "conv2d":
            return {"W": (lay.n_out, self.n_in(v), *lay.kernel), "b": (lay.n_out,)}
        c = self.shapes[v.inputs[0]][0]
        return {n: (c,) for n in PARAM_NAMES["batchnorm"]}

    def param_keys(self):
        keys = []
        for v in self.vertices:
            for name, shp in self.param_shapes(v).items():
                keys.append((v.name, name, shp))
        return keys

    def n_params(self) -> int:
        return int(sum(np.prod(s) for _, _, s in self.param_keys()))

    def products(self) -> int:
        """Multiplications of one row's forward pass: weights times the places they are used at."""
        n = 0
        for v in self.vertices:
            size = int(np.prod(self.shapes[v.name]))
            w = self.param_shapes(v).get("W")
            n += size if w is None else size * (int(np.prod(w)) // v.layer.n_out)
        return n

    def nbytes(self) -> int:
        return 8 * self.n_params()

    # ------------------------------------------------------------ parameters
    def init(self, seed=0, scheme="xavier", std=0.01, bias=0.0):
        """OPT-1: seeded initial parameters (driver side; parameters are small)."""
        rng = np.random.default_rng(seed)
        for v in self.vertices:
            for name, shp in self.param_shapes(v).items():
                if name in ("b", "beta", "mean"):
                    arr = np.full(shp, float(bias) if name == "b" else 0.0)
                elif name in ("gamma", "var"):
                    arr = np.ones(shp)
                else:
                    fan_in = int(np.prod(shp[1:])) if v.layer.kind == "conv2d" else shp[0]
                    fan_out = shp[0] * int(np.prod(shp[2:])) if v.layer.kind == "conv2d" else shp[1]
                    if scheme == "xavier":
                        arr = rng.normal(0.0, np.sqrt(2.0 / (fan_in + fan_out)), shp)
                    elif scheme == "normal":
                        arr = rng.normal(0.0, std, shp)
                    elif scheme == "truncated_normal":
                        arr = rng.normal(0.0, std, shp)
                        bad = np.abs(arr) > 2 * std
                        while bad.any():
                            arr[bad] = rng.normal(0.0, std, int(bad.sum()))
                            bad = np.abs(arr) > 2 * std
                    elif scheme == "zero":
                        arr = np.zeros(shp)
                    else:
                        raise ValueError(scheme)
                self.params[(v.name, name)] = arr
        return self

    def fixed_init(self):
        """Deterministic dyadic parameters used by tests and oracles (see FIXED VALUES)."""
        for li, v in enumerate(self.vertices):
            for name, shp in self.param_shapes(v).items():
                self.params[(v.name, name)] = fixed_param(li, name, shp, v.layer.kind)
        return self

    def flat(self) -> np.ndarray:
        return np.concatenate([self.params[(n, p)].ravel() for n, p, _ in self.param_keys()]) \
            if self.param_keys() else np.zeros(0)

    def set_flat(self, vec: np.ndarray):
        off = 0
        for n, p, shp in self.param_keys():
            size = int(np.prod(shp))
            self.params[(n, p)] = np.asarray(vec[off:off + size], dtype=float).reshape(shp)
            off += size
        return self

    def copy(self):
        other = Net(self.inputs, self.vertices, self.outputs)
        other.params = {k: v.copy() for k, v in self.params.items()}
        return other

    # ------------------------------------------------------------ forward / backward
    def _reshape_in(self, name, x):
        shp = self.inputs[name]
        return x.reshape((x.shape[0],) + shp)

    def values(self, feeds: dict, wanted) -> dict:
        """Values of the wanted vertices only: others are computed where these need them and dropped
        after their last use."""
        wanted = set(wanted)
        needed, todo = set(), list(wanted)
        by_name = {v.name: v for v in self.vertices}
        while todo:
            name = todo.pop()
            if name in by_name and name not in needed:
                needed.add(name)
                todo += by_name[name].inputs
        path = [v for v in self.vertices if v.name in needed]
        uses: dict = {}
        for v in path:
            for i in v.inputs:
                uses[i] = uses.get(i, 0) + 1
        part = Net(self.inputs, [], [])
        part.params = self.params
        vals = {k: self._reshape_in(k, np.asarray(x, dtype=float)) for k, x in feeds.items()}
        for v in path:
            part.vertices = [v]
            vals[v.name] = part.forward({}, seen=vals)[0][v.name]
            for i in v.inputs:
                uses[i] -= 1
                if not uses[i] and i not in wanted:
                    vals.pop(i, None)
        return {k: vals[k] for k in wanted}

    def forward(self, feeds: dict, train=False, mask_fn=None, seen: dict | None = None):
        """Values of every vertex. ``mask_fn(vertex, shape)`` gives dropout masks when training; ``seen``
        holds values computed before."""
        vals = {k: self._reshape_in(k, np.asarray(x, dtype=float)) for k, x in feeds.items()}
        vals.update(seen or {})
        cache = {}
        for v in self.vertices:
            ins = [vals[i] for i in v.inputs]
            if v.op == "merge":
                vals[v.name] = np.concatenate([i.reshape(i.shape[0], -1) if i.ndim == 2 else i for i in ins], axis=1)
                continue
            if v.op == "add":
                out = ins[0].copy()
                for i in ins[1:]:
                    out = out + i
                vals[v.name] = out
                continue
            x, lay = ins[0], v.layer
            if train and lay.keep < 1.0 and mask_fn is not None:
                m = mask_fn(v, x.shape)
                x = x * m / lay.keep
                cache[(v.name, "mask")] = m
            cache[(v.name, "x")] = x
            kind = lay.kind
            if kind in ("dense", "output"):
                z = x.reshape(x.shape[0], -1) @ self.params[(v.name, "W")] + self.params[(v.name, "b")]
                cache[(v.name, "z")] = z
                vals[v.name] = K.activate(z, lay.activation)
            elif kind == "conv2d":
                z = K.conv2d(x, self.params[(v.name, "W")], self.params[(v.name, "b")],
                             lay.stride, lay.padding, lay.mode)
                cache[(v.name, "z")] = z
                vals[v.name] = K.activate(z, lay.activation)
            elif kind == "pool2d":
                vals[v.name] = K.pool2d(x, lay.kernel, lay.stride, lay.padding, lay.mode, lay.pool)
            elif kind == "lrn":
                vals[v.name] = K.lrn(x, **lay.opts)
            elif kind == "batchnorm":
                p = {n: self.params[(v.name, n)] for n in PARAM_NAMES["batchnorm"]}
                vals[v.name] = K.batchnorm(x, p["gamma"], p["beta"], p["mean"], p["var"], lay.opts.get("eps", K.BN_EPS))
            elif kind == "zeropad":
                vals[v.name] = K.zeropad(x, *lay.padding)
            elif kind == "activation":
                cache[(v.name, "z")] = x
                vals[v.name] = K.activate(x, lay.activation)
            else:
                raise ValueError(kind)
        return vals, cache

    def predict_proba(self, feeds: dict) -> dict:
        vals, _ = self.forward(feeds)
        return {o: vals[o].reshape(vals[o].shape[0], -1) for o in self.outputs}

    def loss_and_grads(self, feeds: dict, labels: dict, train=True, mask_fn=None, reduce="mean"):
        """Mean loss over rows (sum over outputs) and mean (or summed) gradients, no penalty."""
        vals, cache = self.forward(feeds, train=train, mask_fn=mask_fn)
        n = next(iter(feeds.values())).shape[0]
        grads_v = {}
        loss_rows = np.zeros(n)
        for o in self.outputs:
            lay = self._vertex(o).layer
            y = np.asarray(labels[o], dtype=float)
            p = vals[o].reshape(n, -1)
            loss_rows += K.loss_rows(p, y, lay.loss or "mse")
            gz = K.loss_grad_z(cache[(o, "z")], p, y, lay.loss or "mse", lay.activation)
            grads_v[o] = ("z", gz / n if reduce == "mean" else gz)
        pgrads = {k: np.zeros_like(v) for k, v in self.params.items()}
        for v in reversed(self.vertices):
            if v.name not in grads_v:
                continue
            kind_g, g = grads_v.pop(v.name)
            if v.op in ("merge", "add"):
                off = 0
                for i in v.inputs:
                    if v.op == "merge":
                        width = vals[i].shape[1]
                        gi = g[:, off:off + width]
                        off += width
                    else:
                        gi = g
                    self._acc(grads_v, i, gi.reshape(vals[i].shape))
                continue
            lay = v.layer
            x = cache[(v.name, "x")]
            if lay.kind in ("dense", "output", "conv2d", "activation"):
                dz = g if kind_g == "z" else K.activate_grad(cache[(v.name, "z")], vals[v.name], g, lay.activation)
            if lay.kind in ("dense", "output"):
                xf = x.reshape(x.shape[0], -1)
                pgrads[(v.name, "W")] += xf.T @ dz
                pgrads[(v.name, "b")] += dz.sum(axis=0)
                dx = (dz @ self.params[(v.name, "W")].T).reshape(x.shape)
            elif lay.kind == "conv2d":
                dx, dW, db = K.conv2d_backward(x, self.params[(v.name, "W")], dz, lay.stride, lay.padding, lay.mode)
                pgrads[(v.name, "W")] += dW
                pgrads[(v.name, "b")] += db
            elif lay.kind == "pool2d":
                dx = K.pool2d_backward(x, g, lay.kernel, lay.stride, lay.padding, lay.mode, lay.pool)
            elif lay.kind == "activation":
                dx = dz
            elif lay.kind == "zeropad":
                t, b, l, r = lay.padding
                dx = g[:, :, t:g.shape[2] - b, l:g.shape[3] - r]
            else:
                raise NotImplementedError(f"no gradient for {lay.kind}")
            if (v.name, "mask") in cache:
                dx = dx * cache[(v.name, "mask")] / lay.keep
            src = v.inputs[0]
            if src in self.inputs:
                continue
            self._acc(grads_v, src, dx.reshape(vals[src].shape))
        return float(loss_rows.mean()), pgrads, loss_rows

    @staticmethod
    def _acc(grads_v, name, g):
        if name in grads_v:
            grads_v[name] = ("a", grads_v[name][1] + g)
        else:
            grads_v[name] = ("a", g)

    def _vertex(self, name) -> Vertex:
        return next(v for v in self.vertices if v.name == name)

    def weight_keys(self):
        """Keys of parameters that take L1/L2 penalties (weights only)."""
        return [(n, p) for n, p, _ in self.param_keys() if p == "W"]

    # ------------------------------------------------------------ description
    def layer_rows(self):
        rows = []
        for li, v in enumerate(self.vertices):
            lay = v.layer
            opts = {"name": v.name, "op": v.op, "inputs": v.inputs}
            if lay is not None:
                d = asdict(lay)
                opts.update({k: d[k] for k in ("kernel", "stride", "padding", "mode", "pool", "keep", "opts", "loss")})
            rows.append((li, lay.kind if lay else v.op, self.n_in(v) if lay and lay.kind in PARAM_NAMES else 0,
                         int(lay.n_out) if lay else 0, lay.activation if lay else "identity",
                         json.dumps(opts, sort_keys=True)))
        return rows

    def config_json(self) -> str:
        return json.dumps({"inputs": {k: list(v) for k, v in self.inputs.items()}, "outputs": self.outputs})


def net_from_rows(layer_rows, config_json) -> Net:
    cfg = json.loads(config_json)
    vs = []
    for li, kind, n_in, n_out, act, opts_s in sorted(layer_rows, key=lambda r: r[0]):
        o = json.loads(opts_s)
        if o["op"] in ("merge", "add"):
            vs.append(Vertex(o["name"], o["op"], o["inputs"]))
        else:
            lay = Layer(kind, n_out=n_out, activation=act, loss=o.get("loss"), kernel=tuple(o["kernel"]),
                        stride=tuple(o["stride"]), padding=tuple(o["padding"]), mode=o["mode"], pool=o["pool"],
                        keep=o["keep"], opts=o["opts"])
            vs.append(Vertex(o["name"], "layer", o["inputs"], lay))
    return Net({k: tuple(v) for k, v in cfg["inputs"].items()}, vs, cfg["outputs"])


# FIXED VALUES: deterministic dyadic parameters shared with the SQL oracles.
#   weight (layer l, row i, column j) = ((i*7 + j*13 + l*3) mod 17 - 8) / 64
#   bias   (layer l, unit j)          = ((j*5 + l) mod 9 - 4) / 64
#   batch-norm channel c of layer l: gamma = 1 + ((c*3 + l) mod 5 - 2) / 8,
#     beta = ((c*7 + l) mod 5 - 2) / 16, mean = ((c*5 + l) mod 7 - 3) / 16, var = (1 + (c + l) mod 3) / 4
# For a conv kernel W[o, c, ky, kx] the row index is i = (c*kh + ky)*kw + kx and the column j = o.
def fixed_weight(l, i, j):
    return ((i * 7 + j * 13 + l * 3) % 17 - 8) / 64.0


def fixed_param(l, name, shp, kind):
    if name == "W":
        if kind == "conv2d":
            o, c, kh, kw = shp
            oo, cc, yy, xx = np.meshgrid(np.arange(o), np.arange(c), np.arange(kh), np.arange(kw), indexing="ij")
            return fixed_weight(l, (cc * kh + yy) * kw + xx, oo).astype(float)
        ii, jj = np.meshgrid(np.arange(shp[0]), np.arange(shp[1]), indexing="ij")
        return fixed_weight(l, ii, jj).astype(float)
    idx = np.arange(shp[0])
    if name == "b":
        return ((idx * 5 + l) % 9 - 4) / 64.0
    if name == "gamma":
        return 1.0 + ((idx * 3 + l) % 5 - 2) / 8.0
    if name == "beta":
        return ((idx * 7 + l) % 5 - 2) / 16.0
    if name == "mean":
        return ((idx * 5 + l) % 7 - 3) / 16.0
    if name == "var":
        return (1 + (idx + l) % 3) / 4.0
    raise ValueError(name)
