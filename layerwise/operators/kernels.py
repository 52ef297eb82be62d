"""NumPy layer arithmetic used inside Spark tasks (one Arrow batch at a time).

No Spark here: these functions turn a (rows x features) matrix into outputs and
gradients. Images are (n, c, h, w) views of channel-major rows.
"""

from __future__ import annotations

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

# Fixed values taken as library defaults.
LEAKY_SLOPE = 0.01
LRN_K, LRN_N, LRN_ALPHA, LRN_BETA = 2.0, 5, 1e-4, 0.75
BN_EPS = 1e-5
LOG_EPS = 1e-10


# ---------------------------------------------------------------- activations

def activate(z: np.ndarray, kind: str) -> np.ndarray:
    kind = kind.lower()
    if kind == "identity":
        return z
    if kind == "relu":
        return np.maximum(z, 0.0)
    if kind == "leakyrelu":
        return np.where(z > 0, z, LEAKY_SLOPE * z)
    if kind == "sigmoid":
        return 1.0 / (1.0 + np.exp(-z))
    if kind == "tanh":
        return np.tanh(z)
    if kind == "softmax":
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)
    raise ValueError(f"unknown activation {kind}")


def activate_grad(z: np.ndarray, a: np.ndarray, da: np.ndarray, kind: str) -> np.ndarray:
    """dL/dz from dL/da for element-wise activations (softmax handled by the loss)."""
    kind = kind.lower()
    if kind == "identity":
        return da
    if kind == "relu":
        return da * (z > 0)
    if kind == "leakyrelu":
        return da * np.where(z > 0, 1.0, LEAKY_SLOPE)
    if kind == "sigmoid":
        return da * a * (1.0 - a)
    if kind == "tanh":
        return da * (1.0 - a * a)
    if kind == "softmax":
        s = (da * a).sum(axis=1, keepdims=True)
        return a * (da - s)
    raise ValueError(kind)


# ---------------------------------------------------------------- losses

def loss_rows(p: np.ndarray, y: np.ndarray, kind: str) -> np.ndarray:
    """Per-row loss. nll/mcxent: -sum y log p; mse: mean over outputs; kl: sum y log(y/p)."""
    kind = kind.lower()
    if kind in ("nll", "negativeloglikelihood", "mcxent"):
        return -(y * np.log(np.clip(p, LOG_EPS, None))).sum(axis=1)
    if kind == "mse":
        return ((p - y) ** 2).mean(axis=1)
    if kind in ("kl", "kl_divergence"):
        yc = np.clip(y, LOG_EPS, None)
        pc = np.clip(p, LOG_EPS, None)
        return (y * (np.log(yc) - np.log(pc))).sum(axis=1)
    raise ValueError(kind)


def loss_grad_z(z: np.ndarray, p: np.ndarray, y: np.ndarray, loss: str, act: str) -> np.ndarray:
    """dL/dz per row for an output layer (not divided by the batch size)."""
    loss, act = loss.lower(), act.lower()
    if act == "softmax" and loss in ("nll", "negativeloglikelihood", "mcxent"):
        return p - y
    if loss in ("nll", "negativeloglikelihood", "mcxent"):
        dp = -y / np.clip(p, LOG_EPS, None)
    elif loss == "mse":
        dp = 2.0 * (p - y) / p.shape[1]
    elif loss in ("kl", "kl_divergence"):
        dp = -y / np.clip(p, LOG_EPS, None)
    else:
        raise ValueError(loss)
    return activate_grad(z, p, dp, act)


# ---------------------------------------------------------------- convolution / pooling

def same_pad(size: int, k: int, s: int) -> tuple[int, int]:
    out = -(-size // s)
    total = max((out - 1) * s + k - size, 0)
    return total // 2, total - total // 2


def conv_geometry(h, w, kh, kw, sh, sw, ph, pw, mode):
    if mode == "same":
        pt, pb = same_pad(h, kh, sh)
        pl, pr = same_pad(w, kw, sw)
    else:
        pt = pb = ph
        pl = pr = pw
    oh = (h + pt + pb - kh) // sh + 1
    ow = (w + pl + pr - kw) // sw + 1
    return (pt, pb, pl, pr), oh, ow


def _windows(xp, kh, kw, sh, sw, oh, ow):
    v = sliding_window_view(xp, (kh, kw), axis=(2, 3))  # n, c, H', W', kh, kw
    return v[:, :, ::sh, ::sw][:, :, :oh, :ow]


def conv2d(x, W, b, stride=(1, 1), padding=(0, 0), mode="truncate"):
    """x (n,c,h,w), W (o,c,kh,kw), b (o,) -> (n,o,oh,ow)."""
    n, c, h, w = x.shape
    o, _, kh, kw = W.shape
    pads, oh, ow = conv_geometry(h, w, kh, kw, stride[0], stride[1], padding[0], padding[1], mode)
    xp = np.pad(x, ((0, 0), (0, 0), (pads[0], pads[1]), (pads[2], pads[3])))
    cols = _windows(xp, kh, kw, stride[0], stride[1], oh, ow)
    out = np.einsum("ncyxij,ocij->noyx", cols, W, optimize=True)
    return out + b[None, :, None, None]


def conv2d_backward(x, W, dout, stride=(1, 1), padding=(0, 0), mode="truncate"):
    n, c, h, w = x.shape
    o, _, kh, kw = W.shape
    sh, sw = stride
    pads, oh, ow = conv_geometry(h, w, kh, kw, sh, sw, padding[0], padding[1], mode)
    xp = np.pad(x, ((0, 0), (0, 0), (pads[0], pads[1]), (pads[2], pads[3])))
    cols = _windows(xp, kh, kw, sh, sw, oh, ow)
    dW = np.einsum("noyx,ncyxij->ocij", dout, cols, optimize=True)
    db = dout.sum(axis=(0, 2, 3))
    dxp = np.zeros_like(xp)
    for i in range(kh):
        for j in range(kw):
            dxp[:, :, i:i + sh * oh:sh, j:j + sw * ow:sw] += np.einsum("noyx,oc->ncyx", dout, W[:, :, i, j])
    dx = dxp[:, :, pads[0]:pads[0] + h, pads[2]:pads[2] + w]
    return dx, dW, db


def pool2d(x, kernel=(2, 2), stride=(2, 2), padding=(0, 0), mode="truncate", kind="max"):
    n, c, h, w = x.shape
    kh, kw = kernel
    pads, oh, ow = conv_geometry(h, w, kh, kw, stride[0], stride[1], padding[0], padding[1], mode)
    fill = -np.inf if kind == "max" else 0.0
    xp = np.pad(x, ((0, 0), (0, 0), (pads[0], pads[1]), (pads[2], pads[3])), constant_values=fill)
    win = _windows(xp, kh, kw, stride[0], stride[1], oh, ow)
    if kind == "max":
        return win.max(axis=(4, 5))
    return win.mean(axis=(4, 5))


def pool2d_backward(x, dout, kernel=(2, 2), stride=(2, 2), padding=(0, 0), mode="truncate", kind="max"):
    n, c, h, w = x.shape
    kh, kw = kernel
    sh, sw = stride
    pads, oh, ow = conv_geometry(h, w, kh, kw, sh, sw, padding[0], padding[1], mode)
    fill = -np.inf if kind == "max" else 0.0
    xp = np.pad(x, ((0, 0), (0, 0), (pads[0], pads[1]), (pads[2], pads[3])), constant_values=fill)
    win = _windows(xp, kh, kw, sh, sw, oh, ow).reshape(n, c, oh, ow, kh * kw)
    dxp = np.zeros_like(xp, dtype=float)
    if kind == "max":
        arg = win.argmax(axis=4)  # first maximum wins
        for i in range(kh):
            for j in range(kw):
                m = (arg == i * kw + j)
                dxp[:, :, i:i + sh * oh:sh, j:j + sw * ow:sw] += dout * m
    else:
        share = dout / (kh * kw)
        for i in range(kh):
            for j in range(kw):
                dxp[:, :, i:i + sh * oh:sh, j:j + sw * ow:sw] += share
    return dxp[:, :, pads[0]:pads[0] + h, pads[2]:pads[2] + w]


def lrn(x, k=LRN_K, n=LRN_N, alpha=LRN_ALPHA, beta=LRN_BETA):
    """Across-channel local response normalisation: a / (k + alpha * sum_{|c'-c|<=n/2} a^2)^beta."""
    c = x.shape[1]
    sq = x * x
    half = n // 2
    acc = np.zeros_like(x)
    for ci in range(c):
        lo, hi = max(0, ci - half), min(c, ci + half + 1)
        acc[:, ci] = sq[:, lo:hi].sum(axis=1)
    return x / (k + alpha * acc) ** beta


def batchnorm(x, gamma, beta, mean, var, eps=BN_EPS):
    shp = (1, -1) + (1,) * (x.ndim - 2)
    return (x - mean.reshape(shp)) / np.sqrt(var.reshape(shp) + eps) * gamma.reshape(shp) + beta.reshape(shp)


def zeropad(x, top, bottom, left, right):
    return np.pad(x, ((0, 0), (0, 0), (top, bottom), (left, right)))


# ---------------------------------------------------------------- recurrent

def lstm_step(x, h, c, Wx, Wh, b, peep):
    """Peephole LSTM step. Gate order in the 4*u blocks: input, forget, output, cell."""
    u = h.shape[1]
    g = x @ Wx + h @ Wh + b
    i = 1.0 / (1.0 + np.exp(-(g[:, :u] + peep[0] * c)))
    f = 1.0 / (1.0 + np.exp(-(g[:, u:2 * u] + peep[1] * c)))
    cand = np.tanh(g[:, 3 * u:])
    c2 = f * c + i * cand
    o = 1.0 / (1.0 + np.exp(-(g[:, 2 * u:3 * u] + peep[2] * c2)))
    return o * np.tanh(c2), c2
