"""Image layers as column expressions: convolution, pooling, response normalisation, padding.

Each takes a channel-major array column of a stated shape (c, h, w) and returns an array column; the
rows never leave the JVM. Output positions come from index arithmetic, so the plan grows with the
window, not with the image. A null image gives a null result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.columns import let, literal_array
from .kernels import LRN_ALPHA, LRN_BETA, LRN_K, LRN_N, conv_geometry


UNROLLED_TAPS = 64  # windows up to this size are written out term by term


def _array(px: Column | str) -> Column:
    return F.col(px) if isinstance(px, str) else px


def _div(a: Column, b: int) -> Column:
    return F.floor(a / b).cast("int")


def _pixels(c: int, oh: int, ow: int, value: Callable[[Column, Column, Column], Column]) -> Column:
    area = oh * ow
    return F.transform(F.sequence(F.lit(0), F.lit(c * area - 1)), lambda i: value(_div(i, area), _div(i % area, ow), i % ow))


def _reader(arr: Column, h: int, w: int):
    """(channel, y, x) -> value, null outside the image."""
    def at(ch, y, x):
        inside = (y >= 0) & (y < h) & (x >= 0) & (x < w)
        return F.when(inside, F.get(arr, ch * (h * w) + y * w + x).cast("double"))
    return at


def conv2d(px: Column | str, c: int, h: int, w: int, weights: np.ndarray, bias: np.ndarray, stride=(1, 1), padding=(0, 0),
           mode: str = "truncate") -> Column:
    """SCR-03: weights (n_out, c, kh, kw) travel as one literal array; zeros outside the image."""
    n_out, _, kh, kw = weights.shape
    (top, _, left, _), oh, ow = conv_geometry(h, w, kh, kw, stride[0], stride[1], padding[0], padding[1], mode)
    flat, shift = literal_array(weights.ravel()), literal_array(bias)
    taps = c * kh * kw
    inner = conv_geometry(h, w, kh, kw, stride[0], stride[1], padding[0], padding[1], mode)[0] == (0, 0, 0, 0)

    def body(arr):
        at = _reader(arr, h, w)

        def unrolled(o, y, x):
            # one addition for each place, the place in the array being a constant away from the window's corner
            def total(corner, first):
                out = F.get(shift, o)
                for t in range(taps):
                    ch, i, j = t // (kh * kw), t % (kh * kw) // kw, t % kw
                    got = F.get(arr, corner + (ch * h * w + i * w + j)).cast("double")
                    if not inner:
                        yy, xx = y * stride[0] + (i - top), x * stride[1] + (j - left)
                        got = F.when((yy >= 0) & (yy < h) & (xx >= 0) & (xx < w), got).otherwise(F.lit(0.0))
                    out = out + F.coalesce(got, F.lit(0.0)) * F.get(flat, first + t)
                return out
            return let((y * stride[0] - top) * w + x * stride[1] - left, lambda corner: let(o * taps, lambda first: total(corner, first)))

        def looped(o, y, x):
            y0, x0 = y * stride[0] - top, x * stride[1] - left

            def add(acc, t):
                got = at(_div(t, kh * kw), y0 + _div(t % (kh * kw), kw), x0 + t % kw)
                return acc + F.coalesce(got, F.lit(0.0)) * F.get(flat, o * taps + t)
            return F.aggregate(F.sequence(F.lit(0), F.lit(taps - 1)), F.lit(0.0), add) + F.get(shift, o)
        return F.when(arr.isNotNull(), _pixels(n_out, oh, ow, unrolled if taps <= UNROLLED_TAPS else looped))
    return let(_array(px), body)


def pool2d(px: Column | str, c: int, h: int, w: int, kernel=(2, 2), stride=(2, 2), padding=(0, 0), mode: str = "truncate",
           kind: str = "max") -> Column:
    """SCR-04: largest or mean value of each window; places outside the image are skipped by max and 0 to mean."""
    kh, kw = kernel
    (top, _, left, _), oh, ow = conv_geometry(h, w, kh, kw, stride[0], stride[1], padding[0], padding[1], mode)

    def body(arr):
        at = _reader(arr, h, w)

        def value(ch, y, x):
            cells = F.array(*[at(ch, y * stride[0] - top + i, x * stride[1] - left + j) for i in range(kh) for j in range(kw)])
            if kind == "max":
                return F.array_max(cells)
            return F.aggregate(cells, F.lit(0.0), lambda acc, v: acc + F.coalesce(v, F.lit(0.0))) / float(kh * kw)
        return F.when(arr.isNotNull(), _pixels(c, oh, ow, value))
    return let(_array(px), body)


def wide_pool2d(px: Column | str, c: int, h: int, w: int, kernel=(2, 2), stride=(2, 2), padding=(0, 0), mode: str = "truncate",
                kind: str = "max") -> Column:
    """``pool2d`` for windows of any size: along rows, then along columns, each in log2(width) steps a place.

    One step doubles the run that a place knows (2, 4, 8, ... neighbours); a window is put together from the runs that
    the binary digits of its width name. Steps are a fold over a short literal array, so the plan does not grow with the window."""
    kh, kw = kernel
    (top, _, left, _), oh, ow = conv_geometry(h, w, kh, kw, stride[0], stride[1], padding[0], padding[1], mode)
    tall, wide = max(h + top, (oh - 1) * stride[0] + kh), max(w + left, (ow - 1) * stride[1] + kw)
    none = F.lit(None).cast("double")

    def join(a: Column, b: Column) -> Column:
        return F.greatest(a, b) if kind == "max" else F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0))

    def runs(arr: Column, width: int, step: int) -> Column:
        """At each place the aggregate of ``width`` places, ``step`` apart; right where all of them are in the frame."""
        digits, done = [], 0
        for j in range(width.bit_length()):
            taken = bool(width >> j & 1)
            digits.append(f"struct({(1 << j) * step} as shift, {str(taken).lower()} as taken, {done * step} as done)")
            done += (1 << j) * taken

        def digit(acc, d):
            known = F.when(d["taken"], F.transform(acc["known"], lambda v, i: join(v, F.get(acc["run"], i + d["done"])))).otherwise(acc["known"])
            run = F.transform(acc["run"], lambda v, i: join(v, F.get(acc["run"], i + d["shift"])))
            return F.struct(run.alias("run"), known.alias("known"))
        start = F.struct(arr.alias("run"), F.transform(arr, lambda v: none).alias("known"))
        return F.aggregate(F.expr("array(" + ", ".join(digits) + ")"), start, digit, lambda acc: acc["known"])

    def body(arr):
        at = _reader(arr, h, w)
        framed = _pixels(c, tall, wide, lambda ch, y, x: at(ch, y - top, x - left))
        out = let(framed, lambda f: let(runs(f, kw, 1), lambda r: let(runs(r, kh, wide), lambda v: _pixels(
            c, oh, ow, lambda ch, y, x: F.get(v, ch * (tall * wide) + y * (stride[0] * wide) + x * stride[1])))))
        return F.when(arr.isNotNull(), out if kind == "max" else F.transform(out, lambda v: v / float(kh * kw)))
    return let(_array(px), body)


def lrn(px: Column | str, c: int, h: int, w: int, k: float = LRN_K, n: int = LRN_N, alpha: float = LRN_ALPHA, beta: float = LRN_BETA) -> Column:
    """SCR-05: a / (k + alpha * sum of squares over the n nearest channels) ^ beta."""

    def body(arr):
        at = _reader(arr, h, w)

        def value(ch, y, x):
            total = F.lit(0.0)
            for d in range(-(n // 2), n // 2 + 1):
                near = F.when((ch + d >= 0) & (ch + d < c), at(ch + d, y, x))
                total = total + F.coalesce(near * near, F.lit(0.0))
            return at(ch, y, x) / F.pow(F.lit(float(k)) + F.lit(float(alpha)) * total, F.lit(float(beta)))
        return F.when(arr.isNotNull(), _pixels(c, h, w, value))
    return let(_array(px), body)


def zero_pad(px: Column | str, c: int, h: int, w: int, top: int, bottom: int, left: int, right: int) -> Column:
    """SCR-07: a frame of zeros around every channel."""

    def body(arr):
        at = _reader(arr, h, w)
        out = _pixels(c, h + top + bottom, w + left + right, lambda ch, y, x: F.coalesce(at(ch, y - top, x - left), F.lit(0.0)))
        return F.when(arr.isNotNull(), out)
    return let(_array(px), body)
