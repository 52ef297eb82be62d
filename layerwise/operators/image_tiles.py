"""Image layers on tiles, for images larger than one row should be.

An image is a set of rows (id, ty, tx, px), each a tile of th x tw places with all its channels, channel-major;
places of border tiles outside the image are null.  A layer with a window exchanges once: every tile sends each
output tile the rectangle that its windows read there, which is the tile itself or a border strip of the window's
width (the halo), so an image's rows are never brought together.  Layers without a window work on the tiles as they are.

An id names one image (null is a name too).  A tile that is absent counts as places outside the image.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import let
from . import image_ops as I
from .kernels import conv_geometry


@dataclass(frozen=True)
class Grid:
    """Shape of an image (c, h, w) and of its tiles (th, tw)."""
    c: int
    h: int
    w: int
    th: int
    tw: int

    @property
    def rows(self) -> int:
        return -(-self.h // self.th)

    @property
    def cols(self) -> int:
        return -(-self.w // self.tw)


def cut_tiles(df: DataFrame, id_col: str, px_col: str, grid: Grid) -> DataFrame:
    """(id, ty, tx, px) of images that come as one array each; a null image has no tiles."""
    tiles = df.filter(F.col(px_col).isNotNull()).select(
        id_col, F.col(px_col).alias("_px"), F.explode(F.sequence(F.lit(0), F.lit(grid.rows * grid.cols - 1))).alias("_t"))
    tiles = tiles.select(id_col, "_px", F.floor(F.col("_t") / grid.cols).cast("int").alias("ty"), (F.col("_t") % grid.cols).cast("int").alias("tx"))
    at = I._reader(F.col("_px"), grid.h, grid.w)
    px = I._pixels(grid.c, grid.th, grid.tw, lambda ch, y, x: at(ch, F.col("ty") * grid.th + y, F.col("tx") * grid.tw + x))
    return tiles.select(id_col, "ty", "tx", px.alias("px"))


def _readers(tile: Column, size: int, length: int, out_size: int, n_out: int, window: int, stride: int, before: int) -> Column:
    """Output tiles along one axis whose windows read the input tile, as (t, place in their region, first and last place read)."""
    step, region = out_size * stride, (out_size - 1) * stride + window
    a = tile * size
    b = F.least(a + size, F.lit(length))
    first = F.greatest(F.floor((a + (before - region)) / F.lit(step)).cast("int") + 1, F.lit(0))
    last = F.least(F.floor((b + (before - 1)) / F.lit(step)).cast("int"), F.lit(n_out - 1))

    def reader(t: Column) -> Column:
        start = t * step - before
        lo, hi = F.greatest(a, start), F.least(b, start + region)
        return F.struct(t.alias("t"), (lo - start).alias("at"), (lo - a).alias("lo"), (hi - lo).alias("n"))
    return F.when(first <= last, F.filter(F.transform(F.sequence(first, F.greatest(first, last)), reader), lambda r: r["n"] > 0)) \
        .otherwise(F.array().cast("array<struct<t:int,at:int,lo:int,n:int>>"))


def _regions(tiles: DataFrame, id_col: str, grid: Grid, out: Grid, window, stride, before) -> tuple[DataFrame, int, int]:
    """(id, ty, tx, px): for each tile of ``out`` the places its windows read, null outside the image; and the regions' shape."""
    rh, rw = (out.th - 1) * stride[0] + window[0], (out.tw - 1) * stride[1] + window[1]
    down = _readers(F.col("ty"), grid.th, grid.h, out.th, out.rows, window[0], stride[0], before[0])
    along = _readers(F.col("tx"), grid.tw, grid.w, out.tw, out.cols, window[1], stride[1], before[1])
    sent = tiles.select(id_col, "px", F.explode(down).alias("_y"), along.alias("_xs")).select(id_col, "px", "_y", F.explode("_xs").alias("_x"))
    area = F.col("_y.n") * F.col("_x.n")

    def value(i: Column) -> Column:
        ch, rest = F.floor(i / area).cast("int"), i % area
        y, x = F.col("_y.lo") + F.floor(rest / F.col("_x.n")).cast("int"), F.col("_x.lo") + rest % F.col("_x.n")
        return F.get("px", ch * (grid.th * grid.tw) + y * grid.tw + x).cast("double")
    part = F.transform(F.sequence(F.lit(0), area * grid.c - 1), value)
    sent = sent.select(id_col, F.col("_y.t").alias("ty"), F.col("_x.t").alias("tx"),
                       F.struct(F.col("_y.at").alias("y"), F.col("_x.at").alias("x"), F.col("_y.n").alias("h"), F.col("_x.n").alias("w"), part.alias("v")).alias("part"))
    met = sent.groupBy(id_col, "ty", "tx").agg(F.collect_list("part").alias("parts"))  # the tiles that one region touches

    def place(ch: Column, y: Column, x: Column) -> Column:
        def look(acc: Column, p: Column) -> Column:
            dy, dx = y - p["y"], x - p["x"]
            inside = (dy >= 0) & (dy < p["h"]) & (dx >= 0) & (dx < p["w"])
            return F.when(inside, F.get(p["v"], ch * p["h"] * p["w"] + dy * p["w"] + dx)).otherwise(acc)
        return F.aggregate("parts", F.lit(None).cast("double"), look)
    return met.select(id_col, "ty", "tx", I._pixels(grid.c, rh, rw, place).alias("px")), rh, rw


def _inside(px: Column, grid: Grid) -> Column:
    """The tile with places outside the image set to null."""
    area = grid.th * grid.tw
    y = F.col("ty") * grid.th

    def keep(v: Column, i: Column) -> Column:
        return F.when((y + F.floor((i % area) / grid.tw).cast("int") < grid.h) & (F.col("tx") * grid.tw + i % grid.tw < grid.w), v)
    return F.transform(px, keep)


def _layer(tiles, id_col, grid: Grid, channels: int, window, stride, padding, mode, tile, body) -> tuple[DataFrame, Grid]:
    (top, _, left, _), oh, ow = conv_geometry(grid.h, grid.w, *window, *stride, *padding, mode)
    out = Grid(channels, oh, ow, *(tile or (min(grid.th, oh), min(grid.tw, ow))))
    met, rh, rw = _regions(tiles, id_col, grid, out, window, stride, (top, left))
    px = let(body(F.col("px"), rh, rw), lambda v: _inside(v, out))
    return met.select(id_col, "ty", "tx", px.alias("px")), out


def conv2d_tiles(tiles: DataFrame, id_col: str, grid: Grid, weights: np.ndarray, bias: np.ndarray, stride=(1, 1), padding=(0, 0),
                 mode: str = "truncate", tile: tuple[int, int] | None = None) -> tuple[DataFrame, Grid]:
    """SCR-03 on tiles: the output's tiles (of ``tile`` places, by default the input's) and their grid."""
    return _layer(tiles, id_col, grid, weights.shape[0], weights.shape[2:], stride, padding, mode, tile,
                  lambda px, rh, rw: I.conv2d(px, grid.c, rh, rw, weights, bias, stride))


def pool2d_tiles(tiles: DataFrame, id_col: str, grid: Grid, kernel=(2, 2), stride=(2, 2), padding=(0, 0), mode: str = "truncate",
                 kind: str = "max", tile: tuple[int, int] | None = None) -> tuple[DataFrame, Grid]:
    """SCR-04 on tiles."""
    return _layer(tiles, id_col, grid, grid.c, kernel, stride, padding, mode, tile,
                  lambda px, rh, rw: I.pool2d(px, grid.c, rh, rw, kernel, stride, kind=kind))


def lrn_tiles(tiles: DataFrame, id_col: str, grid: Grid, **options) -> tuple[DataFrame, Grid]:
    """SCR-05 on tiles: neighbours are channels of the same place, so nothing is exchanged."""
    return tiles.select(id_col, "ty", "tx", I.lrn("px", grid.c, grid.th, grid.tw, **options).alias("px")), grid


def tile_values(tiles: DataFrame, id_col: str, grid: Grid) -> DataFrame:
    """(id, i, value) of every place inside the image, i counting channel-major over the whole image."""
    area = grid.th * grid.tw
    rows = tiles.select(id_col, "ty", "tx", F.posexplode("px").alias("_i", "value"))
    y = F.col("ty") * grid.th + F.floor((F.col("_i") % area) / grid.tw).cast("int")
    x = F.col("tx") * grid.tw + F.col("_i") % grid.tw
    i = F.floor(F.col("_i") / area) * (grid.h * grid.w) + y * grid.w + x
    return rows.filter((y < grid.h) & (x < grid.w)).select(id_col, i.cast("bigint").alias("i"), "value")
