"""Preparation of labelled examples: native column and array expressions only.

Images are channel-major flattened arrays ``px`` with their shape (c, h, w)
passed as arguments; everything here is a JVM-side column expression (no Python).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash01



# ---------------------------------------------------------------- PRE-01..04

def split_label(df: DataFrame, cols: Sequence[str], label_index: int,
                features_col: str = "features", label_col: str = "label",
                keep: Sequence[str] = ()) -> DataFrame:
    """PRE-01: the column at ``label_index`` is the label, all others the features."""
    cols = list(cols)
    label = cols[label_index]
    feats = [F.col(c).cast("double") for i, c in enumerate(cols) if i != label_index]
    return df.select(*keep, F.array(*feats).alias(features_col), F.col(label).cast("int").alias(label_col))


def index_labels(df: DataFrame, col: str, out_col: str = "label") -> DataFrame:
    """PRE-02: class name -> 0-based id in sorted order of the distinct names."""
    from .splits import sorted_numbers
    names = df.select(F.col(col).alias("_name")).where(F.col("_name").isNotNull()).distinct()
    lut = sorted_numbers(names, "_name", out_col).withColumn(out_col, F.col(out_col).cast("int"))
    return df.join(lut, F.col(col) == F.col("_name"), "left").drop("_name")


def class_list(df: DataFrame, label_col: str) -> DataFrame:
    """SRC-04 companion: distinct class names with their id and row count."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    return index_labels(counts, label_col, "class_id")


def one_hot(label: Column | str, k: int) -> Column:
    """PRE-03: width-k one-hot DOUBLE array of an int label."""
    lab = F.col(label) if isinstance(label, str) else label
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                       lambda j: F.when(j == lab, F.lit(1.0)).otherwise(F.lit(0.0)))


def check_labels(df: DataFrame, col: str, k: int, strict: bool = True) -> DataFrame:
    """PRE-04: labels must lie in 0..k-1.

    strict: a bad row raises at execution time (``raise_error``);
    otherwise a boolean ``label_ok`` column is added for reporting.
    """
    ok = F.col(col).isNotNull() & (F.col(col) >= 0) & (F.col(col) < k)
    if strict:
        return df.withColumn(col, F.when(ok, F.col(col)).otherwise(
            F.raise_error(F.concat(F.lit(f"label outside 0..{k - 1}: "), F.coalesce(F.col(col).cast("string"), F.lit("null"))))))
    return df.withColumn("label_ok", ok)


def label_report(df: DataFrame, col: str, k: int) -> DataFrame:
    flagged = check_labels(df, col, k, strict=False)
    return flagged.agg(F.count(F.lit(1)).alias("n_rows"),
                       F.sum(F.when(~F.col("label_ok"), 1).otherwise(0)).cast("bigint").alias("n_bad"))


# ---------------------------------------------------------------- PRE-05 scaling

def scale_pixels(px: Column | str, a: float = 0.0, b: float = 1.0, max_value: float = 255.0) -> Column:
    """PRE-05 fixed range: pixel / 255 mapped to [a, b]; no pass over the data."""
    arr = F.col(px) if isinstance(px, str) else px
    return F.transform(arr, lambda x: x.cast("double") / F.lit(max_value) * F.lit(b - a) + F.lit(a))


def fit_range(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """PRE-05 fit: one aggregate pass, a 2 x len(cols) result."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    row = df.agg(*aggs).first()
    return {c: (float(row[f"min_{c}"]), float(row[f"max_{c}"])) for c in cols}


def apply_range(df: DataFrame, stats: dict[str, tuple[float, float]], a: float = 0.0, b: float = 1.0,
                suffix: str = "_scaled") -> DataFrame:
    out = df
    for c, (lo, hi) in stats.items():
        span = hi - lo
        expr = ((F.col(c).cast("double") - F.lit(lo)) / F.lit(span) * F.lit(b - a) + F.lit(a)) if span else F.lit(a)
        out = out.withColumn(c + suffix, expr)
    return out


# ---------------------------------------------------------------- PRE-06..08 images

def _shape(v) -> Column:
    return F.lit(v) if isinstance(v, int) else F.col(v) if isinstance(v, str) else v


def align_channels(px: Column | str, c, h, w, to_c: int) -> Column:
    """Images of c channels with ``to_c`` of them: grey is repeated, an alpha channel (c = 2 or 4) is
    dropped, colour becomes grey by the mean. ``c, h, w`` are numbers or columns of the row."""
    arr = F.col(px) if isinstance(px, str) else px
    c, n = _shape(c), _shape(h) * _shape(w)
    plane = lambda k: F.slice(arr, n * k + 1, n)
    grey = c <= 2
    if to_c == 1:
        mean = F.transform(F.sequence(F.lit(1), n), lambda i: ((F.element_at(arr, i) + F.element_at(arr, i + n) + F.element_at(arr, i + n + n))
                                                              / F.lit(3.0)).cast("int"))
        return F.when(grey, plane(0)).otherwise(mean)
    return F.when(grey, F.concat(*[plane(0)] * to_c)).otherwise(F.slice(arr, 1, n * to_c))


def resize(px: Column | str, c, h, w, oh: int, ow: int) -> Column:
    """PRE-06: bilinear resize with half-pixel centres, edge-clamped, per channel.

    src = (dst + 0.5) * in / out - 0.5, negative src clamped to 0, the right/bottom
    neighbour clamped to the last row/column. Output is DOUBLE. ``c, h, w`` are numbers or
    columns, so every image is read by its own shape; an array whose length is not c*h*w raises.
    The plan does not grow with the image: positions come from index arithmetic.
    """
    arr = F.col(px) if isinstance(px, str) else px
    c, h, w = _shape(c), _shape(h), _shape(w)
    area = oh * ow

    def one(i):
        y, x = F.floor((i % area) / ow), i % ow
        base = F.floor(i / area) * h * w + 1
        fy = F.greatest((y + 0.5) * (h.cast("double") / F.lit(float(oh))) - 0.5, F.lit(0.0))
        fx = F.greatest((x + 0.5) * (w.cast("double") / F.lit(float(ow))) - 0.5, F.lit(0.0))
        y0, x0 = F.least(F.floor(fy), h - 1), F.least(F.floor(fx), w - 1)
        y1, x1 = F.least(y0 + 1, h - 1), F.least(x0 + 1, w - 1)
        ty, tx = fy - F.floor(fy), fx - F.floor(fx)
        at = lambda yy, xx: F.element_at(arr, (base + yy * w + xx).cast("int")).cast("double")
        top = (F.lit(1.0) - tx) * at(y0, x0) + tx * at(y0, x1)
        bot = (F.lit(1.0) - tx) * at(y1, x0) + tx * at(y1, x1)
        return (F.lit(1.0) - ty) * top + ty * bot

    out = F.transform(F.sequence(F.lit(0), c * area - 1), one)
    wrong = F.raise_error(F.concat_ws(" ", F.lit("image of"), F.size(arr), F.lit("values where"), c * h * w, F.lit("are stated")))
    return F.when(arr.isNull(), F.lit(None).cast("array<double>")).when(F.size(arr) != c * h * w, wrong.cast("array<double>")).otherwise(out)


def flip_horizontal(px: Column | str, c: int, h: int, w: int) -> Column:
    """PRE-07: mirror around the vertical axis (x -> w-1-x) in every channel row."""
    arr = F.col(px) if isinstance(px, str) else px
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(c * h - 1)),
                                 lambda r: F.reverse(F.slice(arr, r * w + 1, w))))


def _one_argument(fn: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda x: fn(x)  # transform counts a function's arguments, defaults included


def augment(df: DataFrame, px_col: str, id_col: str,
            steps: Sequence[tuple[Callable[[Column], Column], float]], seed, epoch: int = 0,
            out_col: str | None = None) -> DataFrame:
    """PRE-08: ordered pipeline; step s applies when hash01(seed|s|epoch|id) < p.

    Steps that change the array length must have p = 1.0. A step reads the array of the step before through a
    lambda variable: its formula may use it for every pixel, and the steps before are computed once an image.
    """
    cur = F.col(px_col)
    for s, (fn, p) in enumerate(steps):
        step = fn if p >= 1.0 else lambda x, fn=fn, s=s, p=p: F.when(hash01(seed, F.lit(s), F.lit(epoch), id_col) < F.lit(p), fn(x)).otherwise(x)
        cur = F.element_at(F.transform(F.array(cur), _one_argument(step)), 1)
    return df.withColumn(out_col or px_col, cur)


# ---------------------------------------------------------------- PRE-10 reshape

def to_pixel_rows(df: DataFrame, id_col: str, px_col: str, c: int, h: int, w: int,
                  keep: Sequence[str] = ()) -> DataFrame:
    """PRE-10: flattened channel-major array -> rows (id, c, y, x, value)."""
    ex = (df.select(id_col, *keep, F.posexplode_outer(px_col).alias("_i", "value"))
          .filter(F.col("_i").isNotNull()))
    return ex.select(id_col, *keep,
                     (F.col("_i") / F.lit(h * w)).cast("bigint").alias("c"),
                     ((F.col("_i") % F.lit(h * w)) / F.lit(w)).cast("bigint").alias("y"),
                     (F.col("_i") % F.lit(w)).cast("bigint").alias("x"),
                     "value")


def from_pixel_rows(rows: DataFrame, id_col: str, h: int, w: int, out_col: str = "px") -> DataFrame:
    """PRE-10 inverse: rows -> flattened array; one group holds one image only."""
    idx = (F.col("c") * F.lit(h * w) + F.col("y") * F.lit(w) + F.col("x")).cast("int")
    g = rows.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct(idx.alias("i"), F.col("value")))).alias("_s"))
    return g.select(id_col, F.transform("_s", lambda s: s["value"]).alias(out_col))


def explode_array(df: DataFrame, keys: Sequence[str], arr_col: str, idx_name: str = "i",
                  val_name: str = "value") -> DataFrame:
    """(keys..., array) -> (keys..., i, value) for comparison or SQL-form operators.

    posexplode_outer + a filter on the position gives the same rows as posexplode, but
    keeps Catalyst from inferring a size(array) > 0 filter below the projection, which
    would re-evaluate an expensive array expression a second time per row.
    """
    return (df.select(*keys, F.posexplode_outer(arr_col).alias(idx_name, val_name))
            .filter(F.col(idx_name).isNotNull())
            .withColumn(idx_name, F.col(idx_name).cast("bigint")))
