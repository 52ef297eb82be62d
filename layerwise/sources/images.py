"""SRC-03/04: image folders as DataFrames, labels from parent folders."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import local_fs_path

ALLOWED_FORMATS = ("bmp", "gif", "jpg", "jpeg", "png")


def label_from_path(df: DataFrame, path_col: str, out_col: str = "label", strip: str | None = None) -> DataFrame:
    """Parent folder name: the second-last '/' segment (after removing ``strip`` regex)."""
    p = F.col(path_col)
    if strip:
        p = F.regexp_replace(p, strip, "")
    return df.withColumn(out_col, F.element_at(F.split(p, "/"), -2))


def _ext_filter(origin: Column, formats: Sequence[str]) -> Column:
    pat = "(?i)\\.(" + "|".join(formats) + ")$"
    return origin.rlike(pat)


_IMG_SCHEMA = T.StructType([T.StructField("origin", T.StringType()), T.StructField("c", T.IntegerType()),
                            T.StructField("h", T.IntegerType()), T.StructField("w", T.IntegerType()),
                            T.StructField("px", T.ArrayType(T.IntegerType()))])


def _to_channel_major(batches):
    for rb in batches:
        img = rb.column("image")
        origin = img.field("origin").to_pylist()
        hs = img.field("height").to_numpy(zero_copy_only=False)
        ws = img.field("width").to_numpy(zero_copy_only=False)
        cs = img.field("nChannels").to_numpy(zero_copy_only=False)
        data = img.field("data").to_pylist()
        pxs = []
        for d, h, w, c in zip(data, hs, ws, cs):
            if h < 0:  # an undecodable file: shape -1, no pixels
                pxs.append(None)
                continue
            a = np.frombuffer(d, dtype=np.uint8).reshape(h, w, c)
            if c >= 3:
                a = a[:, :, [2, 1, 0] + list(range(3, c))]  # BGR(A) -> RGB(A)
            pxs.append(a.transpose(2, 0, 1).ravel().astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(origin), pa.array(cs.astype(np.int32)), pa.array(hs.astype(np.int32)),
             pa.array(ws.astype(np.int32)), pa.array(pxs, type=pa.list_(pa.int32()))],
            names=["origin", "c", "h", "w", "px"])


def scan_images(spark: SparkSession, path: str, formats: Sequence[str] = ALLOWED_FORMATS,
                with_label: bool = True, channels: int | None = None, invalid: str = "raise") -> DataFrame:
    """Every allowed image under ``path`` (recursively) as (origin, c, h, w, px) with px channel-major
    RGB ints; label = parent folder name. ``channels`` brings all images to that many channels.

    A file that does not decode fails the scan, or with ``invalid="keep"`` stays as a row with
    null px and shape -1 (``invalid_images`` counts them)."""
    return _decoded(_image_files(spark, path, formats).select("image"), with_label, channels, invalid)


def _image_files(spark: SparkSession, path: str, formats: Sequence[str]) -> DataFrame:
    """(image, key): key is the file's path below the folder. Both the filter on names and conditions on
    the key are decided on file names, when files are listed; the images of other files are not read."""
    raw = spark.read.format("image").option("recursiveFileLookup", "true").load(path)
    file = F.col("_metadata.file_path")
    folder = re.escape(path.rstrip("/").rsplit("/", 1)[-1])
    return raw.filter(_ext_filter(file, formats)).select("image", F.regexp_replace(file, f"^.*?/{folder}/", "").alias("key"))


def split_images(spark: SparkSession, path: str, weights: Sequence[float], seed, formats: Sequence[str] = ALLOWED_FORMATS,
                 with_label: bool = True, channels: int | None = None, invalid: str = "raise") -> list[DataFrame]:
    """The images under ``path`` split by weight in the seeded order of their paths, one frame like ``scan_images`` a part.

    The split works on the list of files: sizes and cuts are looked up without reading any file, and a part is a condition
    on paths, so its scan opens its own files once and no others."""
    from ..operators.splits import split_frames
    files = _image_files(spark, path, formats)
    return [_decoded(part.select("image"), with_label, channels, invalid) for part in split_frames(files, "key", weights, seed, tie_cols=["key"])]


def _decoded(raw: DataFrame, with_label: bool, channels: int | None, invalid: str) -> DataFrame:
    out = raw.mapInArrow(_to_channel_major, _IMG_SCHEMA)
    if invalid == "raise":
        fail = F.raise_error(F.concat(F.lit("not an image: "), F.col("origin"))).cast("int")
        out = out.withColumn("h", F.when(F.col("h") < 0, fail).otherwise(F.col("h")))
    elif invalid != "keep":
        raise ValueError(f"invalid={invalid!r}: 'raise' or 'keep'")
    if channels is not None:
        from ..operators.prep import align_channels
        px = F.when(F.col("px").isNotNull(), align_channels("px", "c", "h", "w", channels))
        out = out.withColumn("px", px).withColumn("c", F.when(F.col("c") > 0, F.lit(channels)).otherwise(F.col("c")))
    return label_from_path(out, "origin") if with_label else out


def invalid_images(scanned: DataFrame) -> DataFrame:
    """Number of files that did not decode, per label (scan with ``invalid="keep"``)."""
    return scanned.filter(F.col("px").isNull()).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def png_bytes(px: np.ndarray) -> bytes:
    """Minimal 8-bit greyscale (h, w) or RGB (h, w, 3) PNG encoder for fixtures."""
    px = np.asarray(px, dtype=np.uint8)
    h, w = px.shape[:2]
    ctype = 0 if px.ndim == 2 else 2
    raw = b"".join(b"\x00" + px[y].tobytes() for y in range(h))

    def chunk(tag, body):
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body) & 0xFFFFFFFF)

    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, ctype, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def write_png_folder(df: DataFrame, root: str, id_col: str, px_col: str, label_col: str, h: int, w: int) -> int:
    """Write one greyscale PNG per row to root/<label>/<id>.png from the executors.

    ``root`` must be on shared storage mounted as a POSIX path. Returns the row count written.
    """
    base = local_fs_path(root)

    def run(batches):
        for rb in batches:
            ids = rb.column(id_col).to_pylist()
            labels = rb.column(label_col).to_pylist()
            pxs = rb.column(px_col).to_pylist()
            for i, lab, p in zip(ids, labels, pxs):
                d = os.path.join(base, str(lab))
                os.makedirs(d, exist_ok=True)
                tmp = os.path.join(d, f".{i}.png.tmp")
                with open(tmp, "wb") as f:
                    f.write(png_bytes(np.asarray(p, dtype=np.uint8).reshape(h, w)))
                os.replace(tmp, os.path.join(d, f"{i}.png"))  # idempotent under task retries
            yield pa.RecordBatch.from_arrays([pa.array([len(ids)], type=pa.int64())], names=["n"])

    res = df.select(id_col, px_col, label_col).mapInArrow(run, "n long").agg(F.sum("n")).first()[0]
    return int(res or 0)
