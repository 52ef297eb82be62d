"""Seeded, platform-independent randomness from md5.

Every random decision (shuffle order, split, worker, augmentation coin, dropout)
is a pure function of (seed, id, ...), so reruns, retried tasks and the SQL
oracles agree exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def md5_key(seed, *cols) -> Column:
    """md5 hex of 'seed|c1|c2|...'."""
    parts = [F.lit(str(seed))] + [_col(c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def hex_prefix_int(key: Column, digits: int = 8) -> Column:
    """First ``digits`` hex digits of a hex string as a non-negative BIGINT."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("bigint")


def md5_int(seed, *cols) -> Column:
    """32-bit integer from the first 8 hex digits of md5(seed|cols)."""
    return hex_prefix_int(md5_key(seed, *cols), 8)


def hash01(seed, *cols) -> Column:
    """Uniform in [0, 1): md5_int / 2^32."""
    return md5_int(seed, *cols) / F.lit(TWO_32)


def md5_int_np(seed, *vals) -> int:
    """Python twin of ``md5_int`` for driver-side checks."""
    import hashlib
    s = "|".join([str(seed)] + [str(v) for v in vals])
    return int(hashlib.md5(s.encode()).hexdigest()[:8], 16)
