"""Deterministic pseudo-random columns.

Every draw is a function of (row key, seed, draw number) through md5, so it
does not depend on partitioning, retries or executor loss, and any SQL engine
with md5 reproduces it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 13  # 52 bits: exactly representable in a double


def order_key(keys: list[str | Column], seed: int) -> Column:
    """32 hex characters that shuffle rows reproducibly."""
    return F.md5(F.concat_ws("|", *[F.col(k) if isinstance(k, str) else k for k in keys], F.lit(str(seed))))


def uniform(keys: list[str | Column], seed: int, draw: int = 0) -> Column:
    """Uniform double in [0, 1)."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    digest = F.md5(F.concat_ws("|", *cols, F.lit(f"{seed}:{draw}")))
    return F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("double") / F.lit(float(16**_HEX_DIGITS))


def uniform_between(u: Column, lo: float, hi: float) -> Column:
    return F.lit(lo) + u * F.lit(hi - lo)


def log_uniform(u: Column, lo: float, hi: float) -> Column:
    return F.exp(F.log(F.lit(lo)) + u * (F.log(F.lit(hi)) - F.log(F.lit(lo))))


def random_integer(u: Column, lo: int, hi: int) -> Column:
    """Integer in [lo, hi)."""
    return (F.lit(lo) + F.floor(u * F.lit(hi - lo))).cast("int")


def beta_2_5(keys: list[str | Column], seed: int) -> Column:
    """Beta(2, 5): the second smallest of six uniforms."""
    return F.get(F.array_sort(F.array(*[uniform(keys, seed, i) for i in range(6)])), F.lit(1))
