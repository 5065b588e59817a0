"""Deterministic randomness: uniforms derived from md5(seed : key).

The value depends only on the seed and the row's key, never on partitioning or
on the order of rows, so a rerun after an executor loss gives the same result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hex digits fit a double without rounding.
HEX_DIGITS = 13
SCALE = float(2 ** 52)


def digest(seed, *keys) -> Column:
    """Hex md5 of ``seed:key1:key2...``; keys must not be null."""
    parts = [F.lit(str(seed))] + [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))


def uniform(seed, *keys) -> Column:
    """Uniform in [0, 1) from the digest."""
    return F.conv(F.substring(digest(seed, *keys), 1, HEX_DIGITS), 16, 10).cast("double") / F.lit(SCALE)


def normal(seed, *keys) -> Column:
    """Standard normal by Box-Muller from two digests."""
    u1 = F.lit(1.0) - uniform(f"{seed}/a", *keys)
    u2 = uniform(f"{seed}/b", *keys)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def uniform_int(seed, low: int | Column, high: int | Column, *keys) -> Column:
    """Integer in [low, high], both ends included."""
    lo = F.lit(low) if isinstance(low, int) else low
    hi = F.lit(high) if isinstance(high, int) else high
    return (lo + F.floor(uniform(seed, *keys) * (hi - lo + 1))).cast("int")


def uniform_sql(seed, *keys: str) -> str:
    """The same uniform as SQL text (hex cast as understood by DuckDB)."""
    return (f"(('0x' || substr({digest_sql(seed, *keys)}, 1, {HEX_DIGITS}))::BIGINT"
            f" / 4503599627370496::DOUBLE)")


def digest_sql(seed, *keys: str) -> str:
    return f"md5(concat_ws(':', '{seed}', {', '.join(keys)}))"
