"""Deterministic Bernoulli draws from row keys.

A draw depends on the seed, a tag and the key alone, so a row gets the same
answer in any partitioning, on any retry after a lost executor, and in any
engine with md5. Nothing is shuffled and nothing visits the driver.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tags keep draws for different purposes independent. One shared draw would put
# every user that survives a 50 % downsample into the first half of the split.
DOWNSAMPLE_TAG = "d"
USER_GROUP_TAG = "u"
ITEM_HOLDOUT_TAG = "i"


def validate_fraction(fraction: float) -> Decimal:
    """Check ``0 < fraction <= 1`` on the decimal as written, without truncation."""
    value = Decimal(str(fraction))
    if not 0 < value <= 1:
        raise ValueError(f"fraction must be in (0, 1], got {fraction}")
    return value


def key_hash(seed: int, tag: str, *keys: str) -> Column:
    """md5 of ``seed:tag:key[:key...]`` as 32 lower-case hex digits."""
    parts: list[Column] = [F.lit(f"{seed}:{tag}")]
    for key in keys:
        parts += [F.lit(":"), F.col(key).cast("string")]
    return F.md5(F.concat(*parts))


def hash_cut(fraction: float | Decimal) -> str:
    """The 8 hex digits below which a ``fraction`` of all hashes fall.

    Fixed-width hex sorts like the number it spells, so the test is one string
    comparison; no conversion of the digest to a number is needed.
    """
    return f"{math.ceil(float(fraction) * 2**32):08x}"


def hash_below(fraction: float | Decimal, seed: int, tag: str, *keys: str) -> Column:
    """True for about ``fraction`` of the distinct keys."""
    if float(fraction) >= 1:
        return F.lit(True)
    return key_hash(seed, tag, *keys) < F.lit(hash_cut(fraction))
