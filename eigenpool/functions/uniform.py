"""Partition-independent randomness: every draw is a hash of a seed and a key."""

from __future__ import annotations

import math
import secrets

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def secret_seed() -> str:
    """Unpredictable seed, the default wherever noise must not be removable."""
    return secrets.token_hex(16)


def _text(part) -> Column:
    return part.cast("string") if isinstance(part, Column) else F.lit(str(part))


def uniform(seed, *parts) -> Column:
    """U(0,1) from the first 32 bits of md5('seed|part|part...')."""
    key = F.concat_ws("|", _text(seed), *[_text(p) for p in parts])
    bits = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(TWO_32)


def normal(seed, *parts) -> Column:
    """N(0,1) by the cosine branch of Box-Muller on two hashed uniforms."""
    radius = F.sqrt(F.lit(-2.0) * F.log(uniform(seed, *parts, "r")))
    return radius * F.cos(F.lit(2.0 * math.pi) * uniform(seed, *parts, "t"))


def laplace(seed, scale, *parts) -> Column:
    """Laplace(0, scale) by inverting its distribution function."""
    centred = uniform(seed, *parts) - F.lit(0.5)
    spread = scale if isinstance(scale, Column) else F.lit(float(scale))
    return -spread * F.signum(centred) * F.log(F.lit(1.0) - F.lit(2.0) * F.abs(centred))
