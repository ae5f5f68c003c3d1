"""Deterministic random draws keyed by a row key (no ``rand()``).

Every draw is a pure function of (key, salt), so a job recomputed after an
executor loss, or run with another partition count, yields the same rows,
and DuckDB can compute the very same numbers for the oracle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

TWO_POW_32 = 4294967296.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def u01(key, salt: str) -> Column:
    """Uniform in [0, 1): first 8 hex digits of md5("<key>:<salt>") / 2^32."""
    h = F.md5(F.concat(_col(key).cast("string"), F.lit(":" + salt)))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(TWO_POW_32)


def hash52(key, salt: str) -> Column:
    """52-bit prefix of md5("<key>:<salt>") as bigint: orders rows like the
    full md5 text does (ties only on 52-bit collisions), exact in a double."""
    h = F.md5(F.concat(_col(key).cast("string"), F.lit(":" + salt)))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint")


def key_md5(key, salt: str) -> Column:
    return F.md5(F.concat(_col(key).cast("string"), F.lit(":" + salt)))


def u_int(key, salt: str, lo: int, hi: int) -> Column:
    """Uniform integer in [lo, hi)."""
    return (F.lit(lo) + F.floor(u01(key, salt) * F.lit(hi - lo))).cast("bigint")


def uniform(key, salt: str, lo: float, hi: float) -> Column:
    return F.lit(float(lo)) + u01(key, salt) * F.lit(float(hi - lo))


def normal01(key, salt: str) -> Column:
    """Box-Muller on two independent uniforms; 1-u keeps ln finite."""
    u1 = u01(key, salt + "_a")
    u2 = u01(key, salt + "_b")
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2 * math.pi) * u2)


def normal(key, salt: str, mean: float, std: float) -> Column:
    return F.lit(float(mean)) + F.lit(float(std)) * normal01(key, salt)


def expo(key, salt: str, scale: float) -> Column:
    return F.lit(-float(scale)) * F.log(F.lit(1.0) - u01(key, salt))


def choice(key, salt: str, values, probs) -> Column:
    """Weighted choice: a ``when`` ladder over cumulative probabilities."""
    u = u01(key, salt)
    acc = 0.0
    expr = None
    for v, p in zip(values[:-1], probs[:-1]):
        acc += p
        expr = (F.when(u < F.lit(acc), F.lit(v)) if expr is None
                else expr.when(u < F.lit(acc), F.lit(v)))
    last = F.lit(values[-1])
    return last if expr is None else expr.otherwise(last)


def bernoulli(key, salt: str, p) -> Column:
    """1 when u < p (p may be a Column expression), else 0."""
    p = p if isinstance(p, Column) else F.lit(float(p))
    return F.when(u01(key, salt) < p, F.lit(1)).otherwise(F.lit(0))
