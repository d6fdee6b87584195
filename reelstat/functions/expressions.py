"""Column expressions (all JVM-side, whole-stage codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Longest dot product unrolled into plain arithmetic. Measured on a full epoch
# (sf0.1, local[8]): unrolled is ~1.5-2x faster than the array fold at K = 10,
# 16 and 24, but ~2x slower at K = 40, where the generated stage outgrows the
# JIT's method-size limit and runs interpreted.
UNROLL_MAX = 24


def dot(a: str | Column, b: str | Column, k: int | None = None) -> Column:
    """Dot product of two equal-length double arrays (F2), as a left fold.

    With a known length ``k ≤ UNROLL_MAX`` the sum is plain arithmetic that
    whole-stage codegen compiles; otherwise ``aggregate(zip_with(...))``. Both
    sum in the same order, so results are identical.
    """
    x, y = col(a), col(b)
    if k is None or k > UNROLL_MAX:
        return F.aggregate(F.zip_with(x, y, lambda u, v: u * v), F.lit(0.0), lambda s, t: s + t)
    acc = x[0] * y[0]
    for j in range(1, k):
        acc = acc + x[j] * y[j]
    return acc


def sum_squares(a: str | Column) -> Column:
    """Σ x² of an array (G9 building block)."""
    return F.aggregate(col(a), F.lit(0.0), lambda s, x: s + x * x)


def clamp(x: str | Column, lo: float = 1.0, hi: float = 5.0) -> Column:
    """Clamp into [lo, hi]."""
    return F.least(F.lit(hi), F.greatest(F.lit(lo), col(x)))


def init_vector(id_col: str | Column, k: int, init_range: float = 0.05) -> Column:
    """Repeatable factor init (M1): init_range · ((id·31 + j·17) mod 1000) / 1000, j = 0..k-1.

    Integer arithmetic only, so any engine can repeat it; the spread replaces
    the reference's unseeded ``rand()``.
    """
    i = col(id_col).cast("long")
    return F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)),
        lambda j: F.lit(init_range) * F.pmod(i * 31 + j * 17, F.lit(1000)).cast("double") / F.lit(1000.0),
    )


def const_vector(value: float, k: int) -> Column:
    """Constant vector."""
    return F.array_repeat(F.lit(float(value)), k)


# Fixed values of the draw hash: a multiply-mod generator on integers so
# that Spark and any SQL engine draw the same partners.
DRAW_MOD = 2147483647


DRAW_MULTS = (1103515245, 12345, 2654435761 % DRAW_MOD, 40503, 69069, 69621)


def draw_key_sql(*parts: str) -> str:
    """``draw_key`` as SQL expression text over column names / literals (one JVM call to build)."""
    acc = " + ".join(f"CAST({p} AS BIGINT) * {m}" for p, m in zip(parts, DRAW_MULTS))
    x = f"pmod({acc}, {DRAW_MOD})"
    return f"pmod({x} * {x} + {x}, {DRAW_MOD})"


def basis_points(x: str | Column) -> Column:
    """floor(x·10000) as an integer."""
    return F.floor(col(x) * 10000).cast("long")


def fixed(x: str | Column, digits: int) -> Column:
    """``%.Nf`` of a double as C's printf gives it (F7): the binary value is rounded, exact ties to the even digit.

    ``format_string`` rounds the shortest decimal text of the value half up. The two differ only where that text lies in
    the middle of two results, j / (2·10^N) with an odd j; there the sign of the exact difference between j and the double
    times 2·10^N decides. The double is taken apart into two numbers of few bits, whose products are exact.
    """
    v, scale = col(x), 2.0 * 10**digits
    j = F.rint(v * scale)
    high = v.cast("float").cast("double")
    short = (j - high * scale) - (v - high) * scale   # > 0: the double is less than the middle
    down, up = F.floor(j / 2), F.ceil(j / 2)
    even = F.when(F.pmod(down, F.lit(2)) == 0, down).otherwise(up)
    at = F.when(short > 0, down).when(short < 0, up).otherwise(even)
    middle = (v == j / scale) & (F.pmod(j, F.lit(2.0)) == 1)
    return F.format_string(f"%.{digits}f", F.when(middle, at / (scale / 2)).otherwise(v))
