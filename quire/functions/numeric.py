"""Python's ``round(x, digits)`` for doubles, as a native expression.

Python rounds the exact binary value of a double half to even (0.00015 is
stored as 0.000149999... and rounds down; 0.03125 is an exact tie and rounds
to even).  Spark's ``round``/``bround`` round the shortest decimal form
instead, which differs on such values.  Exact route, all in integer
arithmetic:

1. ``|x| * 2^k`` with ``k = 53 - floor(log2|x|)`` is an exact integer N
   (power-of-two scaling is exact; the product lies in [2^52, 2^55) even if
   ``log2`` is off by one), so ``|x| = N / 2^k`` exactly;
2. ``N * 10^d`` divided by ``2^k`` in ``decimal(38,0)``: quotient and
   remainder are exact; the remainder against ``2^k / 2`` decides the
   rounding, ties to even;
3. the result is the double nearest the decimal ``q / 10^d``, as Python returns.

From 2^52 on a double is an integer and stays as it is; below half a unit of
the last place the result is a zero of x's sign.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DEC = "decimal(38,0)"


def _pow2(k: Column) -> Column:
    """2^k exactly as decimal(38,0) for 0 <= k <= 124."""
    one = F.lit(1).cast("long")
    lo = F.call_function("shiftleft", one, F.least(k, F.lit(62)))
    hi = F.call_function("shiftleft", one, F.greatest(k - 62, F.lit(0)))
    return lo.cast(_DEC) * hi.cast(_DEC)


def py_round(x: Column, digits: int = 4) -> Column:
    """``round(x, digits)`` exactly as Python computes it for a double ``x`` (digits <= 6)."""
    if not 0 <= digits <= 6:
        raise ValueError("digits must be in [0, 6]")
    a = F.abs(x)
    k = (F.lit(53) - F.floor(F.log2(a))).cast("int")
    n = (a * F.pow(F.lit(2.0), k)).cast("long")
    num = n.cast(_DEC) * F.lit(10 ** digits).cast(_DEC)
    den = _pow2(k)
    q0 = F.floor(num / den).cast(_DEC)
    twice_rem = (num - q0 * den) * F.lit(2).cast(_DEC)
    up = F.when(twice_rem > den, 1).when(twice_rem < den, 0).otherwise((q0 % 2).cast("int"))
    q = ((q0 + up).cast("decimal(31,0)") / F.lit(10 ** digits).cast("decimal(7,0)")).cast("double")
    exact = F.signum(x) * q
    return (F.when(x.isNull(), F.lit(None).cast("double"))
            .when(F.isnan(x), x)
            .when(a == 0, x)
            .when(a >= F.lit(2.0 ** 52), x)
            .when(a < F.lit(0.4 * 10.0 ** -digits), F.signum(x) * F.lit(0.0))
            .otherwise(exact))
