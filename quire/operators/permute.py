"""Keyed permutation of 0..n-1: a seeded order of numbered rows without a sort, a window or a shuffle.

A number is split into two digits of a mixed base (a, b) with a = ceil(sqrt n)
and b = ceil(n / a), and six Feistel rounds add to one digit a keyed hash of
the other, modulo its base.  Each round can be undone, so the whole is a
permutation of 0..a*b-1.  A result of n or more, fewer than a of them, is
permuted again until it is below n (cycle walking), which makes it a
permutation of 0..n-1.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 6
# A walk visits each number from n up to a*b at most once.  Beyond 65,536 rows there can be more of them than steps, but the
# chance that a walk takes them all is below (a / n) ** 256: under 1e-600.
MAX_WALK = 256


def bases(n: int) -> tuple[int, int]:
    """(a, b) with a * b >= n and a * b - n < a."""
    a = isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def _hash(value: Column, key: str, base: int) -> Column:
    """60 bits of the md5 of the key and the value, modulo the base."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(key), value.cast("string"))), 1, 15), 16, 10).cast("long") % F.lit(base)


def _rounds(x: Column, n: int, key: str) -> Column:
    a, b = bases(n)
    left, right = F.call_function("div", x, F.lit(b).cast("long")), x % F.lit(b)
    for i in range(ROUNDS):
        if i % 2 == 0:
            left = (left + _hash(right, f"{key}:{i}:", a)) % F.lit(a)
        else:
            right = (right + _hash(left, f"{key}:{i}:", b)) % F.lit(b)
    return left * F.lit(b) + right


def permuted(index: Column, n: int, seed: int, salt: str = "") -> Column:
    """The place of row ``index`` (0..n-1) in the seeded order.  A null index, or one outside, is an error."""
    a, b = bases(n)
    index = index.cast("long")
    known = F.when((index >= 0) & (index < n), index).otherwise(F.raise_error(F.lit(f"index not in 0..{n - 1}")).cast("long"))
    first = _rounds(known, n, f"{seed}:{salt}")
    if a * b == n:
        return first
    steps = F.sequence(F.lit(1), F.lit(min(a * b - n, MAX_WALK)))
    walked = F.aggregate(steps, first, lambda x, _: F.when(x < n, x).otherwise(_rounds(x, n, f"{seed}:{salt}")))
    return F.when(first < n, first).otherwise(F.when(walked < n, walked).otherwise(F.raise_error(F.lit("walk did not end")).cast("long")))
