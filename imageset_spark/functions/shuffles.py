"""A shuffle that is worked out row by row: a keyed bijection of row numbers.

Row ``x`` of ``n`` goes to place ``p(x)``, and no two rows to one place, so nothing has
to be sorted or moved to shuffle a numbered table anew. The bijection is a Feistel
network on pairs (left, right) with left below ``a`` and right below ``b``: every step adds a
hash of one half to the other. ``a * b`` may exceed ``n`` a little; a row that lands
beyond ``n`` is sent through the network again until it lands below (cycle walking),
which keeps the map a bijection. As at most ``a * b - n`` numbers lie beyond, that
takes ``a * b - n`` repeats at most, and ``a`` is chosen so that these are few.
"""

from math import isqrt

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 8
#: Divisors that are tried, and how far below the square root they may lie.
_TRIED, _NARROWEST = 1 << 20, 16


def halves(n):
    """(a, b) with ``a * b >= n`` and as little beyond ``n`` as can be, both not far from the square root."""
    top = max(1, isqrt(n))
    low = max(min(2, top), top // _NARROWEST, top - _TRIED)
    tried = np.arange(low, top + 1, dtype=np.int64)
    beyond = -n % tried
    # Of equally good ones the largest.
    a = int(tried[::-1][np.argmin(beyond[::-1])])
    return a, -(-n // a)


def _column(value):
    return value if isinstance(value, Column) else F.lit(value).cast("bigint")


def shuffled_place(number, n, key, dims=None, rounds=ROUNDS):
    """Place of row ``number`` (from 0) among ``n`` rows, for a text ``key``.

    ``dims`` is (a, b) if ``n`` is a column, else it follows from ``n``.
    """
    a, b = (_column(d) for d in (dims or halves(n)))
    n = _column(n)

    def hashed(step, half):
        text = F.concat_ws(":", key if isinstance(key, Column) else F.lit(key), step.cast("string"), half.cast("string"))
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")

    def moved(pair, step):
        left, right = pair["l"], pair["r"]
        return F.when(
            step % 2 == 0, F.struct(((left + hashed(step, right)) % a).alias("l"), right.alias("r"))
        ).otherwise(F.struct(left.alias("l"), ((right + hashed(step, left)) % b).alias("r")))

    def network(x):
        start = F.struct(((x - x % b) / b).cast("bigint").alias("l"), (x % b).alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, moved, lambda pair: pair["l"] * b + pair["r"])

    walks = F.sequence(F.lit(0).cast("bigint"), a * b - n)
    return F.aggregate(
        walks, _column(number) if not isinstance(number, str) else F.col(number).cast("bigint"),
        lambda x, walk: F.when((walk == 0) | (x >= n), network(x)).otherwise(x),
    )
