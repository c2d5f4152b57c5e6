"""Hash order and hash noise: pure functions of (row id, seed).

Samples, folds and noise must not depend on partitioning, task retries or row order, so none of them
draws from a generator; each row derives its own position or draw from its id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

HASH_BITS = 32


def order_hash(row_id: Column, seed: int, method: str = "xxhash64") -> Column:
    """A BIGINT in [0, 2**32), uniform over ids.

    ``xxhash64`` is the fast default. ``md5`` gives the same value in any engine with an md5 function.
    """
    if method == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(row_id, F.lit(seed)), 64 - HASH_BITS)
    if method == "md5":
        digest = F.md5(F.concat_ws("|", row_id.cast("string"), F.lit(str(seed))))
        return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")
    raise ValueError(f"unknown hash method: {method}")


def gaussian(row_id: Column, seed: int, name: str, method: str = "xxhash64") -> Column:
    """A standard normal draw per (row id, seed, name), by the Box-Muller transform."""
    span = float(2 ** HASH_BITS)
    tagged = [F.concat_ws("|", row_id.cast("string"), F.lit(name), F.lit(part)) for part in "ab"]
    u1, u2 = ((order_hash(t, seed, method) + 0.5) / span for t in tagged)
    return F.sqrt(F.log(u1) * -2.0) * F.cos(u2 * (2 * math.pi))
