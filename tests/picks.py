"""Seeded pseudo-random choices as plain column expressions.

Every pick is a hash of (row id, seed, tag), so it does not depend on how the
rows are partitioned and a recomputed task produces the same values again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_MASK_ROWS = 1 << 41
_LIMB = 1 << 20


def _hash(row_id: Column, seed: int, tag: str) -> Column:
    return F.xxhash64(row_id, F.lit(seed), F.lit(tag))


def pick_int(row_id: Column, seed: int, tag: str, low: int, high: int) -> Column:
    """Uniform integer in [low, high)."""
    return F.pmod(_hash(row_id, seed, tag), F.lit(high - low)) + F.lit(low)


def pick_unit(row_id: Column, seed: int, tag: str) -> Column:
    """Uniform double in [0, 1)."""
    steps = 1 << 52
    return F.pmod(_hash(row_id, seed, tag), F.lit(steps)) / F.lit(float(steps))


def pick_from(row_id: Column, seed: int, tag: str, values: Sequence) -> Column:
    """One of ``values``, uniformly."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (pick_int(row_id, seed, tag, 0, len(values)) + 1).cast("int"))


def exact_k_mask(row_id: Column, n: int, k: int, seed: int) -> Column:
    """True for exactly ``k`` of the ids 1..n: sampling without replacement, no shuffle.

    The ids are permuted by ``x -> (x * a + b) mod n`` with ``a`` coprime to
    ``n``; the ids that land below ``k`` are chosen. The choice is evenly
    spread, not statistically random, which is enough for injecting anomalies.
    Different seeds give different multipliers, so two masks overlap.
    """
    if n <= 0 or k <= 0:
        return F.lit(False)
    if n > MAX_MASK_ROWS:
        raise ValueError(f"exact_k_mask supports up to {MAX_MASK_ROWS} rows, got {n}")
    a = max(1, int(n * (0.381966 + 0.0173 * (seed % 13))) % n)
    while math.gcd(a, n) != 1:
        a += 1
    b = (seed * 7919) % n
    # The product is taken in two 20-bit limbs of ``a``: every term stays below 2^62.
    x = row_id.cast("long") - 1
    high = (x * F.lit(a // _LIMB)) % F.lit(n)
    position = (high * F.lit(_LIMB) + x * F.lit(a % _LIMB) + F.lit(b)) % F.lit(n)
    return position < F.lit(k)
