"""Repeatable random numbers for resampling.

Weights must not depend on partitioning or on a retried task, so they are computed from the row
key: two seeds out of a digest, a line through them at the draw number, and a power map modulo
the prime 2^31 - 1. The line makes draws pairwise independent; x^5 is a permutation of the
residues (5 does not divide p - 1) and breaks up the regular spacing. All of it is 64-bit integer
arithmetic inside generated code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = 2_147_483_647


def seeds(key: Column, seed: int) -> tuple[Column, Column]:
    """Offset in [0, p) and slope in [1, p) for a key."""
    digest = F.md5(F.concat_ws(":", key, F.lit(str(seed))))
    first, second = (F.conv(F.substr(digest, F.lit(at), F.lit(8)), 16, 10).cast("bigint") for at in (1, 9))
    return first % PRIME, second % (PRIME - 1) + 1


def draw(offset: Column, slope: Column, number: Column) -> Column:
    """Uniform integer in [0, p) for a draw number below 2^31."""
    x = (offset + slope * number) % PRIME
    square = x * x % PRIME
    return square * square % PRIME * x % PRIME


def poisson_thresholds() -> list[int]:
    """Cumulative Poisson(1) probabilities on the scale of `draw`."""
    total, term, thresholds = 0.0, math.exp(-1.0), []
    k = 0
    while int((total + term) * PRIME) < PRIME - 1:
        total += term
        thresholds.append(int(total * PRIME))
        k += 1
        term /= k
    return thresholds


def poisson_weight(uniform: Column) -> Column:
    """Poisson(1) count of a uniform draw: how many thresholds it reaches."""
    reached = [(uniform >= t).cast("int") for t in poisson_thresholds()]
    return sum(reached[1:], reached[0])
