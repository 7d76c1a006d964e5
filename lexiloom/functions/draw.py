"""Reproducible choices: a hash of (seed, sample, method, slot) instead of a generator.

The same sample gets the same choices on any partitioning and on any retry.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RANGE = 2 ** 32


def draw(seed: int, sample: Column, method: str, slot: Column | str) -> Column:
    """A bigint in [0, 2**32)."""
    slot = F.lit(slot) if isinstance(slot, str) else slot
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), sample, F.lit(method), slot))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def choose(options: Column, drawn: Column) -> Column:
    """The drawn element; NULL when there are no options."""
    return F.get(options, (drawn % F.nullif(F.size(options), F.lit(0))).cast("int"))


def chance(drawn: Column, probability: float) -> Column:
    return drawn < math.ceil(probability * RANGE)
