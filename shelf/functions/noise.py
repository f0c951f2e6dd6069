"""Random numbers that are functions of a key, so any engine and any task draws the same."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hexadecimal digits of a hash that make one uniform number: 52 bits, exact in a double.
DIGITS = 13


def hashed_key(columns: Sequence[str | Column], seed: int) -> Column:
    """The MD5 of the columns as text and the seed, joined by bars; nulls are skipped."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def _uniform(digest: Column, place: int) -> Column:
    digits = F.substring(digest, 1 + place * DIGITS, DIGITS)
    return F.conv(digits, 16, 10).cast("double")


def polar_pair(digest: Column) -> tuple[Column, Column]:
    """Radius and angle of a point in the plane, from a hash (Box-Muller)."""
    # One is added to the first, whose logarithm must exist.
    radius = F.sqrt(F.lit(-2.0) * F.ln((_uniform(digest, 0) + 1) / F.lit(2.0 ** (4 * DIGITS))))
    angle = F.lit(2 * math.pi) * _uniform(digest, 1) / F.lit(2.0 ** (4 * DIGITS))
    return radius, angle


def normal_pair(radius: Column, angle: Column) -> tuple[Column, Column]:
    """Two independent standard normal numbers, the coordinates of that point."""
    return radius * F.cos(angle), radius * F.sin(angle)
