"""Keyed pseudo-random draws.

Every random choice is a hash of the row's key and a seed, so a recomputed task or another
partitioning repeats exactly the same choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 13
_RANGE = float(16**_HEX_DIGITS)


def draw_key(keys: Sequence[Column | str], *salt: object) -> Column:
    """Uniform hexadecimal sort key of a row."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", *cols, *[F.lit(str(s)) for s in salt]))


def unit_draw(keys: Sequence[Column | str], *salt: object) -> Column:
    """Uniform double in [0, 1)."""
    digits = F.substring(draw_key(keys, *salt), 1, _HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(_RANGE)


def index_draw(keys: Sequence[Column | str], size: Column, *salt: object) -> Column:
    """Uniform integer in [0, size)."""
    return F.floor(unit_draw(keys, *salt) * size).cast("bigint")
