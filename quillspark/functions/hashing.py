"""Repeatable draws: every random choice is a digest of a seed and a row id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_DIGITS = 7  # 28 bits


def order_key(seed: int, row_id: Column) -> Column:
    """A hex string that orders rows as a seeded shuffle would."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), row_id.cast("string")).cast("binary"))


def draw(seed: int, row_id: Column, step: str) -> Column:
    """A non-negative integer below 2**28 for one step of one row."""
    text = F.concat_ws(":", F.lit(str(seed)), row_id.cast("string"), F.lit(step))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DRAW_DIGITS), 16, 10).cast("bigint")


def chance(seed: int, row_id: Column, step: str, share: float) -> Column:
    """True for about ``share`` of the rows."""
    return draw(seed, row_id, step) < F.lit(int(share * 16**DRAW_DIGITS))
