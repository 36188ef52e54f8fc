"""Labels, bands and grades."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark import fixed_values as fv


def encode_label(label: Column) -> Column:
    """human -> 0, ai -> 1, anything else -> null."""
    return F.when(label == "human", F.lit(0)).when(label == "ai", F.lit(1))


def confidence_band(confidence: Column) -> Column:
    band = F.lit(fv.LOWEST_BAND)
    for floor, name in reversed(fv.CONFIDENCE_BANDS):
        band = F.when(confidence >= floor, F.lit(name)).otherwise(band)
    return band


def performance_grade(f1: Column) -> Column:
    grade = F.lit(fv.LOWEST_GRADE)
    for floor, name in reversed(fv.GRADES):
        grade = F.when(f1 > floor, F.lit(name)).otherwise(grade)
    return grade


def share_status(deviation: Column) -> Column:
    """How far a provider is from its target share."""
    return (
        F.when(deviation <= fv.SHARE_TOLERANCE, F.lit("within"))
        .when(deviation <= fv.REBALANCE_THRESHOLD, F.lit("near"))
        .otherwise(F.lit("over"))
    )
