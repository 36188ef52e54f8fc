"""Collects every catalog module's queries and oracles."""

from __future__ import annotations

from quillspark.catalog import (  # noqa: F401 - imported for their registrations
    corpus_queries,
    feature_queries,
    metric_queries,
    model_queries,
    quality_queries,
    source_queries,
    stream_queries,
    text_queries,
)
from quillspark.catalog.base import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracles():
    return dict(ORACLES)
