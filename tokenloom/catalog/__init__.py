"""Runnable queries over the driver's tables, each with its DuckDB counterpart where SQL can
express it on whole tables."""

from __future__ import annotations

from .registry import REGISTRY, Query


def all_queries() -> dict[str, tuple[Query, str | None]]:
    """All registered queries by name, in name order."""
    from . import check_queries, encode_queries, expression_queries, packing_queries, source_queries  # noqa: F401

    return dict(sorted(REGISTRY.items()))
