"""Registered queries."""

from tenure.catalog import loading, models, pages, staged, texts  # noqa: F401  (each registers its queries)
from tenure.catalog.registry import QUERIES  # noqa: F401
