"""Registered queries, each next to the SQL text that states its expected result."""

from sedimenta.plans import (  # noqa: F401  (importing a module registers its queries)
    aggregate, arrange, clean, dimension, ingest, privacy, quality, relate, stream,
)
from sedimenta.plans.registry import QUERIES

__all__ = ["QUERIES"]
