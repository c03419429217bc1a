"""Every registered query, by name."""

from bodega.queries import flows, lineage, quality, relational, risk, warehouse  # noqa: F401
from bodega.queries.base import REGISTRY, Tables

__all__ = ["REGISTRY", "Tables"]
