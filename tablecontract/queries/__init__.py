"""One query per operator over whole tables, each with the SQL that gives the same rows."""

from .registry import ORACLES, QUERIES
from . import dynamic, gates, ingestion, projections, rendering, schemas, streams, tables  # noqa: F401  (each registers its queries)

__all__ = ["ORACLES", "QUERIES"]
