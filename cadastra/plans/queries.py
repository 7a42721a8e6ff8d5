"""All queries of the building operators."""

from . import cleaning_queries, release_queries, spatial_queries
from .catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cleaning_queries", "release_queries", "spatial_queries"]
