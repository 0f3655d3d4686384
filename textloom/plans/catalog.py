"""All queries of the library: importing this module registers them."""

from . import glossary_queries, licence_queries, relational_queries, stream_queries, text_queries, usage_queries
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "glossary_queries", "licence_queries", "relational_queries", "stream_queries", "text_queries", "usage_queries"]
