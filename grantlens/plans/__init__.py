"""Queries of the reference operators by name, and their SQL."""

from . import q_aggs, q_joins, q_links, q_rows, q_sources, q_text  # noqa: F401
from .base import ORACLE_SQL, QUERIES  # noqa: F401
