"""Registered queries of the core, with the SQL that gives the same rows."""

from . import analysis_queries, annotation_queries, export_queries, line_queries  # noqa: F401
from .base import QUERIES, SQL  # noqa: F401
