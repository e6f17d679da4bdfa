"""Queries over the driver's tables, each with DuckDB SQL of the same result where SQL has one."""

from . import function_queries, relational_queries, table_queries, value_queries  # noqa: F401
from .registry import ORACLES, QUERIES, query  # noqa: F401
