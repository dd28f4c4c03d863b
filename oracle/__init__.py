"""Independent DuckDB formulations of every registered query.

Written in the reference's shape (range joins against a shift table,
``row_number``-based "latest row" lookups, per-date correlated windows),
over the fixture views of ``events``, so that the Spark plans are checked
against a different formulation of the same semantics.
"""

from oracle.sql import oracle_queries

__all__ = ["oracle_queries"]
