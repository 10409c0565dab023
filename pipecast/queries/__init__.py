"""One runnable query per operator, and the same result as SQL for cross-checking."""

from pipecast.queries.catalog import queries
from pipecast.queries.oracle import oracle_sql

__all__ = ["oracle_sql", "queries"]
