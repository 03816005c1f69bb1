from shelfwise.registry.oracle import oracle_sql
from shelfwise.registry.queries import queries

__all__ = ["oracle_sql", "queries"]
