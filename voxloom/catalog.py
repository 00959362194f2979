"""Registry of the queries outside the training-data subpackage, and their DuckDB twins."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under a name, with its SQL if it has one."""

    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _load() -> None:
    from voxloom.plans import model_queries, relational_queries, source_queries, text_queries  # noqa: F401  they register themselves


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
