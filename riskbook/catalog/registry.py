"""The table of queries and of the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskbook.catalog.loans import LOANS_SQL, loans

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the loan table as a query.

    ``sql`` reads a table called ``loans``, which is put in front of it. A query with no SQL twin is
    one that fits or applies a model.
    """

    def register(build: Callable[[DataFrame], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(loans(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_loans(sql)
        return build

    return register


def with_loans(sql: str) -> str:
    """Put the loan table in front of a statement that may have its own WITH list."""
    body = sql.strip()
    head = "WITH RECURSIVE" if body.upper().startswith("WITH RECURSIVE") else "WITH"
    if body.upper().startswith("WITH"):
        return f"{head} loans AS ({LOANS_SQL}), {body[len(head):].strip()}"
    return f"WITH loans AS ({LOANS_SQL}) {body}"
