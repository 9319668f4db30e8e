"""Registered queries by operator id, and the SQL that must give the same rows."""

from __future__ import annotations

from keeprate.catalog import learning, sources, tables
from keeprate.catalog.common import Query

_MODULES = (sources, tables, learning)


def _in_utc(query: Query) -> Query:
    def run(spark, folder):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, folder)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def queries() -> dict[str, Query]:
    return {name: _in_utc(q) for module in _MODULES for name, q in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
