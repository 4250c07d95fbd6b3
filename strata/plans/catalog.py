"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with SQL oracles.

Every query reads whole driver tables (through the landing derivation in
``driver_tables``) and runs the library's operators on them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import driver_tables as D
from . import oracle_sql as O
from .silver import SILVER_BUILDERS
from .warehouse import GOLD_MODELS, Warehouse, decimals_to_double

Query = Callable[[SparkSession, str], DataFrame]


def _bronze(name: str) -> Query:
    return lambda spark, sf_dir: Warehouse(spark, sf_dir).bronze(name)


def _silver(name: str) -> Query:
    return lambda spark, sf_dir: decimals_to_double(Warehouse(spark, sf_dir).silver(name))


def _gold(name: str) -> Query:
    return lambda spark, sf_dir: decimals_to_double(Warehouse(spark, sf_dir).staged().gold(name))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for name in D.SPECS:
        q[f"bronze_{name}"] = _bronze(name)
    for name in SILVER_BUILDERS:
        q[name] = _silver(name)
    for name in GOLD_MODELS:
        q[name] = _gold(name)
    from . import extra_queries as X
    from . import storage_queries as Y
    q.update(X.queries())
    q.update(Y.queries())
    return q


def oracle_sql() -> dict[str, str]:
    sql = {f"bronze_{name}": D.landing_sql(name) for name in D.SPECS}
    sql.update({name: f() for name, f in O.SILVER.items()})
    sql.update({name: f() for name, f in O.GOLD.items()})
    from . import extra_queries as X
    from . import storage_queries as Y
    sql.update(X.oracle_sql())
    sql.update(Y.oracle_sql())
    return sql
