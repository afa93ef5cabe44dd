"""Registered queries: name -> (Spark builder, oracle SQL).

Every query reads the driver tables through the fixture views (so its work
grows with them).  Most are lazy; the file, loader and job queries write their
files, and ``materialize="table"`` queries their intermediates, while the result
is being built.  The oracle text is the same result stated in plain SQL for
DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.plans.models import Models
from tallyhouse.plans.oracle_sql import oracle
from tallyhouse.sources.tables import adapter_raw

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, materialize: str = "none", stored: bool = False):
    """Decorator: register ``fn(models, spark, sf_dir) -> DataFrame`` under ``name``.

    ``materialize="table"`` is for queries that read the intermediate
    models many times (the checks): they are computed once and read back.
    ``stored`` is for queries that write the raw tables out: the order lines under
    them are joined once.
    """

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Models(adapter_raw(spark, sf_dir, stored), materialize=materialize), spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = oracle(sql)
        return fn

    return wrap


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def _load() -> None:
    # Importing the modules runs their @register decorators.
    from tallyhouse.plans import registry  # noqa: F401
