"""Registry of named queries with their SQL for comparison."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siglake.plans import fixtures
from siglake.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_FIXTURE = re.compile(r"\bf_\w+\b")


def with_fixtures(sql: str) -> str:
    """Prepend the definitions of the fixture tables that the SQL names."""
    needed, open_names = [], _FIXTURE.findall(sql)
    while open_names:
        name = open_names.pop()
        if name in needed:
            needed.remove(name)
        needed.insert(0, name)
        open_names += _FIXTURE.findall(fixtures.SQL[name])
    definitions = ",\n".join(f"{name} AS ({fixtures.SQL[name]})" for name in needed)
    own = re.match(r"\s*WITH\b", sql)
    if own:
        return f"WITH {definitions},{sql[own.end():]}" if definitions else sql
    return f"WITH {definitions}\n{sql}" if definitions else sql


def register(sql: str | None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        name = function.__name__

        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return function(spark, sf_dir)

        query.__name__ = name
        query.__doc__ = function.__doc__
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = with_fixtures(sql)
        return function

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Sums of doubles depend on their order in the last digits.

    Means of a few hundredths can end in a 5 at the seventh digit; they get more digits.
    """
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def r6(column: Column) -> Column:
    return F.round(column, 6)
