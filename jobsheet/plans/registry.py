"""Registry of named queries and their SQL oracles.

A query is a function ``(spark, sf_dir) -> DataFrame`` over the driver
tables.  Its oracle is an independent SQL statement (DuckDB dialect) over
the same tables; ``None`` marks queries that have no SQL form (model fits,
streaming) - those are checked by row count and by our own tests.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsheet.functions.stats import rnd

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    fn: QueryFn
    sql: Callable[[], str] | None
    group: str


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: Callable[[], str] | None = None, group: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, group)
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double / float column with the IEEE-only half-up rule."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(rnd(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
