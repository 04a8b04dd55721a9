"""Registry of named queries (Spark plan + DuckDB oracle SQL).

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables; the
oracle is the same question in DuckDB SQL over the same tables. Float outputs
are rounded on both sides so that summation order cannot change a hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.sources.bindings import EVENTS_SQL, LEDGER_SQL

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
BENCH: list[str] = []


def register(name: str, sql: str | None = None, *, bench: bool = False):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        if bench:
            BENCH.append(name)
        return fn
    return deco


def _with(cte: str, body: str) -> str:
    body = body.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {cte},\n{body[4:].lstrip()}"
    return f"WITH {cte}\n{body}"


def with_ledger(body: str) -> str:
    return _with(LEDGER_SQL, body)


def with_events(body: str) -> str:
    return _with(EVENTS_SQL, body)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (oracle comparisons only)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])
