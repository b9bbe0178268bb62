"""Registry of queries and their oracle texts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clubflow.catalog.standins import Tables, with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    """Result columns as both engines show them: days as text, money as double."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(field.name))
    return df.select(*out)


def query(
    name: str,
    sql: str | None = None,
    tables: Sequence[str] = (),
    dates: Sequence[str] = (),
    money: Sequence[str] = (),
):
    """Register ``fn(tables) -> DataFrame`` with its oracle.

    ``tables`` are the stand-ins the oracle reads; ``dates`` and ``money`` the
    columns it shows as text and as double.
    """

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(Tables(spark, sf_dir)))

        run.__name__ = name
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            shown = [f'CAST("{d}" AS VARCHAR) AS "{d}"' for d in dates]
            shown += [f'CAST("{m}" AS DOUBLE) AS "{m}"' for m in money]
            text = f"SELECT * REPLACE ({', '.join(shown)}) FROM ({sql}) AS shown" if shown else sql
            ORACLES[name] = with_tables(text, *tables)
        return fn

    return register
