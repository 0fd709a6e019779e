"""Query registry: each key pairs a Spark builder with its DuckDB oracle text.

Outputs are normalised the same way on both sides so values hash equally:
doubles rounded to 6 decimals, dates/timestamps as ISO strings, integers as
64-bit.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.catalog.fixture_sql import FIXTURE_SQL


@dataclass
class Entry:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: tuple = ()
    strings: tuple = ()
    longs: tuple = ()
    note: str = ""
    tags: tuple = field(default_factory=tuple)


REGISTRY: dict[str, Entry] = {}


def finish(df: DataFrame) -> DataFrame:
    """Normalise output types for a stable, engine-independent comparison."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(key: str, sql: str | None = None, doubles=(), strings=(), longs=(), note: str = ""):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``."""
    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            # naive timestamps are UTC wall-clock values, as in the oracle
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return finish(fn(spark, sf_dir))
        REGISTRY[key] = Entry(key, build, sql, tuple(doubles), tuple(strings), tuple(longs), note)
        return fn
    return deco


def _needed_fixtures(sql: str) -> list[str]:
    want: set[str] = set()
    stack = [n for n in FIXTURE_SQL if re.search(rf"\b{n}\b", sql)]
    while stack:
        n = stack.pop()
        if n in want:
            continue
        want.add(n)
        stack += [m for m in FIXTURE_SQL if m != n and re.search(rf"\b{m}\b", FIXTURE_SQL[n])]
    return [n for n in FIXTURE_SQL if n in want]  # definition order = dependency order


def oracle_text(e: Entry) -> str | None:
    """Full DuckDB statement: fixture CTEs + query + the same normalisation."""
    if e.sql is None:
        return None
    body = e.sql.strip().rstrip(";")
    # Spark rounds the shortest decimal text of a double half-up; do the same
    # here (plain DuckDB ``round`` works on the binary value and differs on ties)
    repl = ([f"coalesce(cast(round(try_cast(cast(cast({c} as double) as varchar) as decimal(38, 20)), 6) "
             f"as double), round(cast({c} as double), 6)) + 0.0 as {c}" for c in e.doubles]
            + [f"cast({c} as varchar) as {c}" for c in e.strings]
            + [f"cast({c} as bigint) as {c}" for c in e.longs])
    sel = f"* replace ({', '.join(repl)})" if repl else "*"
    body = f"select {sel} from (\n{body}\n) as q"
    fx = _needed_fixtures(e.sql)
    if not fx:
        return body
    ctes = ",\n".join(f"{n} as (\n{FIXTURE_SQL[n].strip()}\n)" for n in fx)
    return f"with {ctes}\n{body}"
