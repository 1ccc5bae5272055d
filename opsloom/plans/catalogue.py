"""Registry of the runnable queries and of the SQL text that checks each one."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsloom.sources.sample_views import VIEW_SQL
from opsloom.sources.tables import staged

RAW_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Lazy access to the parquet tables of one directory and to the views on them."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self._raw: dict[str, DataFrame] = {}
        self._once: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        return self._raw[name]

    def view(self, name: str) -> DataFrame:
        return self.sql(f"SELECT * FROM {name}")

    def once(self, name: str) -> DataFrame:
        """A view that a query reads several times: joined once and written to the shared folder."""
        if name not in self._once:
            self._once[name] = staged(self.view(name), name)
        return self._once[name]

    def sql(self, text: str) -> DataFrame:
        text = with_views(text)
        for table in RAW_TABLES:
            if re.search(rf"\b(from|join)\s+{table}\b", text, re.IGNORECASE):
                self.raw(table).createOrReplaceTempView(table)
        return self.spark.sql(text)


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    check_sql: str | None


CATALOGUE: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query builder, with the ANSI SQL that must give the same rows."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in CATALOGUE:
            raise ValueError(f"query {name} registered twice")
        CATALOGUE[name] = Query(name, build, expand_rounding(with_views(sql)) if sql else None)
        return build

    return register


def expand_rounding(sql: str) -> str:
    """Write out `r4(x)`: x to four decimals by plain double arithmetic, halves up.

    SQL engines differ on exact halves in `round`; the same two double operations do not.
    """
    while match := re.search(r"(?<![\w.])r(\d)\(", sql):
        end, depth = match.end(), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        scale = 10 ** int(match.group(1))
        inner = sql[match.end():end - 1]
        sql = f"{sql[:match.start()]}(floor(CAST({inner} AS DOUBLE) * {scale} + 0.5) / {scale}){sql[end:]}"
    return sql


def with_views(sql: str) -> str:
    """Prefix the SQL with the definitions of the sample views it names, directly or not."""
    used: set[str] = set()
    pending = [sql]
    while pending:
        text = pending.pop()
        for name in VIEW_SQL:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                pending.append(VIEW_SQL[name])
    if not used:
        return sql.strip()
    ordered = [name for name in VIEW_SQL if name in used]
    definitions = ",\n".join(f"{v} AS (\n{VIEW_SQL[v].strip()}\n)" for v in ordered)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {definitions},\n{body[5:]}"
    return f"WITH {definitions}\n{body}"


def rounded(df: DataFrame, digits: int = 4, only: list[str] | None = None) -> DataFrame:
    """Round the double columns the way `expand_rounding` writes it for the check."""

    def out(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)) and (
            only is None or field.name in only
        ):
            scale = float(10**digits)
            return (F.floor(col.cast("double") * scale + 0.5) / scale).alias(field.name)
        return col

    return df.select(*[out(f) for f in df.schema.fields])
