"""Registry of queries: each has a function of views and, where SQL can express it, its DuckDB SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import sinks
from .views import TABLES, VIEWS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Data:
    """Tables and derived views of one folder, as DataFrames by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES and name not in VIEWS:
            raise AttributeError(name)
        if name not in self._made:
            if name in TABLES:
                self._made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                sql = VIEWS[name]
                self._made[name] = self.spark.sql(sql, **{n: getattr(self, n) for n in set(re.findall(r"\{([a-z]\w*)\}", sql))})
        return self._made[name]

    def land(self, *names: str) -> Data:
        """This folder's data with views written once as Parquet: what a query reads several times is shuffled once."""
        out = Data(self.spark, self.sf_dir)
        for name in names:
            path = sinks.landing(self.spark, name)
            getattr(self, name).write.option("compression", "zstd").parquet(path)
            out._made[name] = self.spark.read.parquet(path)
        return out

    def spread(self, name: str, *columns: str) -> DataFrame:
        """Columns of a table, or view, dealt out to all cores: a small file is read by one task, and what Python makes of
        its rows is much more than the rows."""
        rows = getattr(self, name)
        return rows.select(*columns or rows.columns).repartition(self.spark.sparkContext.defaultParallelism)


def with_views(sql: str) -> str:
    """sql with {view} names resolved and the views that it needs in front."""
    needed: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\{([a-z]\w*)\}", text):
            if name in VIEWS and name not in needed:
                need(VIEWS[name])
                needed.append(name)

    need(sql)
    plain = lambda s: re.sub(r"\{([a-z]\w*)\}", r"\1", s)
    heads = ", ".join(f"{n} AS ({plain(VIEWS[n])})" for n in needed)
    body = plain(sql).strip()
    if not heads:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {heads}, {body[5:]}"
    return f"WITH {heads} {body}"


def query(name: str, sql: str | None = None):
    """Registers a function of Data as query `name`."""

    def add(function: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: function(Data(spark, sf_dir))
        if sql:
            ORACLE_SQL[name] = with_views(sql)
        return function

    return add
