"""Queries by name, each with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kbforge.sources.tables import table


class Tables:
    """The tables of a data folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name``."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return f

    return add
