"""Registered queries: name -> (function of session and data folder, checking SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palaver.lens import table, with_lens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Board:
    """Tables of one data folder as attributes: base tables and lens tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("__"):
            raise AttributeError(name)
        return table(self.spark, self.sf_dir, name)


def query(name: str, lens: str = "", sql: str | None = None):
    """Register a query over a ``Board``; ``lens`` names the tables its SQL needs."""

    def register(f: Callable[[Board], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = lambda spark, sf_dir: f(Board(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = with_lens(sql, *lens.split())
        return f

    return register
