"""One way to open an archive: a SQLite file, a folder of Parquet tables, or a JDBC address."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palaver.schema import TABLES, evolve


def open_archive(spark: SparkSession, address: str) -> Callable[[str], DataFrame]:
    """A function from a table's name to its frame in the declared layout.

    ``sqlite:path`` or a bare path ending in .db; ``jdbc:...`` (the driver must be
    on the class path); anything else is a folder with ``<table>.parquet``.
    """
    if address.startswith("jdbc:"):
        read = lambda name: spark.read.format("jdbc").option("url", address).option("dbtable", name).load()
    elif address.startswith("sqlite:") or address.endswith((".db", ".sqlite")):
        from palaver.sources.sqlite import read_table

        path = address.removeprefix("sqlite:")
        return lambda name: read_table(spark, path, name)
    else:
        read = lambda name: spark.read.parquet(f"{address.rstrip('/')}/{name}.parquet")
    return lambda name: evolve(read(name), TABLES[name]) if name in TABLES else read(name)


def register_views(spark: SparkSession, address: str, names=None) -> list[str]:
    """Temporary views of an archive's tables, for SQL."""
    opened = open_archive(spark, address)
    names = list(names or TABLES)
    for name in names:
        opened(name).createOrReplaceTempView(name)
    return names
