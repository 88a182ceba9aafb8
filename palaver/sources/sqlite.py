"""SQLite archives as a Spark data source: one partition a range of row ids."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from palaver.schema import TABLES, evolve

_AFFINITY = {"INTEGER": "long", "INT": "long", "BIGINT": "long", "TEXT": "string", "VARCHAR": "string", "BLOB": "binary", "REAL": "double"}


class _Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, table: str, names: list[str], parts: int):
        self.path, self.table, self.names, self.parts = path, table, names, parts

    def _connect(self):
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self) -> list[InputPartition]:
        with self._connect() as db:
            low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.table}"').fetchone()
        if low is None:
            return [_Range(0, 0)]
        step = max(1, -(-(high - low + 1) // self.parts))
        return [_Range(a, min(a + step, high + 1)) for a in range(low, high + 1, step)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        columns = ", ".join(f'"{n}"' for n in self.names)
        with self._connect() as db:
            yield from db.execute(f'SELECT {columns} FROM "{self.table}" WHERE rowid >= ? AND rowid < ?', (partition.low, partition.high))


class SqliteSource(DataSource):
    """format('sqlite_archive') with options path, table and parts."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_archive"

    def _columns(self) -> list[tuple[str, str]]:
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            rows = db.execute(f"PRAGMA table_info(\"{self.options['table']}\")").fetchall()
        return [(r[1], _AFFINITY.get(r[2].split("(")[0].upper(), "string")) for r in rows]

    def schema(self) -> str:
        return ", ".join(f"`{n}` {t}" for n, t in self._columns())

    def reader(self, schema) -> DataSourceReader:
        return SqliteReader(self.options["path"], self.options["table"], [f.name for f in schema], int(self.options.get("parts", "8")))


def read_table(spark: SparkSession, path: str, table: str, parts: int = 8) -> DataFrame:
    """A stored table in its declared layout; text dates become timestamps."""
    spark.dataSource.register(SqliteSource)
    df = spark.read.format("sqlite_archive").option("path", path).option("table", table).option("parts", str(parts)).load()
    return evolve(df, TABLES[table]) if table in TABLES else df
