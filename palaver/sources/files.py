"""Files as a sink: one file a row, written as a transaction.

Tasks write into folders of their own below a staging folder, and tell the driver
which files they hold.  Only when all tasks are done does the commit move the files
to their places; a task that is tried again leaves its first try behind in staging,
and a job that fails leaves nothing but what was there before.  The folder may be
any that pyarrow's file systems reach.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from palaver.sources.sinks import safe_name


@dataclass
class Staged(WriterCommitMessage):
    """The files of one task: where they lie and their names."""

    folder: str
    names: list[str]


class FileWriter(DataSourceWriter):
    def __init__(self, folder: str):
        self.folder, self.job = folder, f"_staging-{uuid.uuid4().hex}"

    def _store(self) -> tuple[FileSystem, str]:
        return FileSystem.from_uri(self.folder)

    def write(self, iterator: Iterator) -> Staged:
        store, root = self._store()
        folder, names = f"{root}/{self.job}/{uuid.uuid4().hex}", {}
        store.create_dir(folder)
        for row in iterator:
            name, body = safe_name(row["name"]), row["data"]
            path = f"{folder}/{name}"
            if "/" in name:
                store.create_dir(path.rpartition("/")[0])
            with store.open_output_stream(path) as f:
                f.write(body.encode() if isinstance(body, str) else bytes(body or b""))
            names[name] = True
        return Staged(folder, list(names))

    def _clear(self) -> None:
        store, root = self._store()
        with contextlib.suppress(FileNotFoundError):
            store.delete_dir(f"{root}/{self.job}")

    def commit(self, messages: list) -> None:
        store, root = self._store()
        made = set()
        for m in messages:
            for name in m.names if m else ():
                to = f"{root}/{name}"
                above = to.rpartition("/")[0]
                if above not in made:
                    store.create_dir(above)
                    made.add(above)
                store.move(f"{m.folder}/{name}", to)
        self._clear()

    def abort(self, messages: list) -> None:
        self._clear()


class FileSink(DataSource):
    """format('one_file_a_row') with the option folder, for rows of name and data."""

    @classmethod
    def name(cls) -> str:
        return "one_file_a_row"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return FileWriter(self.options["folder"])


def write_files(rows: DataFrame, folder: str, name: str = "name", data: str = "data") -> None:
    """One file a row in a folder that all tasks reach; all of them or none.

    Of rows with one name one is kept; names stay below the folder.
    """
    rows.sparkSession.dataSource.register(FileSink)
    body = F.col(data) if dict(rows.dtypes)[data] == "binary" else F.encode(F.col(data).cast("string"), "UTF-8")
    rows.select(F.col(name).cast("string").alias("name"), body.alias("data")).write.format("one_file_a_row").option("folder", folder).mode("append").save()
