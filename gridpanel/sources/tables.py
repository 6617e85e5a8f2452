"""Parquet tables: scan, append, replace, and several of these as one commit.

A table is a list of folders, and a commit file names the folders of all tables.
Rows are written to new folders first; the commit then becomes visible by the
rename of one small file, which fails if another commit took its number. So a
writer that is lost half way leaves the old tables as they were, readers see all
tables of a commit or none, and a plan may replace a table that it reads. Folders
that no commit names any more are left to the store's clean-up policy. Replacing a
table by itself gathers the folders of many appends into one.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from gridpanel.sources import schemas

TABLES = {
    "countries": schemas.COUNTRIES,
    "circuits": schemas.CIRCUITS,
    "meetings": schemas.MEETINGS,
    "sessions": schemas.SESSIONS,
    "positions": schemas.POSITIONS,
}
COMMITS = "_commits"


class Change(NamedTuple):
    """Rows of a table to add, or to have instead of all others."""

    rows: DataFrame
    replace: bool = False


class _Store:
    """The file system a folder lies in, through Spark's own configuration."""

    def __init__(self, spark: SparkSession, root: str):
        self.context, self.jvm = spark.sparkContext, spark.sparkContext._jvm
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(self.context._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def commits(self) -> list[int]:
        folder = self.path(COMMITS)
        if not self.fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in self.fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def read(self, number: int) -> dict[str, list[str]]:
        stream = self.fs.open(self.path(f"{COMMITS}/{number}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def publish(self, number: int, folders: dict[str, list[str]]) -> None:
        draft = self.path(f"{COMMITS}/_draft-{uuid.uuid4().hex}")
        stream = self.fs.create(draft)
        stream.write(bytearray(json.dumps(folders, sort_keys=True).encode()))
        stream.close()
        files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.context._jsc.hadoopConfiguration())
        # without an option, a rename onto a commit that is there already fails
        options = self.context._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        files.rename(draft, self.path(f"{COMMITS}/{number}"), options)


def _latest(store: _Store) -> tuple[int, dict[str, list[str]]]:
    commits = store.commits()
    return (commits[-1], store.read(commits[-1])) if commits else (-1, {})


def read_table(spark: SparkSession, root: str, name: str, commit: int | None = None) -> DataFrame:
    """The table as of the latest commit, or of an earlier one."""
    store = _Store(spark, root)
    folders = (_latest(store)[1] if commit is None else store.read(commit)).get(name, [])
    reader = spark.read.schema(TABLES[name])
    if not folders:
        return spark.createDataFrame([], TABLES[name])
    return reader.parquet(*[f"{store.root}/{folder}" for folder in folders])


def commit(spark: SparkSession, root: str, changes: dict[str, Change]) -> int:
    """Write all changes, then make them visible together; the commit's number."""
    store = _Store(spark, root)
    number, folders = _latest(store)
    for name, change in changes.items():
        columns = [field.split()[0] for field in TABLES[name].split(", ")]
        folder = f"{name}/{uuid.uuid4().hex}"
        change.rows.select(*columns).write.parquet(f"{store.root}/{folder}")
        folders[name] = [folder] if change.replace else [*folders.get(name, []), folder]
    store.publish(number + 1, folders)
    return number + 1


def create_tables(spark: SparkSession, root: str) -> None:
    """Empty tables, so that a first load reads the same way as any later one."""
    if not _Store(spark, root).commits():
        commit(spark, root, {name: Change(spark.createDataFrame([], schema)) for name, schema in TABLES.items()})


def append(df: DataFrame, root: str, name: str) -> None:
    commit(df.sparkSession, root, {name: Change(df)})


def replace(df: DataFrame, root: str, name: str) -> None:
    """Another table instead of the stored one; the plan may read the stored one."""
    commit(df.sparkSession, root, {name: Change(df, replace=True)})


def register_views(spark: SparkSession, root: str) -> None:
    """Temporary views of all tables, for SQL text."""
    for name in TABLES:
        read_table(spark, root, name).createOrReplaceTempView(name)


def read_inputs(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{folder}/{name}.parquet") for name in names]
