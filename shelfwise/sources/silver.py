"""Keyed, hive-style partitioned Parquet tables.

Beside its directories a table has a record (``_schema``) of its columns and last commit, and, while
directories are being replaced, a note (``_pending``) of what the commit replaces. Replacing rows
are written in directory layout below the table first, so that a commit only moves directories, can be
carried on by anyone who finds the note, and reads as done from the moment the note is there.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.sources.files import (
    delete,
    matching,
    move_folder,
    read_note,
    replace_folders,
    write_note,
)

_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
BUCKET = "key_bucket"
_STAGED = "_staged-"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# A reader that meets this many commits while it lists a table gives up.
LOOKS = 20


@dataclass(frozen=True)
class SilverTable:
    """A table with one row per row key; greater ``ordering`` wins on upsert.

    The row key is (partition, keys), so one key may stand in several partitions; with
    ``scope="global"`` it is the keys alone, and a row that comes into another partition leaves the old one.

    ``buckets`` splits each partition into that many sub-directories by key hash. An upsert
    rewrites the directories it touches, so a partition that holds much of the data should be
    split; the number is fixed for the life of the table. ``sequence`` names a column that keeps the number
    of the batch a row came with: at equal ordering the later batch wins, whichever is loaded last.
    """

    path: str
    keys: tuple[str, ...]
    partition: str
    ordering: str
    partition_type: str = "string"
    buckets: int = 1
    scope: str = "partition"
    sequence: str | None = None

    def __post_init__(self):
        if self.scope not in ("partition", "global"):
            raise ValueError(f"unknown scope {self.scope!r}")

    @property
    def row_key(self) -> list[str]:
        if self.scope == "global":
            return list(self.keys)
        # The partition, with few values, comes last: sorts mostly end at the first column.
        return [*(k for k in self.keys if k != self.partition), self.partition]

    @property
    def note(self) -> str:
        """Says what a commit is replacing; scans skip it."""
        return f"{self.path}/_pending"

    @property
    def record(self) -> str:
        """Columns of the table and its last commit; scans skip it."""
        return f"{self.path}/_schema"

    @property
    def directories(self) -> list[str]:
        return [self.partition, BUCKET] if self.buckets > 1 else [self.partition]

    def place(self, df: DataFrame) -> DataFrame:
        """Rows with the columns that name their directory. Empty text stands for NULL too."""
        if self.partition_type == "string":
            df = df.withColumn(self.partition, F.coalesce(self.partition, F.lit("")))
        if self.buckets > 1:
            bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
            df = df.withColumn(BUCKET, bucket)
        return df

    def ordered(self, schema: T.StructType) -> T.StructType:
        """Data columns, then the directory columns with their types, as a scan returns them."""
        data = [f for f in schema.fields if f.name not in self.directories]
        named = T.StructType.fromDDL(f"`{self.partition}` {self.partition_type}, {BUCKET} int")
        return T.StructType([*data, *named.fields[: len(self.directories)]])


def directory_of(table: SilverTable) -> Column:
    """A row's directory as text: the values of its directory columns."""
    return F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in table.directories])


def directory_value(name: str) -> str:
    """The same from the name of a directory, as a table has it on disk."""
    values = [unquote(part.split("=", 1)[1]) for part in name.split("/")]
    return "/".join("" if v == _NO_VALUE else v for v in values)


@dataclass(frozen=True)
class Commit:
    """What replaces which directories: ``staged`` holds the new ones, ``emptied`` names those that go."""

    id: str
    schema: T.StructType
    emptied: list[str] = field(default_factory=list)

    def staged(self, table: SilverTable) -> str:
        return f"{table.path}/{_STAGED}{self.id}"

    def text(self) -> str:
        return json.dumps({"id": self.id, "schema": self.schema.jsonValue(), "emptied": self.emptied})

    @staticmethod
    def parse(text: str) -> Commit | None:
        if not text:
            return None
        said = json.loads(text)
        return Commit(said["id"], T.StructType.fromJson(said["schema"]), said.get("emptied", []))


def table_directories(spark: SparkSession, root: str, table: SilverTable) -> list[str]:
    """Directories with rows below ``root``, as relative paths."""
    return matching(spark, root, *[f"{c}=*" for c in table.directories])


def recorded_schema(spark: SparkSession, table: SilverTable) -> T.StructType | None:
    """The columns of the table as its record has them; None for a table without one."""
    commit = Commit.parse(read_note(spark, table.note)) or Commit.parse(read_note(spark, table.record))
    return commit.schema if commit else None


def read_silver(spark: SparkSession, table: SilverTable, merge_schema: bool = True) -> DataFrame:
    """The current snapshot, read from the table root so that the partition column is there.

    Columns come from the table's record, and no file is opened to find them. A table without a
    record (written by other means) is read by its files; there ``merge_schema`` unites the columns
    of all of them, which reads every footer. Directory values are read as the table's own type
    (``007`` stays text) and an empty text value, which Spark stores as the default directory,
    comes back as ``''``. A filter on the partition column still prunes directories.

    A commit that is under way or was cut off reads as done: its staged directories are read in
    place of those they replace. If the table changes while it is listed, it is listed again, so that the
    snapshot is one commit's. A snapshot does not keep its files: evaluating it after another commit
    replaced some of them fails, rather than mixing old rows and new.
    """
    return read_placed(spark, table, merge_schema).drop(BUCKET)


def read_placed(spark: SparkSession, table: SilverTable, merge_schema: bool = True) -> DataFrame:
    """The snapshot with all directory columns."""
    for _ in range(LOOKS):
        note, record = read_note(spark, table.note), read_note(spark, table.record)
        df = _snapshot(spark, table, Commit.parse(note), Commit.parse(record), merge_schema)
        if (note, record) == (read_note(spark, table.note), read_note(spark, table.record)):
            break
    else:
        raise RuntimeError(f"{table.path} keeps changing while it is listed")
    if table.partition_type == "string":
        df = df.withColumn(table.partition, F.coalesce(table.partition, F.lit("")))
    return df


def _snapshot(
    spark: SparkSession, table: SilverTable, pending: Commit | None, last: Commit | None, merge_schema: bool
) -> DataFrame:
    commit = pending or last
    if commit is None:
        return _scan(spark, table, _schema_of_files(spark, table, merge_schema), table.path)
    df = _scan(spark, table, commit.schema, table.path)
    if pending is None:
        return df
    staged = table_directories(spark, pending.staged(table), table)
    replaced = [directory_value(d) for d in [*staged, *pending.emptied]]
    if replaced:
        df = df.where(~directory_of(table).isin(replaced))
    if staged:
        df = df.unionByName(_scan(spark, table, commit.schema, pending.staged(table)))
    return df


def _scan(spark: SparkSession, table: SilverTable, schema: T.StructType, path: str) -> DataFrame:
    return spark.read.schema(table.ordered(schema)).parquet(path)


def _schema_of_files(spark: SparkSession, table: SilverTable, merge_schema: bool) -> T.StructType:
    return spark.read.option("mergeSchema", merge_schema).parquet(table.path).schema


def read_placed_if_any(
    spark: SparkSession, table: SilverTable, merge_schema: bool = True
) -> DataFrame | None:
    """The snapshot with all directory columns, or None before the first load."""
    try:
        return read_placed(spark, table, merge_schema)
    except AnalysisException as error:
        if error.getCondition() in _ABSENT:
            return None
        raise


def _write(df: DataFrame, table: SilverTable, path: str) -> None:
    """Into a folder that nobody reads until it is whole, so that tasks may move their own files there."""
    by_tasks = df.write.option("mapreduce.fileoutputcommitter.algorithm.version", 2)
    by_tasks.partitionBy(*table.directories).parquet(path)


def stage(df: DataFrame, table: SilverTable, schema: T.StructType) -> Commit:
    """Write placed rows in directory layout, where no scan of the table sees them."""
    commit = Commit(uuid.uuid4().hex, schema)
    _write(df, table, commit.staged(table))
    return commit


def create(df: DataFrame, table: SilverTable, schema: T.StructType) -> None:
    """The first rows of a table that is not there: written beside it, and the whole folder moved."""
    spark = df.sparkSession
    parent, name = table.path.rstrip("/").rsplit("/", 1)
    for left in matching(spark, parent, f"{_STAGED}{name}-*"):
        delete(spark, f"{parent}/{left}")
    commit = Commit(uuid.uuid4().hex, schema)
    beside = f"{parent}/{_STAGED}{name}-{commit.id}"
    _write(df, table, beside)
    write_note(spark, f"{beside}/_schema", commit.text())
    if not move_folder(spark, beside, table.path):
        raise OSError(f"{table.path} is there, but holds no table")


def apply(spark: SparkSession, table: SilverTable, commit: Commit) -> None:
    """Carry out a commit whose note is written. Doing it again, from any point, ends the same."""
    staged = commit.staged(table)
    replace_folders(spark, staged, table.path, table_directories(spark, staged, table))
    for name in commit.emptied:
        delete(spark, f"{table.path}/{name}")
    write_note(spark, table.record, commit.text())
    delete(spark, table.note)
    delete(spark, staged)


def finish(spark: SparkSession, table: SilverTable) -> None:
    """Carry on a commit that was cut off, and drop rows staged for one that never came to be."""
    commit = Commit.parse(read_note(spark, table.note))
    if commit is not None:
        apply(spark, table, commit)
    for name in matching(spark, table.path, f"{_STAGED}*"):
        delete(spark, f"{table.path}/{name}")
