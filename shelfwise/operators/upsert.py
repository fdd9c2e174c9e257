"""Keyed upsert into a partitioned silver table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.dedupe import latest_per_key
from shelfwise.sources.files import write_note
from shelfwise.sources.scratch import freed_scratch, materialise
from shelfwise.sources.silver import (
    SilverTable,
    apply,
    create,
    directory_of,
    directory_value,
    finish,
    read_placed_if_any,
    stage,
    table_directories,
)

# A directory with more rows is split over several files.
ROWS_PER_FILE = 1_000_000
_SIDE, _STORED, _INCOMING = "__side", 0, 1
_FILE = "__file"


def both_sides(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows of both sides in one frame, each marked with its side."""
    marked = [df.withColumn(_SIDE, F.lit(side)) for side, df in ((_STORED, stored), (_INCOMING, incoming))]
    return marked[0].unionByName(marked[1], allowMissingColumns=True)


def merge_rows(rows: DataFrame, table: SilverTable, together: Sequence[str] = ()) -> DataFrame:
    """Of ``both_sides`` one row per row key; at equal ordering the later batch wins, or the incoming row.

    Both sides must be unique on the row key, so no key is hot. A row stays if no row of the other side
    comes before it: all rows meet in one sort by key. ``together`` are columns that follow from the row key
    and by which ``rows`` are shuffled already; then they are not shuffled again.
    """
    key = table.row_key
    order = [c for c in (table.ordering, table.sequence) if c is not None and c not in key]
    latest_first = [*[F.col(c).desc_nulls_last() for c in order], F.col(_SIDE).desc()]
    window = Window.partitionBy(*dict.fromkeys([*together, *key])).orderBy(*latest_first)
    until_here = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    alone = F.min(_SIDE).over(until_here) == F.max(_SIDE).over(until_here)
    return rows.withColumn("__alone", alone).where("__alone").drop("__alone", _SIDE)


def upsert(
    batch: DataFrame,
    table: SilverTable,
    unique: bool = False,
    merge_schema: bool = True,
    sequence: int | None = None,
) -> int:
    """Merge ``batch`` into ``table``, rewriting only the directories it touches.

    ``unique=True`` says that the batch comes from a written table and has one row per row key
    already. Columns only one side has are filled with NULL on the other; a column must keep
    its type. Columns are known from the table's record, and only files of touched directories are
    opened; ``merge_schema`` matters for a table without a record. ``sequence`` is the number of the batch, for
    tables that keep it. Repeating a batch changes nothing. One writer at a time.

    The merged rows are written once, staged in directory layout beside the table's directories, and
    noted in the table; then directories are replaced by moving. If that is cut off, readers see the
    new rows all the same, and the next upsert first finishes it. Returns the number of row keys that the
    batch brought.
    """
    spark = batch.sparkSession
    if (table.sequence is None) != (sequence is None):
        raise ValueError("a batch has a sequence number if and only if the table keeps it")
    if table.sequence is not None:
        batch = batch.withColumn(table.sequence, F.lit(sequence).cast("long"))
    finish(spark, table)
    batch = table.place(batch)
    with freed_scratch(spark):
        if not unique:
            batch = materialise(latest_per_key(batch, table.row_key, table.ordering), "upsert-batch")
        stored = read_placed_if_any(spark, table, merge_schema)
        schema = table.ordered(batch.schema if stored is None else united(stored.schema, batch.schema))
        sizes = _sizes(batch, table)
        brought = sum(sizes.values())
        if stored is None:
            create(gather(batch, table, sizes), table, schema)
            return brought
        touched = list(dict.fromkeys([*sizes, *_old_places(stored, batch, table)]))
        old = touched_rows(stored, touched, table)
        for name, n in _sizes(old, table).items():
            sizes[name] = sizes.get(name, 0) + n
        rows = both_sides(old, batch)
        if table.scope == "global":
            # A key may come from one directory and go to another.
            merged = gather(merge_rows(rows, table), table, sizes)
        else:
            gathered, together = _gathered(rows, table, sizes)
            merged = merge_rows(gathered, table, together).drop(_FILE)
        commit = stage(merged, table, schema)
        if table.scope == "global":
            commit = replace(commit, emptied=_emptied(spark, table, commit.staged(table), touched))
        write_note(spark, table.note, commit.text())
        apply(spark, table, commit)
        return brought


def united(stored: T.StructType, batch: T.StructType) -> T.StructType:
    """Columns of both; one that both have must have the same type."""
    types = {f.name: f.dataType for f in stored.fields}
    for f in batch.fields:
        if f.name in types and types[f.name].simpleString() != f.dataType.simpleString():
            raise ValueError(
                f"column {f.name} is {types[f.name].simpleString()} in the table "
                f"and {f.dataType.simpleString()} in the batch"
            )
    return T.StructType([*stored.fields, *[f for f in batch.fields if f.name not in types]])


def _sizes(rows: DataFrame, table: SilverTable) -> dict[str, int]:
    """Rows of each directory, from the directory columns alone.

    Names of directories, not rows, come to the driver, where the file index holds those of the
    whole table anyway.
    """
    counts = rows.groupBy(directory_of(table).alias("name")).agg(F.count("*").alias("n"))
    return {row["name"]: row["n"] for row in counts.collect()}


def _old_places(stored: DataFrame, batch: DataFrame, table: SilverTable) -> list[str]:
    """Directories in which keys of the batch stand already, wherever the batch puts them.

    For keys that are unique in the whole table: a scan of its keys and nothing else.
    """
    if table.scope != "global":
        return []
    keys = batch.select(*[F.col(c).alias(f"__{c}") for c in table.keys])
    same = F.lit(True)
    for c in table.keys:
        same = same & stored[c].eqNullSafe(keys[f"__{c}"])
    hits = stored.join(keys, same, "left_semi").select(directory_of(table)).distinct()
    return [row[0] for row in hits.collect()]


def _emptied(spark: SparkSession, table: SilverTable, staged: str, touched: list[str]) -> list[str]:
    """Touched directories of the table that no row is left for."""
    left = set(table_directories(spark, staged, table))
    gone = set(touched)
    return [d for d in table_directories(spark, table.path, table) if d not in left and directory_value(d) in gone]


def touched_rows(stored: DataFrame, touched: list[str], table: SilverTable) -> DataFrame:
    """Stored rows of the directories the batch writes to.

    Naming the directories to the scan makes partition pruning certain.
    """
    return stored.where(directory_of(table).isin(touched))


def gather(rows: DataFrame, table: SilverTable, sizes: dict[str, int]) -> DataFrame:
    """Bring each directory's rows together for writing, so that no task writes into all of them.

    ``sizes`` are upper bounds of the rows of each directory. One gets a file for each ``ROWS_PER_FILE``
    of them, and a row its file by the hash of its key, of which no other row in the directory has
    the same: a directory that holds much of the data is spread over many tasks.
    """
    return _gathered(rows, table, sizes)[0].drop(_FILE)


def _gathered(rows: DataFrame, table: SilverTable, sizes: dict[str, int]) -> tuple[DataFrame, list[str]]:
    """The rows so gathered, and the columns by which: directory columns and maybe the number of the file."""
    if not sizes:
        return rows, []
    files = {name: -(-n // ROWS_PER_FILE) for name, n in sizes.items()}
    by_rows = -(-2 * sum(sizes.values()) // ROWS_PER_FILE)
    by_cores = 2 * rows.sparkSession.sparkContext.defaultParallelism
    n_tasks = min(sum(files.values()), max(by_rows, by_cores))
    large = [(name, n) for name, n in files.items() if n > 1]
    together = list(table.directories)
    if large:
        several = rows.sparkSession.createDataFrame(large, "__name string, __files int")
        # As long as a list the driver holds. Without its size Spark would shuffle all rows by directory.
        placed = rows.join(F.broadcast(several), directory_of(table) == several["__name"], "left")
        file = F.pmod(F.xxhash64(*table.row_key), F.coalesce("__files", F.lit(1)))
        rows = placed.withColumn(_FILE, file).select(*rows.columns, _FILE)
        together.append(_FILE)
    return rows.repartition(n_tasks, *together), together
