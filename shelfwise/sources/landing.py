"""Landing CSV, bronze Parquet, quarantine JSON and report CSV files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.sources.files import first_lines


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_landing(
    spark: SparkSession,
    path: str | list[str],
    infer: bool = False,
    declared: tuple[str, ...] = (),
) -> DataFrame:
    """Header-bearing CSV, every column as text unless ``infer``: a file, folder or pattern, or named files.

    Text keeps the raw value (``007`` stays ``007``) and spares the type-inference pass over the
    file; extra columns are carried along. Columns are named by the header of their own file: CSV rows
    are read by position, so files are grouped by header and the groups united by name. A column that
    a file does not have is NULL there, as are ``declared`` columns that no file has. A column that is
    inferred differently in two groups stays text.
    """
    groups: dict[str, list[str]] = {}
    files = landing_files(spark, path) if isinstance(path, str) else path
    for file, line in zip(files, first_lines(spark, files), strict=True):
        if line.strip("\ufeff \t"):
            groups.setdefault(line, []).append(file)
    one = len(groups) == 1
    # A folder of one header is read as one, however many files it has.
    whole = path if one and isinstance(path, str) else None
    parts = [_one_header(spark, group, whole, infer) for group in groups.values()]
    if not parts:
        return spark.createDataFrame([], text_schema(declared))
    kinds: dict[str, set[str]] = {}
    for f in (f for part in parts for f in part.schema.fields):
        kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    as_text = [c for c, found in kinds.items() if len(found) > 1]
    rows = parts[0].withColumns({c: F.col(c).cast("string") for c in as_text if c in parts[0].columns})
    for part in parts[1:]:
        part = part.withColumns({c: F.col(c).cast("string") for c in as_text if c in part.columns})
        rows = rows.unionByName(part, allowMissingColumns=True)
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in declared if c not in rows.columns})
    # In an order that does not depend on which file comes first.
    extra = [c for c in rows.columns if c not in declared]
    return rows.select(*declared, *(extra if one else sorted(extra)))


def landing_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files below ``path``; their content is not read."""
    listed = spark.read.format("binaryFile").load(path).select("path")
    return sorted({row["path"] for row in listed.collect()})


def _one_header(spark: SparkSession, files: list[str], whole: str | None, infer: bool) -> DataFrame:
    """Files with one and the same header; ``whole`` names all of them at once."""
    exact = [re.sub(r"([\\{}\[\]*?])", r"\\\1", f) for f in files]  # names, not patterns
    rows = spark.read.csv(exact if infer else exact[:1], header=True, inferSchema=infer)
    return spark.read.schema(rows.schema).csv(whole or exact, header=True, enforceSchema=False)


def write_landing(df: DataFrame, path: str) -> None:
    """Write text columns as landing CSV, keeping leading and trailing spaces."""
    df.write.mode("overwrite").csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def write_bronze(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_quarantine(records: DataFrame, base: str, dataset_name: str, batch_id: str) -> None:
    """Write one batch's audit rows; a rerun of the batch replaces them instead of adding."""
    path = f"{base}/{dataset_name}/batch_id={batch_id}"
    records.write.mode("overwrite").json(path)


def read_quarantine(spark: SparkSession, base: str, dataset_name: str) -> DataFrame:
    schema = "dataset_name string, original_record string, dq_failure_reason string, batch_id string"
    return spark.read.schema(schema).json(f"{base}/{dataset_name}")


def write_report(df: DataFrame, path: str) -> None:
    """CSV with a header in every part file; parts are written in parallel."""
    df.write.mode("overwrite").csv(path, header=True)


def read_report(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a written report; a quoted empty field is ``''`` and an unquoted one NULL, as written."""
    return spark.read.csv(path, header=True, schema=schema, nullValue="\u0000")


def read_duplicates(spark: SparkSession, base: str, dataset_name: str) -> DataFrame:
    """Audit of the rows that lost to another one of their key."""
    schema = "dataset_name string, original_record string, dq_failure_reason string, n_copies long, batch_id string"
    return spark.read.schema(schema).json(f"{base}/{dataset_name}")
