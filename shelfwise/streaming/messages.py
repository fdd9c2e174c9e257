"""Landing rows as a stream of JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.plans.specs import DatasetSpec
from shelfwise.sources.landing import text_schema


def read_landing_stream(
    spark: SparkSession,
    landing_dir: str,
    spec: DatasetSpec,
    files_per_batch: int | None = None,
    archive_dir: str | None = None,
    doubled_quotes: bool = False,
) -> DataFrame:
    """CSV files as they arrive in ``landing_dir``, all columns as text.

    A quote inside a quoted field is written ``\\"`` as in Spark's own CSV, or ``""`` with
    ``doubled_quotes``.

    Columns are named by the header of a file that is there already, or by the declaration if
    there is none; a later file with another header fails the query instead of filling the wrong
    columns. With ``archive_dir`` a file is moved there once a later batch has been committed.
    """
    present = spark.read.option("ignoreMissingFiles", True).csv(landing_dir, header=True).columns
    schema = text_schema(present or spec.columns)
    reader = spark.readStream.schema(schema).options(header=True, enforceSchema=False)
    if doubled_quotes:
        reader = reader.option("escape", '"')
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.csv(landing_dir)


def to_messages(rows: DataFrame) -> DataFrame:
    """One JSON object per row in ``value``; every field is text, a missing one is ``""``."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns]
    return rows.select(F.to_json(F.struct(*fields)).alias("value"))


def from_messages(messages: DataFrame, spec: DatasetSpec) -> DataFrame:
    record = F.from_json("value", text_schema(spec.columns)).alias("record")
    return messages.select(record).select("record.*")


def read_messages(spark: SparkSession, source: str, options: dict[str, str]) -> DataFrame:
    """The texts that arrive at a source, as ``value``: ``kafka``, or ``text`` files of one message a line."""
    return spark.readStream.format(source).options(**options).load().select(F.col("value").cast("string"))


def read_records(messages: DataFrame, spec: DatasetSpec) -> DataFrame:
    """(value, readable, record): each message is parsed once; ``record`` is NULL where it is not one JSON object.

    Field ``""`` is a missing value, as in landing files. A declared field that a message does not
    have is NULL; fields that are not declared are left out. A value that is not a text keeps its JSON.
    """
    broken = "__broken"
    schema = text_schema([*spec.columns, broken])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    parsed = messages.select("value", F.from_json("value", schema, options).alias("record"))
    fine = F.col("record").isNotNull() & F.col(f"record.{broken}").isNull() & F.col("value").rlike(r"^\s*\{")
    fields = [F.nullif(F.col(f"record.{c}"), F.lit("")).alias(c) for c in spec.columns]
    parsed = parsed.select("value", F.coalesce(fine, F.lit(False)).alias("readable"), F.struct(*fields).alias("record"))
    return parsed.withColumn("record", F.when(F.col("readable"), F.col("record")))


def readable(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(landing rows, messages that are not one JSON object) of written ``read_records``."""
    return records.where("readable").select("record.*"), records.where("NOT readable").select("value")


def publish(
    messages: DataFrame, checkpoint: str, sink: str, options: dict[str, str]
) -> StreamingQuery:
    """Send messages to ``sink``: ``kafka`` (its connector is not part of Spark) or a file format.

    Everything that has arrived is sent, then the query ends.
    """
    writer = messages.writeStream.format(sink).options(**options)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
