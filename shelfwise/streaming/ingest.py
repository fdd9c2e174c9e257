"""Incremental loads: each landing file once, through the same steps as a batch load."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.operators.quality import REASON
from shelfwise.plans.etl import DEFAULTS, Lake, LoadCounts, LoadOptions, load_batch
from shelfwise.plans.specs import DatasetSpec
from shelfwise.sources.landing import read_bronze, read_landing, write_bronze, write_quarantine
from shelfwise.streaming.messages import read_messages, read_records, readable

#: Reason of a message that is not one JSON object.
UNREADABLE = "unreadable_message"
_FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest_landing(
    spark: SparkSession,
    landing_dir: str,
    spec: DatasetSpec,
    lake: Lake,
    checkpoint: str,
    options: LoadOptions = DEFAULTS,
    files_per_batch: int | None = None,
    archive_dir: str | None = None,
    run: str = "stream",
    on_loaded: Callable[[str, LoadCounts], None] | None = None,
) -> StreamingQuery:
    """Load all files that have arrived, then end; the checkpoint remembers them.

    The stream is one of files, and each batch reads its own by their headers, as a batch load does:
    files of one folder may have different ones.

    A replayed batch overwrites its own bronze and quarantine folders and repeats its upsert, so a
    failure between the writes and the commit of the batch leaves the same result. Batches are
    numbered by the checkpoint: a new checkpoint needs a new ``run`` name, or its first batches
    would take the folders of the old ones. In a lake that keeps batch numbers, that of the stream counts
    from ``options.sequence``. ``on_loaded`` is told the counts of each batch.
    """

    def load(files: DataFrame, epoch: int) -> None:
        session = files.sparkSession
        # A file can be listed twice in a batch.
        paths = sorted({row["path"] for row in files.collect()})
        if paths:
            rows = read_landing(session, paths, options.infer, spec.columns)
            _load(rows, epoch, spec, lake, options, run, on_loaded)

    reader = spark.readStream.format("binaryFile").schema(_FILES)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    # Without its content a file is listed, not read.
    stream = reader.load(landing_dir).select("path")
    return _started(stream, load, checkpoint)


def ingest_messages(
    spark: SparkSession,
    source: str,
    source_options: dict[str, str],
    spec: DatasetSpec,
    lake: Lake,
    checkpoint: str,
    options: LoadOptions = DEFAULTS,
    run: str = "messages",
    on_loaded: Callable[[str, LoadCounts], None] | None = None,
) -> StreamingQuery:
    """Load all messages that have arrived at a source (``kafka`` or a file format), then end.

    A message is one JSON object of texts, as ``to_messages`` makes them. One that cannot be read
    so goes to quarantine as it came. The others are loaded as landing rows are, under the
    same promises as ``ingest_landing``.
    """

    def load(messages: DataFrame, epoch: int) -> None:
        # Both outputs read the written records, so that a source is asked for them once and each is
        # parsed once.
        bronze = f"{lake.bronze(spec)}/messages/batch_id={_batch_id(run, epoch)}"
        write_bronze(read_records(messages, spec), bronze)
        rows, broken = readable(read_bronze(messages.sparkSession, bronze))
        broken = broken.select(
            F.lit(spec.name).alias("dataset_name"), F.col("value").alias("original_record"), F.lit(UNREADABLE).alias(REASON)
        )
        write_quarantine(broken, lake.quarantine, spec.name, f"{_batch_id(run, epoch)}-unreadable")
        _load(rows, epoch, spec, lake, options, run, on_loaded)

    return _started(read_messages(spark, source, source_options), load, checkpoint)


def _batch_id(run: str, epoch: int) -> str:
    return f"{run}-{epoch:010d}"


def _load(rows: DataFrame, epoch: int, spec: DatasetSpec, lake: Lake, options: LoadOptions, run: str, on_loaded) -> None:
    batch_id = _batch_id(run, epoch)
    bronze = f"{lake.bronze(spec)}/batch_id={batch_id}"
    write_bronze(rows, bronze)
    if lake.sequence is not None:
        options = replace(options, sequence=(options.sequence or 0) + epoch)
    counts = load_batch(read_bronze(rows.sparkSession, bronze), spec, lake, batch_id, options)
    if on_loaded is not None:
        on_loaded(batch_id, counts)


def _started(stream: DataFrame, load, checkpoint: str) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
