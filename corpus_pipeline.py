"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import jaccard_join, langid, mixing, packing, pii
from shelfwise.llm.bit_filter import maybe_in
from shelfwise.llm.queries import byte_bpe
from shelfwise.sources.scratch import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near copies share at least four fifths of their shingles of five words.
NEAR = jaccard_join.JaccardParams(words=5, percent=80)
#: Texts that a task hands to Python at once, by rows and by bytes (a text is never cut). Spark's usual
#: 10,000 rows are some 35 MB of text, which the executor and its Python workers hold several times over.
BATCH_ROWS = 500
BATCH_BYTES = 1 << 21
#: The mix that files and rows follow, and region after region the sequences.
MIX = mixing.MixParams()


def _small_batches(spark: SparkSession) -> None:
    """For the session, since a stage's rows are worked out when they are written."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language the model knows with a probability of at least a half."""
    _small_batches(spark)
    model = langid.train(docs)
    return langid.confident(langid.predict(docs, model)).select(*docs.columns)


def _parted(rows: DataFrame, ids: DataFrame, most: int = 250_000) -> tuple[DataFrame, DataFrame]:
    """The rows with one of the distinct ``ids``, and all others.

    A few ids are broadcast; beside more, rows that surely have none of them are not shuffled.
    """
    ids, others = ids.withColumnRenamed("doc_id", "its_id"), None
    if ids.count() <= most:
        ids = F.broadcast(ids)
    else:
        on, keys_on = ([F.col(c).cast("long")] for c in ("doc_id", "its_id"))
        rows, others = maybe_in(rows, on, ids, keys_on, most)
    same = rows["doc_id"].eqNullSafe(ids["its_id"])
    without = rows.join(ids, same, "left_anti")
    return rows.join(ids, same, "left_semi"), without if others is None else others.unionByName(without)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; of repeated rows one."""
    _small_batches(spark)
    found = jaccard_join.near_duplicates(docs, NEAR)
    copies = found.filter("doc_id != component_id").select("doc_id").distinct()
    _, left = _parted(docs, materialise(copies, "copies"))
    repeated = docs.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    more, once = _parted(left, materialise(repeated, "repeated"))
    return once.unionByName(more.dropDuplicates()).select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, with personal data in ``text`` replaced by its kind and ``n_chars`` following."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, in files and rows that follow the mix of the sources."""
    return mixing.in_mix_order(docs, MIX)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its sequence and its offset there; sequences follow the
    regions of the mix. A row's region depends on the rows alone, so it needs no column."""
    _small_batches(spark)
    # A worker also holds what earlier stages left in it, beside an executor that has touched all its heap.
    tokenizer = replace(byte_bpe(), cached_words=200_000, slice_bytes=1 << 19)
    return packing.pack_regions(mixing.in_regions(docs, MIX), tokenizer)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("jaccard_join", one_of_each_group),
    ("pii", without_personal_data),
    ("mixing", mixed),
    ("packing", packed),
]
#: Training a model cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
