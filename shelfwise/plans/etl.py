"""One dataset load: landing to bronze to silver, with rejected rows in quarantine."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.quality import (
    REASON,
    UNDECIDED,
    accepted,
    duplicate_records,
    quarantine_records,
    tag_first_failure,
)
from shelfwise.operators.upsert import upsert
from shelfwise.plans.specs import DatasetSpec, clean, dedupe, lost_to_duplicates
from shelfwise.sources.landing import (
    read_bronze,
    read_landing,
    write_bronze,
    write_quarantine,
)
from shelfwise.sources.scratch import freed_scratch, materialise
from shelfwise.sources.silver import SilverTable


@dataclass(frozen=True)
class Lake:
    """Folders of one lake under a shared root.

    ``buckets`` and ``scopes`` by dataset and ``sequence`` are those of ``SilverTable``.
    """

    root: str
    buckets: dict[str, int] = field(default_factory=dict)
    scopes: dict[str, str] = field(default_factory=dict)
    sequence: str | None = None

    def bronze(self, spec: DatasetSpec) -> str:
        return f"{self.root}/bronze/{spec.name}"

    def silver(self, spec: DatasetSpec) -> SilverTable:
        return spec.table(
            f"{self.root}/silver/{spec.name}",
            self.buckets.get(spec.name, 1),
            self.scopes.get(spec.name, "partition"),
            self.sequence,
        )

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def duplicates(self) -> str:
        return f"{self.root}/duplicates"

    @property
    def report(self) -> str:
        return f"{self.root}/gold/report"


@dataclass(frozen=True)
class LoadOptions:
    """Choices of a load.

    ``as_of`` and ``stamp`` fix today's date and the processing time (both the clock's by
    default). ``dedupe_after_rules`` lets a bad duplicate no longer displace a good one.
    ``evolve=False`` says that the table's columns never change; ``infer`` lets the landing CSV's
    types be inferred. ``audit_duplicates`` writes the rows that lost to a duplicate, too. ``sequence`` is
    the number of the batch, for a lake whose tables keep it.
    """

    as_of: str | None = None
    stamp: str | None = None
    null_policy: str = "reject"
    blank_is_null: bool = False
    dedupe_after_rules: bool = False
    evolve: bool = True
    infer: bool = False
    audit_duplicates: bool = False
    sequence: int | None = None


@dataclass(frozen=True)
class LoadCounts:
    """Rows of one load: every row read is a duplicate, rejected, undecided or accepted.

    ``merged`` are the row keys among the accepted ones that went into the silver table.
    """

    read: int
    duplicates: int
    rejected: int
    undecided: int
    accepted: int
    merged: int

    def __post_init__(self):
        if self.read != self.duplicates + self.rejected + self.undecided + self.accepted:
            raise ValueError(f"a load lost track of rows: {self}")


DEFAULTS = LoadOptions()


def tag_rows(
    raw: DataFrame, spec: DatasetSpec, options: LoadOptions = DEFAULTS, read: Observation | None = None
) -> DataFrame:
    """Cleaned rows with the first failed rule of each; one scan, at most one shuffle."""
    rows = clean(raw, spec, options.blank_is_null)
    if read is not None:
        rows = rows.observe(read, F.count("*").alias("n"))
    if not options.dedupe_after_rules:
        rows = dedupe(rows, spec)
    return tag_first_failure(rows, spec.rules, options.as_of, options.null_policy)


def accepted_rows(tagged: DataFrame, spec: DatasetSpec, options: LoadOptions = DEFAULTS) -> DataFrame:
    rows = accepted(tagged)
    return dedupe(rows, spec) if options.dedupe_after_rules else rows


def _pin_today(spark: SparkSession, options: LoadOptions) -> LoadOptions:
    """Today's date, read once, so that a load that runs past midnight keeps to one date."""
    if options.as_of is not None:
        return options
    today = spark.range(1).select(F.current_date().cast("string")).first()[0]
    return replace(options, as_of=today)


def _seen(observation: Observation) -> dict[str, int]:
    """Counts that came with a write."""
    return {k: v or 0 for k, v in observation.get.items()}


def load_batch(
    raw: DataFrame, spec: DatasetSpec, lake: Lake, batch_id: str, options: LoadOptions = DEFAULTS
) -> LoadCounts:
    """Clean, check and upsert one batch of written raw rows. Repeating a batch id is safe.

    Where duplicates are resolved, the tagged rows are written once and read by both outputs, so
    that shuffle runs once and both see the same choice. Otherwise tagging is a scan without a
    shuffle, and repeating it costs less than writing all rows. The counts are taken while the rows are
    written anyway.
    """
    options = _pin_today(raw.sparkSession, options)
    read, tags, kept = (Observation() for _ in range(3))
    with freed_scratch(raw.sparkSession):
        tagged = tag_rows(raw, spec, options, read)
        tagged = tagged.observe(
            tags,
            F.count("*").alias("n"),
            F.count_if(F.col(REASON).isNull()).alias("accepted"),
            F.count_if(F.col(REASON) == UNDECIDED).alias("undecided"),
        )
        if spec.dedupe_keys and not options.dedupe_after_rules:
            tagged = materialise(tagged, f"tagged-{spec.name}")
        write_quarantine(quarantine_records(tagged, spec.name), lake.quarantine, spec.name, batch_id)
        tests = _seen(tags)
        rows = accepted_rows(tagged, spec, options)
        if options.dedupe_after_rules:
            rows = rows.observe(kept, F.count("*").alias("n"))
        if options.audit_duplicates:
            _write_duplicates(raw, tagged, spec, lake, batch_id, options)
        if spec.stamp is not None:
            given = F.lit(options.stamp).cast("timestamp")
            now = F.current_timestamp() if options.stamp is None else given
            rows = rows.withColumn(spec.stamp, now)
        unique = spec.unique_after_dedupe and not options.dedupe_after_rules
        merged = upsert(rows, lake.silver(spec), unique, options.evolve, options.sequence)
        accepted_n = _seen(kept)["n"] if options.dedupe_after_rules else tests["accepted"]
        n_read = _seen(read)["n"]
        return LoadCounts(
            read=n_read,
            duplicates=n_read - tests["n"] + tests["accepted"] - accepted_n,
            rejected=tests["n"] - tests["accepted"] - tests["undecided"],
            undecided=tests["undecided"],
            accepted=accepted_n,
            merged=merged,
        )


def _write_duplicates(
    raw: DataFrame, tagged: DataFrame, spec: DatasetSpec, lake: Lake, batch_id: str, options: LoadOptions
) -> None:
    """Audit of the rows that lost to another one of their key; a rerun replaces it."""
    rows = accepted(tagged) if options.dedupe_after_rules else clean(raw, spec, options.blank_is_null)
    lost = lost_to_duplicates(rows, spec)
    if lost is not None:
        write_quarantine(duplicate_records(lost, spec.name), lake.duplicates, spec.name, batch_id)


def load_landing(
    spark: SparkSession,
    landing_path: str,
    spec: DatasetSpec,
    lake: Lake,
    batch_id: str,
    options: LoadOptions = DEFAULTS,
) -> LoadCounts:
    """Landing CSV to bronze (overwritten each run), then bronze to silver and quarantine."""
    rows = read_landing(spark, landing_path, options.infer, spec.columns)
    write_bronze(rows, lake.bronze(spec))
    return load_batch(read_bronze(spark, lake.bronze(spec)), spec, lake, batch_id, options)
