"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import dedupe, forecast, gap, quality, ranking
from shelfwise.operators.upsert import upsert
from shelfwise.plans import etl, gold
from shelfwise.plans.specs import (
    ALL_SPECS,
    COMPANY_SALES,
    COMPETITOR_SALES,
    SELLER_CATALOG,
    DatasetSpec,
    clean,
)
from shelfwise.sources import driver_views as views
from shelfwise.sources import landing
from shelfwise.sources.scratch import materialise, scratch_path
from shelfwise.sources.silver import SilverTable, read_silver
from shelfwise.streaming.ingest import UNREADABLE, ingest_landing, ingest_messages
from shelfwise.streaming.messages import from_messages, publish, read_landing_stream, to_messages

AS_OF = "2001-01-01"
OPTIONS = etl.LoadOptions(as_of=AS_OF)
DROP_NULLS = etl.LoadOptions(as_of=AS_OF, null_policy="drop")
LANDING_FILES = 4
# More files where one would hold more lines.
LINES_PER_FILE = 1_000_000
# Messages that no landing row was sent as.
BROKEN_MESSAGES = ("not json", '{"seller_id": "S1"', "[1, 2]")

Query = Callable[[SparkSession, str], DataFrame]

_DIRTY = {
    SELLER_CATALOG.name: views.dirty_catalog,
    COMPANY_SALES.name: views.dirty_company,
    COMPETITOR_SALES.name: views.dirty_competitor,
}


def _dates_as_text(df: DataFrame) -> DataFrame:
    return _as_text(df, [f.name for f in df.schema.fields if f.dataType.typeName() == "date"])


def _as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Whole numbers that may be missing, and dates, look the same in any client as text."""
    changes = {c: F.col(c).cast("string") for c in columns if c in df.columns}
    return df.withColumns(changes) if changes else df


_COUNTS = ["units_sold", "stock_qty"]
_TOTALS = ["market_units", "seller_count", "comp_units"]


def _clean(spec: DatasetSpec) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _as_text(_dates_as_text(clean(_DIRTY[spec.name](spark, sf), spec)), _COUNTS)

    return query


def _tagged(spark: SparkSession, sf: str, spec: DatasetSpec, options=OPTIONS) -> DataFrame:
    return etl.tag_rows(_DIRTY[spec.name](spark, sf), spec, options)


def _accepted(spec: DatasetSpec) -> Query:
    return lambda spark, sf: _dates_as_text(quality.accepted(_tagged(spark, sf, spec)))


def _union(parts: list[DataFrame]) -> DataFrame:
    first, *others = parts
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def _first_failures(spark: SparkSession, sf: str, options) -> DataFrame:
    return _union(
        [
            quality.rejected(_tagged(spark, sf, spec, options)).select(
                F.lit(spec.name).alias("dataset_name"),
                (F.col("seller_id") if "seller_id" in spec.columns else F.lit(None).cast("string")).alias("seller_id"),
                "item_id",
                quality.REASON,
            )
            for spec in ALL_SPECS
        ]
    )


def dq_first_failure(spark: SparkSession, sf: str) -> DataFrame:
    return _first_failures(spark, sf, OPTIONS)


def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.failure_summary(_first_failures(spark, sf, OPTIONS))


def dq_summary_null_drop(spark: SparkSession, sf: str) -> DataFrame:
    return quality.failure_summary(_first_failures(spark, sf, DROP_NULLS))


_RECORD = (
    "seller_id string, item_id string, item_name string, category string, units_sold string, "
    "revenue double, marketplace_price double, stock_qty string, sale_date string"
)


def dq_quarantine_json(spark: SparkSession, sf: str) -> DataFrame:
    """Audit files written for the three datasets, read back with the records unpacked."""
    base = scratch_path(spark, "quarantine")
    for spec in ALL_SPECS:
        records = quality.quarantine_records(_tagged(spark, sf, spec), spec.name)
        landing.write_quarantine(records, base, spec.name, "first")
    stored = _union([landing.read_quarantine(spark, base, spec.name) for spec in ALL_SPECS])
    record = F.from_json("original_record", _RECORD).alias("record")
    return stored.select("dataset_name", quality.REASON, record).select(
        "dataset_name", quality.REASON, "record.*"
    )


def dedupe_keep_one(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean(views.dirty_catalog(spark, sf), SELLER_CATALOG)
    return dedupe.keep_one(rows, ["seller_id", "item_id"])


def dedupe_company_items(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean(views.dirty_company(spark, sf), COMPANY_SALES)
    return _as_text(_dates_as_text(dedupe.keep_one(rows, ["item_id"])), _COUNTS)


def dedupe_after_rules(spark: SparkSession, sf: str) -> DataFrame:
    options = etl.LoadOptions(as_of=AS_OF, dedupe_after_rules=True)
    tagged = _tagged(spark, sf, SELLER_CATALOG, options)
    return etl.accepted_rows(tagged, SELLER_CATALOG, options)


def _listings(spark: SparkSession, sf: str) -> DataFrame:
    return gold.listing_rows(views.catalog(spark, sf))


def distinct_listings(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.distinct_rows(gold.listing_rows(views.dirty_catalog(spark, sf)))


def distinct_item_meta(spark: SparkSession, sf: str) -> DataFrame:
    return gold.item_metadata(_listings(spark, sf))


def distinct_sellers(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.distinct_rows(_listings(spark, sf), "seller_id")


def company_item_units(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.company_item_units(gold.company_rows(views.company(spark, sf)))


def market_item_totals(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.market_item_totals(gold.competitor_rows(views.competitor(spark, sf)))


def company_with_meta(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.with_metadata(company_item_units(spark, sf), distinct_item_meta(spark, sf))


def market_with_meta(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.with_metadata(market_item_totals(spark, sf), distinct_item_meta(spark, sf))


def top10_company(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.top_items(company_with_meta(spark, sf), "comp_units")


def top10_market(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.top_items(market_with_meta(spark, sf), "market_units")


def target_items(spark: SparkSession, sf: str) -> DataFrame:
    return gap.target_items(top10_company(spark, sf), top10_market(spark, sf))


def _gap_inputs(listings: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sellers, targets, listings of targets) as small written tables."""
    targets = materialise(targets, "targets")
    listed = materialise(gold.listed_targets(listings, targets), "listed-targets")
    return dedupe.distinct_rows(listed, "seller_id"), targets, listed.where("item_id IS NOT NULL")


def seller_item_matrix(spark: SparkSession, sf: str) -> DataFrame:
    sellers, targets, _ = _gap_inputs(_listings(spark, sf), target_items(spark, sf))
    return gap.seller_item_matrix(sellers, targets)


def assortment_gap(spark: SparkSession, sf: str) -> DataFrame:
    return gap.assortment_gap(*_gap_inputs(_listings(spark, sf), target_items(spark, sf)))


def gap_or_full_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """All listings under one seller, who thus lists every target: the full matrix comes back."""
    listings = _listings(spark, sf).withColumn("seller_id", F.lit("everyone"))
    return gap.gap_or_full_matrix(*_gap_inputs(listings, target_items(spark, sf)))


def _gap_with_totals(spark: SparkSession, sf: str) -> DataFrame:
    """The gap unfolded from the report's own target rows, before they meet their metadata."""
    listings = _listings(spark, sf)
    targets = gold.measured_targets(
        gold.item_metadata(listings),
        gold.company_rows(views.company(spark, sf)),
        gold.competitor_rows(views.competitor(spark, sf)),
    )
    return gap.gap_or_full_matrix(*_gap_inputs(listings, targets))


_GAP_KEY = ["seller_id", "item_id", "category"]


def gap_with_totals(spark: SparkSession, sf: str) -> DataFrame:
    rows = _gap_with_totals(spark, sf).select(*_GAP_KEY, "market_revenue", *_TOTALS)
    return _as_text(rows, _TOTALS)


def expected_units(spark: SparkSession, sf: str) -> DataFrame:
    return _gap_with_totals(spark, sf).select(*_GAP_KEY, "expected_units_sold")


def market_price(spark: SparkSession, sf: str) -> DataFrame:
    return _gap_with_totals(spark, sf).select(*_GAP_KEY, "market_price")


def expected_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return _gap_with_totals(spark, sf).select(*_GAP_KEY, "expected_revenue")


def seller_report(spark: SparkSession, sf: str) -> DataFrame:
    return gold.seller_report(
        views.catalog(spark, sf), views.company(spark, sf), views.competitor(spark, sf)
    )


def _two_names(spark: SparkSession, sf: str) -> DataFrame:
    """Listings in which marketplace lines put the item in a category of its own."""
    ledger = views.listing_batch(spark, sf, market=False)
    market = views.listing_batch(spark, sf, market=True)
    market = market.withColumn("category", F.concat(F.lit("Market "), "category"))
    rows = ledger.unionByName(market)
    return rows.select("seller_id", "item_id", F.concat(F.lit("Item "), "item_id").alias("item_name"), "category")


def meta_fanout(spark: SparkSession, sf: str) -> DataFrame:
    return gold.seller_report(
        _two_names(spark, sf), views.company(spark, sf), views.competitor(spark, sf)
    )


def one_meta_per_item(spark: SparkSession, sf: str) -> DataFrame:
    return gold.seller_report(
        _two_names(spark, sf), views.company(spark, sf), views.competitor(spark, sf), True
    )


def _listing_table(spark: SparkSession, buckets: int = 1) -> SilverTable:
    path = scratch_path(spark, "listings")
    return SilverTable(path, ("seller_id", "item_id"), "category", "listed_on", buckets=buckets)


def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    listings = _listing_table(spark)
    for market in (False, True):
        upsert(views.listing_batch(spark, sf, market), listings)
    return _dates_as_text(read_silver(spark, listings))


def upsert_evolved(spark: SparkSession, sf: str) -> DataFrame:
    """A later batch brings a new column, into a table whose partitions are split by key."""
    listings = _listing_table(spark, buckets=4)
    upsert(views.listing_batch(spark, sf, market=False), listings)
    market = views.listing_batch(spark, sf, market=True).withColumn("channel", F.lit("market"))
    upsert(market, listings)
    return _dates_as_text(read_silver(spark, listings))


def upsert_global_key(spark: SparkSession, sf: str) -> DataFrame:
    """Marketplace lines put half the items into a category of their own: the old copies leave."""
    path = scratch_path(spark, "listings")
    listings = SilverTable(path, ("seller_id", "item_id"), "category", "listed_on", scope="global")
    upsert(views.listing_batch(spark, sf, market=False), listings)
    market = views.listing_batch(spark, sf, market=True)
    moved = F.concat(F.lit("Market "), "category")
    even = F.col("item_id").cast("int") % 2 == 0
    upsert(market.withColumn("category", F.when(even, moved).otherwise(F.col("category"))), listings)
    return _dates_as_text(read_silver(spark, listings))


def upsert_replayed(spark: SparkSession, sf: str) -> DataFrame:
    """Rows are ordered by their partition alone; the first batch comes once more after the second."""
    path = scratch_path(spark, "listings")
    listings = SilverTable(path, ("seller_id", "item_id"), "category", "category", sequence="batch")
    for market, number in ((False, 1), (True, 2), (False, 1)):
        upsert(views.listing_batch(spark, sf, market), listings, sequence=number)
    return _dates_as_text(read_silver(spark, listings))


def dedupe_losers(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean(views.dirty_catalog(spark, sf), SELLER_CATALOG)
    return dedupe.losers(rows, ["seller_id", "item_id"])


def load_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    """Counts that came with the loads of all three datasets."""
    lake = etl.Lake(scratch_path(spark, "lake"))
    rows = []
    for spec in ALL_SPECS:
        n = etl.load_batch(_DIRTY[spec.name](spark, sf), spec, lake, "first", OPTIONS)
        rows.append((spec.name, n.read, n.duplicates, n.rejected, n.undecided, n.accepted, n.merged))
    counts = ("n_read", "n_duplicates", "n_rejected", "n_undecided", "n_accepted", "n_merged")
    return spark.createDataFrame(rows, "dataset_name string, " + ", ".join(f"{c} long" for c in counts))


def _mixed_landing(spark: SparkSession, sf: str, folder: str) -> None:
    """Landing files of three kinds: as declared, in another order, and with one column for another."""
    rows = views.dirty_catalog(spark, sf)
    kind = F.coalesce(F.trim("item_id").cast("int"), F.lit(0)) % 3
    columns = rows.columns
    landing.write_landing(rows.where(kind == 0), folder)
    turned = rows.where(kind == 1).select(*reversed(columns))
    other = rows.where(kind == 2).withColumn("channel", F.lit("web")).drop("stock_qty")
    for part in (turned, other):
        part.write.mode("append").csv(
            folder, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )


def landing_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """Every listing as landing CSV, its types found by Spark."""
    source = scratch_path(spark, "landing")
    landing.write_landing(_as_text(views.catalog(spark, sf), ["marketplace_price", "stock_qty"]), source)
    return landing.read_landing(spark, source, infer=True)


def silver_stamped(spark: SparkSession, sf: str) -> DataFrame:
    """When the rows of the accepted catalog were loaded."""
    lake = etl.Lake(scratch_path(spark, "lake"))
    options = replace(OPTIONS, stamp="2001-01-01 06:30:00")
    etl.load_batch(views.dirty_catalog(spark, sf), SELLER_CATALOG, lake, "first", options)
    rows = read_silver(spark, lake.silver(SELLER_CATALOG))
    return rows.select("seller_id", "item_id", F.col("ingestion_time").cast("string").alias("ingestion_time"))


def clean_every_sale(spark: SparkSession, sf: str) -> DataFrame:
    """Every line as a marketplace sale, whatever its tax."""
    return _as_text(_dates_as_text(clean(views.dirty_sales(spark, sf), COMPETITOR_SALES)), _COUNTS)


def dq_every_sale(spark: SparkSession, sf: str) -> DataFrame:
    tagged = etl.tag_rows(views.dirty_sales(spark, sf), COMPETITOR_SALES, OPTIONS)
    return _as_text(_dates_as_text(tagged), _COUNTS)


def dedupe_every_company_sale(spark: SparkSession, sf: str) -> DataFrame:
    """One sale of each item over every line."""
    rows = clean(views.dirty_sales(spark, sf).select(*COMPANY_SALES.columns), COMPANY_SALES)
    return _as_text(_dates_as_text(dedupe.keep_one(rows, ["item_id"])), _COUNTS)


def silver_every_sale(spark: SparkSession, sf: str) -> DataFrame:
    lake = etl.Lake(scratch_path(spark, "lake"))
    etl.load_batch(views.dirty_sales(spark, sf), COMPETITOR_SALES, lake, "first", OPTIONS)
    return _dates_as_text(read_silver(spark, lake.silver(COMPETITOR_SALES)))


def landing_mixed_headers(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "landing")
    _mixed_landing(spark, sf, folder)
    return landing.read_landing(spark, folder, declared=SELLER_CATALOG.columns)


def stream_mixed_headers(spark: SparkSession, sf: str) -> DataFrame:
    """The same files through the incremental load."""
    root = scratch_path(spark, "stream")
    lake = etl.Lake(f"{root}/lake")
    _mixed_landing(spark, sf, f"{root}/landing")
    ingest_landing(
        spark, f"{root}/landing", SELLER_CATALOG, lake, f"{root}/checkpoint", OPTIONS
    ).awaitTermination()
    return read_silver(spark, lake.silver(SELLER_CATALOG)).drop("ingestion_time")


def stream_messages_to_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Every listing line sent as a message, with broken messages among them, and loaded by a second stream."""
    root = scratch_path(spark, "messages")
    lake = etl.Lake(f"{root}/lake")
    landing.write_landing(views.dirty_catalog(spark, sf), f"{root}/landing")
    rows = read_landing_stream(spark, f"{root}/landing", SELLER_CATALOG)
    publish(
        to_messages(rows), f"{root}/sent", "text", {"path": f"{root}/topic"}
    ).awaitTermination()
    broken = spark.createDataFrame([(m,) for m in BROKEN_MESSAGES], "value string")
    broken.write.mode("append").text(f"{root}/other")
    for number, topic in enumerate(("topic", "other")):
        ingest_messages(
            spark, "text", {"path": f"{root}/{topic}"}, SELLER_CATALOG, lake,
            f"{root}/taken-{number}", OPTIONS, run=topic,
        ).awaitTermination()
    audit = landing.read_quarantine(spark, lake.quarantine, SELLER_CATALOG.name)
    unread = audit.where(F.col(quality.REASON) == UNREADABLE).select(
        F.lit(None).cast("string").alias("seller_id"), F.col("original_record").alias("item_id"),
        F.col(quality.REASON).alias("item_name"),
    )
    stored = read_silver(spark, lake.silver(SELLER_CATALOG)).drop("ingestion_time")
    return stored.unionByName(unread, allowMissingColumns=True)


def csv_bronze_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    source, bronze = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    landing.write_landing(views.dirty_competitor(spark, sf), source)
    landing.write_bronze(landing.read_landing(spark, source), bronze)
    return landing.read_bronze(spark, bronze)


def csv_bronze_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The same over every line, as a listing."""
    source, bronze = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    landing.write_landing(views.dirty_catalog(spark, sf), source)
    landing.write_bronze(landing.read_landing(spark, source), bronze)
    return landing.read_bronze(spark, bronze)


def _silver(spark: SparkSession, sf: str, spec: DatasetSpec) -> DataFrame:
    lake = etl.Lake(scratch_path(spark, "lake"))
    etl.load_batch(_DIRTY[spec.name](spark, sf), spec, lake, "first", OPTIONS)
    return read_silver(spark, lake.silver(spec))


def silver_snapshot_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The accepted catalog, stored by category and read from the table root."""
    return _silver(spark, sf, SELLER_CATALOG).drop("ingestion_time")


def silver_company(spark: SparkSession, sf: str) -> DataFrame:
    """Accepted company sales, stored by date."""
    return _dates_as_text(_silver(spark, sf, COMPANY_SALES))


def silver_competitor(spark: SparkSession, sf: str) -> DataFrame:
    """Accepted marketplace sales, stored by date; of a key's sales on a day the upsert keeps one."""
    return _dates_as_text(_silver(spark, sf, COMPETITOR_SALES))


def report_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "report")
    landing.write_report(seller_report(spark, sf), path)
    return landing.read_report(spark, path, forecast.REPORT_SCHEMA)


def medallion_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Landing CSV of all three datasets through bronze, silver and quarantine to the report."""
    root = scratch_path(spark, "lake")
    lake = etl.Lake(root)
    for spec in ALL_SPECS:
        source = f"{root}/landing/{spec.name}"
        landing.write_landing(_DIRTY[spec.name](spark, sf), source)
        etl.load_landing(spark, source, spec, lake, "first", OPTIONS)
    gold.publish_report(spark, lake)
    return landing.read_report(spark, lake.report, forecast.REPORT_SCHEMA)


def _messages(spec: DatasetSpec) -> Query:
    """Landing rows of a dataset sent as messages, and the messages read back."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        root = scratch_path(spark, "messages")
        landing.write_landing(_DIRTY[spec.name](spark, sf), f"{root}/landing")
        rows = read_landing_stream(spark, f"{root}/landing", spec)
        sent = publish(to_messages(rows), f"{root}/checkpoint", "text", {"path": f"{root}/topic"})
        sent.awaitTermination()
        return from_messages(spark.read.text(f"{root}/topic"), spec)

    return query


def stream_landing_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog in several files, copies of a key in one of them, loaded half of the files at a time."""
    root = scratch_path(spark, "stream")
    lake = etl.Lake(f"{root}/lake")
    rows = views.dirty_catalog(spark, sf)
    lines = views.table(spark, sf, "lineitem").count()
    per_batch = max(LANDING_FILES // 2, -(-lines // (2 * LINES_PER_FILE)))
    spread = rows.repartition(2 * per_batch, F.trim("seller_id"), F.trim("item_id"))
    landing.write_landing(spread, f"{root}/landing")
    ingest_landing(
        spark,
        f"{root}/landing",
        SELLER_CATALOG,
        lake,
        f"{root}/checkpoint",
        OPTIONS,
        files_per_batch=per_batch,
        archive_dir=f"{root}/archive",
    ).awaitTermination()
    return read_silver(spark, lake.silver(SELLER_CATALOG)).drop("ingestion_time")


QUERIES: dict[str, Query] = {
    "clean_catalog": _clean(SELLER_CATALOG),
    "clean_company": _clean(COMPANY_SALES),
    "clean_competitor": _clean(COMPETITOR_SALES),
    "dq_catalog_accepted": _accepted(SELLER_CATALOG),
    "dq_company_accepted": _accepted(COMPANY_SALES),
    "dq_competitor_accepted": _accepted(COMPETITOR_SALES),
    "dq_first_failure": dq_first_failure,
    "dq_quarantine_json": dq_quarantine_json,
    "dq_summary": dq_summary,
    "dq_summary_null_drop": dq_summary_null_drop,
    "dedupe_keep_one": dedupe_keep_one,
    "dedupe_company_items": dedupe_company_items,
    "dedupe_after_rules": dedupe_after_rules,
    "distinct_listings": distinct_listings,
    "distinct_item_meta": distinct_item_meta,
    "distinct_sellers": distinct_sellers,
    "company_item_units": company_item_units,
    "market_item_totals": market_item_totals,
    "company_with_meta": company_with_meta,
    "market_with_meta": market_with_meta,
    "top10_company": top10_company,
    "top10_market": top10_market,
    "target_items": target_items,
    "seller_item_matrix": seller_item_matrix,
    "assortment_gap": assortment_gap,
    "gap_or_full_matrix": gap_or_full_matrix,
    "gap_with_totals": gap_with_totals,
    "expected_units": expected_units,
    "market_price": market_price,
    "expected_revenue": expected_revenue,
    "seller_report": seller_report,
    "meta_fanout": meta_fanout,
    "one_meta_per_item": one_meta_per_item,
    "upsert_latest": upsert_latest,
    "upsert_evolved": upsert_evolved,
    "upsert_global_key": upsert_global_key,
    "upsert_replayed": upsert_replayed,
    "dedupe_losers": dedupe_losers,
    "load_reconciliation": load_reconciliation,
    "landing_inferred": landing_inferred,
    "silver_stamped": silver_stamped,
    "clean_every_sale": clean_every_sale,
    "dq_every_sale": dq_every_sale,
    "dedupe_every_company_sale": dedupe_every_company_sale,
    "silver_every_sale": silver_every_sale,
    "landing_mixed_headers": landing_mixed_headers,
    "stream_mixed_headers": stream_mixed_headers,
    "stream_messages_to_silver": stream_messages_to_silver,
    "csv_bronze_roundtrip": csv_bronze_roundtrip,
    "csv_bronze_catalog": csv_bronze_catalog,
    "silver_snapshot_scan": silver_snapshot_scan,
    "silver_company": silver_company,
    "silver_competitor": silver_competitor,
    "report_csv_roundtrip": report_csv_roundtrip,
    "medallion_end_to_end": medallion_end_to_end,
    "stream_messages": _messages(COMPANY_SALES),
    "stream_messages_catalog": _messages(SELLER_CATALOG),
    "stream_messages_competitor": _messages(COMPETITOR_SALES),
    "stream_landing_ingest": stream_landing_ingest,
}
