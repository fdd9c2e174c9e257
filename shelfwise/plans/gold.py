"""The gold report: what each seller could add, and what it may bring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.dedupe import distinct_rows
from shelfwise.operators.forecast import (
    REPORT_COLUMNS,
    add_measures,
    company_item_units,
    market_item_totals,
    with_metadata,
)
from shelfwise.operators.gap import gap_or_full_matrix
from shelfwise.operators.ranking import top_items
from shelfwise.plans.etl import Lake
from shelfwise.plans.specs import COMPANY_SALES, COMPETITOR_SALES, SELLER_CATALOG
from shelfwise.sources.landing import write_report
from shelfwise.sources.scratch import freed_scratch, materialise
from shelfwise.sources.silver import read_silver

# Fixed value: the category of a listing without one.
DEFAULT_CATEGORY = "General"


def listing_rows(catalog: DataFrame) -> DataFrame:
    """Catalog rows as the report uses them; rows without both ids are left out."""
    category = F.coalesce(F.col("category"), F.lit(DEFAULT_CATEGORY))
    return catalog.where("seller_id IS NOT NULL AND item_id IS NOT NULL").select(
        F.trim("seller_id").alias("seller_id"),
        F.trim("item_id").alias("item_id"),
        F.trim("item_name").alias("item_name"),
        F.trim(F.initcap(category)).alias("category"),
    )


def company_rows(company: DataFrame) -> DataFrame:
    return company.where("item_id IS NOT NULL").select(
        F.trim("item_id").alias("item_id"),
        F.col("units_sold").try_cast("int").alias("units_sold"),
    )


def competitor_rows(competitor: DataFrame) -> DataFrame:
    return competitor.where("item_id IS NOT NULL").select(
        F.trim("item_id").alias("item_id"),
        F.trim("seller_id").alias("seller_id"),
        F.col("units_sold").try_cast("int").alias("units_sold"),
        F.col("revenue").try_cast("double").alias("revenue"),
    )


def item_metadata(listings: DataFrame, one_per_item: bool = False) -> DataFrame:
    """Distinct (item_id, item_name, category); optionally only the first of each item."""
    if one_per_item:
        first = F.min(F.struct("item_name", "category")).alias("meta")
        return listings.groupBy("item_id").agg(first).select("item_id", "meta.*")
    return distinct_rows(listings, "item_id", "item_name", "category")


_TARGET_COLUMNS = (
    "item_id",
    "category",
    "comp_units",
    "market_units",
    "seller_count",
    "market_revenue",
)


def _entry(ranking: str, units: str, sold: str) -> Column:
    """An item's entry in one of the two rankings."""
    return F.struct(
        F.lit(ranking).alias("ranking"), F.col(units).alias("units"), F.col(sold).alias("sold")
    )


def measured_targets(
    item_meta: DataFrame, company: DataFrame, competitor: DataFrame, k: int = 10
) -> DataFrame:
    """Target rows with both totals and the measures made of them: a few rows per category.

    Both totals are joined once per item and both rankings come from one window, so each sales
    table is scanned once, the measures come along with the ranked rows, and no total is joined
    to the far larger gap.
    """
    units = company_item_units(company).withColumn("in_company", F.lit(True))
    totals = market_item_totals(competitor).withColumn("in_market", F.lit(True))
    items = with_metadata(units.join(totals, "item_id", "full"), item_meta)
    entries = F.array(_entry("company", "comp_units", "in_company"), _entry("market", "market_units", "in_market"))
    contenders = items.select("*", F.inline(entries)).where("sold")
    best = top_items(contenders, "units", k, group=("category", "ranking"))
    targets = best.select(*_TARGET_COLUMNS).dropDuplicates(["item_id", "category"])
    return add_measures(targets)


def target_facts(
    item_meta: DataFrame, company: DataFrame, competitor: DataFrame, k: int = 10
) -> DataFrame:
    """Target rows with their measures and metadata.

    A target row meets every metadata row of its item, as the report lists each.
    """
    measured = measured_targets(item_meta, company, competitor, k)
    renamed = measured.withColumnRenamed("category", "target_category")
    facts = renamed.join(item_meta, "item_id", "inner")
    return facts.select("target_category", *[c for c in REPORT_COLUMNS if c != "seller_id"])


def listed_targets(listings: DataFrame, targets: DataFrame) -> DataFrame:
    """Per seller, the target ids it lists, and one row with NULL for anything else it lists.

    One scan of the catalog, reduced within each task before its only shuffle, gives both the
    seller list and the listings that matter to the gap.
    """
    ids = targets.select("item_id").distinct().withColumn("target_id", F.col("item_id"))
    matched = listings.select("seller_id", "item_id").join(ids, "item_id", "left")
    return matched.select("seller_id", F.col("target_id").alias("item_id")).distinct()


def seller_report(
    catalog: DataFrame, company: DataFrame, competitor: DataFrame, one_meta_per_item: bool = False
) -> DataFrame:
    """The seven-column report over typed silver rows.

    Two small tables are written on the way: the target rows with their measures, and each
    seller's listings of them. The report unfolds from these two.
    """
    listings = listing_rows(catalog)
    meta = item_metadata(listings, one_meta_per_item)
    facts = target_facts(meta, company_rows(company), competitor_rows(competitor))
    facts = materialise(facts, "target-facts")
    listed = materialise(listed_targets(listings, facts), "listed-targets")
    sellers = distinct_rows(listed, "seller_id")
    held = listed.where("item_id IS NOT NULL")
    return gap_or_full_matrix(sellers, facts, held).select(*REPORT_COLUMNS)


def lake_report(spark: SparkSession, lake: Lake) -> DataFrame:
    """The report over the current silver snapshots. Every file has the columns it needs."""
    specs = (SELLER_CATALOG, COMPANY_SALES, COMPETITOR_SALES)
    tables = [read_silver(spark, lake.silver(spec), merge_schema=False) for spec in specs]
    return seller_report(*tables)


def publish_report(spark: SparkSession, lake: Lake) -> None:
    with freed_scratch(spark):
        write_report(lake_report(spark, lake), lake.report)
