"""Item totals and the expected measures of the report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.measures import first_known, ratio, sum_money

# The measures of an item about which nothing is known.
DEFAULT_UNITS = 1.0
DEFAULT_PRICE = 19.99
REPORT_COLUMNS = (
    "seller_id",
    "item_id",
    "item_name",
    "category",
    "market_price",
    "expected_units_sold",
    "expected_revenue",
)
REPORT_SCHEMA = (
    "seller_id string, item_id string, item_name string, category string, "
    "market_price double, expected_units_sold double, expected_revenue double"
)


def company_item_units(company: DataFrame) -> DataFrame:
    return company.groupBy("item_id").agg(F.sum("units_sold").alias("comp_units"))


def market_item_totals(competitor: DataFrame) -> DataFrame:
    """Units, revenue and ``seller_count`` per item: the number of sale rows with a seller."""
    return competitor.groupBy("item_id").agg(
        F.sum("units_sold").alias("market_units"),
        F.count("seller_id").alias("seller_count"),
        sum_money(F.col("revenue")).alias("market_revenue"),
    )


def with_metadata(totals: DataFrame, item_meta: DataFrame) -> DataFrame:
    """Totals of items that have metadata, one row per metadata row."""
    return totals.join(item_meta, "item_id", "inner")


def attach_totals(df: DataFrame, market: DataFrame, company: DataFrame) -> DataFrame:
    return df.join(market, "item_id", "left").join(company, "item_id", "left")


def add_expected_units(df: DataFrame) -> DataFrame:
    """Mean units per marketplace sale row, else the company's total, else 1."""
    per_sale = ratio(F.col("market_units"), first_known(F.col("seller_count"), 1))
    units = first_known(per_sale, F.col("comp_units").cast("double"), DEFAULT_UNITS)
    return df.withColumn("expected_units_sold", units)


def add_market_price(df: DataFrame) -> DataFrame:
    """Marketplace revenue per unit, else a default price."""
    price = first_known(ratio(F.col("market_revenue"), F.col("market_units")), DEFAULT_PRICE)
    return df.withColumn("market_price", price)


def add_expected_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("expected_revenue", F.col("expected_units_sold") * F.col("market_price"))


def add_measures(df: DataFrame) -> DataFrame:
    return add_expected_revenue(add_market_price(add_expected_units(df)))
