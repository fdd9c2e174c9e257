"""The driver's tables seen as the three retail datasets.

Every ``lineitem`` row is used. Each row is a listing of (supplier, part); each row is also one
sale, on the marketplace when taxed at the marketplace rate and in the company's own ledger
otherwise. Returned marketplace sales count no units. Some items thus have no marketplace sale,
and some only returned ones, so that every fallback of the report is reached.

The dirty feeds are the same rows as text with faults put in by row number arithmetic (values are
spoiled, rows are never left out).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: sales taxed above this rate are marketplace sales.
MARKET_TAX = 0.075


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("item_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_quantity").cast("int").alias("units"),
        F.col("l_extendedprice").alias("revenue"),
        F.to_date("l_shipdate").alias("sale_date"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_tax").alias("tax"),
        (F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("n"),
    )


def _on_market() -> Column:
    return F.col("tax") > MARKET_TAX


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_type", "p_size", "p_retailprice"
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_tax", "l_shipdate"
    ).join(part, "l_partkey")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing per (supplier, part)."""
    pairs = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct()
    part = table(spark, sf_dir, "part")
    return pairs.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_partkey").cast("string").alias("item_id"),
        F.col("p_name").alias("item_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("marketplace_price"),
        F.col("p_size").alias("stock_qty"),
    )


def company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(spark, sf_dir).where(~_on_market()).select(
        "item_id", F.col("units").alias("units_sold"), "revenue", "sale_date"
    )


def competitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = F.when(F.col("return_flag") == "R", 0).otherwise(F.col("units"))
    return _sales(spark, sf_dir).where(_on_market()).select(
        "item_id",
        "seller_id",
        units.alias("units_sold"),
        "revenue",
        F.col("revenue").alias("marketplace_price"),
        "sale_date",
    )


def listing_batch(spark: SparkSession, sf_dir: str, market: bool) -> DataFrame:
    """Dated listings, one per line: those of the marketplace sales or those of the ledger."""
    chosen = F.col("l_tax") > MARKET_TAX
    return _listings(spark, sf_dir).where(chosen if market else ~chosen).select(
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_partkey").cast("string").alias("item_id"),
        F.col("p_type").alias("category"),
        F.col("l_linenumber").alias("stock_qty"),
        F.to_date("l_shipdate").alias("listed_on"),
    )


# Faults, by the row number ``n``: the first that applies decides, columns are independent.


def _every(n: Column, step: int) -> Column:
    return n % step == 0


def _padded(text: Column) -> Column:
    return F.concat(F.lit("  "), text, F.lit(" "))


def dirty_item_id(text: Column, n: Column) -> Column:
    return F.when(_every(n, 97), None).when(_every(n, 5), _padded(text)).otherwise(text)


def dirty_seller_id(text: Column, n: Column) -> Column:
    return F.when(_every(n, 101), None).when(_every(n, 103), F.lit("   ")).otherwise(text)


def dirty_units(units: Column, n: Column) -> Column:
    text = units.cast("string")
    return (
        F.when(_every(n, 89), None)
        .when(_every(n, 83), F.lit("abc"))
        .when(_every(n, 79), F.concat(F.lit("-"), text))
        .when(_every(n, 73), F.concat(text, F.lit(".5")))
        .otherwise(text)
    )


def _dirty_amount(amount: Column, n: Column, missing: int, unreadable: int, negative: int) -> Column:
    text = amount.cast("decimal(18,2)").cast("string")
    return (
        F.when(_every(n, missing), None)
        .when(_every(n, unreadable), F.lit("x"))
        .when(_every(n, negative), F.concat(F.lit("-"), text))
        .otherwise(text)
    )


def dirty_revenue(amount: Column, n: Column) -> Column:
    return _dirty_amount(amount, n, 71, 67, 61)


def dirty_price(amount: Column, n: Column) -> Column:
    return _dirty_amount(amount, n, 89, 83, 79)


def dirty_stock(stock: Column, n: Column) -> Column:
    text = stock.cast("string")
    return F.when(_every(n, 73), None).when(_every(n, 71), F.concat(F.lit("-"), text)).otherwise(text)


def dirty_name(text: Column, n: Column, missing: int) -> Column:
    return (
        F.when(_every(n, missing), None)
        .when(_every(n, 5), _padded(text))
        .when(_every(n, 3), F.upper(text))
        .otherwise(text)
    )


def dirty_date(day: Column, n: Column) -> Column:
    return (
        F.when(_every(n, 59), None)
        .when(_every(n, 53), F.lit("1999-13-45"))
        .when(_every(n, 47), F.date_format(day, "yyyy-M-d"))
        .when(_every(n, 43), F.lit("2999-01-01"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )


def spoil_catalog(rows: DataFrame) -> DataFrame:
    n = F.col("n")
    return rows.select(
        dirty_seller_id(F.col("seller_id"), n).alias("seller_id"),
        dirty_item_id(F.col("item_id"), n).alias("item_id"),
        dirty_name(F.col("item_name"), n, 67).alias("item_name"),
        dirty_name(F.col("category"), n, 107).alias("category"),
        dirty_price(F.col("marketplace_price"), n).alias("marketplace_price"),
        dirty_stock(F.col("stock_qty"), n).alias("stock_qty"),
    )


def spoil_company(rows: DataFrame) -> DataFrame:
    n = F.col("n")
    return rows.select(
        dirty_item_id(F.col("item_id"), n).alias("item_id"),
        dirty_units(F.col("units"), n).alias("units_sold"),
        dirty_revenue(F.col("revenue"), n).alias("revenue"),
        dirty_date(F.col("sale_date"), n).alias("sale_date"),
    )


def spoil_competitor(rows: DataFrame, price_shift: int = 0) -> DataFrame:
    """``price_shift`` keeps the price's faults from meeting the same steps of the units' faults."""
    n = F.col("n")
    return rows.select(
        dirty_item_id(F.col("item_id"), n).alias("item_id"),
        dirty_seller_id(F.col("seller_id"), n).alias("seller_id"),
        dirty_units(F.col("units"), n).alias("units_sold"),
        dirty_revenue(F.col("revenue"), n).alias("revenue"),
        dirty_price(F.col("price"), n + price_shift).alias("marketplace_price"),
        dirty_date(F.col("sale_date"), n).alias("sale_date"),
    )


def dirty_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing record per line, so a (supplier, part) recurs at several prices."""
    rows = _listings(spark, sf_dir).select(
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_partkey").cast("string").alias("item_id"),
        F.col("p_name").alias("item_name"),
        F.col("p_type").alias("category"),
        (F.col("p_retailprice") + F.col("l_linenumber")).alias("marketplace_price"),
        F.col("p_size").alias("stock_qty"),
        (F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("n"),
    )
    return spoil_catalog(rows)


def dirty_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spoil_company(_sales(spark, sf_dir).where(~_on_market()))


def dirty_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as a marketplace sale."""
    return spoil_competitor(_sales(spark, sf_dir).withColumn("price", F.col("revenue")), price_shift=1)


def dirty_competitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sales(spark, sf_dir).where(_on_market())
    return spoil_competitor(rows.withColumn("price", F.col("revenue")), price_shift=1)
