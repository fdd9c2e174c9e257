"""The small golden mapping of FIXTURES.md section 5, used to check measured counts only.

The registered queries use ``shelfwise.sources.driver_views``, which leaves no row out.
"""

from pyspark.sql import functions as F

from shelfwise.sources import driver_views as views

# Padded, so that ids sort like the numbers by which the counted report broke its ties.
ITEM_ID = "lpad(string(l_partkey), 9, '0') AS item_id"


def catalog(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem").where("l_suppkey % 5 <> 0")
    part = views.table(spark, sf_dir, "part")
    return (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .selectExpr(
            "string(l_suppkey) AS seller_id",
            ITEM_ID,
            "p_name AS item_name",
            "p_type AS category",
            "p_retailprice AS marketplace_price",
            "p_size AS stock_qty",
        )
        .distinct()
    )


def _sales(spark, sf_dir, condition, units="int(l_quantity)"):
    return (
        views.table(spark, sf_dir, "lineitem")
        .where(condition)
        .selectExpr(
            ITEM_ID,
            "string(l_suppkey) AS seller_id",
            f"{units} AS units_sold",
            "l_extendedprice AS revenue",
            "l_extendedprice / l_quantity AS price",
            "date(l_shipdate) AS sale_date",
            "l_orderkey * 7 + l_linenumber AS n",
        )
    )


OWN = "l_suppkey % 5 = 0"
MARKET = "l_suppkey % 5 <> 0 AND l_partkey % 20 <> 0"


def company(spark, sf_dir):
    return _sales(spark, sf_dir, OWN)


def competitor(spark, sf_dir):
    return _sales(spark, sf_dir, MARKET, "CASE WHEN l_partkey % 50 = 1 THEN 0 ELSE int(l_quantity) END")


def dirty_catalog(spark, sf_dir):
    rows = catalog(spark, sf_dir)
    again = rows.where("int(item_id) % 10 = 3").withColumn("marketplace_price", F.col("marketplace_price") + 1)
    return views.spoil_catalog(rows.unionByName(again).withColumn("n", F.expr("bigint(seller_id) * 7 + bigint(item_id)")))


def dirty_company(spark, sf_dir):
    return views.spoil_company(_sales(spark, sf_dir, OWN).withColumnRenamed("units_sold", "units"))


def dirty_competitor(spark, sf_dir):
    return views.spoil_competitor(_sales(spark, sf_dir, MARKET).withColumnRenamed("units_sold", "units"))
