import datetime
import json

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import quality
from shelfwise.plans import etl
from shelfwise.plans.specs import COMPANY_SALES, COMPETITOR_SALES, SELLER_CATALOG
from shelfwise.sources.landing import read_quarantine, write_quarantine

AS_OF = "2026-07-28"
COMPANY = "item_id string, units_sold string, revenue string, sale_date string"
COMPETITOR = (
    "item_id string, seller_id string, units_sold string, revenue string, marketplace_price string, sale_date string"
)
CATALOG = (
    "seller_id string, item_id string, item_name string, category string, marketplace_price string, stock_qty string"
)


def tag(spark, rows, schema, spec, **options):
    options = etl.LoadOptions(as_of=AS_OF, **options)
    return etl.tag_rows(spark.createDataFrame(rows, schema), spec, options)


def reasons(tagged, key="item_id"):
    return {r[key]: r[quality.REASON] for r in tagged.collect()}


def test_company_rules_in_order(spark):
    rows = [
        ("good", "1", "2", AS_OF),
        ("zero", None, None, "2020-01-01"),
        ("units", "-1", "-2", "bad"),
        ("text", "abc", "2", AS_OF),
        ("money", "1", "-2", "bad"),
        ("late", "1", "2", "2026-07-29"),
        ("undated", "1", "2", None),
        (None, "-1", "2", AS_OF),
    ]
    assert reasons(tag(spark, rows, COMPANY, COMPANY_SALES)) == {
        "good": None,
        "zero": None,
        "units": "units_negative",
        "text": "units_negative",
        "money": "revenue_negative",
        "late": "invalid_sale_date",
        "undated": "invalid_sale_date",
        None: "missing_item_id",
    }


def test_competitor_rules_in_order(spark):
    good = ["s", "1", "2", "3", AS_OF]
    rows = [("good", *good), (None, *good), ("seller", None, *good[1:])]
    rows.append(("blank", "   ", *good[1:]))
    rows.append(("price", "s", "1", "2", "-3", AS_OF))
    rows.append(("pricetext", "s", "1", "2", "x", AS_OF))
    rows.append(("all", None, "-1", "-2", "-3", None))
    assert reasons(tag(spark, rows, COMPETITOR, COMPETITOR_SALES)) == {
        "good": None,
        None: "missing_item_id",
        "seller": "missing_seller_id",
        "blank": None,
        "price": "price_negative",
        "pricetext": "price_negative",
        "all": "missing_seller_id",
    }


def test_catalog_rules_in_order(spark):
    rows = [
        ("s", "good", "n", "c", "1", "1"),
        (None, "seller", "n", "c", "1", "1"),
        ("s", None, "n", "c", "1", "1"),
        ("s", "price", "n", "c", "-1", "-1"),
        ("s", "noprice", "n", "c", None, "1"),
        ("s", "stock", "n", "c", "1", "-1"),
        ("s", "name", None, None, "1", "1"),
        ("s", "category", "n", None, "1", None),
    ]
    assert reasons(tag(spark, rows, CATALOG, SELLER_CATALOG)) == {
        "good": None,
        "seller": "missing_seller_id",
        None: "missing_item_id",
        "price": "price_negative",
        "noprice": "price_negative",
        "stock": "stock_negative",
        "name": "missing_item_name",
        "category": "missing_category",
    }


def test_null_policy_drop_loses_undecided_rows(spark):
    rows = [("ok", "1", "2", AS_OF), ("lost", "abc", "2", AS_OF), ("neg", "-1", "x", AS_OF), ("x", "1", "x", "bad")]
    tagged = tag(spark, rows, COMPANY, COMPANY_SALES, null_policy="drop")
    assert [r["item_id"] for r in quality.accepted(tagged).collect()] == ["ok"]
    assert reasons(quality.rejected(tagged)) == {"neg": "units_negative"}
    with pytest.raises(ValueError):
        quality.tag_first_failure(tagged, (), None, "other")


def test_same_rows_accepted_under_both_policies(spark):
    rows = [(str(i), u, r, d) for i, (u, r, d) in enumerate(
        (u, r, d) for u in ("1", "-1", "abc", None) for r in ("1", "-1", "x", None) for d in (AS_OF, "bad", None)
    )]
    kept = [
        {r["item_id"] for r in quality.accepted(tag(spark, rows, COMPANY, COMPANY_SALES, null_policy=p)).collect()}
        for p in ("reject", "drop")
    ]
    assert kept[0] == kept[1]
    tagged = tag(spark, rows, COMPANY, COMPANY_SALES)
    assert quality.accepted(tagged).count() + quality.rejected(tagged).count() == len(rows)


def test_duplicate_choice_comes_before_the_rules(spark):
    rows = [("i", "-1", "2", AS_OF), ("i", "5", "2", AS_OF), (None, "1", "2", AS_OF), (None, "2", "2", AS_OF)]
    tagged = tag(spark, rows, COMPANY, COMPANY_SALES)
    assert reasons(tagged) == {"i": "units_negative", None: "missing_item_id"}
    assert tagged.count() == 2
    options = etl.LoadOptions(as_of=AS_OF, dedupe_after_rules=True)
    later = etl.tag_rows(spark.createDataFrame(rows, COMPANY), COMPANY_SALES, options)
    kept = etl.accepted_rows(later, COMPANY_SALES, options).collect()
    assert [(r["item_id"], r["units_sold"]) for r in kept] == [("i", 5)]


def test_blank_is_null_option(spark):
    rows = [("  ", "1", "2", AS_OF)]
    assert reasons(tag(spark, rows, COMPANY, COMPANY_SALES)) == {"": None}
    assert reasons(tag(spark, rows, COMPANY, COMPANY_SALES, blank_is_null=True)) == {None: "missing_item_id"}


def test_nan_passes_unless_told_otherwise(spark):
    df = spark.createDataFrame([(float("nan"),)], "v double")
    lenient = quality.tag_first_failure(df, [quality.not_negative("neg", "v")])
    strict = quality.tag_first_failure(df, [quality.not_negative("neg", "v", nan_is_invalid=True)])
    assert lenient.first()[quality.REASON] is None
    assert strict.first()[quality.REASON] == "neg"


def test_today_is_the_default_date(spark):
    day = datetime.date.today()
    df = spark.createDataFrame(
        [("past", day - datetime.timedelta(days=2)), ("future", day + datetime.timedelta(days=2))], "item_id string, d date"
    )
    tagged = quality.tag_first_failure(df, [quality.dated_by("late", "d")])
    assert reasons(tagged) == {"past": None, "future": "late"}


def test_quarantine_record(spark, tmp_path):
    rows = [("ITEM-9042", "-14", "350.00", "2026-07-28"), ("ITEM-1", "1", None, "2026-99-28")]
    records = quality.quarantine_records(tag(spark, rows, COMPANY, COMPANY_SALES), "company_sales")
    got = {json.loads(r["original_record"])["item_id"]: r for r in records.collect()}
    row = got["ITEM-9042"]
    assert row["dataset_name"] == "company_sales"
    assert row[quality.REASON] == "units_negative"
    assert json.loads(row["original_record"]) == {
        "item_id": "ITEM-9042", "units_sold": -14, "revenue": 350.0, "sale_date": "2026-07-28",
    }
    assert json.loads(got["ITEM-1"]["original_record"]) == {"item_id": "ITEM-1", "units_sold": 1, "revenue": 0.0}
    for _ in range(2):
        write_quarantine(records, str(tmp_path), "company_sales", "b1")
    write_quarantine(records, str(tmp_path), "company_sales", "b2")
    stored = read_quarantine(spark, str(tmp_path), "company_sales")
    assert {(r["batch_id"], r["n"]) for r in stored.groupBy("batch_id").agg(F.count("*").alias("n")).collect()} == {
        ("b1", 2), ("b2", 2),
    }
    summary = {tuple(r) for r in quality.failure_summary(records).collect()}
    assert summary == {("company_sales", "units_negative", 1), ("company_sales", "invalid_sale_date", 1)}
