"""Counts measured beforehand for the golden mapping (FIXTURES.md section 5)."""

import fixture_views as fixtures
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import quality
from shelfwise.operators.dedupe import keep_one
from shelfwise.plans import etl, gold
from shelfwise.plans.specs import COMPANY_SALES, COMPETITOR_SALES, SELLER_CATALOG, clean

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
REJECT = etl.LoadOptions(as_of="2001-01-01")
DROP = etl.LoadOptions(as_of="2001-01-01", null_policy="drop")
NAMES = (
    "accepted", "missing_seller_id", "missing_item_id", "units_negative", "revenue_negative", "price_negative",
    "stock_negative", "missing_item_name", "missing_category", "invalid_sale_date",
)
COUNTS = {
    ("catalog", SMALL): (1386, 16, 8, 0, 0, 52, 23, 23, 12, 0),
    ("catalog", MEDIUM): (37502, 424, 79, 0, 0, 1459, 585, 636, 385, 0),
    ("company", SMALL): (901, 0, 14, 30, 24, 0, 0, 0, 0, 176),
    ("company", MEDIUM): (9364, 0, 111, 278, 353, 0, 0, 0, 0, 1924),
    ("competitor", SMALL): (3528, 56, 41, 111, 126, 0, 0, 0, 0, 735),
    ("competitor", MEDIUM): (34869, 466, 466, 1115, 1337, 0, 0, 0, 0, 7315),
}
LOST = {
    ("catalog", SMALL): 33, ("catalog", MEDIUM): 942, ("company", SMALL): 24, ("company", MEDIUM): 323,
    ("competitor", SMALL): 123, ("competitor", MEDIUM): 1194,
}
SPECS = {
    "catalog": (SELLER_CATALOG, fixtures.dirty_catalog),
    "company": (COMPANY_SALES, fixtures.dirty_company),
    "competitor": (COMPETITOR_SALES, fixtures.dirty_competitor),
}


def tagged_counts(tagged):
    rows = tagged.groupBy(F.coalesce(quality.REASON, F.lit("accepted")).alias("r")).count().collect()
    return {r["r"]: r["count"] for r in rows}


def tag(spark, dataset, sf_dir, options):
    """Rules without the company's keep-one, whose table is counted before it; the catalog's
    duplicates are told apart by price first, as in the table."""
    spec, source = SPECS[dataset]
    rows = clean(source(spark, sf_dir), spec)
    if dataset == "catalog":
        order = [F.col(c).asc_nulls_first() for c in ("marketplace_price", "stock_qty")]
        rows = keep_one(rows, spec.dedupe_keys, order)
    return quality.tag_first_failure(rows, spec.rules, options.as_of, options.null_policy)


@pytest.mark.parametrize("dataset, sf_dir", COUNTS)
def test_first_failures(spark, dataset, sf_dir):
    counts = tagged_counts(tag(spark, dataset, sf_dir, REJECT))
    assert tuple(counts.get(n, 0) for n in NAMES) == COUNTS[dataset, sf_dir]
    dropping = tagged_counts(tag(spark, dataset, sf_dir, DROP))
    assert dropping[quality.UNDECIDED] == LOST[dataset, sf_dir]
    assert dropping["accepted"] == counts["accepted"]


@pytest.mark.parametrize("sf_dir, expected", [(SMALL, (156, 1, 4, 7, 32)), (MEDIUM, (1539, 1, 44, 46, 367))])
def test_company_after_keep_one(spark, sf_dir, expected):
    rows = clean(fixtures.dirty_company(spark, sf_dir), COMPANY_SALES)
    order = [F.col(c).asc_nulls_first() for c in ("sale_date", "units_sold", "revenue")]
    tagged = quality.tag_first_failure(keep_one(rows, ["item_id"], order), COMPANY_SALES.rules, REJECT.as_of)
    counts = tagged_counts(tagged)
    names = ("accepted", "missing_item_id", "units_negative", "revenue_negative", "invalid_sale_date")
    assert tuple(counts.get(n, 0) for n in names) == expected


@pytest.mark.parametrize(
    "sf_dir, expected", [(SMALL, (31, 0, 0, 31)), (MEDIUM, (6372, 241, 65, 6066))]
)
def test_report_rows(spark, sf_dir, expected):
    report = gold.seller_report(*[f(spark, sf_dir) for f in (fixtures.catalog, fixtures.company, fixtures.competitor)])
    default = F.col("market_price") == 19.99
    row = report.agg(
        F.count("*"),
        F.count(F.when(default & (F.col("expected_units_sold") > 0), 1)),
        F.count(F.when(default & (F.col("expected_units_sold") == 0), 1)),
        F.count(F.when(~default, 1)),
    ).first()
    assert tuple(row) == expected
