import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import first_known, parse_date, ratio, sum_money, title_case, to_double, to_int, trim_text
from shelfwise.functions.cleaning import DATE_TEXT
from shelfwise.plans.specs import COMPANY_SALES, COMPETITOR_SALES, SELLER_CATALOG, clean


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")


def apply(spark, values, expression):
    rows = texts(spark, values).select("i", expression(F.col("s")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_to_int(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        cases = {
            "3": 3, None: None, "abc": None, "12.5": 12, "-1": -1, "1e3": None, "7f": None, "1d": None,
            "NaN": None, "99999999999": None, "-.5": 0, " 7 ": 7, "+4": 4, "": None, "   ": None,
        }
        assert apply(spark, list(cases), to_int) == list(cases.values())
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_to_int_of_inferred_numbers(spark):
    df = spark.createDataFrame([(7, 12.9), (None, None)], "a bigint, b double")
    rows = df.select(
        to_int(F.col("a"), df.schema["a"].dataType).alias("a"),
        to_int(F.col("b"), df.schema["b"].dataType).alias("b"),
    ).collect()
    assert [tuple(r) for r in rows] == [(7, 12), (None, None)]


def test_to_double(spark):
    assert apply(spark, ["1.5", "x", None, "-2", "1e3", " 4 "], to_double) == [1.5, None, None, -2.0, 1000.0, 4.0]


def test_parse_date(spark):
    day = datetime.date
    cases = {
        "2026-07-28": day(2026, 7, 28),
        "2026-7-8": day(2026, 7, 8),
        "2026-07-28 10:00:00": day(2026, 7, 28),
        "2026-07-28T10:00:00": day(2026, 7, 28),
        "2026-07-28abc": day(2026, 7, 28),
        "  2026-07-28": day(2026, 7, 28),
        "2026-007-01": day(2026, 7, 1),
        "26-07-28": day(26, 7, 28),
        "2024-02-29": day(2024, 2, 29),
        "2023-02-29": None,
        "2026-02-30": None,
        "1999-13-45": None,
        "28/07/2026": None,
        "2026": None,
        "2026-07": None,
        "2026-07-281": None,
        "abc": None,
        "": None,
        "   ": None,
        None: None,
        "2026-07-28\nmore": day(2026, 7, 28),
    }
    assert apply(spark, list(cases), parse_date) == list(cases.values())


def test_plain_dates_read_as_any_other_text(spark):
    """Only text that is not read as a plain date meets the expression, and both agree."""
    plain = lambda c: parse_date(c).cast("string")  # Python has no year 0
    lenient = lambda c: F.regexp_replace(c, DATE_TEXT, "000$1-$2-$3").try_cast("date").cast("string")
    rng = random.Random(3)
    shape = lambda n: "".join(rng.choice("0012 -+T\tx") for _ in range(n))
    values = [f"{shape(4)}-{shape(2)}-{shape(2)}" for _ in range(3000)]
    values += [f"{y}-{m}-{d}" for y in ("2024", " 202", "+202", "0000") for m in ("02", "2 ", " 2", "13") for d in ("29", "1 ", "1T", "T1", "30")]
    found = apply(spark, values, plain)
    assert found == apply(spark, values, lenient)
    assert sum(d is not None for d in found) > 10
    plan = texts(spark, values).select(parse_date(F.col("s")))._jdf.queryExecution().analyzed().toString()
    assert plan.index("____-__-__") < plan.index("regexp_replace")


def test_parse_date_of_typed_columns(spark):
    df = spark.createDataFrame([(datetime.datetime(2026, 7, 28, 10), datetime.date(2026, 7, 28))], "t timestamp, d date")
    row = df.select(*[parse_date(F.col(c), df.schema[c].dataType).alias(c) for c in ("t", "d")]).first()
    assert tuple(row) == (datetime.date(2026, 7, 28),) * 2


def test_text(spark):
    both = lambda c: title_case(trim_text(c))
    values = [" wireless  MOUSE ", "o'neil-shoes", "   ", None, "\tx"]
    assert apply(spark, values, both) == ["Wireless  Mouse", "O'neil-shoes", "", None, "\tx"]
    assert apply(spark, ["   ", " a"], lambda c: trim_text(c, blank_is_null=True)) == [None, "a"]


def test_default_applies_before_the_cast(spark):
    rows = [("1", None, None, None), ("2", "abc", "x", "2026-1-2"), ("3", "4", "5.5", "bad")]
    df = spark.createDataFrame(rows, "item_id string, units_sold string, revenue string, sale_date string")
    got = [tuple(r) for r in clean(df, COMPANY_SALES).orderBy("item_id").collect()]
    assert got == [
        ("1", 0, 0.0, None),
        ("2", None, None, datetime.date(2026, 1, 2)),
        ("3", 4, 5.5, None),
    ]


def test_catalog_price_has_no_default_and_extra_columns_stay(spark):
    df = spark.createDataFrame(
        [(" S1 ", " I1", "aB c", "home GOODS", None, None, "kept")],
        "seller_id string, item_id string, item_name string, category string, "
        "marketplace_price string, stock_qty string, extra string",
    )
    assert tuple(clean(df, SELLER_CATALOG).first()) == ("S1", "I1", "Ab C", "Home Goods", None, 0, "kept")


def test_competitor_price_defaults_to_zero(spark):
    df = spark.createDataFrame(
        [("1", "2", "3", "4", None, "2020-01-01")], ", ".join(f"{c} string" for c in COMPETITOR_SALES.columns)
    )
    assert clean(df, COMPETITOR_SALES).first()["marketplace_price"] == 0.0


def money(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return df.agg(sum_money(F.col("v")).alias("s")).first()["s"]


def test_money_is_exact_and_loses_nothing(spark):
    assert money(spark, [0.1] * 10) == 1.0
    assert money(spark, [0.29, 0.57, -1.13, 90071992547.41]) == 90071992547.14
    assert money(spark, [1.005, 1.0]) == 2.005
    assert money(spark, [9e16, 9e16]) == 1.8e17
    assert money(spark, [None, 2.25]) == 2.25
    assert money(spark, [None]) is None
    assert money(spark, [0.125, 0.25]) == 0.375
    assert money(spark, [1e300, 1.0]) == 1e300
    assert money(spark, [float("inf"), 1.0]) == float("inf")
    assert money(spark, [float("nan"), 1.0]) != money(spark, [float("nan"), 1.0])


def test_ratio_and_fallbacks(spark):
    df = spark.createDataFrame([(6.0, 4), (6.0, 0), (None, 2)], "a double, b int")
    rows = df.select(first_known(ratio(F.col("a"), F.col("b")), 19.99).alias("r")).collect()
    assert [r["r"] for r in rows] == [1.5, 19.99, 19.99]


def random_texts(seed, pieces, n=3000):
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 8))) for _ in range(n)]


def read_int(text):
    if not re.fullmatch(r"\s*[+-]?\d*\.?\d*\s*", text) or not re.search(r"\d", text):
        return None
    value = int(float(text))
    return value if -(2**31) <= value < 2**31 else None


def test_any_text_to_int(spark):
    values = random_texts(1, ["1", "27", "900", ".", "-", "+", " ", "e", "f", "5555"])
    assert apply(spark, values, to_int) == [read_int(v) for v in values]


def read_date(text):
    match = re.match(r"\s*(\d{1,4})-0*(\d{1,2})-0*(\d{1,2})(?:\D|$)", text)
    try:
        return datetime.date(*map(int, match.groups())) if match else None
    except ValueError:
        return None


def test_any_text_to_date(spark):
    values = random_texts(2, ["2026", "19", "1", "0", "-", "-", "12", " ", "x", "31", "-02-", "T"])
    values += [f"{y}-{m}-{d}{end}" for y in ("2024", "26", "02023") for m in ("2", "02", "002", "13") for d in ("1", "29", "030") for end in ("", " 1", "x", "9")]
    readable = [(v, read_date(v)) for v in values if not re.match(r"\s*0+-", v)]  # Python has no year 0
    found = apply(spark, [v for v, _ in readable], parse_date)
    assert found == [d for _, d in readable]
    assert sum(d is not None for d in found) > 20
