"""One key, seller, item, category or missing id holding a third of all rows, against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import dedupe, forecast, gap, ranking
from shelfwise.operators.upsert import upsert
from shelfwise.plans import gold
from shelfwise.plans.specs import SELLER_CATALOG, clean
from shelfwise.plans.specs import dedupe as dedupe_spec
from shelfwise.sources.silver import SilverTable, read_silver

N = 6000


def hot(rng, values, favourite):
    return favourite if rng.random() < 1 / 3 else rng.choice(values)


@pytest.fixture(scope="module")
def rng():
    return random.Random(11)


def test_missing_ids_hold_a_third(spark, rng):
    ids = [str(i) for i in range(300)]
    rows = [(hot(rng, ids, None), hot(rng, ids, None), f"n{rng.randrange(3)}", "c", str(rng.randrange(9)), "1") for _ in range(N)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SELLER_CATALOG.columns)).repartition(7)
    got = dedupe_spec(clean(df, SELLER_CATALOG), SELLER_CATALOG).collect()
    best = {}
    for s, i, name, _, price, _ in rows:
        value = (name.title(), "C", float(price), 1)
        best[s, i] = min(best.get((s, i), value), value)
    assert {(r["seller_id"], r["item_id"]): tuple(r)[2:] for r in got} == best
    assert len(got) == len(best)


def test_catalog_sorts_by_item_first(spark):
    """An item has few sellers and a seller many items: most comparisons of a sort end at the first column."""
    df = spark.createDataFrame([("1", "2", "n", "c", "3", "1")], ", ".join(f"{c} string" for c in SELLER_CATALOG.columns))
    plan = dedupe_spec(df, SELLER_CATALOG)._jdf.queryExecution().executedPlan().toString()
    sorts = [line.split("Sort [")[1] for line in plan.splitlines() if "Sort [" in line]
    assert len(sorts) == 2 and all(s.startswith("item_id") for s in sorts)


def test_one_category_holds_a_third(spark, rng):
    categories = [f"c{i}" for i in range(20)]
    rows = [(f"i{n:05}", "n", hot(rng, categories, "c0"), rng.randrange(500)) for n in range(N)]
    df = spark.createDataFrame(rows, "item_id string, item_name string, category string, units int").repartition(9)
    got = Counter(map(tuple, ranking.top_items(df, "units").collect()))
    by_category = defaultdict(list)
    for row in rows:
        by_category[row[2]].append(row)
    expected = Counter(
        row for group in by_category.values() for row in sorted(group, key=lambda r: (-r[3], r[0]))[:10]
    )
    assert got == expected


def test_one_item_and_seller_hold_a_third(spark, rng):
    items = [f"i{n}" for n in range(200)]
    sellers = [f"s{n}" for n in range(40)]
    catalog = [(hot(rng, sellers, "s0"), hot(rng, items, "i0")) for _ in range(N)]
    company = [(hot(rng, items, "i0"), rng.randrange(9)) for _ in range(N)]
    market = [(hot(rng, items, "i1"), hot(rng, sellers, "s1"), rng.randrange(9), rng.randrange(9999) / 100) for _ in range(N)]
    report = gold.seller_report(
        spark.createDataFrame([(s, i, f"n {i}", f"c{int(i[1:]) % 3}") for s, i in catalog],
                              "seller_id string, item_id string, item_name string, category string").repartition(8),
        spark.createDataFrame(company, "item_id string, units_sold int"),
        spark.createDataFrame(market, "item_id string, seller_id string, units_sold int, revenue double"),
    )
    own, units, cents, sales = Counter(), Counter(), Counter(), Counter()
    for i, u in company:
        own[i] += u
    for i, _, u, r in market:
        units[i] += u
        cents[i] += round(r * 100)
        sales[i] += 1
    known = {i for _, i in catalog}
    targets = set()
    for totals in (own, units):
        for c in range(3):
            group = [i for i in totals if i in known and int(i[1:]) % 3 == c]
            targets |= set(sorted(group, key=lambda i: (-totals[i], i))[:10])
    listed = set(catalog)
    expected = set()
    for s in {s for s, _ in catalog}:
        for i in targets:
            if (s, i) not in listed:
                amount = units[i] / sales[i] if i in sales else float(own[i])
                price = cents[i] / 100 / units[i] if units[i] else 19.99
                expected.add((s, i, f"n {i}", price, amount, amount * price))
    got = [(r[0], r[1], r[2], r[4], r[5], r[6]) for r in report.collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_one_partition_and_one_key_hold_a_third(spark, rng, tmp_path):
    table = SilverTable(str(tmp_path / "t"), ("k",), "p", "t", buckets=4)
    keys, parts = [str(n) for n in range(400)], [f"p{n}" for n in range(12)]
    expected = {}
    for _ in range(2):
        rows = [(hot(rng, keys, "0"), hot(rng, parts, "p0"), rng.randrange(50), rng.randrange(1000)) for _ in range(N)]
        upsert(spark.createDataFrame(rows, "k string, p string, t int, v int").repartition(6), table)
        batch = {}
        for k, p, t, v in rows:
            batch[k, p] = max(batch.get((k, p), (t, v)), (t, v))
        for key, (t, v) in batch.items():
            if key not in expected or t >= expected[key][0]:
                expected[key] = (t, v)
    rows = read_silver(spark, table).select("k", "p", "t", "v").collect()
    assert {(r["k"], r["p"]): (r["t"], r["v"]) for r in rows} == expected and len(rows) == len(expected)


def test_totals_of_a_hot_item(spark, rng):
    rows = [(hot(rng, ["a", "b"], "hot"), hot(rng, ["x"], None), 1, 0.01) for _ in range(N)]
    df = spark.createDataFrame(rows, "item_id string, seller_id string, units_sold int, revenue double").repartition(5)
    got = {r["item_id"]: tuple(r)[1:] for r in forecast.market_item_totals(df).collect()}
    counts = Counter(r[0] for r in rows)
    sellers = Counter(r[0] for r in rows if r[1])
    assert got == {i: (n, sellers[i], n / 100) for i, n in counts.items()}
    assert dedupe.distinct_rows(df, "item_id").count() == len(counts)


def test_packs_are_even_when_one_item_has_most_rows(spark):
    """An item with 100,000 metadata rows fills many packs, and a seller that lists it drops them all."""
    one = spark.range(100_000).select(F.lit("big").alias("item_id"), F.concat(F.lit("c"), "id").alias("category"))
    rest = spark.range(5_000).select(F.concat(F.lit("i"), "id").alias("item_id"), F.lit("c").alias("category"))
    targets = one.unionByName(rest)
    n = gap.pack_count(targets.count())
    sizes = [r[0] for r in gap.packed_rows(targets, n, targets.columns).select(F.size("wanted")).collect()]
    assert len(sizes) == n and max(sizes) < 2 * sum(sizes) / n
    sellers = spark.createDataFrame([("a",), ("b",)], "seller_id string")
    listings = spark.createDataFrame([("a", "big"), ("a", "i7"), ("b", "i8"), ("b", "other")], "seller_id string, item_id string")
    found = gap.assortment_gap(sellers, targets, listings).groupBy("seller_id").count().collect()
    assert {r["seller_id"]: r["count"] for r in found} == {"a": 4_999, "b": 104_999}
