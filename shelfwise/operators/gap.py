"""Target lists and the assortment gap.

The sellers x targets matrix is the result of two of these operators, so its size is a given, but
it is never joined or shuffled. Target rows are packed into short arrays of even length, an item with
many rows into several; a seller meets each pack once, drops the items it lists already, and the
remaining rows are unfolded. What is shuffled is
the seller list, the packs and the listings of target items.

The inputs are read more than once: pass written tables (``materialise``), reduced to what matters
(``plans.gold.listed_targets``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Average number of target rows in a pack: bounds the array that any one row carries.
PACK_SIZE = 256
# Matrix pairs unfolded by one task; the seller list is too small to set the parallelism itself.
PAIRS_PER_TASK = 2_000_000


def target_items(company_top: DataFrame, market_top: DataFrame) -> DataFrame:
    """(item_id, category) pairs on either list, each once."""
    pair = ["item_id", "category"]
    return company_top.select(*pair).unionByName(market_top.select(*pair)).distinct()


def _counts(frames: dict[str, DataFrame]) -> dict[str, int]:
    """Row counts of several relations in one job."""
    names = [df.select(F.lit(name).alias("name")) for name, df in frames.items()]
    counted = reduce(DataFrame.unionAll, names).groupBy("name").count().collect()
    return {**dict.fromkeys(frames, 0), **{row["name"]: row["count"] for row in counted}}


def _held_pairs(sellers: DataFrame, ids: DataFrame, listings: DataFrame) -> DataFrame:
    """Distinct (seller_id, item_id) of the sellers' listings of target ids."""
    pairs = listings.select("seller_id", "item_id").join(ids, "item_id", "left_semi")
    return pairs.join(sellers, "seller_id", "left_semi").distinct()


def _pack_of(targets: DataFrame, n_packs: int) -> Column:
    """A target row's pack, by all it holds: rows of one item spread over as many packs as they fill."""
    return F.pmod(F.xxhash64(*targets.columns), F.lit(n_packs)).alias("pack")


def packed_rows(targets: DataFrame, n_packs: int, columns: list[str]) -> DataFrame:
    """(pack, wanted): whole target rows, so that nothing is joined once they are unfolded."""
    row = F.struct(*columns)
    return targets.groupBy(_pack_of(targets, n_packs)).agg(F.collect_list(row).alias("wanted"))


def pack_count(n_rows: int) -> int:
    return max(1, -(-n_rows // PACK_SIZE))


def _unlisted(
    sellers: DataFrame, targets: DataFrame, listings: DataFrame | None, full_if_none: bool = False
) -> DataFrame:
    """Target rows by seller, without the ids the seller lists."""
    sellers = sellers.select("seller_id").distinct()
    ids = targets.select("item_id").distinct()
    held = None if listings is None else _held_pairs(sellers, ids, listings)
    inputs = {"ids": ids, "rows": targets, "sellers": sellers}
    counts = _counts({**inputs, **({"held": held} if full_if_none else {})})
    n_ids, n_rows, n_sellers = counts["ids"], counts["rows"], counts["sellers"]
    if full_if_none and counts["held"] == n_ids * n_sellers:
        held = None
    n_packs = pack_count(n_rows)
    by_cores = targets.sparkSession.sparkContext.defaultParallelism
    n_tasks = max(by_cores, -(-n_rows * n_sellers // PAIRS_PER_TASK))
    columns = ["item_id", *[c for c in targets.columns if c != "item_id"]]
    # An item may be a target in two categories; each target row counts.
    wanted = packed_rows(targets, n_packs, columns)
    all_packs = F.sequence(F.lit(0).cast("long"), F.lit(n_packs - 1).cast("long"))
    offers = sellers.select("seller_id", F.explode(all_packs).alias("pack"))
    offers = offers.repartition(n_tasks, "seller_id", "pack")
    missing = F.col("wanted")
    if held is not None:
        # A listed item leaves every pack that holds rows of it.
        places = targets.select("item_id", _pack_of(targets, n_packs)).distinct()
        lists = held.join(places, "item_id").groupBy("seller_id", "pack").agg(F.collect_list("item_id").alias("held"))
        offers = offers.join(lists, ["seller_id", "pack"], "left")
        none = F.array().cast("array<string>")
        offers = offers.withColumn("held", F.coalesce("held", none))
        missing = F.filter("wanted", lambda t: ~F.array_contains(F.col("held"), t["item_id"]))
    # The packs come last, so that only seller ids and held ids have been shuffled until here.
    pairs = offers.join(wanted, "pack").select("seller_id", F.explode(missing).alias("target"))
    return pairs.select("seller_id", *[F.col("target")[c].alias(c) for c in columns])


def seller_item_matrix(sellers: DataFrame, targets: DataFrame) -> DataFrame:
    """Every seller with every target row."""
    return _unlisted(sellers, targets, None)


def assortment_gap(sellers: DataFrame, targets: DataFrame, listings: DataFrame) -> DataFrame:
    """Matrix rows whose (seller_id, item_id) is not in ``listings``."""
    return _unlisted(sellers, targets, listings)


def gap_or_full_matrix(sellers: DataFrame, targets: DataFrame, listings: DataFrame) -> DataFrame:
    """The gap, or the whole matrix when the gap is empty.

    The gap is empty exactly when there are as many distinct listed (seller, target id) pairs as
    sellers times target ids: three counts over the small inputs decide, and the gap itself is not
    computed twice.
    """
    return _unlisted(sellers, targets, listings, full_if_none=True)
