"""What makes each dataset different: columns, rules, keys and table layout."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.cleaning import (
    default_when_null,
    parse_date,
    title_case,
    to_double,
    to_int,
    trim_text,
)
from shelfwise.operators.dedupe import keep_one, losers
from shelfwise.operators.quality import Rule, dated_by, not_negative, present
from shelfwise.sources.silver import SilverTable


@dataclass(frozen=True)
class DatasetSpec:
    """Declares one dataset's load.

    ``ints`` and ``doubles`` map a column to the value that replaces a missing one, or to None
    where a missing value stays NULL.
    """

    name: str
    columns: tuple[str, ...]
    trimmed: tuple[str, ...]
    titled: tuple[str, ...] = ()
    ints: dict[str, int | None] = field(default_factory=dict)
    doubles: dict[str, float | None] = field(default_factory=dict)
    dates: tuple[str, ...] = ()
    dedupe_keys: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    record_keys: tuple[str, ...] = ()
    partition: str = ""
    partition_type: str = "string"
    ordering: str = ""
    stamp: str | None = None

    def table(
        self, path: str, buckets: int = 1, scope: str = "partition", sequence: str | None = None
    ) -> SilverTable:
        return SilverTable(
            path,
            self.record_keys,
            self.partition,
            self.ordering,
            self.partition_type,
            buckets,
            scope,
            sequence,
        )

    @property
    def unique_after_dedupe(self) -> bool:
        """Whether keep-one already leaves one row per record key, and so per row key of any scope."""
        return bool(self.dedupe_keys) and set(self.dedupe_keys) <= set(self.record_keys)


# Dataset, column and rule names, the order of the rules, and the defaults.

SELLER_CATALOG = DatasetSpec(
    name="seller_catalog",
    columns=("seller_id", "item_id", "item_name", "category", "marketplace_price", "stock_qty"),
    trimmed=("seller_id", "item_id", "item_name", "category"),
    titled=("item_name", "category"),
    ints={"stock_qty": 0},
    doubles={"marketplace_price": None},
    # Items first: few rows share one, so sorts end early, and rows with equal names stand together.
    dedupe_keys=("item_id", "seller_id"),
    rules=(
        present("missing_seller_id", "seller_id"),
        present("missing_item_id", "item_id"),
        not_negative("price_negative", "marketplace_price"),
        not_negative("stock_negative", "stock_qty"),
        present("missing_item_name", "item_name"),
        present("missing_category", "category"),
    ),
    record_keys=("seller_id", "item_id"),
    partition="category",
    ordering="ingestion_time",
    stamp="ingestion_time",
)

COMPANY_SALES = DatasetSpec(
    name="company_sales",
    columns=("item_id", "units_sold", "revenue", "sale_date"),
    trimmed=("item_id",),
    ints={"units_sold": 0},
    doubles={"revenue": 0.0},
    dates=("sale_date",),
    dedupe_keys=("item_id",),
    rules=(
        present("missing_item_id", "item_id"),
        not_negative("units_negative", "units_sold"),
        not_negative("revenue_negative", "revenue"),
        dated_by("invalid_sale_date", "sale_date"),
    ),
    record_keys=("item_id",),
    partition="sale_date",
    partition_type="date",
    ordering="sale_date",
)

COMPETITOR_SALES = DatasetSpec(
    name="competitor_sales",
    columns=("item_id", "seller_id", "units_sold", "revenue", "marketplace_price", "sale_date"),
    trimmed=("item_id", "seller_id"),
    ints={"units_sold": 0},
    doubles={"revenue": 0.0, "marketplace_price": 0.0},
    dates=("sale_date",),
    rules=(
        present("missing_item_id", "item_id"),
        present("missing_seller_id", "seller_id"),
        not_negative("units_negative", "units_sold"),
        not_negative("revenue_negative", "revenue"),
        not_negative("price_negative", "marketplace_price"),
        dated_by("invalid_sale_date", "sale_date"),
    ),
    record_keys=("seller_id", "item_id"),
    partition="sale_date",
    partition_type="date",
    ordering="sale_date",
)

ALL_SPECS = (SELLER_CATALOG, COMPANY_SALES, COMPETITOR_SALES)


def clean(df: DataFrame, spec: DatasetSpec, blank_is_null: bool = False) -> DataFrame:
    """Trim, title-case, default and type the declared columns; others pass through."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changes = {}
    for c in spec.trimmed:
        text = trim_text(F.col(c).cast("string"), blank_is_null)
        changes[c] = title_case(text) if c in spec.titled else text
    for c, default in spec.ints.items():
        parsed = to_int(F.col(c), types[c])
        changes[c] = parsed if default is None else default_when_null(F.col(c), parsed, default)
    for c, default in spec.doubles.items():
        parsed = to_double(F.col(c))
        changes[c] = parsed if default is None else default_when_null(F.col(c), parsed, default)
    for c in spec.dates:
        changes[c] = parse_date(F.col(c), types[c])
    return df.withColumns(changes)


def dedupe(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Keep one row per dedupe key; datasets without such keys pass through."""
    return keep_one(df, spec.dedupe_keys) if spec.dedupe_keys else df


def lost_to_duplicates(df: DataFrame, spec: DatasetSpec) -> DataFrame | None:
    """The rows that ``dedupe`` leaves out, with ``n_copies``; None for datasets without such keys."""
    return losers(df, spec.dedupe_keys) if spec.dedupe_keys else None
