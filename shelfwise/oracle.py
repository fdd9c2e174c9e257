"""The registered queries as DuckDB SQL over the same tables, written independently of Spark.

Statements are put together from common table expressions; only those a query needs are included.
Window sorts name the place of NULLs, and text is cast with ``try_cast`` under a pattern, because
plain casts round and accept more than the library does.
"""

from __future__ import annotations

from collections import Counter

AS_OF = "date '2001-01-01'"


def _every(step: int, n: str = "n") -> str:
    return f"{n} % {step} = 0"


def _pad(text: str) -> str:
    return f"'  ' || {text} || ' '"


def _bad_item(x: str) -> str:
    return f"case when {_every(97)} then null when {_every(5)} then {_pad(x)} else {x} end"


def _bad_seller(x: str) -> str:
    return f"case when {_every(101)} then null when {_every(103)} then '   ' else {x} end"


def _bad_units(x: str) -> str:
    return (
        f"case when {_every(89)} then null when {_every(83)} then 'abc' "
        f"when {_every(79)} then '-' || {x} when {_every(73)} then {x} || '.5' else {x} end"
    )


def _bad_amount(x: str, missing: int, unreadable: int, negative: int, n: str = "n") -> str:
    text = f"cast(cast({x} as decimal(18,2)) as varchar)"
    return (
        f"case when {_every(missing, n)} then null when {_every(unreadable, n)} then 'x' "
        f"when {_every(negative, n)} then '-' || {text} else {text} end"
    )


def _bad_name(x: str, missing: int) -> str:
    return (
        f"case when {_every(missing)} then null when {_every(5)} then {_pad(x)} "
        f"when {_every(3)} then upper({x}) else {x} end"
    )


def _bad_date(x: str) -> str:
    return (
        f"case when {_every(59)} then null when {_every(53)} then '1999-13-45' "
        f"when {_every(47)} then year({x}) || '-' || month({x}) || '-' || day({x}) "
        f"when {_every(43)} then '2999-01-01' else strftime({x}, '%Y-%m-%d') end"
    )


def _initcap(x: str) -> str:
    words = f"string_split(lower({x}), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


def _trim(x: str) -> str:
    return f"trim({x}, ' ')"


def _int(x: str, default: str) -> str:
    number = f"try_cast(trunc(try_cast({x} as double)) as integer)"
    pattern = r"^\s*[+-]?\d*\.?\d*\s*$"
    return f"case when {x} is null then {default} when regexp_matches({x}, '{pattern}') then {number} end"


def _double(x: str, default: str) -> str:
    return f"case when {x} is null then {default} else try_cast({x} as double) end"


def _date(x: str) -> str:
    pattern = r"^\s*(\d{1,4})-0*(\d{1,2})-0*(\d{1,2})(\D|$)"
    parts = [
        f"lpad(regexp_extract({x}, '{pattern}', {i}), {width}, '0')"
        for i, width in ((1, 4), (2, 2), (3, 2))
    ]
    return f"case when regexp_matches({x}, '{pattern}') then try_cast({' || '.join([parts[0], chr(39) + '-' + chr(39), parts[1], chr(39) + '-' + chr(39), parts[2]])} as date) end"


def _first_failure(rules: list[tuple[str, str]]) -> str:
    whens = " ".join(f"when not coalesce({test}, false) then '{name}'" for name, test in rules)
    return f"case {whens} end"


def _first_failure_dropping(rules: list[tuple[str, str]]) -> str:
    whens = " ".join(f"when ({test}) is null then '' when not ({test}) then '{name}'" for name, test in rules)
    return f"case {whens} end"


_DATE_TEST = f"sale_date is not null and sale_date <= {AS_OF}"
_CATALOG_RULES = [
    ("missing_seller_id", "seller_id is not null"),
    ("missing_item_id", "item_id is not null"),
    ("price_negative", "marketplace_price >= 0"),
    ("stock_negative", "stock_qty >= 0"),
    ("missing_item_name", "item_name is not null"),
    ("missing_category", "category is not null"),
]
_COMPANY_RULES = [
    ("missing_item_id", "item_id is not null"),
    ("units_negative", "units_sold >= 0"),
    ("revenue_negative", "revenue >= 0"),
    ("invalid_sale_date", _DATE_TEST),
]
_COMPETITOR_RULES = [
    ("missing_item_id", "item_id is not null"),
    ("missing_seller_id", "seller_id is not null"),
    ("units_negative", "units_sold >= 0"),
    ("revenue_negative", "revenue >= 0"),
    ("price_negative", "marketplace_price >= 0"),
    ("invalid_sale_date", _DATE_TEST),
]
_CATALOG_COLUMNS = "seller_id, item_id, item_name, category, marketplace_price, stock_qty"
_COMPANY_COLUMNS = "item_id, units_sold, revenue, cast(sale_date as varchar) as sale_date"
_COMPETITOR_COLUMNS = (
    "item_id, seller_id, units_sold, revenue, marketplace_price, cast(sale_date as varchar) as sale_date"
)


def _text(columns: str, number: str) -> str:
    return columns.replace(number, f"cast({number} as varchar) as {number}")


def _sent(columns: str) -> str:
    """The columns as a message carries them: a missing one is empty text."""
    return ", ".join(f"coalesce({c}, '') as {c}" for c in columns.split(", "))


def _keep_one(source: str, keys: str, rest: list[str]) -> str:
    order = ", ".join(f"{c} asc nulls first" for c in rest)
    return (
        f"select * exclude (rn) from (select *, row_number() over (partition by {keys} "
        f"order by {order}) as rn from {source}) where rn = 1"
    )


_CATALOG_REST = ["item_name", "category", "marketplace_price", "stock_qty"]

# Name -> (text, names it is built on).
_PARTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "catalog": (
        """select distinct cast(l_suppkey as varchar) as seller_id, cast(l_partkey as varchar) as item_id,
           p_name as item_name, p_type as category, p_retailprice as marketplace_price, p_size as stock_qty
           from lineitem join part on l_partkey = p_partkey""",
        (),
    ),
    "company": (
        """select cast(l_partkey as varchar) as item_id, cast(l_quantity as integer) as units_sold,
           l_extendedprice as revenue, cast(l_shipdate as date) as sale_date
           from lineitem where not l_tax > 0.075""",
        (),
    ),
    "competitor": (
        """select cast(l_partkey as varchar) as item_id, cast(l_suppkey as varchar) as seller_id,
           case when l_returnflag = 'R' then 0 else cast(l_quantity as integer) end as units_sold,
           l_extendedprice as revenue from lineitem where l_tax > 0.075""",
        (),
    ),
    "dirty_catalog": (
        f"""select {_bad_seller("seller")} as seller_id, {_bad_item("item")} as item_id,
            {_bad_name("p_name", 67)} as item_name, {_bad_name("p_type", 107)} as category,
            {_bad_amount("price", 89, 83, 79)} as marketplace_price,
            case when {_every(73)} then null when {_every(71)} then '-' || p_size
                 else cast(p_size as varchar) end as stock_qty
            from (select cast(l_suppkey as varchar) as seller, cast(l_partkey as varchar) as item, p_name, p_type,
                         p_retailprice + l_linenumber as price, p_size, l_orderkey * 7 + l_linenumber as n
                  from lineitem join part on l_partkey = p_partkey)""",
        (),
    ),
    "sale_lines": (
        """select cast(l_partkey as varchar) as item, cast(l_suppkey as varchar) as seller,
           cast(cast(l_quantity as integer) as varchar) as units, l_extendedprice as amount,
           cast(l_shipdate as date) as day, l_tax > 0.075 as on_market, l_orderkey * 7 + l_linenumber as n
           from lineitem""",
        (),
    ),
    "dirty_company": (
        f"""select {_bad_item("item")} as item_id, {_bad_units("units")} as units_sold,
            {_bad_amount("amount", 71, 67, 61)} as revenue, {_bad_date("day")} as sale_date
            from sale_lines where not on_market""",
        ("sale_lines",),
    ),
    "dirty_competitor": (
        f"""select {_bad_item("item")} as item_id, {_bad_seller("seller")} as seller_id,
            {_bad_units("units")} as units_sold, {_bad_amount("amount", 71, 67, 61)} as revenue,
            {_bad_amount("amount", 89, 83, 79, "(n + 1)")} as marketplace_price, {_bad_date("day")} as sale_date
            from sale_lines where on_market""",
        ("sale_lines",),
    ),
    "clean_catalog": (
        f"""select {_trim("seller_id")} as seller_id, {_trim("item_id")} as item_id,
            {_initcap(_trim("item_name"))} as item_name, {_initcap(_trim("category"))} as category,
            try_cast(marketplace_price as double) as marketplace_price, {_int("stock_qty", "0")} as stock_qty
            from dirty_catalog""",
        ("dirty_catalog",),
    ),
    "clean_company": (
        f"""select {_trim("item_id")} as item_id, {_int("units_sold", "0")} as units_sold,
            {_double("revenue", "0.0")} as revenue, {_date("sale_date")} as sale_date from dirty_company""",
        ("dirty_company",),
    ),
    "clean_competitor": (
        f"""select {_trim("item_id")} as item_id, {_trim("seller_id")} as seller_id,
            {_int("units_sold", "0")} as units_sold, {_double("revenue", "0.0")} as revenue,
            {_double("marketplace_price", "0.0")} as marketplace_price, {_date("sale_date")} as sale_date
            from dirty_competitor""",
        ("dirty_competitor",),
    ),
    "one_catalog": (_keep_one("clean_catalog", "seller_id, item_id", _CATALOG_REST), ("clean_catalog",)),
    "one_company": (
        _keep_one("clean_company", "item_id", ["units_sold", "revenue", "sale_date"]),
        ("clean_company",),
    ),
    "tag_catalog": (f"select *, {_first_failure(_CATALOG_RULES)} as reason from one_catalog", ("one_catalog",)),
    "tag_company": (f"select *, {_first_failure(_COMPANY_RULES)} as reason from one_company", ("one_company",)),
    "tag_competitor": (
        f"select *, {_first_failure(_COMPETITOR_RULES)} as reason from clean_competitor",
        ("clean_competitor",),
    ),
    "good_catalog": ("select * exclude (reason) from tag_catalog where reason is null", ("tag_catalog",)),
    "good_company": ("select * exclude (reason) from tag_company where reason is null", ("tag_company",)),
    "good_competitor": ("select * exclude (reason) from tag_competitor where reason is null", ("tag_competitor",)),
    "failures": (
        """select 'seller_catalog' as dataset_name, seller_id, item_id, reason as dq_failure_reason
           from tag_catalog where reason is not null
           union all select 'company_sales', null, item_id, reason from tag_company where reason is not null
           union all select 'competitor_sales', seller_id, item_id, reason from tag_competitor
           where reason is not null""",
        ("tag_catalog", "tag_company", "tag_competitor"),
    ),
    "failures_dropping": (
        f"""select * from (
           select 'seller_catalog' as dataset_name, {_first_failure_dropping(_CATALOG_RULES)} as dq_failure_reason
           from one_catalog
           union all select 'company_sales', {_first_failure_dropping(_COMPANY_RULES)} from one_company
           union all select 'competitor_sales', {_first_failure_dropping(_COMPETITOR_RULES)} from clean_competitor)
           where dq_failure_reason <> ''""",
        ("one_catalog", "one_company", "clean_competitor"),
    ),
}

_PAIRS = "select distinct item_id, item_name, category from listings"


def _gold_parts() -> dict[str, tuple[str, tuple[str, ...]]]:
    """The report over relations named listings, company and competitor."""
    return {
        "item_meta": (_PAIRS, ("listings",)),
        "sellers": ("select distinct seller_id from listings", ("listings",)),
        "comp_agg": (
            "select item_id, cast(sum(units_sold) as bigint) as comp_units from company group by item_id",
            ("company",),
        ),
        "market_agg": (
            """select item_id, cast(sum(units_sold) as bigint) as market_units, count(seller_id) as seller_count,
               cast(sum(cast(revenue as decimal(18,2))) as double) as market_revenue
               from competitor group by item_id""",
            ("competitor",),
        ),
        "comp_meta": ("select * from comp_agg join item_meta using (item_id)", ("comp_agg", "item_meta")),
        "market_meta": ("select * from market_agg join item_meta using (item_id)", ("market_agg", "item_meta")),
        "top_company": (
            """select * exclude (rn) from (select *, row_number() over (partition by category
               order by comp_units desc nulls last, item_id asc nulls first, item_name asc nulls first) as rn
               from comp_meta) where rn <= 10""",
            ("comp_meta",),
        ),
        "top_market": (
            """select * exclude (rn) from (select *, row_number() over (partition by category
               order by market_units desc nulls last, item_id asc nulls first, item_name asc nulls first) as rn
               from market_meta) where rn <= 10""",
            ("market_meta",),
        ),
        "targets": (
            "select item_id, category from top_company union select item_id, category from top_market",
            ("top_company", "top_market"),
        ),
        "matrix": ("select * from sellers cross join targets", ("sellers", "targets")),
        "gap": (
            "select m.* from matrix m anti join listings l "
            "on l.seller_id = m.seller_id and l.item_id = m.item_id",
            ("matrix", "listings"),
        ),
        "gap_or_matrix": (
            "select * from gap union all select matrix.* from matrix, (select count(*) as n from gap) where n = 0",
            ("gap", "matrix"),
        ),
        "listed": ("select distinct seller_id, item_id from listings", ("listings",)),
        "facts": (
            """select t.item_id, t.category, m.market_units, m.seller_count, m.market_revenue, c.comp_units,
               coalesce(m.market_units / nullif(coalesce(m.seller_count, 1), 0),
                        cast(c.comp_units as double), 1.0) as expected_units_sold,
               coalesce(m.market_revenue / nullif(m.market_units, 0), 19.99) as market_price
               from targets t
               left join market_agg m on t.item_id = m.item_id
               left join comp_agg c on t.item_id = c.item_id""",
            ("targets", "market_agg", "comp_agg"),
        ),
        "measures": (
            _unfolded(
                "f.item_id, f.category, f.market_units, f.seller_count, f.market_revenue, f.comp_units, "
                "f.expected_units_sold, f.market_price, f.expected_units_sold * f.market_price as expected_revenue",
                "facts f",
            ),
            ("sellers", "facts", "listed"),
        ),
        "report": (
            _unfolded(
                "f.item_id, f.item_name, f.category, f.market_price, f.expected_units_sold, "
                "f.expected_units_sold * f.market_price as expected_revenue",
                "(select t.item_id, t.market_price, t.expected_units_sold, i.item_name, i.category "
                "from facts t join item_meta i on t.item_id = i.item_id) f",
            ),
            ("sellers", "facts", "listed", "item_meta"),
        ),
    }


def _unfolded(columns: str, source: str) -> str:
    """Rows of ``source`` f for every seller that does not list the item, or for all if each lists all."""
    return f"""select * exclude (unlisted, n_unlisted) from (
        select s.seller_id, {columns}, l.item_id is null as unlisted,
               count(case when l.item_id is null then 1 end) over () as n_unlisted
        from sellers s cross join {source}
        left join listed l on l.seller_id = s.seller_id and l.item_id = f.item_id)
        where unlisted or n_unlisted = 0"""


def _listings_from(relation: str) -> str:
    category = _trim(_initcap("coalesce(category, 'General')"))
    return (
        f"select distinct {_trim('seller_id')} as seller_id, {_trim('item_id')} as item_id, "
        f"{_trim('item_name')} as item_name, {category} as category from {relation} "
        "where seller_id is not null and item_id is not null"
    )


_GOLD = {**_PARTS, **_gold_parts(), "listings": (_listings_from("catalog"), ("catalog",))}

_EVERYONE = {
    **_GOLD,
    "sellers": ("select 'everyone' as seller_id", ()),
    "everyone_listings": ("select distinct 'everyone' as seller_id, item_id from listings", ("listings",)),
    "gap": (
        "select m.* from matrix m anti join everyone_listings l "
        "on l.seller_id = m.seller_id and l.item_id = m.item_id",
        ("matrix", "everyone_listings"),
    ),
}

_TWO_NAMES = {
    **_GOLD,
    "listings": (
        f"""select distinct cast(l_suppkey as varchar) as seller_id, cast(l_partkey as varchar) as item_id,
            'Item ' || l_partkey as item_name,
            {_initcap("case when l_tax > 0.075 then 'Market ' || p_type else p_type end")} as category
            from lineitem join part on l_partkey = p_partkey""",
        (),
    ),
}

_ONE_META = {
    **_TWO_NAMES,
    "item_meta": (
        """select item_id, item_name, category from (select *, row_number() over (partition by item_id
           order by item_name asc nulls first, category asc nulls first) as rn
           from (select distinct item_id, item_name, category from listings)) where rn = 1""",
        ("listings",),
    ),
}

_LAKE = {
    **_GOLD,
    "listings": (_listings_from("good_catalog"), ("good_catalog",)),
    "company": ("select * from good_company", ("good_company",)),
    "competitor": (
        """select * exclude (rn) from (select *, row_number() over (partition by sale_date, seller_id, item_id
           order by units_sold desc nulls last, revenue desc nulls last, marketplace_price desc nulls last) as rn
           from good_competitor) where rn = 1""",
        ("good_competitor",),
    ),
}

_UPSERT = {
    "batches": (
        """select cast(l_suppkey as varchar) as seller_id, cast(l_partkey as varchar) as item_id,
           p_type as category, l_linenumber as stock_qty, cast(l_shipdate as date) as day, l_tax > 0.075 as second
           from lineitem join part on l_partkey = p_partkey""",
        (),
    ),
    "snapshot": (
        """select seller_id, item_id, category, stock_qty, cast(day as varchar) as listed_on,
           case when second then 'market' end as channel
           from (select *, row_number() over (partition by category, seller_id, item_id
                 order by day desc nulls last, second desc, stock_qty desc nulls last) as rn from batches)
           where rn = 1""",
        ("batches",),
    ),
}


_MOVED = {
    "batches": (
        """select cast(l_suppkey as varchar) as seller_id, cast(l_partkey as varchar) as item_id,
           case when l_tax > 0.075 and l_partkey % 2 = 0 then 'Market ' || p_type else p_type end as category,
           l_linenumber as stock_qty, cast(l_shipdate as date) as day, l_tax > 0.075 as second
           from lineitem join part on l_partkey = p_partkey""",
        (),
    ),
    "snapshot": (
        """select seller_id, item_id, category, stock_qty, cast(day as varchar) as listed_on
           from (select *, row_number() over (partition by seller_id, item_id order by day desc nulls last,
                 second desc, category desc nulls last, stock_qty desc nulls last) as rn from batches)
           where rn = 1""",
        ("batches",),
    ),
}

_REPLAYED = {
    **_UPSERT,
    "snapshot": (
        """select seller_id, item_id, category, stock_qty, cast(day as varchar) as listed_on,
           cast(case when second then 2 else 1 end as bigint) as batch
           from (select *, row_number() over (partition by category, seller_id, item_id
                 order by second desc, stock_qty desc nulls last, day desc nulls last) as rn from batches)
           where rn = 1""",
        ("batches",),
    ),
}

_OTHER_KIND = "coalesce(try_cast(trim(item_id, ' ') as integer), 0) % 3 = 2"

_MIXED = {
    **_PARTS,
    "every_catalog": _PARTS["dirty_catalog"],
    "dirty_catalog": (
        f"""select seller_id, item_id, item_name, category, marketplace_price,
            case when not {_OTHER_KIND} then stock_qty end as stock_qty,
            case when {_OTHER_KIND} then 'web' end as channel from every_catalog""",
        ("every_catalog",),
    ),
    "clean_catalog": (
        _PARTS["clean_catalog"][0].replace("as stock_qty", "as stock_qty, channel"),
        ("dirty_catalog",),
    ),
}

_EVERY_SALE = {
    **_PARTS,
    "dirty_competitor": (_PARTS["dirty_competitor"][0].replace("where on_market", ""), ("sale_lines",)),
    "dirty_company": (
        "select item_id, units_sold, revenue, sale_date from dirty_competitor",
        ("dirty_competitor",),
    ),
    "competitor": (_LAKE["competitor"][0], ("good_competitor",)),
}

_LOADED = {
    "lost": (
        f"""select {_CATALOG_COLUMNS}, count(*) as n_copies from (
            select *, row_number() over (partition by seller_id, item_id order by
            {", ".join(f"{c} asc nulls first" for c in _CATALOG_REST)}) as rn from clean_catalog)
            where rn > 1 group by all""",
        ("clean_catalog",),
    ),
    "reconciled": (
        " union all ".join(
            f"""select '{dataset}' as dataset_name, (select count(*) from {source}) as n_read,
            (select count(*) from {source}) - count(*) as n_duplicates, count(reason) as n_rejected,
            cast(0 as bigint) as n_undecided, count(*) - count(reason) as n_accepted,
            (select count(*) from {stored}) as n_merged from {tagged}"""
            for dataset, source, tagged, stored in (
                ("seller_catalog", "clean_catalog", "tag_catalog", "good_catalog"),
                ("company_sales", "clean_company", "tag_company", "good_company"),
                ("competitor_sales", "clean_competitor", "tag_competitor", "competitor"),
            )
        ),
        ("clean_catalog", "tag_catalog", "good_catalog", "clean_company", "tag_company", "good_company",
         "clean_competitor", "tag_competitor", "competitor"),
    ),
}


def _build(final: str, needs: tuple[str, ...], parts: dict[str, tuple[str, tuple[str, ...]]]) -> str:
    """``final`` preceded by the expressions it needs, each after those it is built on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for other in parts[name][1]:
                add(other)
            ordered.append(name)

    for name in needs:
        add(name)
    # What several expressions read is worked out once, whatever the planner would do.
    uses = Counter(other for name in ordered for other in parts[name][1]) + Counter(needs)
    kind = {name: "as materialized" if uses[name] > 1 else "as" for name in ordered}
    expressions = ",\n".join(f"{name} {kind[name]} ({parts[name][0]})" for name in ordered)
    return f"with {expressions}\n{final}"


def _all(name: str, columns: str = "*", parts=_GOLD) -> str:
    return _build(f"select {columns} from {name}", (name,), parts)


_RECORD_COLUMNS = (
    "select '{dataset}' as dataset_name, reason as dq_failure_reason, {seller} as seller_id, item_id, "
    "{name} as item_name, {category} as category, {units} as units_sold, {revenue} as revenue, "
    "{price} as marketplace_price, {stock} as stock_qty, {day} as sale_date from {source} where reason is not null"
)
_QUARANTINE = " union all ".join(
    [
        _RECORD_COLUMNS.format(
            dataset="seller_catalog", seller="seller_id", name="item_name", category="category",
            units="cast(null as varchar)", revenue="cast(null as double)", price="marketplace_price",
            stock="cast(stock_qty as varchar)", day="cast(null as varchar)", source="tag_catalog",
        ),
        _RECORD_COLUMNS.format(
            dataset="company_sales", seller="null", name="null", category="null", units="cast(units_sold as varchar)",
            revenue="revenue", price="null", stock="null", day="cast(sale_date as varchar)", source="tag_company",
        ),
        _RECORD_COLUMNS.format(
            dataset="competitor_sales", seller="seller_id", name="null", category="null", units="cast(units_sold as varchar)",
            revenue="revenue", price="marketplace_price", stock="null", day="cast(sale_date as varchar)",
            source="tag_competitor",
        ),
    ]
)
_COUNT = "select dataset_name, dq_failure_reason, count(*) as n_rows from {} group by all"
_AFTER_RULES = _build(
    f"select {_CATALOG_COLUMNS} from kept",
    ("kept",),
    {
        **_PARTS,
        "tested": (
            f"select *, {_first_failure(_CATALOG_RULES)} as reason from clean_catalog",
            ("clean_catalog",),
        ),
        "passed": ("select * exclude (reason) from tested where reason is null", ("tested",)),
        "kept": (_keep_one("passed", "seller_id, item_id", _CATALOG_REST), ("passed",)),
    },
)
_TOTALS = (
    "seller_id, item_id, category, market_revenue, cast(market_units as varchar) as market_units, "
    "cast(seller_count as varchar) as seller_count, cast(comp_units as varchar) as comp_units"
)

ORACLE: dict[str, str] = {
    "clean_catalog": _all("clean_catalog", _text(_CATALOG_COLUMNS, "stock_qty")),
    "clean_company": _all("clean_company", _text(_COMPANY_COLUMNS, "units_sold")),
    "clean_competitor": _all("clean_competitor", _text(_COMPETITOR_COLUMNS, "units_sold")),
    "dq_catalog_accepted": _all("good_catalog", _CATALOG_COLUMNS),
    "dq_company_accepted": _all("good_company", _COMPANY_COLUMNS),
    "dq_competitor_accepted": _all("good_competitor", _COMPETITOR_COLUMNS),
    "dq_first_failure": _all("failures"),
    "dq_quarantine_json": _build(_QUARANTINE, ("tag_catalog", "tag_company", "tag_competitor"), _PARTS),
    "dq_summary": _build(_COUNT.format("failures"), ("failures",), _PARTS),
    "dq_summary_null_drop": _build(_COUNT.format("failures_dropping"), ("failures_dropping",), _PARTS),
    "dedupe_keep_one": _all("one_catalog", _CATALOG_COLUMNS),
    "dedupe_company_items": _all("one_company", _text(_COMPANY_COLUMNS, "units_sold")),
    "dedupe_after_rules": _AFTER_RULES,
    "distinct_listings": _build(_listings_from("dirty_catalog"), ("dirty_catalog",), _PARTS),
    "distinct_item_meta": _all("item_meta"),
    "distinct_sellers": _all("sellers"),
    "company_item_units": _all("comp_agg"),
    "market_item_totals": _all("market_agg"),
    "company_with_meta": _all("comp_meta"),
    "market_with_meta": _all("market_meta"),
    "top10_company": _all("top_company"),
    "top10_market": _all("top_market"),
    "target_items": _all("targets"),
    "seller_item_matrix": _all("matrix"),
    "assortment_gap": _all("gap"),
    "gap_or_full_matrix": _all("gap_or_matrix", parts=_EVERYONE),
    "gap_with_totals": _all("measures", _TOTALS),
    "expected_units": _all("measures", "seller_id, item_id, category, expected_units_sold"),
    "market_price": _all("measures", "seller_id, item_id, category, market_price"),
    "expected_revenue": _all("measures", "seller_id, item_id, category, expected_revenue"),
    "seller_report": _all("report"),
    "meta_fanout": _all("report", parts=_TWO_NAMES),
    "one_meta_per_item": _all("report", parts=_ONE_META),
    "upsert_latest": _all("snapshot", "seller_id, item_id, category, stock_qty, listed_on", _UPSERT),
    "upsert_evolved": _all("snapshot", parts=_UPSERT),
    "upsert_global_key": _all("snapshot", parts=_MOVED),
    "upsert_replayed": _all("snapshot", parts=_REPLAYED),
    "dedupe_losers": _all("lost", parts={**_PARTS, **_LOADED}),
    "load_reconciliation": _all("reconciled", parts={**_LAKE, **_LOADED}),
    "landing_inferred": _all(
        "catalog",
        "cast(seller_id as integer) as seller_id, cast(item_id as integer) as item_id, item_name, category, "
        "cast(marketplace_price as double) as marketplace_price, cast(stock_qty as integer) as stock_qty",
    ),
    "silver_stamped": _all("good_catalog", "seller_id, item_id, '2001-01-01 06:30:00' as ingestion_time"),
    "clean_every_sale": _all("clean_competitor", _text(_COMPETITOR_COLUMNS, "units_sold"), _EVERY_SALE),
    "dq_every_sale": _all(
        "tag_competitor",
        _text(_COMPETITOR_COLUMNS, "units_sold") + ", reason as dq_failure_reason",
        _EVERY_SALE,
    ),
    "dedupe_every_company_sale": _all("one_company", _text(_COMPANY_COLUMNS, "units_sold"), _EVERY_SALE),
    "silver_every_sale": _all("competitor", _COMPETITOR_COLUMNS, _EVERY_SALE),
    "landing_mixed_headers": _all("dirty_catalog", parts=_MIXED),
    "stream_mixed_headers": _all("good_catalog", _CATALOG_COLUMNS + ", channel", _MIXED),
    "stream_messages_to_silver": _build(
        f"select {_CATALOG_COLUMNS} from good_catalog union all "
        + " union all ".join(
            f"select null, '{m}', 'unreadable_message', null, null, null"
            for m in ("not json", '{"seller_id": "S1"', "[1, 2]")
        ),
        ("good_catalog",),
        _PARTS,
    ),
    "csv_bronze_roundtrip": _all("dirty_competitor"),
    "csv_bronze_catalog": _all("dirty_catalog"),
    "silver_snapshot_scan": _all("good_catalog", _CATALOG_COLUMNS),
    "silver_company": _all("company", _COMPANY_COLUMNS, _LAKE),
    "silver_competitor": _all("competitor", _COMPETITOR_COLUMNS, _LAKE),
    "report_csv_roundtrip": _all("report"),
    "medallion_end_to_end": _all("report", parts=_LAKE),
    "stream_messages": _all("dirty_company", _sent("item_id, units_sold, revenue, sale_date")),
    "stream_messages_catalog": _all("dirty_catalog", _sent(_CATALOG_COLUMNS)),
    "stream_messages_competitor": _all(
        "dirty_competitor",
        _sent("item_id, seller_id, units_sold, revenue, marketplace_price, sale_date"),
    ),
    "stream_landing_ingest": _all("good_catalog", _CATALOG_COLUMNS),
}
