"""Places of regular-expression matches, as DataFrame expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,value:string>>"


#: Matches of one block: a block's spans are gathered by themselves, since gathering copies them.
BLOCK = 128


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def match_spans(text: Column, pattern: Column | str) -> Column:
    """Leftmost non-overlapping matches: start and end in code points (end exclusive) and value.

    The text between matches and the matches themselves give the places by running length: first of
    whole blocks of matches, then within each block, so that many matches in one text cost little
    more than as many in several. The pattern must not match the empty string. Null text gives an
    empty array.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    text = F.coalesce(text, F.lit(""))
    pieces = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, pattern, F.lit(0)),
        lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")),
    )
    none = F.array().cast(SPAN)

    def step(done, piece):
        start = done["at"] + piece["gap"]
        end = start + F.length(piece["value"])
        span = F.struct(start.alias("start"), end.alias("end"), piece["value"].alias("value"))
        grown = F.struct(end.alias("at"), F.concat(done["found"], F.array(span)).alias("found"))
        return F.when(piece["value"].isNull(), done).otherwise(grown)

    def located(pieces):
        def block(first):
            return F.slice(pieces, first, F.lit(BLOCK))

        def passed(done, first):
            size = F.aggregate(
                block(first),
                F.lit(0),
                lambda n, p: n + p["gap"] + F.coalesce(F.length(p["value"]), F.lit(0)),
            )
            here = F.struct(first.alias("first"), done["at"].alias("at"))
            return F.struct(
                (done["at"] + size).alias("at"), F.concat(done["blocks"], F.array(here)).alias("blocks")
            )

        nothing = F.array().cast("array<struct<first:int,at:int>>")
        blocks = F.aggregate(
            F.sequence(F.lit(1), F.size(pieces), F.lit(BLOCK)),
            F.struct(F.lit(0).alias("at"), nothing.alias("blocks")),
            passed,
            lambda done: done["blocks"],
        )

        def spans(b):
            begin = F.struct(b["at"].alias("at"), none.alias("found"))
            return F.aggregate(block(b["first"]), begin, step, lambda done: done["found"])

        return F.flatten(F.transform(blocks, spans))

    return bound(pieces, lambda p: F.when(F.size(p) > 1, located(p)).otherwise(none))


def gated(condition: Column, spans: Column) -> Column:
    """``spans`` where the cheap condition holds, else none."""
    return F.when(condition, spans).otherwise(F.array().cast(SPAN))
