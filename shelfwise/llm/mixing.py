"""Mixing sources to target weights by Pfair scheduling.

A source of weight w owns one block in every 1/w places of the mix: its block k is released at
place floor(k / w) and due by place ceil((k + 1) / w). Placing at each step the released block that
is due first keeps every source, at every place, less than one block from its target.

Weights are whole parts of ``parts``, so that order repeats after ``parts`` places. One period is
worked out in advance (its size is a parameter) and joined to the blocks; everything else is ranks.
Where a source has placed its last block, which may be a part of one, a new phase begins: a new
schedule over the weights of the sources that remain. There is at most one phase a source.
Beyond ``most_sources`` the sources of least weight share one place in the schedule, by the sum of their
weights, and their number has no limit: there blocks follow each other by deadline on a clock of
their own, so that each is less than one block from its weight by that clock. A source that runs out
there leaves its places to the others there. These blocks are put in order by Spark, the driver sees sums.
A source's documents come in a fixed shuffled order, by a hash of id and text, in blocks of
``block_docs``. Ranks run over hash ranges whose number follows the source's size, so one large
source is ranked by many tasks.

Every row gets a place exactly once: none is dropped or repeated. ``in_mix`` holds in the first phase,
where the weights are those of all sources; ``phase`` says which one a row is in. A null source counts as
the empty one; rows without target weight for their source are an error. Repeated rows follow each
other. An empty table gives no rows. Same-named columns of the input are replaced.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.sources.scratch import materialise

PLACES = ("rank", "block", "slot", "position", "in_mix")


@dataclass(frozen=True)
class MixParams:
    """Without ``weights`` a source weighs its size to the power ``flattening``."""

    weights: dict[str, float] | None = None
    flattening: float = 0.7
    parts: int = 10_000
    block_docs: int = 16
    #: Text that ``in_mix_order`` brings together in one task, more where there would be more
    #: than ``most_regions`` tasks.
    region_bytes: int = 32 << 20
    most_regions: int = 50_000
    #: Sources with a schedule of their own, at most ``parts``; the others share one.
    most_sources: int = 200


def whole_parts(weights: dict[str, float], parts: int) -> dict[str, int]:
    """Shares of ``parts`` by largest remainder, at least one each."""
    if any(not w > 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    if len(weights) > parts:
        raise ValueError(f"{len(weights)} sources need more than {parts} parts")
    total, spare = sum(weights.values()), parts - len(weights)
    exact = {s: w / total * spare for s, w in weights.items()}
    shares = {s: 1 + int(x) for s, x in exact.items()}
    left = parts - sum(shares.values())
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[:left]:
        shares[s] += 1
    return shares


def one_period(shares: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, block, place) of one period: earliest deadline first among released blocks."""
    parts = sum(shares.values())
    waiting = [(0, s, 0) for s in sorted(shares)]
    ready: list[tuple[int, str, int]] = []
    placed = []
    for place in range(parts):
        while waiting and waiting[0][0] <= place:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * parts // shares[s]), s, k))
        _, s, k = heapq.heappop(ready)
        placed.append((s, k, place))
        if k + 1 < shares[s]:
            heapq.heappush(waiting, ((k + 1) * parts // shares[s], s, k + 1))
    return placed


@dataclass(frozen=True)
class Phase:
    """A schedule of ``n_slots`` from slot ``first`` on: shares of the sources still running, their
    blocks from and to, and the places of one period, as far as it is used."""

    first: int
    n_slots: int
    shares: dict[str, int]
    blocks: dict[str, tuple[int, int]]
    places: dict[str, list[int]]


def phases(sizes: dict[str, int], weights: dict[str, float], params: MixParams) -> list[Phase]:
    """Phase after phase, each up to the last block of the source that runs out next."""
    left = {s: -(-n // params.block_docs) for s, n in sizes.items()}
    done, first, found = dict.fromkeys(left, 0), 0, []
    while left:
        shares = whole_parts({s: weights[s] for s in left}, params.parts)
        places: dict[str, list[int]] = {s: [] for s in left}
        for s, _, place in one_period(shares):
            places[s].append(place)
        ends = {s: divmod(n - 1, shares[s]) for s, n in left.items()}
        n_slots = 1 + min(turn * params.parts + places[s][k] for s, (turn, k) in ends.items())
        turns, rest = divmod(n_slots, params.parts)
        placed = {s: turns * shares[s] + bisect_left(places[s], rest) for s in left}
        blocks = {s: (done[s], done[s] + n) for s, n in placed.items()}
        used = {s: places[s][: placed[s]] for s in left}
        found.append(Phase(first, n_slots, shares, blocks, used))
        first += n_slots
        done |= {s: end for s, (_, end) in blocks.items()}
        left = {s: n - placed[s] for s, n in left.items() if n > placed[s]}
    return found


@dataclass(frozen=True)
class Rare:
    """The sources that share one place in the schedule under ``name``: rows of each source, and
    the number in the common order of each source's blocks."""

    name: str
    sizes: DataFrame
    blocks: DataFrame


@dataclass(frozen=True)
class Schedule:
    """What the sizes of the sources decide."""

    params: MixParams
    sizes: dict[str, int]
    phases: list[Phase]
    n_rows: int
    n_bytes: int
    rare: Rare | None = None

    @property
    def n_slots(self) -> int:
        return self.phases[-1].first + self.phases[-1].n_slots


def schedule(
    docs: DataFrame, params: MixParams, source: str, weigh: bool = False
) -> Schedule | None:
    """The schedule of ``docs``, or None if there are no rows; ``weigh`` adds up their text, too."""
    n_bytes = F.sum(F.octet_length("text") if weigh else F.lit(0)).alias("bytes")
    counted = docs.groupBy(_source(source).alias("s")).agg(F.count("*").alias("n"), n_bytes)
    most = min(params.most_sources, params.parts)
    found = counted.limit(most + 1).collect()
    if len(found) > most:
        return _schedule_with_rare(materialise(counted, "mix-sources"), params, most)
    sizes = {r["s"]: r["n"] for r in found}
    weights = params.weights or {s: n**params.flattening for s, n in sizes.items()}
    _all_weighed(sorted(sizes.keys() - weights.keys()))
    if not sizes:
        return None
    n_bytes = sum(r["bytes"] or 0 for r in found)
    return Schedule(params, sizes, phases(sizes, weights, params), sum(sizes.values()), n_bytes)


def _all_weighed(missing: list[str]) -> None:
    if missing:
        raise ValueError(f"no target weight for {missing[:5]}")


def _schedule_with_rare(counted: DataFrame, params: MixParams, most: int) -> Schedule:
    """All but the ``most - 1`` sources of greatest weight share one place."""
    weight = F.pow("n", F.lit(params.flattening))
    if params.weights:
        given = _small_table(counted.sparkSession, list(params.weights.items()), "s: string, w: double")
        counted, weight = counted.join(given, "s", "left"), F.col("w")
    weighed = materialise(counted.withColumn("w", weight), "mix-weights")
    _all_weighed([r["s"] for r in weighed.filter("w is null").orderBy("s").limit(5).collect()])
    if weighed.filter("not w > 0").limit(1).count():
        raise ValueError("weights must be positive")
    top = weighed.orderBy(F.desc("w"), "s").limit(most - 1).collect()
    rest = weighed.filter(~F.col("s").isin([r["s"] for r in top]))
    n_blocks = F.ceil(F.col("n") / params.block_docs)
    blocks, share = rest.agg(F.sum(n_blocks), F.sum("w")).first()
    n_rows, n_bytes = weighed.agg(F.sum("n"), F.sum("bytes")).first()
    name = "rare"
    while any(r["s"] == name for r in top):
        name += "-"
    sizes = {r["s"]: r["n"] for r in top}
    weights = params.weights or {s: n**params.flattening for s, n in sizes.items()}
    found = phases(
        {**sizes, name: blocks * params.block_docs}, {**{s: weights[s] for s in sizes}, name: share}, params
    )
    rare = Rare(name, rest.select(F.col("s").alias("_s"), F.col("n").alias("_n")), _by_clock(rest, n_blocks, blocks))
    return Schedule(params, sizes, found, n_rows, n_bytes or 0, rare)


def _by_clock(rest: DataFrame, n_blocks: Column, total: int, chunk: int = 4096) -> DataFrame:
    """(source, block, number) of all blocks of ``rest`` in the order of their deadlines."""
    each = rest.withColumn("blocks", n_blocks).select(
        "s", "w", "blocks", F.explode(F.expr(f"sequence(0L, (blocks - 1) div {chunk})")).alias("c")
    )
    last = F.least((F.col("c") + 1) * chunk, "blocks") - 1
    each = each.select("s", "w", F.explode(F.sequence(F.col("c") * chunk, last)).alias("block"))
    order = ("deadline", "s", "block")
    each = each.withColumn("deadline", (F.col("block") + 1) / F.col("w")).select(*order)
    n_tasks = max(1, -(-total // (1 << 18)))
    each = each.repartitionByRange(n_tasks, *order).withColumn("task", F.spark_partition_id())
    each = materialise(each, "mix-rare")  # what a task holds must not change any more
    before = W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)  # one row a task
    firsts = each.groupBy("task").count()
    firsts = firsts.select("task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    number = F.row_number().over(W.partitionBy("task").orderBy(*order)) - 1 + F.col("first")
    numbered = each.join(firsts, "task")
    return materialise(
        numbered.select(F.col("s").alias("_s"), "block", number.cast("long").alias("_at")), "mix-clock"
    )


def _source(source: str) -> Column:
    return F.coalesce(F.col(source), F.lit(""))


def _small_table(spark: SparkSession, rows: list[tuple], fields: str) -> DataFrame:
    """A table of ``fields``. It goes to Spark as one literal: rows made by ``createDataFrame``
    would be read through Python workers in every executor."""
    names = [field.split(":")[0].strip() for field in fields.split(", ")]
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    table = F.from_json(F.lit(text), f"array<struct<{fields}>>")
    return spark.range(0, 1, 1, 1).select(F.inline(table))


def _dealt(docs: DataFrame, kept: list[str], found: Schedule, source: str) -> DataFrame:
    """``kept`` columns with the source, the draw and the draw's bucket of each row."""
    bucket_rows = max(256, isqrt(found.n_rows))
    plan = _small_table(
        docs.sparkSession,
        [(s, -(-n // bucket_rows)) for s, n in found.sizes.items()],
        "_s: string, _buckets: bigint",
    )
    if found.rare is None:
        plan = F.broadcast(plan)
    else:  # a written table, whose size Spark knows
        buckets = F.ceil(F.col("_n") / bucket_rows).alias("_buckets")
        plan = materialise(plan.unionByName(found.rare.sizes.select("_s", buckets)), "mix-plan")
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("mix"), "doc_id", "text"), 33)
    high = F.col("_draw").cast("double") / F.lit(float(1 << 31))
    return (
        docs.select(*kept, _source(source).alias("_s"), draw.alias("_draw"))
        .join(plan, "_s")
        .withColumn("_bucket", F.floor(high * F.col("_buckets")))
    )


def _placed(
    dealt: DataFrame, found: Schedule, number: Callable[[], Column] = F.row_number
) -> DataFrame:
    """``dealt`` rows with rank, block, phase and slot. The joined tables are small: one row a
    bucket, one a source and phase, and at most ``parts`` rows a phase; but there is one a block of
    the sources that share a place."""
    before = W.partitionBy("_s").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = dealt.groupBy("_s", "_bucket").count()
    first = F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first")
    firsts = materialise(counts.select("_s", "_bucket", first), "mix-buckets")
    own = W.partitionBy("_s", "_bucket").orderBy("_draw", "doc_id")
    ranked = dealt.withColumn("_n", number().over(own)).join(firsts, ["_s", "_bucket"])
    return _slotted(ranked.withColumn("rank", F.col("_first") + F.col("_n") - 1), found)


def _slotted(ranked: DataFrame, found: Schedule) -> DataFrame:
    params = found.params
    spark, numbered = ranked.sparkSession, list(enumerate(found.phases))
    starts = _small_table(
        spark,
        [(s, i, *p.blocks[s], p.shares[s], p.first) for i, p in numbered for s in p.shares],
        "_of: string, phase: bigint, _start: bigint, _end: bigint, _share: bigint, _slot: bigint",
    )
    places = _small_table(
        spark,
        [(s, i, used) for i, p in numbered for s, used in p.places.items() if used],
        "_s: string, phase: bigint, _places: array<bigint>",
    ).select("_s", "phase", F.posexplode("_places").alias("_k", "_place"))
    block = F.col("block")
    ranked = ranked.withColumn("block", F.floor(F.col("rank") / params.block_docs))
    if found.rare is not None:
        name = F.when(F.col("_at").isNull(), F.col("_s")).otherwise(found.rare.name)
        ranked = ranked.join(found.rare.blocks, ["_s", "block"], "left").withColumn("_s", name)
        block = F.coalesce("_at", "block")
    here = (F.col("_s") == F.col("_of")) & (block >= F.col("_start")) & (block < F.col("_end"))
    ranked = ranked.join(F.broadcast(starts), here).withColumn("_in", block - F.col("_start"))
    ranked = ranked.withColumn("_k", (F.col("_in") % F.col("_share")).cast("int"))
    turn = F.floor(F.col("_in") / F.col("_share"))
    slot = F.col("_slot") + turn * params.parts + F.col("_place")
    return ranked.join(F.broadcast(places), ["_s", "phase", "_k"]).withColumn("slot", slot)


def mix(docs: DataFrame, params: MixParams | None = None, source: str = "source") -> DataFrame:
    """``docs`` with phase, rank and block in the source, slot of the block, position, and in_mix."""
    params = params or MixParams()
    kept = [c for c in docs.columns if c not in ("phase", *PLACES)]
    found = schedule(docs, params, source)
    if found is None:
        long = F.lit(0).cast("long")
        return docs.select(
            *kept, *[long.alias(c) for c in ("phase", *PLACES[:-1])], F.lit(True).alias("in_mix")
        )
    position = F.col("slot") * params.block_docs + F.col("rank") % params.block_docs
    held = [F.col(c).alias(f"_in_{c}") for c in kept]  # so that they meet no name used here
    return (
        _placed(_dealt(docs, [*held, "doc_id"], found, source), found)
        .withColumn("position", position)
        .withColumn("in_mix", F.col("phase") == 0)
        .select(*[F.col(f"_in_{c}").alias(c) for c in kept], "phase", *PLACES)
    )


def in_mix_order(
    docs: DataFrame, params: MixParams | None = None, source: str = "source"
) -> DataFrame:
    """The rows of ``docs``, partition after partition in the order of the mix.

    The texts are shuffled once. Places are first worked out for numbers alone (source, draw, id);
    from them each hash bucket learns the draws at which its rows pass from one region of the mix
    to the next, so that the scan sends every text straight to its region, where the places are
    worked out again from the regions' first ranks. A region has about ``region_bytes`` of text.
    Repeated rows (same id and text) stay in one region, even if that takes some past its end.
    Where sources share a place, the texts go through the joins that place them.
    """
    found = schedule(docs, params or MixParams(), source, weigh=True)
    if found is None:
        return docs
    sent, n_regions = _sent(docs, found, source)
    if found.rare is not None:
        in_order = sent.repartitionById(n_regions, "_region").sortWithinPartitions("slot", "rank")
        return in_order.select(*[F.col(f"_in_{c}").alias(c) for c in docs.columns])
    sent = sent.repartitionById(n_regions, "_region")
    own = W.partitionBy("_region", "_s", "_bucket").orderBy("_draw", "doc_id")
    ranked = sent.withColumn("rank", F.col("_cut.first") + F.row_number().over(own) - 1)
    in_order = _slotted(ranked, found).sortWithinPartitions("slot", "rank")
    return in_order.select(*[F.col(f"_in_{c}").alias(c) for c in docs.columns])


def in_regions(
    docs: DataFrame, params: MixParams | None = None, source: str = "source"
) -> DataFrame:
    """``docs`` with ``region``, the number from 0 of the region of the mix that a row is in: the
    partitions of ``in_mix_order``, but nothing is moved there."""
    found = schedule(docs, params or MixParams(), source, weigh=True)
    if found is None:
        return docs.withColumn("region", F.lit(0))
    sent, _ = _sent(docs, found, source)
    kept = [F.col(f"_in_{c}").alias(c) for c in docs.columns if c != "region"]
    return sent.select(*kept, F.col("_region").alias("region"))


def _sent(docs: DataFrame, found: Schedule, source: str) -> tuple[DataFrame, int]:
    """``docs`` with ``_cut`` (where no sources share a place, else slot and rank) and ``_region``, its
    columns as ``_in_...``, and how many regions."""
    params = found.params
    n_regions = max(1, min(found.n_rows, params.most_regions, -(-found.n_bytes // params.region_bytes)))
    region = F.floor(F.col("slot") * n_regions / found.n_slots).cast("int")
    kept = [F.col(c).alias(f"_in_{c}") for c in docs.columns]
    if found.rare is not None:
        placed = _placed(_dealt(docs, [*kept, "doc_id"], found, source), found)
        return placed.withColumn("_region", region), n_regions
    key = F.struct("_draw", "doc_id")
    numbers = _dealt(docs, ["doc_id"], found, source)
    cuts = (
        _placed(numbers, found, F.rank)
        .groupBy("_s", "_bucket", region.alias("region"))
        .agg(F.min(key).alias("start"), F.min("rank").alias("first"))
        .groupBy("_s", "_bucket")
        .agg(F.collect_list(F.struct("region", "start", "first")).alias("_cuts"))
    )
    cuts = materialise(cuts, "mix-cuts")
    dealt = _dealt(docs, [*kept, "doc_id"], found, source).join(cuts, ["_s", "_bucket"])
    passed = F.filter("_cuts", lambda cut: cut["start"] <= key)
    sent = dealt.withColumn("_cut", F.array_max(passed)).drop("_cuts")
    return sent.withColumn("_region", F.col("_cut.region")), n_regions
