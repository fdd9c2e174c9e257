"""Exact near-duplicate join: word-shingle sets whose Jaccard similarity reaches a threshold.

Jaccard distance is a metric. Two sets link when their distance is at most eps = 1 - threshold.

* Equal sets are one node.
* **Pivots**: single shingles. A set is nearest to the pivots it contains, all at the same distance,
  and ties go to the smallest hashes. A partner within eps lacks at most eps * n of a set's n
  shingles, so a set enters the regions of its first eps * n + 1 + slack pivots: this window
  replicates boundary sets so far that every linked pair meets in a region.
* **Crowded regions** (more than ``crowd`` nodes) belong to shared passages or to large groups of
  copies. A set with enough uncrowded pivots is *free*: it meets its free partners in uncrowded
  regions, and is left out of the crowded ones unless a set that is not free is there.
* **Recursion**: each region first joins with one of its nodes, its leader; what links is verified
  exactly and components are formed. Only pairs of different components are joined further: those
  of uncrowded regions by counting common pivots and then whole sets, those of crowded ones under
  their leader in blocks of a window of sizes, where only links that join components are kept. A set
  waits there only if its crowded pivots are as many as a linked set must share with it.

Documents come out with the smallest id of their component. Null text and texts without words have an
empty set and link with nothing. Repeated rows count as equal sets; a null id is never a component's
id unless all are null. Only ``doc_id`` and ``text`` are read. Hashes of 64 bits stand for shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.bit_filter import maybe_in
from shelfwise.llm.components import connected_components
from shelfwise.llm.textops import chain, mix, slices, word_hashes
from shelfwise.sources.scratch import freed_shuffles, materialise

# Bytes of text whose sets a task computes at a time: nothing is combined within them.
SLICE = 1 << 19

_SETS = "doc_id long, text_key long, n_shingles long, node long"


@dataclass(frozen=True)
class JaccardParams:
    words: int = 4
    percent: int = 85
    crowd: int = 24
    block_shingles: int = 150_000
    class_width: int = 1
    broadcast_rows: int = 250_000

    def spare(self, n):
        """Shingles of a set of ``n`` that a linked set may lack."""
        return (100 - self.percent) * n // 100

    def window(self, n):
        """Pivots that a set of ``n`` enters."""
        spare = self.spare(n)
        return min(n, spare + 1 + max(4, spare))


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct hashes of its shingles."""
    hashes, first = word_hashes(column)
    if len(hashes) >= words:
        parts = [hashes[k : len(hashes) - words + 1 + k] for k in range(words)]
        shingles = chain(*parts)
    for begin, end in zip(first[:-1], first[1:], strict=True):
        if end - begin >= words:
            yield np.unique(shingles[begin : end - words + 1])
        elif end > begin:
            yield chain(*[hashes[k : k + 1] for k in range(begin, end)])
        else:
            yield hashes[:0]


def _node(own: np.ndarray) -> int:
    """One number for a whole set."""
    weights = mix(np.arange(1, len(own) + 1, dtype=np.uint64)) | np.uint64(1)
    return int(mix((own * weights).sum(keepdims=True)).view(np.int64)[0])


def _sets(docs: DataFrame, params: JaccardParams) -> DataFrame:
    """Per row: set size and node."""

    def read(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                own = list(shingle_sets(part.column("text"), params.words))
                nodes = [_node(s) if len(s) else None for s in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_key"),
                        pa.array([len(s) for s in own], pa.int64()),
                        pa.array(nodes, pa.int64()),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "node"],
                )

    return _keyed(docs).mapInArrow(read, _SETS)


def _entries(docs: DataFrame, params: JaccardParams) -> DataFrame:
    """(pivot, node) of the pivots that sets enter; equal sets of a task enter once.

    The texts are read again for this, so that their many pivots are shuffled but never stored.
    """

    def read(batches):
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                pivots, nodes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for own in shingle_sets(part.column("text"), params.words):
                    if not len(own) or (node := _node(own)) in seen:
                        continue
                    if len(seen) > 1_000_000:
                        seen.clear()
                    seen.add(node)
                    pivots.append(own[: params.window(len(own))])
                    nodes.append(np.full(len(pivots[-1]), node))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(pivots).view(np.int64)),
                        pa.array(np.concatenate(nodes)),
                    ],
                    names=["pivot", "node"],
                )

    return docs.select("text").mapInArrow(read, "pivot long, node long")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a hash of the text, by which the row of a node is found again."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_key().alias("text_key"))


def _text_key() -> Column:
    return F.xxhash64("text")


def _shared_pivots(docs: DataFrame, params: JaccardParams) -> DataFrame:
    """(pivot, node, crowded, leader) of pivots that several nodes enter.

    Rows arrive by pivot and node. A run of one pivot is held until it is longer than ``crowd``;
    from then on it streams through. An uncrowded region is led by its smallest node.
    """

    def read(batches):
        held_pivot, held, last = np.zeros(0, np.int64), np.zeros(0, np.int64), None

        def emit(pivot, node, crowded, leader):
            return pa.RecordBatch.from_arrays(
                [pa.array(pivot), pa.array(node), pa.array(crowded), pa.array(leader)],
                names=["pivot", "node", "crowded", "leader"],
            )

        crowd_pivot = None
        for batch in batches:
            pivot = np.concatenate([held_pivot, batch.column("pivot").to_numpy()])
            node = np.concatenate([held, batch.column("node").to_numpy()])
            if not len(pivot):
                continue
            new = np.ones(len(pivot), bool)
            new[1:] = (pivot[1:] != pivot[:-1]) | (node[1:] != node[:-1])
            if last is not None:
                new[0] = (pivot[0], node[0]) != last
            pivot, node = pivot[new], node[new]
            if not len(pivot):
                held_pivot, held = pivot, node
                continue
            begins = np.flatnonzero(np.append(True, pivot[1:] != pivot[:-1]))
            size = np.diff(np.append(begins, len(pivot)))
            run = np.repeat(np.arange(len(begins)), size)
            crowded_run = size > params.crowd
            if crowd_pivot is not None and pivot[0] == crowd_pivot:
                crowded_run[0] = True
            open_run = run == len(begins) - 1
            streams = bool(crowded_run[-1])
            ready = ((size > 1) | crowded_run)[run] & (~open_run | streams)
            leader = node[begins][run[ready]]
            yield emit(pivot[ready], node[ready], crowded_run[run[ready]], leader)
            crowd_pivot = pivot[-1] if streams else None
            if streams:
                last = (pivot[-1], node[-1])
                held_pivot, held = pivot[:0], node[:0]
            else:
                last = None
                held_pivot, held = pivot[open_run], node[open_run]
        if len(held) > 1:
            yield emit(held_pivot, held, np.zeros(len(held), bool), np.full(len(held), held[0]))

    by_pivot = _entries(docs, params).repartition("pivot").sortWithinPartitions("pivot", "node")
    return by_pivot.mapInArrow(read, "pivot long, node long, crowded boolean, leader long")


def _node_facts(sets: DataFrame, shared: DataFrame, params: JaccardParams) -> DataFrame:
    """Per node with shared pivots: set size, pivots it may count on, and whether it is free."""
    rep = F.min(F.struct("doc_id", "text_key"))
    nodes = sets.filter("node is not null").groupBy("node").agg(
        F.first("n_shingles").alias("n"), rep.alias("rep")
    )
    crowded = shared.groupBy("node").agg(F.count_if("crowded").alias("n_crowded"))
    need_all = _need_all(F.col("n"), params)
    return crowded.join(nodes, "node").select(
        "node",
        "n",
        "rep.doc_id",
        "rep.text_key",
        need_all.alias("need_all"),
        (need_all - F.col("n_crowded")).alias("need"),
    )


def _need_all(n: Column, params: JaccardParams) -> Column:
    """Pivots of its window that a set of ``n`` shares with a linked one, unless that one needs fewer."""
    spare = F.floor(F.lit(100 - params.percent) * n / 100)
    window = F.least(n, spare + 1 + F.greatest(F.lit(4), spare))
    return window - spare


def _sizes_fit(n_a: Column, n_b: Column, params: JaccardParams) -> Column:
    return 100 * F.least(n_a, n_b) >= params.percent * F.greatest(n_a, n_b)


def _with_texts(
    docs: DataFrame, rows: DataFrame, facts: DataFrame, params: JaccardParams
) -> DataFrame:
    """``rows`` with the text of their node.

    Up to ``broadcast_rows`` rows go to the scan of the documents; more are joined by a shuffle, of
    those documents that a filter lets through.
    """
    named = {"doc_id": "its_id", "text_key": "its_key"}
    rows = rows.join(facts.select("node", "doc_id", "text_key").withColumnsRenamed(named), "node")
    rows = materialise(rows, "wanted")
    keyed = _keyed(docs)
    few = rows.count() <= params.broadcast_rows
    if not few:
        on, keys_on = [F.col(c) for c in named], [F.col(c) for c in named.values()]
        keyed, _ = maybe_in(keyed, on, rows, keys_on, params.broadcast_rows)
    same = F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("text_key") == F.col("its_key"))
    found = keyed.join(F.broadcast(rows) if few else rows, same)
    return found.select(*[c for c in rows.columns if c not in named.values()], "text")


def _verified(
    docs: DataFrame, pairs: DataFrame, facts: DataFrame, params: JaccardParams
) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets."""
    sides = F.explode(F.array("a", "b")).alias("node")
    texts = _with_texts(docs, pairs.select("a", "b", sides), facts, params)
    side = lambda c: F.max(F.when(F.col("node") == F.col(c), F.col("text"))).alias(f"text_{c}")
    both = texts.groupBy("a", "b").agg(side("a"), side("b"))

    def compare(batches):
        for batch in batches:
            for part in slices(batch, "text_a", SLICE):
                a = list(shingle_sets(part.column("text_a"), params.words))
                rights = part.column("text_b")
                keep = np.zeros(part.num_rows, bool)
                at = 0
                for sub in slices(part.select(["text_b"]), "text_b", SLICE):
                    for b in shingle_sets(sub.column("text_b"), params.words):
                        own = a[at]
                        common = len(np.intersect1d(own, b, assume_unique=True))
                        union = len(own) + len(b) - common
                        keep[at] = 100 * common >= params.percent * union
                        at += 1
                assert at == len(rights)
                yield part.select(["a", "b"]).filter(pa.array(keep))

    return both.mapInArrow(compare, "a long, b long")


def _labelled(facts: DataFrame, links: DataFrame) -> DataFrame:
    """``facts`` with the component that the links so far make."""
    found = connected_components(links)
    return facts.join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )


def _off_centre() -> Column:
    """Small for nodes whose pivots are crowded, as those of the text that copies stem from are."""
    return (F.col("need") / F.col("need_all")).alias("off_centre")


def _leader_pairs(shared: DataFrame, facts: DataFrame, params: JaccardParams) -> DataFrame:
    """Each node with the leaders of its regions, if they share enough pivots to be promising."""
    own = facts.select("node", "n", "need", "need_all")
    crowded = shared.filter("crowded").select("pivot", "node")
    crowded = crowded.join(own.filter("need < 1"), "node")
    leaders = crowded.groupBy("pivot").agg(F.min(F.struct(_off_centre(), "node")).alias("l"))
    crowded = crowded.join(leaders, "pivot").select("l.node", crowded["node"])
    uncrowded = shared.filter("not crowded").select("leader", "node")
    a, b = own.select(*[F.col(c).alias(f"{c}_a") for c in own.columns]), own
    pairs = (
        uncrowded.union(crowded)
        .filter("leader != node")
        .groupBy(F.col("leader").alias("node_a"), "node")
        .agg(F.count("*").alias("common"))
        .join(b, "node")
        .join(a, "node_a")
    )
    least = F.least("need", "need_a")
    promising = (2 * F.col("common") >= F.greatest(least, F.lit(2))) & _sizes_fit(
        F.col("n"), F.col("n_a"), params
    )
    return pairs.filter(promising).select(F.col("node_a").alias("a"), F.col("node").alias("b"))


def _uncrowded_pairs(entries: DataFrame, tested: DataFrame, params: JaccardParams) -> DataFrame:
    """Pairs of different components with enough common pivots in uncrowded regions."""
    member = F.struct("node", "n", "need", "component")
    regions = (
        entries.filter(~F.col("crowded"))
        .groupBy("pivot")
        .agg(F.array_sort(F.collect_list(member)).alias("m"))  # at most ``crowd`` of them
        .filter(F.exists("m", lambda x: x["component"] != F.col("m")[0]["component"]))
    )
    pairs = F.flatten(
        F.transform(
            "m",
            lambda x, i: F.transform(
                F.filter(
                    F.slice("m", i + 2, F.size("m")),
                    lambda y: (y["component"] != x["component"])
                    & _sizes_fit(x["n"], y["n"], params),
                ),
                lambda y: F.struct(
                    x["node"].alias("a"),
                    y["node"].alias("b"),
                    F.least(x["need"], y["need"]).alias("need"),
                ),
            ),
        )
    )
    counted = (
        regions.select(F.explode(pairs).alias("p"))
        .groupBy("p.a", "p.b")
        .agg(F.count("*").alias("common"), F.first("p.need").alias("need"))
        .filter(F.col("common") >= F.col("need"))
    )
    either = tested.unionByName(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return counted.select("a", "b").join(either, ["a", "b"], "left_anti")


def _crowded_links(
    docs: DataFrame, entries: DataFrame, facts: DataFrame, params: JaccardParams
) -> DataFrame:
    """Links between components whose nodes may meet in crowded regions only.

    At least one node of such a link is not free. A leader's region is cut into classes by size,
    and a class into blocks of so many shingles. Members wait in a block; those that are not free
    visit all blocks of the classes that a set linked to them can be in, again block by block. A
    task compares a block of visitors with a block of members by their whole sets and returns the
    links that join two components there: fewer than it has rows.

    Linked sets share as many pivots of their windows as one of the two needs. Where no region that is
    not crowded has both, all of these are crowded pivots of both, and the other set is no smaller
    than the threshold allows. So a set with fewer crowded pivots than the smallest such set needs
    meets its partners elsewhere and is left out.
    """
    crowded = entries.filter("crowded").drop("leader")
    leaders = crowded.filter("need < 1").groupBy("pivot").agg(F.min(F.struct(_off_centre(), "node"))["node"].alias("leader"))
    wide = params.class_width * float(np.log(100 / params.percent))
    size_class = lambda n: F.floor(F.log(n) / wide)
    smallest = F.ceil(F.col("n") * params.percent / 100)
    enough = F.col("need_all") - F.col("need") >= _need_all(smallest, params)
    members = materialise(
        crowded.filter(enough)
        .join(leaders, "pivot")
        .select("leader", "node", "n", "need", "component")
        .distinct()
        .withColumn("class", size_class(F.col("n"))),
        "crowded-members",
    )
    least = F.ceil(F.col("n") * params.percent / 100)
    most = F.floor(F.col("n") * 100 / params.percent)
    classes = F.explode(F.sequence(size_class(least), size_class(most)))
    visitors = members.filter("need < 1").withColumnRenamed("class", "home")
    visitors = visitors.withColumn("class", classes)
    ends = [F.min("component").alias("low"), F.max("component").alias("high")]
    here = members.groupBy("leader", "class").agg(F.sum("n").alias("size"), *ends)
    there = visitors.groupBy("leader", "class").agg(
        F.min("component").alias("v_low"),
        F.max("component").alias("v_high"),
        F.sum("n").alias("v_size"),
    )
    busy = here.join(there, ["leader", "class"]).filter(
        F.least("low", "v_low") < F.greatest("high", "v_high")
    )
    blocks = lambda size: F.ceil(F.col(size) / params.block_shingles).cast("int")
    busy = materialise(
        busy.select(
            "leader", "class", blocks("size").alias("blocks"), blocks("v_size").alias("v_blocks")
        ),
        "crowded-classes",
    )
    dealt = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    places = ["leader", "class", "block", "v_block", "node", "component", "waits", "visits"]
    waiting = members.join(busy, ["leader", "class"]).withColumn("v_block", every("v_blocks"))
    waiting = waiting.withColumns(
        {
            "block": dealt("blocks"),
            "waits": F.lit(True),
            "visits": (F.col("need") < 1) & (F.col("v_block") == dealt("v_blocks")),
        }
    ).select(*places)
    visiting = visitors.join(busy, ["leader", "class"]).withColumn("block", every("blocks"))
    visiting = (
        visiting.filter((F.col("class") != F.col("home")) | (F.col("block") != dealt("blocks")))
        .withColumns(
            {"v_block": dealt("v_blocks"), "waits": F.lit(False), "visits": F.lit(True)}
        )
        .select(*places)
    )
    rows = waiting.unionByName(visiting)
    together = _with_texts(docs, rows, facts, params)

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        part = part.reset_index(drop=True)
        sets = [
            own
            for piece in slices(pa.RecordBatch.from_pandas(part[["text"]]), "text", SLICE)
            for own in shingle_sets(piece.column("text"), params.words)
        ]
        visits, node = part["visits"].to_numpy(), part["node"].to_numpy()
        waiting = np.flatnonzero(part["waits"].to_numpy())
        if not len(waiting) or not visits.any():
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        sizes = np.array([len(sets[k]) for k in waiting], np.int64)
        values, at = np.unique(np.concatenate([sets[k] for k in waiting]), return_inverse=True)
        order = np.argsort(at, kind="stable")
        holders = np.repeat(np.arange(len(waiting)), sizes)[order]
        first = np.searchsorted(at[order], np.arange(len(values) + 1))
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = x = parent.get(parent[x], parent[x])
            return x

        found = []
        component = part["component"].tolist()
        for v in np.flatnonzero(visits):
            own = sets[v]
            place = np.minimum(np.searchsorted(values, own), len(values) - 1)
            place = place[values[place] == own]
            if not len(place):
                continue
            held = np.concatenate([holders[first[p] : first[p + 1]] for p in place])
            common = np.bincount(held, minlength=len(waiting))
            linked = 100 * common >= params.percent * (sizes + len(own) - common)
            for w in waiting[linked]:
                x, y = root(component[v]), root(component[w])
                if x != y:
                    parent[x] = y
                    found.append((node[v], node[w]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    by_block = together.groupBy("leader", "class", "block", "v_block")
    return by_block.applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, params: JaccardParams | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id."""
    with freed_shuffles(docs.sparkSession):
        return _near_duplicates(docs, params or JaccardParams())


def _near_duplicates(docs: DataFrame, params: JaccardParams) -> DataFrame:
    sets = materialise(_sets(docs, params), "shingle-sets")
    shared = materialise(_shared_pivots(docs, params), "shared-pivots")
    facts = materialise(_node_facts(sets, shared, params), "node-facts")
    tested = materialise(_leader_pairs(shared, facts, params), "leader-pairs")
    links = materialise(_verified(docs, tested, facts, params), "leader-links")
    labelled = materialise(_labelled(facts, links), "labelled")
    entries = shared.join(labelled.select("node", "n", "need", "need_all", "component"), "node")
    rest = materialise(_uncrowded_pairs(entries, tested, params), "rest-pairs")
    for more in (_verified(docs, rest, facts, params), _crowded_links(docs, entries, facts, params)):
        links = links.unionByName(materialise(more, "more-links"))
    found = connected_components(links)
    members = sets.select("doc_id", "n_shingles", "node")
    least = members.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc"))
    least = least.join(found, "node", "left").select(
        "node", "doc", F.coalesce("component", "node").alias("component")
    )
    smallest = least.groupBy("component").agg(F.min("doc").alias("smallest"))
    by_node = least.join(smallest, "component").select("node", "smallest")
    return members.join(by_node, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("smallest", "doc_id").alias("component_id")
    )
