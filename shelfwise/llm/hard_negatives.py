"""Hard negatives of anchor vectors by segment summaries.

Vectors become whole numbers, and a score is their inner product. A vector is cut into segments, and
for each the mean and the deviation are stored. For a segment of length L with sums S and T of two
vectors, and lengths d and e of what lies off their means,

    S T / L - d e  <=  inner product of the segments  <=  S T / L + d e,

so two short vectors of summaries bound a score from both sides. Levels go from long segments to
short ones: a pair is looked at on the next level, and at last exactly, only while its bounds
meet the range of scores that an anchor still asks for. The range narrows as better rows are found.

Anchors lie in blocks of files in the shared folder. Tasks over all rows hold one slab of rows at a time
and go through the blocks; they return for each anchor its best rows of the slab, of which Spark
keeps the best. A first pass finds the positives, the rows of the anchor's label with the highest scores; a
second one finds, for each positive, the best rows of other labels whose score lies between two
shares of the positive's. All scores are exact.

A row takes no part if its id, label or vector is null, if a component is null, NaN or infinite, or if its
inner product with itself passes 2**62. Vectors of different length have no score. Zero and empty vectors
score 0. Of rows with one id the smallest by label and then vector counts. Equal scores go by id.
Long vectors make slabs of fewer rows. Columns other than those named are not read. An empty table, or one
without anchors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.arrays import open_array, write_array
from shelfwise.sources.scratch import materialise, scratch_path

#: No score: one below all that can occur.
NONE = -(1 << 62) - 1
TOO_LONG = float(1 << 62)


@dataclass(frozen=True)
class HardNegativeParams:
    """``segments``: lengths of the segments of each level. ``block``: anchors read at once.

    ``slab_numbers``: components of the rows held at once. ``tile``: rows that meet a block at once.
    """

    positives: int = 5
    negatives: int = 10
    low_percent: int = 30
    high_percent: int = 90
    scale: int = 256
    segments: tuple[int, ...] = (16, 4, 2)
    block: int = 512
    slab_numbers: int = 1 << 22
    tile: int = 2048


def whole_vectors(vectors: DataFrame, anchor: Column, scale: int, vector: str = "embedding") -> DataFrame:
    """Rows that take part, one per id: vec_id, label, dim, is_anchor and the whole numbers ``v``."""
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    v = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), anchor.alias("is_anchor"), v.alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    row = F.struct("label", "v", "is_anchor")
    once = rows.filter(squares < TOO_LONG).groupBy("vec_id").agg(F.min(row).alias("row"))
    return once.select("vec_id", "row.label", F.size("row.v").alias("dim"), "row.is_anchor", "row.v")


class Summaries:
    """Rows of whole vectors of one length with the summaries of all levels."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, segments: tuple[int, ...]):
        self.ids, self.labels, self.v = ids, labels, v
        x = v.astype(np.float64)
        self.length = np.sqrt((x * x).sum(axis=1))
        self.longest = float(self.length.max(initial=0.0))
        self.levels = []
        for size in segments:
            begins = np.arange(0, v.shape[1], size)
            if not len(begins):
                continue
            n = np.diff(np.append(begins, v.shape[1])).astype(np.float64)
            total = np.add.reduceat(x, begins, axis=1)
            mean = total / n
            off = x - np.repeat(mean, n.astype(int), axis=1)
            deviation = np.sqrt(np.add.reduceat(off * off, begins, axis=1))
            self.levels.append((total / np.sqrt(n), deviation))

    def part(self, rows: slice) -> Summaries:
        out = object.__new__(Summaries)
        out.ids, out.labels, out.v, out.length = self.ids[rows], self.labels[rows], self.v[rows], self.length[rows]
        out.longest = float(out.length.max(initial=0.0))
        out.levels = [(m[rows], d[rows]) for m, d in self.levels]
        return out


class Refinement:
    """Goes through the levels for tiles of pairs, and counts the pairs seen and those left at the end."""

    DENSE = 8  # pairs are followed one by one once fewer than 1 / DENSE of a tile are left

    def __init__(self):
        self.seen = self.exact = 0

    def pairs(self, a: Summaries, b: Summaries, wanted: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Places (i, j) and scores of all wanted pairs whose score lies between low[i] and high[i]."""
        self.seen += int(np.count_nonzero(wanted))
        slack = 1e-9 * a.length[:, None] * b.length[None, :] + 1e-6
        i = j = None
        for level in range(len(a.levels)):
            (mean_a, off_a), (mean_b, off_b) = a.levels[level], b.levels[level]
            if i is None:
                middle, spread = mean_a @ mean_b.T, off_a @ off_b.T + slack
                wanted = wanted & (middle + spread >= low[:, None]) & (middle - spread <= high[:, None])
                if np.count_nonzero(wanted) * self.DENSE < wanted.size:
                    i, j = np.nonzero(wanted)
            else:
                middle = np.einsum("ij,ij->i", mean_a[i], mean_b[j])
                spread = np.einsum("ij,ij->i", off_a[i], off_b[j]) + slack[i, j]
                keep = (middle + spread >= low[i]) & (middle - spread <= high[i])
                i, j = i[keep], j[keep]
        kind = np.float64 if a.longest * b.longest < 1 << 52 else np.int64
        if i is None:
            score = (a.v.astype(kind) @ b.v.astype(kind).T).astype(np.int64)
            self.exact += int(np.count_nonzero(wanted))
            i, j = np.nonzero(wanted & (score >= low[:, None]) & (score <= high[:, None]))
            return i, j, score[i, j]
        self.exact += len(i)
        score = np.zeros(len(i), np.int64)
        for k in range(0, len(i), 1 << 16):
            s = slice(k, k + (1 << 16))
            score[s] = np.einsum("ij,ij->i", a.v[i[s]].astype(kind), b.v[j[s]].astype(kind)).astype(np.int64)
        keep = (score >= low[i]) & (score <= high[i])
        return i[keep], j[keep], score[keep]


class Best:
    """The ``k`` best rows, by score and then id, of each of ``n`` askers."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.who, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(n, NONE, np.int64)

    def add(self, who: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(who):
            return
        who, score, ids = (
            np.concatenate(c)
            for c in ((self.who, who), (self.score, score), (self.ids, ids))
        )
        order = np.lexsort((ids, -score, who))
        who = who[order]
        begins = np.searchsorted(who, np.arange(self.n))
        rank = np.arange(len(who)) - begins[who]
        keep = rank < self.k
        self.who, self.score, self.ids = who[keep], score[order][keep], ids[order][keep]
        last = rank[keep] == self.k - 1
        self.least[self.who[last]] = self.score[last]


def _share(percent: int, score: np.ndarray, up: bool) -> np.ndarray:
    """percent * score / 100 as a whole number, rounded up or down, without overflow."""
    whole, rest = np.divmod(score, 100)
    return percent * whole + (-((-percent * rest) // 100) if up else percent * rest // 100)


def _slabs(batches: Iterator[pa.RecordBatch], params: HardNegativeParams) -> Iterator[Summaries]:
    """Rows of a partition, by vector length, as slabs of bounded size."""
    held: dict[int, list] = {}
    size: dict[int, int] = {}
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim))
            v = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dim)
            held.setdefault(dim, []).append(
                (part.column("vec_id").to_numpy(), part.column("label").to_numpy(), v)
            )
            size[dim] = size.get(dim, 0) + part.num_rows * (int(dim) + 2)
        while sum(size.values()) > params.slab_numbers:
            dim = max(size, key=size.get)
            del size[dim]
            yield Summaries(*map(np.concatenate, zip(*held.pop(dim), strict=True)), params.segments)
    for rows in held.values():
        yield Summaries(*map(np.concatenate, zip(*rows, strict=True)), params.segments)


def _store_anchors(rows: DataFrame, root: str, params: HardNegativeParams) -> tuple[DataFrame, dict[int, int]]:
    """Writes the blocks; the ids with their block, and the number of blocks for each vector length."""
    anchors = rows.filter("is_anchor")
    counts = anchors.groupBy("dim").agg(F.ceil(F.count("*") / params.block).cast("int").alias("blocks"))
    counts = materialise(counts, "anchor-blocks")
    blocks = {r["dim"]: r["blocks"] for r in counts.collect()}
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block")
    dealt = anchors.join(counts, "dim").select("vec_id", "label", "dim", "v", block)

    def write(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        dim, number = int(key[0]), int(key[1])
        part = part.sort_values("vec_id")
        v = np.array([np.asarray(x, np.int64) for x in part["v"]], np.int64).reshape(len(part), dim)
        # The ids come last: where they are, the rest is.
        write_array(root, f"v-{dim}-{number}", v)
        write_array(root, f"label-{dim}-{number}", part["label"].to_numpy(np.int64))
        write_array(root, f"id-{dim}-{number}", part["vec_id"].to_numpy(np.int64))
        return part[["vec_id"]].assign(dim=dim, block=number).rename(columns={"vec_id": "anchor_id"})

    written = dealt.groupBy("dim", "block").applyInPandas(write, "anchor_id long, dim int, block int")
    return materialise(written, "anchors"), blocks


def _block(root: str, dim: int, number: int, params: HardNegativeParams) -> Summaries | None:
    """A block of anchors; None where no id fell into it."""
    try:
        ids = np.asarray(open_array(root, f"id-{dim}-{number}"))
    except FileNotFoundError:
        return None
    labels, v = (np.asarray(open_array(root, f"{c}-{dim}-{number}")) for c in ("label", "v"))
    return Summaries(ids, labels, v, params.segments)


def _search(block: Summaries, slab: Summaries, refine: Refinement, same: bool, low: np.ndarray,
            high: np.ndarray, k: int, params: HardNegativeParams) -> list[Best]:
    """The best rows of the slab for each anchor and each of its ranges (columns of low and high)."""
    best = [Best(len(block.ids), k) for _ in range(low.shape[1])]
    # A first small tile sets the ranges, so that the bounds have something to rule out by.
    edges = [0, *range(min(256, len(slab.ids)), len(slab.ids), params.tile), len(slab.ids)]
    for begin, end in zip(edges[:-1], edges[1:], strict=True):
        tile = slab.part(slice(begin, end))
        wanted = (block.labels[:, None] == tile.labels[None, :]) == same
        if same:
            wanted &= block.ids[:, None] != tile.ids[None, :]
        floor = np.stack([np.maximum(low[:, c], b.least) for c, b in enumerate(best)])
        i, j, score = refine.pairs(block, tile, wanted, floor.min(axis=0), high.max(axis=1))
        for c, b in enumerate(best):
            keep = (score >= floor[c][i]) & (score <= high[i, c])
            b.add(i[keep], score[keep], tile.ids[j[keep]])
    return best


FOUND = "anchor_id long, slot int, vec_id long, score long"


def _pass(rows: DataFrame, root: str, blocks: dict[int, int], same: bool, params: HardNegativeParams) -> DataFrame:
    def search(batches):
        for slab in _slabs(batches, params):
            dim = slab.v.shape[1]
            refine = Refinement()
            for number in range(blocks.get(dim, 0)):
                block = _block(root, dim, number, params)
                if block is None:
                    continue
                if same:
                    low = np.full((len(block.ids), 1), NONE, np.int64)
                    high = -low
                else:
                    positive = np.asarray(open_array(root, f"positive-{dim}-{number}"))
                    low = _share(params.low_percent, positive, up=True)
                    high = _share(params.high_percent, positive, up=False)
                    low = np.where(positive == NONE, -NONE, low)
                    high = np.where(positive == NONE, NONE, high)
                k = params.positives if same else params.negatives
                for slot, best in enumerate(_search(block, slab, refine, same, low, high, k, params)):
                    n = len(best.who)
                    if n:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(block.ids[best.who]), pa.array(np.full(n, slot + 1, np.int32)),
                             pa.array(best.ids), pa.array(best.score)],
                            names=["anchor_id", "slot", "vec_id", "score"],
                        )

    return rows.select("vec_id", "label", "dim", "v").mapInArrow(search, FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame, anchor: Column, params: HardNegativeParams | None = None, vector: str = "embedding"
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``anchor`` says of a row of ``vectors`` (vec_id, label, embedding) whether it is an anchor.
    """
    params = params or HardNegativeParams()
    spark = vectors.sparkSession
    anchor = F.coalesce(anchor, F.lit(False))
    rows = materialise(whole_vectors(vectors, anchor, params.scale, vector), "whole-vectors")
    root = scratch_path(spark, "anchor-arrays")
    anchors, blocks = _store_anchors(rows, root, params)
    positives = _top(_pass(rows, root, blocks, True, params), params.positives)
    positives = positives.select(
        "anchor_id", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    positives = materialise(positives, "positives")
    width = params.positives

    def write(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        dim, number = int(key[0]), int(key[1])
        ids = np.asarray(open_array(root, f"id-{dim}-{number}"))
        scores = np.full((len(ids), width), NONE, np.int64)
        part = part[part["slot"] > 0]
        at = np.searchsorted(ids, part["anchor_id"].to_numpy(np.int64))
        scores[at, part["slot"].to_numpy(int) - 1] = part["positive_score"].to_numpy(np.int64)
        write_array(root, f"positive-{dim}-{number}", scores)
        return pd.DataFrame({"dim": [dim], "block": [number]})

    # Without nulls, since pandas would make numbers of 53 bits of them.
    with_scores = anchors.join(positives.drop("positive_id"), "anchor_id", "left").fillna(0)
    with_scores.groupBy("dim", "block").applyInPandas(write, "dim int, block int").count()
    negatives = _top(_pass(rows, root, blocks, False, params), params.negatives)
    return negatives.join(positives, ["anchor_id", "slot"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
