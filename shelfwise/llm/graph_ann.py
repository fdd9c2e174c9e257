"""Approximate nearest neighbours by cosine: a robust-pruned directed graph per shard.

Equal vectors are one class that keeps its smallest ids, as many as a result can show besides the
query's own. Classes are dealt to shards by hash. In a shard, a random graph of bounded degree is refined in
two rounds: a greedy beam search for each point proposes the points it visits as neighbours, and
relaxed distance pruning keeps a near one only if no kept one is closer to it by the factor
``alpha``; links are also tried backwards. Vectors, graph and ids of a shard are written as arrays, queries
as blocks; only the names of shards and blocks are joined. A task maps one shard after the other and
reads the blocks it has to answer: a beam search from the shard's medoid finds candidates,
their cosines are computed in double precision from the original vectors, and the best of all
shards are the answer. Shards are large, so that a search visits a small part of one (``visited_share``).

Every row that takes part is indexed: nothing is sampled. Vectors that are null, zero, empty or hold null, NaN
or infinite components take no part. Only vectors of the query's length are candidates. A query
with fewer candidates gets all that were found. Ties go to the smaller id. Repeated rows are
candidates once per id. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.llm.arrays import map_array, write_array
from shelfwise.llm.vectors import bucket_of, matrix, unit_rows, usable
from shelfwise.sources.scratch import materialise, scratch_path

_INDEX = "dim int, shard int, root string, entry int"
_BLOCK = "dim int, block int, queries string"
_FOUND = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class AnnParams:
    """``shard`` points at most make a shard, fewer where ``shard_values`` components are too few for them;
    a task answers ``task_blocks`` blocks of ``query_block`` queries from one shard."""

    k: int = 5
    shard: int = 32_768
    shard_values: int = 1 << 23
    query_block: int = 512
    task_blocks: int = 64
    tasks: int = 20_000
    degree: int = 32
    beam: int = 64
    search_beam: int = 128
    alpha: float = 1.2
    batch: int = 256
    width: int = 4


def beam_search(
    x: np.ndarray, graph: np.ndarray, entry: int, q: np.ndarray, beam: int, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of ``q`` the nearest points found, their squared distances, and the visited.

    All rows step together, each expanding its ``width`` nearest points not yet expanded.
    """
    n, rows = len(x), np.arange(len(q))[:, None]
    visited = np.zeros((len(q), n + 1), bool)
    ids = np.full((len(q), beam), n)
    dist = np.full((len(q), beam), np.inf, x.dtype)
    done = np.ones((len(q), beam), bool)
    ids[:, 0], done[:, 0] = entry, False
    dist[:, 0] = 2 - 2 * (q @ x[entry])
    visited[:, [entry, n]] = True
    while not done.all():
        open_dist = np.where(done, np.inf, dist)
        pick = np.argpartition(open_dist, min(width, beam) - 1, axis=1)[:, :width]
        live = ~done[rows, pick]
        done[rows, pick] = True
        points = np.where(live, ids[rows, pick], n)
        near = graph[points].reshape(len(q), -1)
        order = np.argsort(near, axis=1, kind="stable")
        near = near[rows, order]
        fresh = ~visited[rows, near]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        near = np.where(fresh, near, n)
        visited[rows, near] = True
        far = 2 - 2 * np.einsum("bmd,bd->bm", x[np.minimum(near, n - 1)], q)
        dist = np.concatenate([dist, np.where(fresh, far, np.inf)], axis=1)
        ids = np.concatenate([ids, near], axis=1)
        done = np.concatenate([done, ~fresh], axis=1)
        keep = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        dist, ids, done = dist[rows, keep], ids[rows, keep], done[rows, keep]
    return ids, dist, visited[:, :n]


def robust_prune(
    x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, alpha: float
) -> np.ndarray:
    """Diverse near neighbours of each point among its candidates; n stands for none."""
    n = len(x)
    out = np.full((len(points), degree), n)
    chunk = max(1, (1 << 22) // max(1, candidates.shape[1] ** 2))
    for begin in range(0, len(points), chunk):
        p, c = points[begin : begin + chunk], candidates[begin : begin + chunk]
        rows = np.arange(len(p))
        c = np.sort(c, axis=1)
        alive = (c < n) & (c != p[:, None])
        alive[:, 1:] &= c[:, 1:] != c[:, :-1]
        v = x[np.minimum(c, n - 1)]
        to_point = 2 - 2 * np.einsum("bmd,bd->bm", v, x[p])
        between = 2 - 2 * (v @ v.transpose(0, 2, 1))
        for slot in range(degree):
            best = np.where(alive, to_point, np.inf).argmin(axis=1)
            some = alive[rows, best]
            if not some.any():
                break
            out[begin + rows[some], slot] = c[rows[some], best[some]]
            closer = alpha * alpha * between[rows, best] <= to_point
            alive &= ~closer | ~some[:, None]
            alive[rows, best] = False
    return out


def build_graph(x: np.ndarray, params: AnnParams) -> tuple[np.ndarray, int]:
    """Out-neighbours (row n and entry n stand for none) and the medoid."""
    n = len(x)
    random = np.random.default_rng(n)
    graph = np.full((n + 1, params.degree), n)
    if n > 1:
        graph[:n] = random.integers(0, n, (n, params.degree))
    entry = int((x @ x.mean(axis=0)).argmax())
    for alpha in (1.0, params.alpha):
        order = random.permutation(n)
        for begin in range(0, n, params.batch):
            points = order[begin : begin + params.batch]
            ids, _, _ = beam_search(x, graph, entry, x[points], params.beam, params.width)
            both = np.concatenate([ids, graph[points]], axis=1)
            graph[points] = robust_prune(x, points, both, params.degree, alpha)
            _link_back(x, graph, points, params.degree, alpha)
    return graph, entry


def _link_back(x, graph, points, degree, alpha) -> None:
    """Offers each new link to its target, which prunes again when it has too many."""
    n = len(x)
    source = np.repeat(points, degree)
    target = graph[points].ravel()
    source, target = source[target < n], target[target < n]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    touched, first, count = np.unique(target, return_index=True, return_counts=True)
    if not len(touched):
        return
    offered = np.full((len(touched), count.max()), n)
    row = np.repeat(np.arange(len(touched)), count)
    offered[row, np.arange(len(target)) - first[row]] = source
    both = np.concatenate([graph[touched], offered], axis=1)
    graph[touched] = robust_prune(x, touched, both, degree, alpha)


def _whole_parts(batches, column: str):
    """Rows of equal ``column``, which stand together, as one frame; one is held at a time."""
    parts: list[pd.DataFrame] = []
    for batch in batches:
        for _, part in batch.groupby(column, sort=False):
            if parts and parts[0][column].iloc[0] != part[column].iloc[0]:
                yield pd.concat(parts)
                parts = []
            parts.append(part)
    if parts:
        yield pd.concat(parts)


def _index_shard(part: pd.DataFrame, root: str, params: AnnParams) -> pd.DataFrame:
    part = part.sort_values("node", kind="stable")
    shard = int(part["shard"].iloc[0])
    v = matrix(part["v"])
    graph, entry = build_graph(unit_rows(v).astype(np.float32), params)
    ids = [sorted(own) for own in part["ids"]]
    write_array(root, f"v-{shard}", v)
    write_array(root, f"graph-{shard}", graph.astype(np.int32))
    write_array(root, f"ids-{shard}", np.concatenate(ids).astype(np.int64))
    write_array(root, f"at-{shard}", np.cumsum([0, *map(len, ids)]))
    return pd.DataFrame({"dim": [v.shape[1]], "shard": [shard], "root": [root], "entry": [entry]})


class _Shard:
    """One shard of the index, as written."""

    def __init__(self, root: str, shard: int, entry: int):
        self.key, self.entry = (root, shard), entry
        self._ids, self._at = map_array(root, f"ids-{shard}"), map_array(root, f"at-{shard}")
        self.graph = map_array(root, f"graph-{shard}")
        self.unit = unit_rows(map_array(root, f"v-{shard}"))
        self.small = self.unit.astype(np.float32)

    def ids(self, point: int) -> list[int]:
        return self._ids[self._at[point] : self._at[point + 1]].tolist()


def _search_shard(shard: _Shard, query_ids, q: np.ndarray, params: AnnParams) -> pd.DataFrame:
    q = unit_rows(q)
    beam = max(params.search_beam, params.k + 1)
    near_ids, _, _ = beam_search(
        shard.small, shard.graph, shard.entry, q.astype(np.float32), beam, params.width
    )
    query, found, score = [], [], []
    for k, query_id in enumerate(query_ids.tolist()):
        near = near_ids[k][near_ids[k] < len(shard.unit)]
        cosine = shard.unit[near] @ q[k]
        best = np.argsort(-cosine, kind="stable")
        limit = -np.inf if len(best) <= params.k else cosine[best[params.k]]
        pairs = [
            (-cosine[b], vec_id)
            for b in best[cosine[best] >= limit]
            for vec_id in shard.ids(near[b])
            if vec_id != query_id
        ]
        for minus, vec_id in sorted(pairs)[: params.k]:
            query.append(query_id)
            found.append(vec_id)
            score.append(-minus)
    return pd.DataFrame({"query_id": query, "vec_id": found, "score": score}).astype(
        {"query_id": "int64", "vec_id": "int64", "score": "float64"}
    )


def _points(vectors: DataFrame, vector: str) -> DataFrame:
    v = F.transform(vector, lambda x: x.cast("double") + F.lit(0.0))
    rows = vectors.filter(usable(F.col(vector))).select(F.col("vec_id"), v.alias("v"))
    return rows.select("vec_id", "v", F.xxhash64("v").alias("node"), F.size("v").alias("dim"))


def build_index(
    vectors: DataFrame, params: AnnParams | None = None, vector: str = "embedding"
) -> DataFrame:
    """One row per shard: where its arrays are, and its entry point."""
    params = params or AnnParams()
    root = scratch_path(vectors.sparkSession, "ann")
    own = W.partitionBy("node", "v").orderBy("vec_id")
    # Repeated rows count once, or their copies would fill the class.
    once = _points(vectors, vector).dropDuplicates(["node", "v", "vec_id"])
    first = once.withColumn("_n", F.row_number().over(own))
    classes = first.filter(F.col("_n") <= params.k + 1).groupBy("node", "v", "dim").agg(
        F.collect_set("vec_id").alias("ids")
    )
    classes = materialise(classes, "ann-classes")
    most = F.greatest(F.lit(1), F.least(F.lit(params.shard), F.floor(params.shard_values / F.col("dim"))))
    sizes = classes.groupBy("dim").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("shards", F.ceil(F.col("n") / most))
    before = F.sum("shards").over(W.orderBy("dim")) - F.col("shards")
    sizes = materialise(sizes.withColumn("before", before), "ann-sizes")
    n_shards = sizes.agg(F.sum("shards")).first()[0] or 1
    own_shard = F.pmod(F.xxhash64("node"), F.col("shards")) + F.col("before")
    dealt = classes.join(sizes, "dim").select("node", "ids", "v", own_shard.cast("int").alias("shard"))
    # A shard is much work for few bytes: the number of tasks follows the shards, and no two share one.
    dealt = dealt.repartitionById(min(int(n_shards), params.tasks), "shard").sortWithinPartitions("shard")

    def index(batches):
        for part in _whole_parts(batches, "shard"):
            yield _index_shard(part, root, params)

    return materialise(dealt.mapInPandas(index, _INDEX), "ann-index")


def _query_blocks(queries: DataFrame, vector: str, params: AnnParams) -> DataFrame:
    """One row per block of queries; ids and vectors are written as arrays."""
    root = scratch_path(queries.sparkSession, "ann-blocks")
    points = materialise(_points(queries, vector), "ann-queries")
    sizes = points.groupBy("dim").agg(F.count("*").alias("n"))
    block = bucket_of(F.col("n"), params.query_block, "vec_id").alias("block")

    def gather(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id", kind="stable")
        write_array(root, f"ids-{key[0]}-{key[1]}", part["vec_id"].to_numpy(np.int64))
        write_array(root, f"v-{key[0]}-{key[1]}", matrix(part["v"]))
        return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "queries": [root]})

    blocks = points.join(sizes, "dim").select("dim", block, "vec_id", "v").groupBy("dim", "block")
    return materialise(blocks.applyInPandas(gather, _BLOCK), "ann-blocks")


def _answers(index: DataFrame, blocks: DataFrame, params: AnnParams, answer, schema: str) -> DataFrame:
    """``answer`` for every shard and every block of its dimension."""
    met = blocks.join(index, "dim").withColumn("_group", F.floor(F.col("block") / params.task_blocks))
    groups = index.groupBy("dim").agg(F.count("*").alias("s")).join(
        blocks.groupBy("dim").agg(F.ceil((F.max("block") + 1) / params.task_blocks).alias("g")), "dim"
    )
    n_tasks = groups.agg(F.sum(F.col("s") * F.col("g"))).first()[0] or 1
    # The pairs are names only, so their bytes say nothing about the work.
    met = met.repartition(min(int(n_tasks), params.tasks), "dim", "shard", "_group")

    def find(batches):
        shard = None
        for batch in batches:
            for row in batch.itertuples():
                if shard is None or shard.key != (row.root, row.shard):
                    shard = _Shard(row.root, row.shard, row.entry)
                name = f"{row.dim}-{row.block}"
                ids, q = (map_array(row.queries, f"{array}-{name}") for array in ("ids", "v"))
                yield answer(shard, ids, q, params)

    return met.sortWithinPartitions("dim", "shard", "block").mapInPandas(find, schema)


def search(
    index: DataFrame,
    queries: DataFrame,
    params: AnnParams | None = None,
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found for every query row."""
    params = params or AnnParams()
    found = _answers(index, _query_blocks(queries, vector, params), params, _search_shard, _FOUND)
    nearest = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.distinct().withColumn("rank", F.row_number().over(nearest))
    return found.filter(F.col("rank") <= params.k).select("query_id", "rank", "vec_id", "score")


def _visits(shard: _Shard, query_ids, q: np.ndarray, params: AnnParams) -> pd.DataFrame:
    small, beam = unit_rows(q).astype(np.float32), max(params.search_beam, params.k + 1)
    visited = beam_search(shard.small, shard.graph, shard.entry, small, beam, params.width)[2]
    return pd.DataFrame({"visited": [int(visited.sum())], "points": [int(visited.size)]})


def visited_share(
    index: DataFrame,
    queries: DataFrame,
    params: AnnParams | None = None,
    vector: str = "embedding",
) -> float:
    """The part of all pairs of a query and a point whose distance the searches work out."""
    params = params or AnnParams()
    blocks = _query_blocks(queries, vector, params)
    seen = _answers(index, blocks, params, _visits, "visited long, points long")
    visited, points = seen.agg(F.sum("visited"), F.sum("points")).first()
    return (visited or 0) / (points or 1)


def query_rows(vectors: DataFrame, every: int = 50) -> Column:
    return F.pmod(vectors["vec_id"], F.lit(every)) == 0
