"""Exact near-duplicates among embeddings of one label: int8 tile products with error bounds.

Equal vectors of a label are one class with a count. Classes are dealt to tiles of a label, and every
two tiles of it meet in one task. There each vector x of length one is quantised to s * q with
whole q in -127..127, and its rest e = x - s * q has a known length. Since

    |x.y - (s q).(t r)| <= |e_x| |t r| + |s q| |e_y| + |e_x| |e_y|,

the integer product of two tiles tells for each pair whether its cosine can reach the threshold.
Only those pairs are computed in double precision. Integer products run in floats that hold them
exactly. A tile pair returns per class the number of vectors it links to and one link to the class
that leads its group there, so results grow with rows, not with pairs; groups become components.

Null labels and vectors that are null, zero, empty or hold null, NaN or infinite components link with
nothing and are their own component. Vectors of different length never link. Repeated rows are
equal vectors; vec_id need not be unique for that. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.components import connected_components
from shelfwise.llm.vectors import bucket_of, matrix, unit_rows, usable
from shelfwise.sources.scratch import materialise


@dataclass(frozen=True)
class EmbeddingDedupParams:
    threshold: float = 0.98
    tile: int = 1024


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, and the lengths of s * q and of the rest, rounded up."""
    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    near = codes * scale[:, None]
    up = 1 + 1e-12
    rest = np.sqrt(((x - near) ** 2).sum(axis=1)) * up + 1e-15
    return codes, scale, np.sqrt((near**2).sum(axis=1)) * up, rest


def possible_pairs(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of rows whose cosine can reach the threshold."""
    p, s, p_long, p_rest = quantised(x)
    q, t, q_long, q_rest = quantised(y)
    exact = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = (p.astype(exact) @ q.astype(exact).T) * s[:, None] * t[None, :]
    bound = p_rest[:, None] * (q_long + q_rest)[None, :] + p_long[:, None] * q_rest[None, :]
    return np.nonzero(product + bound >= threshold - 1e-9)


def _leaders(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest row of each row's group, for links a-b among n rows."""
    lead = np.arange(n)
    while True:
        least = np.minimum(lead[a], lead[b])
        new = lead.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == lead).all():
            return lead
        lead = new


def _compare(part: pd.DataFrame, i: int, j: int, threshold: float) -> pd.DataFrame:
    found = []
    for _, same in part.groupby("dim"):
        same = same.sort_values("node")
        left = same[same["own"] == i]
        right = left if i == j else same[same["own"] == j]
        if left.empty or right.empty:
            continue
        x, y = unit_rows(matrix(left["v"])), unit_rows(matrix(right["v"]))
        a, b = possible_pairs(x, y, threshold)
        keep = np.zeros(len(a), bool)
        for k in range(0, len(a), 1 << 16):
            s = slice(k, k + (1 << 16))
            keep[s] = np.einsum("ij,ij->i", x[a[s]], y[b[s]]) >= threshold
        if i == j:
            keep &= a != b
        a, b = a[keep], b[keep]
        weight_a, weight_b = left["copies"].to_numpy(), right["copies"].to_numpy()
        links_a = np.bincount(a, weight_b[b], len(left)).astype(np.int64)
        node_a, node_b = left["node"].to_numpy(), right["node"].to_numpy()
        if i == j:
            node, links, lead = node_a, links_a, _leaders(a, b, len(left))
        else:
            links_b = np.bincount(b, weight_a[a], len(right)).astype(np.int64)
            node, links = np.concatenate([node_a, node_b]), np.concatenate([links_a, links_b])
            lead = _leaders(a, b + len(left), len(node))
        some = links > 0
        found.append(pd.DataFrame({"node": node, "links": links, "leader": node[lead]})[some])
    empty = pd.DataFrame({"node": [], "links": [], "leader": []}, dtype="int64")
    return pd.concat(found) if found else empty


def near_duplicates(
    vectors: DataFrame, params: EmbeddingDedupParams | None = None, vector: str = "embedding"
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept."""
    params = params or EmbeddingDedupParams()
    threshold = params.threshold
    rows = vectors.select(
        "vec_id",
        "label",
        F.transform(vector, lambda x: x.cast("double") + F.lit(0.0)).alias("v"),
        (F.col("label").isNotNull() & usable(F.col(vector))).alias("takes_part"),
    )
    key = F.when(F.col("takes_part"), F.xxhash64("label", "v")).alias("node")
    rows = materialise(rows.select("vec_id", "label", "v", key), "vectors")
    classes = rows.filter("node is not null").groupBy("node").agg(
        F.count("*").alias("copies"),
        F.min("vec_id").alias("least_id"),
        F.first("label").alias("label"),
        F.first("v").alias("v"),
    )
    classes = materialise(classes, "vector-classes")
    sizes = materialise(classes.groupBy("label").agg(F.count("*").alias("n")), "label-sizes")
    dealt = classes.join(sizes, "label").withColumns(
        {
            "own": bucket_of(F.col("n"), params.tile, "node"),
            "tiles": F.ceil(F.col("n") / params.tile).cast("int"),
            "dim": F.size("v"),
        }
    )
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select(
        "label",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        "own",
        "dim",
        "node",
        "copies",
        "v",
    )

    def compare(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return _compare(part, key[1], key[2], threshold)

    met = materialise(
        dealt.groupBy("label", "i", "j").applyInPandas(
            compare, "node long, links long, leader long"
        ),
        "tile-links",
    )
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    found = connected_components(met.filter("node != leader"), "node", "leader")
    nodes = (
        classes.select("node", "copies", "least_id")
        .join(links, "node", "left")
        .join(found, "node", "left")
        .select(
            "node",
            "least_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    nodes = materialise(nodes, "vector-nodes")
    smallest = nodes.groupBy("component").agg(F.min("least_id").alias("smallest"))
    by_node = nodes.join(smallest, "component").select("node", "n_links", "smallest")
    out = rows.select("vec_id", "node").join(by_node, "node", "left")
    component = F.coalesce("smallest", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
