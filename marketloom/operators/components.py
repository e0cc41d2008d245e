"""Connected components of an edge list, without collecting any of it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.session import staged

LINKS = 2_000_000  # as many are finished by one task in memory


def _mark(links: DataFrame) -> tuple:
    """Number of links and a sum of their hashes: equal for equal sets of links."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.hash("v", "u").cast("bigint"))).first())


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """u, component of all nodes of the links: of the labels at both ends of a link the higher one is put under the lower one, round by round."""
    links = [np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns]) for b in batches if b.num_rows]
    if not links:
        return
    nodes, at = np.unique(np.concatenate(links, axis=1), return_inverse=True)
    u, v = at.reshape(2, -1)
    label = np.arange(len(nodes))
    while len(u):
        low = np.minimum(label[u], label[v])
        for end in (label[u], label[v]):  # roots only, so that all who have such a label follow
            np.minimum.at(label, end, low)
        while (label != (further := label[label])).any():
            label = further
        open_ = label[u] != label[v]
        u, v = u[open_], v[open_]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], names=["u", "component"])


def connected_components(nodes: DataFrame, edges: DataFrame, most: int = LINKS) -> DataFrame:
    """node, component (lowest node of the component) for `nodes` (`node`) joined by `edges` (`a`, `b`).

    While there are more than `most` links, rounds of large-star and small-star contraction: every node is linked to the lowest node it sees, so
    the number of rounds grows with the logarithm of the longest chain. Each round is written to the shared folder; it is the last if
    the number of links and a sum of their hashes stay as they were. A hub's lowest neighbour is found by an aggregation that combines
    before the shuffle, and its links then meet that one row, so a hub's join can be split by its links (adaptive skew join). `most` links or
    fewer, edges or what a round leaves of them, are finished by one task in memory.
    """
    links = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    before, now = None, _mark(links)
    while now != before and now[0] > most:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = large.where("u <> v").distinct()
        low = kept.groupBy("u").agg(F.min("v").alias("m"))
        small = kept.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        links = staged(small.where("u <> v").distinct(), "components")
        before, now = now, _mark(links)
    if now[0] > most:
        label = links.groupBy("u").agg(F.min("v").alias("component"))
    else:
        kind = links.schema["u"].dataType.simpleString()
        label = links.select("u", "v").repartition(1).mapInArrow(_finish, f"u {kind}, component {kind}")
    ids = nodes.select("node").distinct()
    return ids.join(label, ids.node == label.u, "left").select("node", F.coalesce("component", "node").alias("component"))
