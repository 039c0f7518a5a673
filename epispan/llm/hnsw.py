"""Nearest neighbours: a hierarchical navigable small-world graph per shard, results merged.

Vectors are sharded by hash. Each shard builds its own graph and keeps it as flat arrays: the
vectors, and per level the members and a fixed-width row of neighbour numbers for each. Queries
go to all shards in blocks; a shard searches a whole block in step, and the best of every shard
are merged by exact double-precision inner product. When a shard is built, its search is measured
against brute force on a sample of its vectors and the beam widened until the recall is right; the
beam is stored with the graph.

Largest inner product is not a distance, so a coordinate is added that makes all stored
vectors of a shard equally long (queries get a zero there); the order by distance among them is
then the order by inner product. Equal vectors are one node of the graph: copies cannot crowd
out a neighbourhood, and a node stands for its smallest ids, as many as a result can hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epispan.session import materialize

from .common import map_arrow

TOP = 20
SHARD_ROWS = 8192
#: Neighbours per node, on the ground level twice as many.
NEIGHBOURS = 16
BUILD_BEAM, SEARCH_BEAM = 64, 224
#: Least recall a shard's beam must reach on ``PROBES`` of its own vectors before the index is stored.
LEAST_RECALL, PROBES = 0.97, 256
#: Nodes inserted, and queries searched, in step.
INSERT_BLOCK, SEARCH_BLOCK = 512, 512
QUERY_BLOCK_ROWS = 4096


@dataclass
class Graph:
    vectors: np.ndarray
    #: Per level from the ground up: neighbour numbers of every node, -1 where there is none.
    links: list[np.ndarray]
    entry: int

    def pack(self) -> list[bytes]:
        return [x.astype("<i4").tobytes() for x in self.links]


def _beam(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of all queries in step on one level: nodes and similarities, best first.

    A step opens the best unopened node of every query still running. A query stops when all
    nodes of its beam are opened. Missing places are -1 with similarity minus infinity.
    """
    q, width = len(queries), links.shape[1]
    nodes = np.full((q, beam), -1, np.int64)
    sims = np.full((q, beam), -np.inf, np.float32)
    opened = np.ones((q, beam), bool)
    e = entries.shape[1]
    nodes[:, :e] = entries
    sims[:, :e] = np.where(entries >= 0, np.einsum("qed,qd->qe", vectors[np.maximum(entries, 0)], queries), -np.inf)
    opened[:, :e] = entries < 0
    seen = np.zeros((q, len(vectors) + 1), bool)
    seen[np.arange(q)[:, None], nodes] = True
    order = np.argsort(-sims, axis=1, kind="stable")
    nodes, sims, opened = (np.take_along_axis(x, order, 1) for x in (nodes, sims, opened))
    live = np.arange(q)
    while len(live):
        closed = opened[live]
        first = closed.argmin(axis=1)
        running = ~closed[np.arange(len(live)), first]
        live, first = live[running], first[running]
        if not len(live):
            break
        opened[live, first] = True
        found = links[nodes[live, first]]
        fresh = (found >= 0) & ~seen[live[:, None], found]
        seen[live[:, None], found] = True
        # Most neighbours are known already; similarities are worked out for the new ones only.
        at, column = np.nonzero(fresh)
        value = np.full((len(live), width), -np.inf, np.float32)
        value[at, column] = np.einsum("nd,nd->n", vectors[found[at, column]], queries[live[at]])
        better = value > sims[live, -1:]
        some = better.any(axis=1)
        rows = live[some]
        if not len(rows):
            continue
        all_sims = np.concatenate([sims[rows], np.where(better[some], value[some], -np.inf)], axis=1)
        all_nodes = np.concatenate([nodes[rows], np.where(better[some], found[some], -1)], axis=1)
        all_open = np.concatenate([opened[rows], ~better[some]], axis=1)
        order = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
        sims[rows], nodes[rows], opened[rows] = (np.take_along_axis(x, order, 1) for x in (all_sims, all_nodes, all_open))
    return nodes, sims


def _diverse(vectors: np.ndarray, nodes: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
    """Up to ``keep`` neighbours of each row: a candidate goes behind if a kept one is nearer to it than the row is.

    Places left over are filled with the nearest of those, so no node is poorly linked.
    """
    n, c = nodes.shape
    chosen = np.zeros((n, c), bool)
    count = np.zeros(n, np.int64)
    v = vectors[np.maximum(nodes, 0)]
    between = np.einsum("ncd,ned->nce", v, v)
    for j in range(c):
        blocked = (between[:, j, :] > sims[:, j:j + 1]) & chosen
        take = (nodes[:, j] >= 0) & ~blocked.any(axis=1) & (count < keep)
        chosen[:, j] = take
        count += take
    rank = np.where(chosen, 0, np.where(nodes >= 0, 1, 2)) * c + np.arange(c)
    order = np.argsort(rank, axis=1, kind="stable")[:, :keep]
    out = np.take_along_axis(nodes, order, 1)
    return out if out.shape[1] == keep else np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1)


def _link_back(vectors: np.ndarray, links: np.ndarray, sources: np.ndarray, targets: np.ndarray) -> None:
    """Add sources to the rows of their targets; full rows choose anew among old and added."""
    keep = links.shape[1]
    at, column = np.nonzero(targets >= 0)
    to, of = targets[at, column], sources[at]
    order = np.lexsort((of, to))
    to, of = to[order], of[order]
    rows, start, added = np.unique(to, return_index=True, return_counts=True)
    place = np.arange(len(to)) - np.repeat(start, added)
    room = min(int(added.max()), 2 * keep)
    near = np.full((len(rows), room), -1, np.int64)
    row = np.repeat(np.arange(len(rows)), added)
    if added.max() > room:
        # Of very many new neighbours the nearest are looked at.
        sims = np.einsum("nd,nd->n", vectors[to], vectors[of])
        order = np.lexsort((-sims, to))
        of = of[order]
    inside = place < room
    near[row[inside], place[inside]] = of[inside]
    candidates = np.concatenate([links[rows], near], axis=1)
    # Repeats within a row count once.
    by = np.sort(candidates, axis=1)
    by[:, 1:][by[:, 1:] == by[:, :-1]] = -1
    sims = np.where(by >= 0, np.einsum("ncd,nd->nc", vectors[np.maximum(by, 0)], vectors[rows]), -np.inf)
    order = np.argsort(-sims, axis=1, kind="stable")
    by, sims = np.take_along_axis(by, order, 1), np.take_along_axis(sims, order, 1)
    full = (by >= 0).sum(axis=1) > keep
    links[rows[~full]] = by[~full, :keep]
    for part in np.array_split(np.flatnonzero(full), max(1, int(full.sum()) // 512)):
        if len(part):
            links[rows[part]] = _diverse(vectors, by[part], sims[part], keep)


def build_graph(vectors: np.ndarray, seed: int = 5) -> Graph:
    """Insert vectors block by block: search the graph so far, join the block's own members, link both ways."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    heights = np.minimum((-np.log(rng.random(n)) / np.log(NEIGHBOURS)).astype(int), 6)
    order = np.argsort(-heights, kind="stable")  # tall nodes first: the entry stays, upper levels fill early
    top = int(heights.max())
    links = [np.full((n, 2 * NEIGHBOURS if level == 0 else NEIGHBOURS), -1, np.int64) for level in range(top + 1)]
    entry = int(order[0])
    done = 1
    while done < n:
        block = order[done:done + min(INSERT_BLOCK, max(1, done))]
        entries = np.full((len(block), 1), entry, np.int64)
        own = vectors[block] @ vectors[block].T
        np.fill_diagonal(own, -np.inf)
        for level in range(top, -1, -1):
            member = heights[block] >= level
            beam = BUILD_BEAM if member.any() else 1
            nodes, sims = _beam(vectors, links[level], vectors[block], entries, beam)
            entries = nodes[:, :min(beam, 4)]
            if member.any():
                rows = np.flatnonzero(member)
                peers = own[np.ix_(rows, rows)]
                near = min(NEIGHBOURS, len(rows))
                best = np.argsort(-peers, axis=1, kind="stable")[:, :near]
                peer_sims = np.take_along_axis(peers, best, 1)
                all_nodes = np.concatenate([nodes[rows], np.where(np.isfinite(peer_sims), block[rows][best], -1)], axis=1)
                all_sims = np.concatenate([sims[rows], peer_sims], axis=1)
                ranked = np.argsort(-all_sims, axis=1, kind="stable")
                chosen = _diverse(vectors, np.take_along_axis(all_nodes, ranked, 1), np.take_along_axis(all_sims, ranked, 1), NEIGHBOURS)
                links[level][block[rows], :NEIGHBOURS] = chosen
                _link_back(vectors, links[level], block[rows], chosen)
        done += len(block)
    return Graph(vectors, links, entry)


def fitted_beam(graph: Graph, queries: np.ndarray, top: int, least: float = LEAST_RECALL, beam: int = SEARCH_BEAM) -> int:
    """The beam, doubled from ``beam``, at which the graph finds ``least`` of the true ``top`` of ``queries``.

    How wide it must be depends on the number, dimension and lengths of the vectors, so it is measured
    against brute force. A beam as wide as the graph compares all nodes.
    """
    truth = _all_nodes(graph, queries, top)[0]
    while beam < len(graph.vectors):
        found = search_graph(graph, queries, top, beam)[0]
        hit = np.mean([len(np.intersect1d(a, b)) for a, b in zip(found, truth, strict=True)]) / truth.shape[1]
        if hit >= least:
            break
        beam *= 2
    return beam


def search_graph(graph: Graph, queries: np.ndarray, top: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` nodes found for each query, best first, -1 where the graph has fewer.

    A beam as wide as the graph would open every node anyway, so a small graph is compared whole;
    so are queries whose search ran dry before it had ``top`` nodes.
    """
    beam = max(beam, top)
    if len(graph.vectors) <= beam:
        return _all_nodes(graph, queries, top)
    nodes = np.full((len(queries), 1), graph.entry, np.int64)
    for level in range(len(graph.links) - 1, 0, -1):
        nodes = _beam(graph.vectors, graph.links[level], queries, nodes, 1)[0]
    nodes, sims = _beam(graph.vectors, graph.links[0], queries, nodes, beam)
    nodes, sims = nodes[:, :top], sims[:, :top]
    dry = np.flatnonzero(nodes[:, -1] < 0)
    if len(dry):
        nodes[dry], sims[dry] = _all_nodes(graph, queries[dry], top)
    return nodes, sims


def _all_nodes(graph: Graph, queries: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    sims = queries @ graph.vectors.T
    nodes = np.argsort(-sims, axis=1, kind="stable")[:, :top]
    short = top - nodes.shape[1]
    return (
        np.pad(nodes, ((0, 0), (0, max(0, short))), constant_values=-1),
        np.pad(np.take_along_axis(sims, nodes, 1), ((0, 0), (0, max(0, short))), constant_values=-np.inf),
    )


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct rows that take part: known id, and a vector that is neither null, zero nor has a null or non-finite component."""
    v = F.transform("embedding", lambda x: x.cast("double") + 0.0)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select("vec_id", v.alias("v")).where(
        F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0)
    ).distinct()


def _shard_graph(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per shard: its distinct vectors and flat neighbour arrays."""
    rows = rows.sort_values("node", kind="stable")
    exact = np.array(rows["v"].tolist(), np.float64)
    squares = np.einsum("nd,nd->n", exact, exact)
    lift = np.sqrt(np.maximum(0, squares.max() - squares))
    graph = build_graph(np.concatenate([exact, lift[:, None]], axis=1).astype(np.float32))
    probes = np.random.default_rng(9).permutation(len(exact))[:PROBES]
    asked = np.concatenate([exact[probes], np.zeros((len(probes), 1))], axis=1).astype(np.float32)
    beam = fitted_beam(graph, asked, TOP + 1)
    return pd.DataFrame([{
        "beam": beam,
        "shard": rows["shard"].iloc[0], "nodes": rows["node"].to_numpy("<i8").tobytes(), "ids": rows["ids"].map(list).tolist(),
        "vectors": exact.astype("<f8").tobytes(), "links": graph.pack(), "entry": graph.entry, "size": exact.shape[1],
    }])


_GRAPH = "shard int, nodes binary, ids array<array<bigint>>, vectors binary, links array<binary>, entry int, size int, beam int"


def build_index(vectors: DataFrame, top: int = TOP, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The stored index of ``vectors`` (vec_id, embedding): one row per shard, every usable vector in it.

    Equal vectors become one node that lists its ``top + 1`` smallest ids: no result can hold
    more of them. Repeated rows are combined before the cut, so it counts ids. The cut is a ranking that Spark applies before the shuffle, so a vector that
    a third of all rows share costs each task a few rows.
    """
    held = usable(vectors)
    first = Window.partitionBy("v").orderBy("vec_id")
    kept = held.withColumn("place", F.row_number().over(first)).where(F.col("place") <= top + 1)
    nodes = materialize(
        kept.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("node", F.xxhash64("v")), "vector-nodes",
    )
    shards = max(1, -(-nodes.count() // shard_rows))
    placed = nodes.select("ids", "v", "node", F.pmod("node", F.lit(shards)).cast("int").alias("shard"), F.size("v").alias("size"))
    return materialize(placed.groupBy("shard", "size").applyInPandas(_shard_graph, _GRAPH), "vector-graphs")


def _best_of_ids(exact: np.ndarray, ids: list[np.ndarray], nodes: np.ndarray, q: np.ndarray, query: int) -> dict[int, float]:
    """The best score of every id the nodes stand for, the query's own left out."""
    best: dict[int, float] = {}
    for k in nodes:
        score = float(np.dot(exact[k], q))
        for v in ids[k].tolist():
            if v != query and score > best.get(v, -np.inf):
                best[v] = score
    return best


def search(index: DataFrame, queries: DataFrame, top: int = TOP, beam: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest found to each query, its own row left out.

    Ties go to the smaller vec_id. An id counts once in a result, at its best score, however many
    rows it or the query has. Queries that are not usable vectors find nothing; a query only
    meets vectors of its own length. Each shard is searched with the beam fitted to it unless ``beam`` is given.
    """
    asked = usable(queries).select(F.col("vec_id").alias("query_id"), "v", F.size("v").alias("size"))
    asked = materialize(asked.select("query_id", "v", "size", F.pmod(F.xxhash64("query_id"), F.lit(1 << 20)).alias("h")), "queries")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK_ROWS))
    shards = [r["shard"] for r in index.select("shard").distinct().collect()]
    if not shards:
        shards = [0]
    # A query block meets every shard: the stated query set against all rows, in blocks.
    sent = asked.select("query_id", "v", "size", (F.col("h") % blocks).cast("int").alias("block"), F.explode(F.lit(shards)).alias("shard"))
    graphs = index.withColumn("block", F.explode(F.lit(list(range(blocks)))))

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            row = right.iloc[0]
            size = int(row["size"])
            exact = np.frombuffer(row["vectors"], "<f8").reshape(-1, size)
            squares = np.einsum("nd,nd->n", exact, exact)
            lifted = np.concatenate([exact, np.sqrt(np.maximum(0, squares.max() - squares))[:, None]], axis=1).astype(np.float32)
            links = [np.frombuffer(x, "<i4").reshape(len(exact), -1).astype(np.int64) for x in row["links"]]
            graph = Graph(lifted, links, int(row["entry"]))
            ids = [np.asarray(x, np.int64) for x in row["ids"]]
            asked_ids, asked_v = left["query_id"].to_numpy(), np.array(left["v"].tolist(), np.float64)
            for start in range(0, len(left), SEARCH_BLOCK):
                q = asked_v[start:start + SEARCH_BLOCK]
                # One more than asked for: the query's own row may be among them.
                nodes, _ = search_graph(graph, np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype(np.float32), top + 1, beam or int(row["beam"]))
                for i, found in enumerate(nodes):
                    query = asked_ids[start + i]
                    best = _best_of_ids(exact, ids, found[found >= 0], q[i], query)
                    if len(best) < top and len(found) < len(exact):
                        # Several nodes of one id stand in the way of others: all nodes are compared.
                        best = _best_of_ids(exact, ids, np.arange(len(exact)), q[i], query)
                    out += sorted((-s, v, query) for v, s in best.items())[:top]
        return pd.DataFrame([(q, v, -s) for s, v, q in out], columns=["query_id", "vec_id", "score"])

    found = sent.groupBy("shard", "size", "block").cogroup(graphs.groupBy("shard", "size", "block")).applyInPandas(
        run, "query_id bigint, vec_id bigint, score double",
    )
    # Shards, and several vectors of a query id, may each have found an id.
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranking = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= top).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 20, top: int = TOP) -> DataFrame:
    """Search ``vectors`` for the rows whose vec_id is divisible by ``every``.

    Null, zero and non-finite vectors take no part, nor do rows without an id. A repeated id is a
    candidate with each of its distinct vectors and in a result once. An empty table gives an empty result.
    """
    return search(build_index(vectors, top), vectors.where(F.col("vec_id") % every == 0), top)
