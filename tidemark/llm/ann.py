"""Approximate nearest neighbours by cosine over robust-pruned directed graphs.

Equal vectors collapse to one node that keeps its few smallest ids. Nodes are dealt over shards of bounded size, and
each shard is a graph built in one task: greedy searches from a central node propose neighbours, and a candidate is
pruned when a neighbour already taken is nearer to it, by a relaxed distance, than the node itself, so long and short
edges both stay. The index is a stored table with a row per shard. Blocks of queries meet every shard by an equality
join, a beam search walks each graph for the whole block at once, and what it finds is scored again in double precision
on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Nodes of a shard, about; queries of a block.
SHARD_NODES, BLOCK_QUERIES = 8192, 1024

#: Edges of a node, beam while building and while searching, relaxation of the pruning distance.
DEGREE, BUILD_BEAM, SEARCH_BEAM, RELAX = 32, 64, 96, 1.2

#: Nodes inserted together while building.
BATCH = 512


def usable(vector: Column) -> Column:
    """Not NULL, not empty, without NULL or non-finite components, and not zero."""
    plain = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & plain & F.exists(vector, lambda x: x != 0)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, as float32; largest components first, so no square overflows or vanishes."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def beam_search(units: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, cosines) of the best ``beam`` nodes that greedy search finds for each query, best first; -1 pads."""
    n, q = len(units), len(queries)
    beam = min(beam, n)
    rows = np.arange(q)[:, None]
    seen = np.zeros((q, n + 1), dtype=bool)
    seen[:, [start, n]] = True
    nodes = np.full((q, beam), n)
    near = np.full((q, beam), -np.inf, dtype=np.float32)
    done = np.ones((q, beam), dtype=bool)
    nodes[:, 0], near[:, 0], done[:, 0] = start, queries @ units[start], False
    padded = np.vstack([units, np.zeros((1, units.shape[1]), dtype=np.float32)])
    going = np.arange(q)
    while len(going):
        at = (~done[going]).argmax(axis=1)
        done[going, at] = True
        fresh = edges[nodes[going, at]]
        fresh = np.where(seen[going[:, None], fresh], n, fresh)
        seen[going[:, None], fresh] = True
        cosine = np.einsum("qd,qrd->qr", queries[going], padded[fresh])
        cosine[fresh == n] = -np.inf
        every = np.concatenate([near[going], cosine], axis=1)
        order = np.argsort(-every, axis=1, kind="stable")[:, :beam]
        row = rows[: len(going)]
        near[going] = every[row, order]
        nodes[going] = np.concatenate([nodes[going], fresh], axis=1)[row, order]
        done[going] = np.concatenate([done[going], fresh == n], axis=1)[row, order]
        going = going[~done[going].all(axis=1)]
    nodes[nodes == n] = -1
    return nodes, near


def robust_prune(units: np.ndarray, points: np.ndarray, pools: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Neighbours of each point from its pool (-1 pads): the nearest is taken and whatever lies much nearer to it goes."""
    n = len(units)
    pools = np.where((pools < 0) | (pools == points[:, None]), n, pools)
    padded = np.vstack([units, np.zeros((1, units.shape[1]), dtype=np.float32)])
    held = padded[pools]
    away = 1 - np.einsum("pd,pcd->pc", units[points], held)
    away[pools == n] = np.inf
    row = np.arange(len(points))
    out = np.full((len(points), degree), n)
    for k in range(degree):
        best = away.argmin(axis=1)
        live = np.isfinite(away[row, best])
        if not live.any():
            break
        out[live, k] = pools[row, best][live]
        between = 1 - np.einsum("pd,pcd->pc", held[row, best], held)
        gone = relax * between <= away
        gone[~live] = False
        gone |= pools == pools[row, best][:, None]
        away[gone] = np.inf
    return out


def build_graph(units: np.ndarray, degree: int, beam: int, relax: float, seed: int = 0) -> tuple[np.ndarray, int]:
    """(edges, start): out-neighbours of each node, padded with the number of nodes, and the node searches start from."""
    n = len(units)
    rng = np.random.default_rng(seed)
    start = int((units @ units.mean(axis=0)).argmax())
    width = min(degree, n - 1)
    edges = np.full((n, degree), n)
    if not width:
        return edges, start
    edges[:, :width] = rng.integers(0, n, (n, width))
    edges[edges == np.arange(n)[:, None]] = n
    for alpha in (1.0, relax):
        order = rng.permutation(n)
        for a in range(0, n, BATCH):
            points = order[a : a + BATCH]
            found = beam_search(units, edges, start, units[points], beam)[0]
            edges[points] = robust_prune(units, points, np.concatenate([found, edges[points]], axis=1), degree, alpha)
            # The reverse edges, grouped by their new owner.
            to, back = edges[points].ravel(), np.repeat(points, degree)
            to, back = to[to < n], back[to < n]
            by = np.argsort(to, kind="stable")
            to, back = to[by], back[by]
            owners, first, count = np.unique(to, return_index=True, return_counts=True)
            new = np.full((len(owners), int(count.max())), n)
            new[np.repeat(np.arange(len(owners)), count), np.arange(len(to)) - np.repeat(first, count)] = back
            known = (new[:, :, None] == edges[owners][:, None, :]).any(axis=2)
            new[known] = n
            free = (edges[owners] == n).sum(axis=1)
            more = (new < n).sum(axis=1)
            fits = more <= free
            for k in np.flatnonzero(fits & (more > 0)).tolist():
                own = edges[owners[k]]
                own[np.flatnonzero(own == n)[: more[k]]] = new[k][new[k] < n]
            full = np.flatnonzero(~fits)
            if len(full):
                pools = np.concatenate([edges[owners[full]], new[full]], axis=1)
                edges[owners[full]] = robust_prune(units, owners[full], pools, degree, alpha)
    return edges, start


INDEX_SCHEMA = "shard int, dim int, start int, ids array<array<long>>, vectors array<double>, edges array<int>"


def build_index(rows: DataFrame, id_col: str, vector_col: str, copies: int, shard_nodes: int = SHARD_NODES,
                degree: int = DEGREE, beam: int = BUILD_BEAM, relax: float = RELAX) -> DataFrame:
    """The stored index of every usable row: a row per shard, which holds vectors of one dimension.

    Of the rows with equal vectors the ``copies`` smallest ids are kept; Spark cuts the others before the shuffle.
    """
    vector = F.col(vector_col).cast("array<double>")
    plain = rows.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(F.col(id_col).cast("long").alias("id"), vector.alias("v"))
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    nodes = plain.distinct().withColumn("nth", nth).where(F.col("nth") <= copies).groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    nodes = stored(nodes, "vectors")
    shards = max(1, -(-nodes.count() // shard_nodes))
    dealt = nodes.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("ids"), F.lit(shards)).cast("int").alias("shard"), "ids", "v")

    def build(key: tuple, group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        order = pa.array(np.argsort([x[0] for x in group["ids"].to_pylist()], kind="stable"))
        group = group.take(order).combine_chunks()
        dim = key[0].as_py()
        flat = group["v"].combine_chunks().flatten()
        vectors = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)
        edges, start = build_graph(unit(vectors), degree, beam, relax)
        return pa.table({
            "shard": pa.array([key[1].as_py()], pa.int32()), "dim": pa.array([dim], pa.int32()), "start": pa.array([start], pa.int32()),
            "ids": pa.array([group["ids"].to_pylist()], pa.list_(pa.list_(pa.int64()))),
            "vectors": pa.array([vectors.ravel()], pa.list_(pa.float64())), "edges": pa.array([edges.ravel()], pa.list_(pa.int32())),
        })

    return stored(dealt.groupBy("dim", "shard").applyInArrow(build, INDEX_SCHEMA), "graphs")


#: Rows and columns, at most, of the grid that shards and query blocks are dealt to.
GRID = 32


def nearest(index: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int = 5, beam: int = SEARCH_BEAM,
            block_queries: int = BLOCK_QUERIES, degree: int = DEGREE) -> DataFrame:
    """The ``k`` nearest that are found for each query: query_id, rank, vec_id and score, its cosine.

    A query's own id is no candidate. Ties go to the smaller id. Queries that are not usable, or of a dimension that
    no indexed vector has, give no rows; repeated rows count once; with fewer candidates than ``k`` all are returned.
    """
    vector = F.col(vector_col).cast("array<double>")
    asked = queries.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"), vector.alias("v")
    ).distinct()
    asked = stored(asked, "queries")
    blocks = max(1, -(-asked.count() // block_queries))
    block = F.pmod(F.xxhash64("id", "v"), F.lit(blocks))
    # A list holds about ``block_queries`` queries.
    grouped = asked.groupBy(F.size("v").alias("dim"), block.alias("block")).agg(
        F.collect_list("id").alias("qids"), F.flatten(F.collect_list("v")).alias("qv")
    )
    # Shards in rows and blocks in columns of a grid: each of its cells is a task that joins its row with its column, so
    # a shard is sent to each column and a block to each row, and no task or broadcast grows with either number.
    rows, columns = min(GRID, max(1, index.count())), min(GRID, blocks)
    cell = ["dim", "grid_row", "grid_column"]
    left = index.withColumn("grid_row", F.pmod(F.xxhash64("dim", "shard"), F.lit(rows))).withColumn(
        "grid_column", F.explode(F.expr(f"sequence(0L, {columns - 1}L)"))
    )
    right = grouped.withColumn("grid_column", F.pmod("block", F.lit(columns))).withColumn(
        "grid_row", F.explode(F.expr(f"sequence(0L, {rows - 1}L)"))
    )
    left, right = (side.repartition(rows * columns, *cell) for side in (left, right))
    pairs = left.join(right.hint("shuffle_hash"), cell).select("dim", "start", "ids", "vectors", "edges", "qids", "qv")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                dim, start, ids, *rest = (c[r] for c in batch.columns)
                dim, ids = dim.as_py(), ids.as_py()
                vectors, edges, qids, qv = (x.values.to_numpy(zero_copy_only=False) for x in rest)
                vectors, qv, edges = vectors.reshape(-1, dim), qv.reshape(-1, dim), edges.reshape(-1, degree)
                nodes = beam_search(unit(vectors), edges, start.as_py(), unit(qv), beam)[0]
                lengths, own = np.linalg.norm(vectors, axis=1), np.linalg.norm(qv, axis=1)
                out = []
                for q, qid in enumerate(qids.tolist()):
                    held = nodes[q][nodes[q] >= 0]
                    cosine = vectors[held] @ qv[q] / (lengths[held] * own[q])
                    best = sorted((-c, x) for c, i in zip(cosine.tolist(), held.tolist(), strict=True) for x in ids[i] if x != qid)
                    out += [(q, qid, x, -c) for c, x in best[:k]]
                cols = list(zip(*out, strict=True)) or [[]] * 4
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.float64())
                hashes = ["q", "query_id", "vec_id", "score"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], hashes)

    found = pairs.mapInArrow(search, "q int, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.drop("q").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
