"""A graph index for vectors: layered small worlds, one a part of the rows, searched by beam.

Rows are dealt to parts of bounded size by a hash. In each part every vector has a level, drawn so that one in LINKS goes
one level up; on each level it is linked to near vectors that are not nearer to one another (so links lead into different
directions) and is linked back. The level below all holds every vector and twice as many links. A search goes down from
the top to the nearest vector of each level, then keeps a beam of the best found at the bottom, whose links it follows
until none of them can be better.

The index is a table: one row a part, with vectors and adjacency lists. It is written once and joined with blocks of
queries; every part gives its best k with the number of distances it took.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.search import query_blocks, unit

#: Vectors of a part at most (about), links of a vector on a level, and those near ones that links are chosen from.
PART_ROWS, LINKS, CANDIDATES = 16_384, 12, 64
#: Vectors whose links are followed in one step.
STEP = 8
LEVEL = "struct<nodes:binary,offsets:binary,targets:binary>"
PARTS = f"part long, width int, ids array<long>, matrix binary, levels array<{LEVEL}>"


def nearest(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of unit vectors the indexes of its `most` nearest others, nearest first, and their similarities."""
    most = min(most, len(x) - 1)
    found = np.empty((len(x), most), np.int64)
    score = np.empty((len(x), most))
    for at in range(0, len(x), 1024):
        near = x[at : at + 1024] @ x.T
        rows = np.arange(len(near))
        near[rows, rows + at] = -np.inf
        top = np.argpartition(-near, most - 1, axis=1)[:, :most] if most < near.shape[1] else np.argsort(-near, axis=1)[:, :most]
        values = np.take_along_axis(near, top, axis=1)
        order = np.lexsort((top, -values), axis=1)
        found[at : at + 1024], score[at : at + 1024] = np.take_along_axis(top, order, 1), np.take_along_axis(values, order, 1)
    return found, score


def spread_links(x: np.ndarray, near: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Which of the near ones are linked: in their order, those nearer to the vector than to any taken before, then others up to `most`."""
    taken = np.zeros(near.shape, bool)
    for at in range(0, len(x), 256):
        some = x[near[at : at + 256]]
        between = np.einsum("icd,ijd->icj", some, some)
        own = taken[at : at + 256]
        for c in range(near.shape[1]):
            blocked = (own[:, :c] & (between[:, c, :c] > score[at : at + 256, c, None])).any(axis=1)
            own[:, c] = ~blocked & (own.sum(axis=1) < most)
        short = most - own.sum(axis=1)
        rest = ~own
        own |= rest & (np.cumsum(rest, axis=1) <= short[:, None])
    return taken


def level_links(x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and targets of the links of unit vectors among themselves, so that all can be reached from the first."""
    n = len(x)
    if n < 2:
        return np.zeros(n + 1, np.int32), np.empty(0, np.int32)
    near, score = nearest(x, CANDIDATES)
    row, column = np.nonzero(spread_links(x, near, score, most))
    a, b, s = row, near[row, column], score[row, column]
    a, b, s = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([s, s])  # and back
    pair, first = np.unique(a * n + b, return_index=True)
    a, b, s = pair // n, pair % n, s[first]
    order = np.lexsort((b, -s, a))
    a, b = a[order], b[order]
    starts = np.searchsorted(a, np.arange(n))
    keep = np.arange(len(a)) - starts[a] < 2 * most  # of very many links back the nearest stay
    a, b = a[keep], b[keep]
    reached = np.zeros(n, bool)
    more: list[tuple[int, int]] = []
    front = np.array([0])
    while True:
        while len(front):
            reached[front] = True
            front = np.unique(b[np.isin(a, front)])
            front = front[~reached[front]]
        if reached.all():
            break
        lost = int(np.flatnonzero(~reached)[0])
        inside = np.flatnonzero(reached)
        more.append((int(inside[(x[inside] @ x[lost]).argmax()]), lost))
        front = np.array([lost])
    if more:
        extra = np.array(more)
        a, b = np.concatenate([a, extra[:, 0]]), np.concatenate([b, extra[:, 1]])
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
    return np.searchsorted(a, np.arange(n + 1)).astype(np.int32), b.astype(np.int32)


def build_part(ids: np.ndarray, matrix: np.ndarray, links: int = LINKS) -> list[dict]:
    """The levels of a part, from the top to the one of all vectors: node numbers with offsets and targets (places among the nodes)."""
    draw = np.random.default_rng(len(ids))
    level = np.floor(-np.log(1 - draw.random(len(ids))) / np.log(links)).astype(int)
    x, out = unit(matrix), []
    for k in range(int(level.max(initial=0)), -1, -1):
        nodes = np.flatnonzero(level >= k)
        offsets, targets = level_links(x[nodes], links if k == 0 else links // 2)
        out.append({"nodes": nodes.astype(np.int32).tobytes(), "offsets": offsets.tobytes(), "targets": targets.tobytes()})
    return out


def graph_index(vectors: DataFrame, id_col: str = "id", vector_col: str = "embedding", part_rows: int = PART_ROWS, links: int = LINKS) -> DataFrame:
    """The index, to be written: part, width, ids, matrix, levels. Vectors of zeros and null ones are in no part; rows are dealt by
    id and vector, vectors of different widths to different parts."""
    rows = vectors.where(F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.exists("v", lambda x: x != 0))
    parts = max(1, -(-rows.count() // part_rows))
    rows = rows.withColumn("width", F.size("v")).withColumn("part", F.pmod(F.xxhash64("id", "v"), F.lit(parts)))

    def run(given: pa.Table) -> pa.Table:
        given = given.combine_chunks()
        order = np.argsort(np.array(given.column("id").fill_null(-(1 << 62)) if given.num_rows else []), kind="stable")
        given = given.take(pa.array(order))
        width = given.column("width")[0].as_py()
        matrix = np.array(given.column("v").combine_chunks().flatten(), np.float64).reshape(-1, width)
        ids = given.column("id").to_pylist()
        levels = build_part(np.array(order), matrix, links)
        return pa.table({"part": given.column("part").slice(0, 1), "width": pa.array([width], pa.int32()), "ids": pa.array([ids], pa.list_(pa.int64())), "matrix": pa.array([matrix.tobytes()], pa.binary()), "levels": pa.array([levels])})

    return rows.groupBy("part", "width").applyInArrow(run, PARTS)


def adjacency(index: DataFrame) -> DataFrame:
    """part, level (0 holds all vectors), id, neighbours (ids): the graph as rows."""

    def run(batches):
        for batch in batches:
            for part, ids, levels in zip(*(batch.column(c).to_pylist() for c in ("part", "ids", "levels"))):
                for k, level in enumerate(reversed(levels)):
                    nodes, offsets, targets = (np.frombuffer(level[c], np.int32) for c in ("nodes", "offsets", "targets"))
                    near = [[ids[nodes[t]] for t in targets[offsets[i] : offsets[i + 1]]] for i in range(len(nodes))]
                    yield pa.RecordBatch.from_arrays([pa.array([part] * len(nodes), pa.int64()), pa.array([k] * len(nodes), pa.int32()), pa.array([ids[i] for i in nodes], pa.int64()), pa.array(near, pa.list_(pa.int64()))], names=["part", "level", "id", "neighbours"])

    return index.select("part", "ids", "levels").mapInArrow(run, "part long, level int, id long, neighbours array<long>")


class Graph:
    """A part in memory."""

    def __init__(self, matrix: np.ndarray, levels: list[dict]):
        self.x = unit(matrix)
        self.levels = [tuple(np.frombuffer(level[c], np.int32) for c in ("nodes", "offsets", "targets")) for level in levels]

    def search(self, q: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, int]:
        """The places of about the k nearest of a unit vector, nearest first, and how many distances were taken."""
        entry, taken = 0, 0
        for at, (nodes, offsets, targets) in enumerate(self.levels):
            bottom = at == len(self.levels) - 1
            width = max(beam, k) if bottom else 1
            start = int(np.searchsorted(nodes, entry))
            known = np.zeros(len(nodes), bool)
            known[start] = True
            best, score, open_ = np.array([start]), self.x[nodes[[start]]] @ q, np.array([True])
            taken += 1
            while open_.any():
                follow = np.flatnonzero(open_)[: STEP if bottom else 1]
                open_[follow] = False
                new = np.unique(np.concatenate([targets[offsets[i] : offsets[i + 1]] for i in best[follow]]))
                new = new[~known[new]]
                if not len(new):
                    continue
                known[new] = True
                near = self.x[nodes[new]] @ q
                taken += len(new)
                best, score, open_ = np.concatenate([best, new]), np.concatenate([score, near]), np.concatenate([open_, np.ones(len(new), bool)])
                order = np.argsort(-score, kind="stable")[:width]
                best, score, open_ = best[order], score[order], open_[order]
            entry = int(nodes[best[0]])
        return nodes[best[:k]], taken


def graph_topk(index: DataFrame, queries: DataFrame, k: int = 10, beam: int = 24) -> DataFrame:
    """query_id, id, score, rank, distances: about the k nearest of each of a stated set of queries (query_id, query), the best of
    those that every part finds, and how many distances the query took in all parts."""

    def run(batches):
        for batch in batches:
            for width, ids, matrix, levels, query_ids, queries in zip(*(batch.column(c).to_pylist() for c in ("width", "ids", "matrix", "levels", "query_ids", "queries"))):
                v, q = (np.frombuffer(x, np.float64).reshape(-1, width) for x in (matrix, queries))
                graph, norm, names = Graph(v, levels), np.linalg.norm(v, axis=1), np.array(ids, object)
                out = []
                for name, row in zip(query_ids, q):
                    size = np.linalg.norm(row)
                    if size == 0:
                        continue
                    near, taken = graph.search(row / size, k, beam)
                    score = np.round(v[near] @ row / (norm[near] * size), 6)
                    out += zip([name] * len(near), names[near].tolist(), score.tolist(), [taken] + [0] * (len(near) - 1))
                columns = list(zip(*out)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.int64()))], names=["query_id", "id", "score", "distances"])

    blocks = query_blocks(queries).drop("list").withColumnRenamed("width", "w")
    pairs = index.crossJoin(blocks).where("width = w").select("width", "ids", "matrix", "levels", "query_ids", "queries")
    found = pairs.mapInArrow(run, "query_id long, id long, score double, distances long")
    own = Window.partitionBy("query_id")
    ranked = found.withColumns({"distances": F.sum("distances").over(own), "rank": F.row_number().over(own.orderBy(F.desc("score"), "id"))})
    return ranked.where(F.col("rank") <= k).select("query_id", "id", "score", "rank", "distances")
