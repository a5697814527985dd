"""Exact top-k inner products by a dual-tree search over cover-tree nodes (operator 7)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vacancia.llm.common import emit, stored
from vacancia.llm.vectors import LEAST, as_matrix, products, whole_vectors


@dataclass
class CoverTree:
    """Centres of the levels of a cover tree on a bounded sample: level i has points further than ``radii[i]`` apart, among
    them those of level i - 1; ``parents[i]`` gives each centre's nearest one in the level above."""

    centres: list[np.ndarray]
    parents: list[np.ndarray]

    @classmethod
    def fit(cls, sample: np.ndarray, leaves: int) -> CoverTree:
        points = sample.astype(np.float64)
        order, far = [0], ((points - points[0]) ** 2).sum(axis=1)
        spread = [np.inf]
        while len(order) < min(leaves, len(points)) and far.max() > 0:  # farthest point first
            i = int(far.argmax())
            order.append(i)
            spread.append(float(far[i]) ** 0.5)
            far = np.minimum(far, ((points - points[i]) ** 2).sum(axis=1))
        sizes, radius = [1], spread[-1] if len(spread) == 1 else spread[1]
        while sizes[-1] < len(order):  # a level per halved radius
            radius /= 2
            n = sum(x > radius for x in spread)
            if n > sizes[-1]:
                sizes.append(n)
        centres = [points[order[:n]] for n in sizes]
        parents = [np.zeros(1, dtype=np.int64)]
        parents += [nearest(b, a)[0] for a, b in zip(centres, centres[1:], strict=False)]
        return cls(centres, parents)


def nearest(rows: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and distance to each row's nearest centre."""
    best = ((centres**2).sum(axis=1)[None, :] - 2 * rows @ centres.T).argmin(axis=1)
    return best, np.sqrt(((rows - centres[best]) ** 2).sum(axis=1))


def surviving(tree: CoverTree, data: list[np.ndarray], query: list[np.ndarray], worst: list[np.ndarray], counts: list[np.ndarray], most: int) -> list[tuple[int, int, int]]:
    """(level, query node, data leaf) left by the dual-tree traversal from the pair of roots.

    ``data[i]`` and ``query[i]`` are covering radii of the nodes of level i (-1: no rows), ``worst`` the least of the
    queries' kth scores so far. A pair goes if q.x <= cq.cx + |cq| rx + |cx| rq + rq rx of its balls is under that. Query
    nodes are opened until they have ``most`` queries or are leaves, data nodes down to the leaves.
    """
    leaf = len(tree.centres) - 1
    children = [[np.flatnonzero(tree.parents[i + 1] == n) for n in range(len(tree.centres[i]))] for i in range(leaf)]
    done, todo = [], [(0, 0, 0, 0)]
    while todo:
        i, q, j, x = todo.pop()
        rq, rx = query[i][q], data[j][x]
        if rq < 0 or rx < 0:
            continue
        cq, cx = tree.centres[i][q], tree.centres[j][x]
        nq, nx = np.linalg.norm(cq), np.linalg.norm(cx)
        top = cq @ cx + nq * rx + nx * rq + rq * rx
        slack = 1e-9 * (nq + rq) * (nx + rx) + 1e-6
        if max(top + slack, float(LEAST)) < worst[i][q]:
            continue
        open_query = i < leaf and counts[i][q] > most
        if open_query and (i <= j or j == leaf):
            todo += [(i + 1, int(c), j, x) for c in children[i][q]]
        elif j < leaf:
            todo += [(i, q, j + 1, int(c)) for c in children[j][x]]
        else:
            done.append((i, q, x))
    return done


def top_k(
    vectors: DataFrame, is_query: str, k: int = 5, key: str = "vec_id", vector: str = "embedding", leaves: int = 64, sample: int = 2048, block: int = 1024
) -> DataFrame:
    """(query_id, rank, id, score): the k rows of greatest inner product for each query, all if there are fewer.

    ``is_query`` is a condition on ``id``. Candidates are all rows but the query's own; ties go to the smaller id; only vectors
    of equal length are compared. ``sample`` rows of least hash fit the tree and give each query a first bound on its
    kth score; every row is indexed. Of equal vectors only the k + 1 smallest ids can show in a result, so the others are
    left before the search, and equal queries are searched once: large groups of copies cost nothing. Repeated rows
    (equal id and vector) count once.
    """
    every = stored(whole_vectors(vectors, key, vector), "vectors")
    first = Window.partitionBy("dim", "v").orderBy("id")
    distinct = every.distinct()
    data = stored(distinct.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1).drop("r"), "data")
    asked = distinct.where(is_query)
    searched = asked.groupBy("dim", "v").agg(F.min("id").alias("id"))
    found = None
    for dim in sorted(r.dim for r in asked.select("dim").distinct().collect()):
        one = _search(data.where(F.col("dim") == dim), stored(searched.where(F.col("dim") == dim), "queries"), k + 1, leaves, sample, block)
        found = one if found is None else found.union(one)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, id long, score long")
    by_vector = searched.select("dim", "v", F.col("id").alias("rep"))
    queries = asked.join(by_vector, ["dim", "v"]).select(F.col("id").alias("query_id"), "rep")
    hits = queries.join(stored(found, "found"), "rep").where("id <> query_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "id", "score")


def _search(data: DataFrame, queries: DataFrame, k: int, leaves: int, sample: int, block: int) -> DataFrame:
    """(rep, id, score): the k best of ``data`` for each of the distinct ``queries``, own row included."""
    spark = data.sparkSession
    drawn = as_matrix(r.v for r in data.select("v").orderBy(F.xxhash64("id")).limit(sample).collect())
    tree = CoverTree.fit(drawn, leaves)
    depth = len(tree.centres)
    path = ", ".join(f"n{i} int" for i in range(depth))
    paths = pa.schema([("id", pa.int64()), ("v", pa.binary()), *((f"n{i}", pa.int32()) for i in range(depth))])
    stats = pa.schema([("level", pa.int32()), ("node", pa.int32()), ("radius", pa.float64()), ("worst", pa.float64()), ("n", pa.int64())])

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = nearest(as_matrix(b.column(1).to_pylist()), tree.centres[-1])[0] if b.num_rows else np.zeros(0, int)
            nodes = [at]
            for parents in reversed(tree.parents[1:]):
                nodes.append(parents[nodes[-1]])
            yield emit(paths, [b.column(0), b.column(1), *reversed(nodes)])

    def measure(batches: Iterable[pa.RecordBatch], bound: bool) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            rows = as_matrix(b.column(1).to_pylist())
            worst = np.full(len(rows), -np.inf)
            if bound and len(drawn) >= k:
                worst = np.partition(products(rows, drawn), -k, axis=1)[:, -k].astype(np.float64)
            for i in range(depth):
                at = b.column(2 + i).to_numpy()
                gap = np.sqrt(((rows - tree.centres[i][at]) ** 2).sum(axis=1))
                for node in np.unique(at):
                    own = at == node
                    yield emit(stats, [[i], [int(node)], [gap[own].max()], [worst[own].min()], [int(own.sum())]])

    def index(rows: DataFrame, name: str, bound: bool) -> tuple[DataFrame, list, list, list]:
        placed = stored(rows.select("id", "v").mapInArrow(place, f"id long, v binary, {path}"), name)
        out = placed.mapInArrow(lambda batches: measure(batches, bound), "level int, node int, radius double, worst double, n long")
        nodes = out.groupBy("level", "node").agg(F.max("radius").alias("radius"), F.min("worst").alias("worst"), F.sum("n").alias("n")).collect()
        radius, worst, n = ([np.full(len(c), v) for c in tree.centres] for v in (-1.0, np.inf, 0))
        for r in nodes:
            radius[r.level][r.node], worst[r.level][r.node], n[r.level][r.node] = r.radius, r.worst, r.n
        return placed, radius, worst, n

    placed, data_radius, _, data_n = index(data, "data", False)
    asked, query_radius, worst, query_n = index(queries, "asked", True)
    pairs = surviving(tree, data_radius, query_radius, worst, query_n, block)

    def blocks(rows: DataFrame, node: str, counts: np.ndarray, as_: str) -> DataFrame:
        """Rows of a node packed into blocks of about ``block`` rows."""
        parts = spark.createDataFrame([(i, int(-(-n // block))) for i, n in enumerate(counts) if n], "node int, parts int")
        dealt = rows.join(F.broadcast(parts), F.col(node) == F.col("node")).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
        return dealt.groupBy("node", "part").agg(F.collect_list(F.struct("id", "v")).alias(as_)).select("node", as_)

    leaf_blocks = blocks(placed, f"n{depth - 1}", data_n[-1], "data").withColumnRenamed("node", "leaf")
    met = None
    for level in sorted({i for i, _, _ in pairs}):
        side = spark.createDataFrame([(q, x) for i, q, x in pairs if i == level], "node int, leaf int")
        one = blocks(asked, f"n{level}", query_n[level], "asked").join(F.broadcast(side), "node").select("leaf", "asked")
        met = one if met is None else met.union(one)
    if met is None:
        return spark.createDataFrame([], "rep long, id long, score long")
    schema = pa.schema([("rep", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for asked_rows, rows in zip(b.column(0), b.column(1), strict=True):
                q, d = asked_rows.values, rows.values
                ids = d.field("id").to_numpy()
                order = np.argsort(ids)
                marks = products(as_matrix(q.field("v").to_pylist()), as_matrix(d.field("v").to_pylist()))[:, order]
                best = np.argsort(~marks, axis=1, kind="stable")[:, :k]  # ~ turns the order round without overflow
                reps = np.repeat(q.field("id").to_numpy(), best.shape[1])
                yield emit(schema, [reps, ids[order][best].ravel(), np.take_along_axis(marks, best, axis=1).ravel()])

    scored = met.join(leaf_blocks, "leaf").select("asked", "data").mapInArrow(score, "rep long, id long, score long")
    best = Window.partitionBy("rep").orderBy(F.desc("score"), "id")
    return scored.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).drop("r")
