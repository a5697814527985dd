"""K-means of many numbers of clusters and many starts, all advanced by the same scans."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SUMS = "run int, slot int, at int, value double"
_SLICE = 8192  # rows of a batch measured together: their distances to all centres are held at once
_STRIP = 1024  # the same for scans of all runs: their distances to some hundred centres stay in the processor's cache


@dataclass
class Run:
    """One start: its centres, how many scans moved them, and the squared distances left over.

    Of each cluster at the end: its rows, how far its mean is from its centre, and the squared distances to the mean.
    """

    k: int
    start: int
    centres: np.ndarray
    cost: float = 0.0
    iterations: int = 0
    done: bool = False
    rows: np.ndarray = field(default_factory=lambda: np.zeros(0))
    shift: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    within: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def end(self, sums: np.ndarray) -> None:
        self.done, self.rows = True, sums[:, -2]
        n = self.rows[:, None]
        self.shift = np.where(n > 0, sums[:, :-2] / np.maximum(n, 1) - self.centres, 0.0)
        self.within = np.maximum(sums[:, -1] - self.rows * (self.shift**2).sum(axis=1), 0.0)


def _even(ids: np.ndarray, seed: int) -> np.ndarray:
    """Numbers in (0, 1] that depend on the id and the seed alone."""
    x = ids.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) / float(1 << 53)


def _batches(batches: Iterable[pa.RecordBatch], size: int = _SLICE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, points) of a few rows at a time; the first column has the ids, each other one a dimension."""
    for batch in batches:
        ids, points = batch.column(0).to_numpy(), np.array([c.to_numpy() for c in batch.columns[1:]])
        for at in range(0, batch.num_rows, size):
            yield ids[at : at + size], points[:, at : at + size].T


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, dimension by dimension: no cancellation, and exact zeros at the centres."""
    out = np.zeros((len(points), len(centres)))
    for d in range(points.shape[1]):
        out += (points[:, d, None] - centres[None, :, d]) ** 2
    return out


def _least_square(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The squared distance to the nearest centre."""
    least = np.full(len(points), np.inf)
    for c in centres:
        square = np.zeros(len(points))
        for d in range(points.shape[1]):
            square += (points[:, d] - c[d]) ** 2
        np.minimum(least, square, out=least)
    return least


def _next_centres(rows: DataFrame, chosen: list[np.ndarray], n_init: int, seed: int) -> list[np.ndarray | None]:
    """For each sequence of centres the next one: a row picked with odds in proportion to its squared distance to them.

    The row with the least exponential draw over its weight is such a pick; a task keeps its own least per sequence. None
    where every row lies on a centre.
    """
    schema = pa.schema([("run", pa.int32()), ("draw", pa.float64()), ("point", pa.list_(pa.float64()))])
    step = len(chosen[0]) if chosen else 0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[float, list[float]]] = {}
        for ids, points in _batches(batches):
            for i in range(n_init):
                draw = -np.log(_even(ids, (seed * 1009 + i) * 1009 + step))
                if chosen:
                    with np.errstate(divide="ignore"):
                        draw = draw / _least_square(points, chosen[i])
                at = int(draw.argmin())
                if np.isfinite(draw[at]) and (i not in best or (draw[at], points[at].tolist()) < best[i]):
                    best[i] = (float(draw[at]), points[at].tolist())
        found = [(i, *x) for i, x in best.items()]
        yield pa.record_batch([pa.array([x[c] for x in found], f.type) for c, f in enumerate(schema)], schema=schema)

    least = rows.mapInArrow(run, "run int, draw double, point array<double>").groupBy("run")
    picked = {r.run: np.array(r.x.point) for r in least.agg(F.min(F.struct("draw", "point")).alias("x")).collect()}
    return [picked.get(i) for i in range(n_init)]


def starts(rows: DataFrame, k: int, n_init: int, seed: int) -> list[np.ndarray]:
    """``n_init`` sequences of up to k centres, each centre picked by distance to those before it; one scan per centre."""
    chosen: list[np.ndarray] = []
    for _ in range(k):
        found = _next_centres(rows, chosen, n_init, seed)
        if all(x is None for x in found):
            break
        if not chosen:
            chosen = [x[None, :] for x in found]
        else:  # a sequence without a pick repeats its last centre: such a slot stays empty
            chosen = [np.vstack([c, c[-1] if x is None else x]) for c, x in zip(chosen, found)]
    return chosen


def _assigned(points: np.ndarray, centres: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre (among equals the first) and squared distance to it.

    ``score`` is |c|^2 - 2 x . c, a row per centre. It decides where one centre is clearly nearest; distances that close
    calls need, and those returned, are added up dimension by dimension.
    """
    best, second = score[0], np.full(len(points), np.inf)
    near = np.zeros(len(points), dtype=np.intp)
    for slot in range(1, len(centres)):
        closer = score[slot] < best
        second = np.where(closer, best, np.minimum(second, score[slot]))
        best = np.minimum(best, score[slot])
        near[closer] = slot
    close = np.flatnonzero(~(second - best > 1e-9 * (np.abs(best) + np.abs(second) + (points * points).sum(axis=1))))
    if len(close) and len(centres) > 1:
        near[close] = _squares(points[close], centres).argmin(axis=1)
    apart = points - centres[near]
    square = np.zeros(len(points))
    for d in range(points.shape[1]):
        square += apart[:, d] ** 2
    return near, square


def _nearest_masks(points: np.ndarray, squares: np.ndarray, centres: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """(run, slot, point): true at the nearest centre, among equals the first. ``scores`` as in ``_assigned``, of runs of one k."""
    best = scores.min(axis=1)
    nearest = scores <= (best + 2e-9 * (np.abs(best) + squares))[:, None]
    for run, at in zip(*_groups(nearest.sum(axis=1, dtype=np.int32) != 1)):
        near = _squares(points[at], centres[run]).argmin(axis=1)
        nearest[run][:, at] = False
        nearest[run][near, at] = True
    return nearest


def _groups(close: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """The runs that have close calls, and the points of each."""
    runs = np.flatnonzero(close.any(axis=1)).tolist()
    return runs, [np.flatnonzero(close[r]) for r in runs]


def _advance(rows: DataFrame, runs: Sequence[Run]) -> list[np.ndarray]:
    """One scan for all runs: per run an array of (slot, dimensions + 2) with each centre's sums, its rows and their cost.

    ``rows``: how often a point occurs, and the point. Runs of one k are measured together. The sums of all slots are one
    product; a slot's cost comes from its sums and the squared lengths of its points.
    """
    all_centres = [r.centres for r in runs]
    same = [(k, [i for i, _ in g]) for k, g in groupby(enumerate(all_centres), key=lambda x: len(x[1]))]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.vstack(all_centres)
        total = np.zeros((len(every), every.shape[1] + 2))
        scale = np.column_stack([-2.0 * every, (every * every).sum(axis=1)])
        for n, points in _batches(batches, _STRIP):
            n, squares = n.astype(np.float64), (points * points).sum(axis=1)
            scores = scale @ np.vstack([points.T, np.ones(len(n))])
            hits, at = np.empty_like(scores), 0
            for k, members in same:
                part = slice(at, at := at + k * len(members))
                centres = every[part].reshape(len(members), k, -1)
                hits[part] = _nearest_masks(points, squares, centres, scores[part].reshape(len(members), k, -1)).reshape(-1, len(n))
            total += hits @ np.column_stack([points * n[:, None], n, squares * n])
        parts, end = [], 0
        for i, centres in enumerate(all_centres):
            sums = total[end : (end := end + len(centres))]
            slot, at = np.nonzero(sums)
            parts.append((np.full(len(slot), i), slot, at, sums[slot, at]))
        cols = [np.concatenate(x) for x in zip(*parts)]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64()]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)], names=["run", "slot", "at", "value"])

    out = [np.zeros((len(c), c.shape[1] + 2)) for c in all_centres]
    sums = rows.mapInArrow(scan, _SUMS).groupBy("run", "slot", "at").agg(F.sum("value").alias("value"))
    for r in sums.collect():  # runs times centres times dimensions
        out[r.run][r.slot, r.at] = r.value
    for found, centres in zip(out, all_centres):
        apart = found[:, -1] - 2.0 * (centres * found[:, :-2]).sum(axis=1) + found[:, -2] * (centres * centres).sum(axis=1)
        found[:, -1] = np.maximum(apart, 0.0)
    return out


def silhouettes(points: DataFrame, runs: Sequence[Run]) -> list[float | None]:
    """The mean silhouette of all rows on squared Euclidean distances, of each run, in one scan; null with one cluster alone.

    ``points`` as ``distinct_points`` has them. The distances of a point x to a cluster's n points sum up to n |x - m|^2 + w, with
    their mean m and their squared distances w to it, which the run's last scan left. A point alone in its cluster scores 0.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, count = np.zeros(len(runs)), 0.0
        for n, x in _batches(batches):
            count += n.sum()
            for i, r in enumerate(runs):
                if (r.rows > 0).sum() < 2:
                    continue
                near, _ = _assigned(x, r.centres, (r.centres**2).sum(axis=1)[:, None] - 2.0 * (r.centres @ x.T))
                mean = r.centres + r.shift
                far = _squares(x, mean) + np.divide(r.within, r.rows, out=np.full(len(mean), np.inf), where=r.rows > 0)
                at = np.arange(len(x))
                own = r.rows[near]
                inner = far[at, near] * own / np.maximum(own - 1, 1)
                far[at, near] = np.inf
                outer = far.min(axis=1)
                most = np.maximum(inner, outer)
                gap = np.divide(outer - inner, most, out=np.zeros(len(x)), where=most > 0)
                score[i] += (np.where(own > 1, gap, 0.0) * n).sum()
        yield pa.record_batch([pa.array(range(len(runs)), pa.int32()), pa.array(score), pa.array(np.full(len(runs), count))], names=["run", "s", "n"])

    sums = points.mapInArrow(scan, "run int, s double, n double").groupBy("run").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    found = {r.run: r.s / r.n for r in sums.collect() if r.n}
    return [found.get(i) if (r.rows > 0).sum() > 1 else None for i, r in enumerate(runs)]


def _flat(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(id, a column per dimension) of the rows with a vector: plain numbers, which go to Python as they are."""
    vector = df.select(F.xxhash64(*keys).alias("id"), F.when(F.col("features").isNotNull(), vector_to_array("features")).alias("x"))
    rows = vector.where("x is not null")
    first = rows.select(F.size("x")).first()
    return rows.select("id", *(F.col("x")[i].alias(f"x{i}") for i in range(first[0] if first else 1)))


def distinct_points(rows: DataFrame) -> DataFrame:
    """How often a point occurs, and the point."""
    cols = rows.columns[1:]
    return rows.groupBy(*cols).agg(F.count("*").alias("n")).select("n", *cols)


def _cheapest(runs: Sequence[Run]) -> Run:
    """The run of least cost; of those that differ by rounding alone the first, as their clusters are the same under other numbers."""
    least = min(r.cost for r in runs)
    return min((r for r in runs if r.cost <= least * (1 + 1e-12)), key=lambda r: r.start)


def fit_all(
    df: DataFrame, keys: Sequence[str], ks: Sequence[int], n_init: int, seed: int = 42, iters: int = 300, tol: float = 1e-4
) -> list[Run]:
    """The runs of ``fit_measured``."""
    return fit_measured(df, keys, ks, n_init, seed, iters, tol)[0]


def fit_measured(
    df: DataFrame,
    keys: Sequence[str],
    ks: Sequence[int],
    n_init: int,
    seed: int = 42,
    iters: int = 300,
    tol: float = 1e-4,
    silhouette: bool = False,
) -> tuple[list[Run], dict[int, tuple[Run, float | None]]]:
    """Every (k, start) run of K-means over the rows' ``features`` vectors.

    All runs advance in one scan per iteration over the distinct points, each with the number of its rows; what leaves a
    task is a few numbers per run and centre. The first k of
    start i's centres begin run (k, i). A run ends when no centre moves farther than ``tol``, and its cost belongs to the
    centres it returns. A centre without rows stays where it is. The picks depend on the keys, not on the
    partitioning. Rows without a vector take no part; no rows at all give no runs. The second result has the cheapest run
    of each k and, if asked for, its silhouette.
    """
    rows = _flat(df, keys).persist()
    points = distinct_points(rows).persist()
    try:
        first = starts(rows, max(ks), n_init, seed)
        runs = [Run(k, i, c[: min(k, len(c))].copy()) for k in ks for i, c in enumerate(first)]
        for step in range(iters + 1):
            open_ = [r for r in runs if not r.done]
            if not open_:
                break
            for r, sums in zip(open_, _advance(points, open_)):
                r.cost = float(sums[:, -1].sum())
                n = sums[:, -2:-1]
                moved = np.where(n > 0, sums[:, :-2] / np.maximum(n, 1), r.centres)
                if step == iters or ((moved - r.centres) ** 2).sum(axis=1).max() <= tol * tol:
                    r.end(sums)  # the cost counted is that of these centres
                else:
                    r.centres, r.iterations = moved, r.iterations + 1
        cheapest = [_cheapest([r for r in runs if r.k == k]) for k in ks] if runs else []
        measured = silhouettes(points, cheapest) if silhouette and cheapest else [None] * len(cheapest)
    finally:
        points.unpersist()
        rows.unpersist()
    return runs, {r.k: (r, s) for r, s in zip(cheapest, measured)}


def nearest(df: DataFrame, centres: np.ndarray, name: str = "cluster") -> DataFrame:
    """Adds the number of the nearest centre, among equals the first; row by row. Null without a vector."""
    point = F.when(F.col("features").isNotNull(), vector_to_array("features"))
    literal = F.array(*(F.array(*map(F.lit, c)) for c in centres.tolist()))

    def measured(centre, at):
        apart = F.zip_with("_p", centre, lambda a, b: (a - b) * (a - b))
        return F.struct(F.aggregate(apart, F.lit(0.0), lambda s, v: s + v).alias("d"), at.alias("i"))

    best = F.array_min(F.transform(literal, measured))["i"]
    return df.withColumn("_p", point).withColumn(name, F.when(F.col("_p").isNotNull(), best)).drop("_p")
