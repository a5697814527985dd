"""Hard negatives from Strassen products of anchor and candidate tiles, merged in bounded heaps (operator 11)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vacancia.llm.common import stored
from vacancia.llm.vectors import as_matrix, products, whole_vectors

LEAF, COLUMNS = 16, 2048


def _even(x: np.ndarray) -> np.ndarray:
    """With a row or column of zeros where their number is odd."""
    m, n = x.shape
    out = np.zeros((m + m % 2, n + n % 2), dtype=x.dtype)
    out[:m, :n] = x
    return out


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` by seven half-size products, down to tiles with a side of at most LEAF.

    Odd sides get a row or column of zeros. Sums of 64-bit integers wrap round, so the result is exact wherever it fits 64
    bits, whatever the steps between do; Python integers (dtype object) are exact always.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a, b = _even(a), _even(b)
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    c = np.empty((2 * i, 2 * l), dtype=a.dtype)
    c11, c12, c21, c22 = c[:i, :l], c[:i, l:], c[i:, :l], c[i:, l:]
    p = strassen(a11 + a22, b11 + b22)
    c11[:], c22[:] = p, p
    p = strassen(a21 + a22, b11)
    c21[:] = p
    c22 -= p
    p = strassen(a11, b12 - b22)
    c12[:] = p
    c22 += p
    p = strassen(a22, b21 - b11)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22)
    c11 -= p
    c12 += p
    c22 += strassen(a21 - a11, b11 + b12)
    c11 += strassen(a12 - a22, b21 + b22)
    return c[:m, :n]


def _sides(anchors: pa.Table, rows: pa.Table) -> tuple[np.ndarray, ...]:
    """Ids, label numbers and vectors of both sides; the second in the order of its ids, so that a stable sort by score settles ties."""
    rows = rows.sort_by("id")
    labels = pa.chunked_array([*anchors["label"].chunks, *rows["label"].chunks], pa.string()).dictionary_encode().unify_dictionaries()
    codes = np.concatenate([c.indices.to_numpy() for c in labels.chunks]) if labels.num_chunks else np.zeros(0, int)
    n = anchors.num_rows
    return anchors["id"].to_numpy(), codes[:n], as_matrix(anchors["v"].to_pylist()), rows["id"].to_numpy(), codes[n:], as_matrix(rows["v"].to_pylist())


def _tiles(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Scores of all rows of ``a`` against some rows of ``b`` at a time."""
    for start in range(0, len(b), COLUMNS):
        part = slice(start, start + COLUMNS)
        yield part, products(a, b[part], strassen)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, ~scores))[:k]  # ~ turns the order round without overflow
    return ids[order], scores[order]


def _grid(anchors: DataFrame, rows: DataFrame, anchor_rows: int, candidate_rows: int):
    """Both sides dealt out over a grid: each cell holds about ``anchor_rows`` by ``candidate_rows`` rows, each pair meets in one cell."""
    down = max(1, -(-anchors.count() // anchor_rows))
    across = max(1, -(-rows.count() // candidate_rows))
    part = lambda seed, n: F.pmod(F.xxhash64("id", "mark", F.lit(seed)), F.lit(n)).cast("int")
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("down", part(1, down)).select("*", copies(across).alias("across"))
    right = rows.withColumn("across", part(2, across)).select("*", copies(down).alias("down"))
    cell = ["dim", "down", "across"]
    return left.groupBy(cell).cogroup(right.groupBy(cell))


def _heap(found: DataFrame, owner: list[str], item: str, k: int) -> DataFrame:
    """The k best of each owner: every cell has cut its own to k before, Spark cuts once more ahead of the shuffle."""
    order = Window.partitionBy(*owner).orderBy(F.desc("score"), item)
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: str,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    anchor_rows: int = 1024,
    candidate_rows: int = 4096,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the anchors, rows where ``is_anchor`` (on ``id``) holds.

    Vectors become whole numbers floor(256 * x); a score is the exact inner product with the anchor (beyond 64 bits the
    nearest number that has them), ties go to the smaller id. An anchor's positives are its best ``positives`` other rows of equal
    label; for each, the best ``negatives`` rows of another label whose score s is in the window low * p <= 100 * s <= 100 * p
    under the positive's score p. Anchors without positives and positives with an empty window give no rows.

    Rows with a null id, label or vector, an empty vector or a null or non-finite component take no part; only vectors of equal
    length are compared. Repeated rows count once; rows that share an id but not label and vector are rows of their own, never paired
    with each other. Other columns are not used.

    All pairs of anchors and rows are scored in cells of bounded size. The first pass takes only rows of the anchor's label in each
    cell, the second needs the scores of the first for its windows.
    """
    named = vectors.select(F.col(key).alias("id"), F.col(vector).alias("vec"), F.col(label).cast("string").alias("label")).where("label is not null")
    rows = whole_vectors(named, "id", "vec", keep=("label",)).distinct().withColumn("mark", F.xxhash64("label", "v"))
    rows = stored(rows, "vectors")
    anchors = stored(rows.where(is_anchor), "anchors")
    found_schema = pa.schema([("anchor_id", pa.int64()), ("anchor_mark", pa.int64()), ("positive_id", pa.int64()), ("score", pa.int64())])
    window_schema = pa.schema([("anchor_id", pa.int64()), ("anchor_mark", pa.int64()), ("positive_score", pa.int64()), ("negative_id", pa.int64()), ("score", pa.int64())])

    def table(columns: list[list], schema: pa.Schema) -> pa.Table:
        flat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in flat], schema=schema)

    def same_label(own: pa.Table, others: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if own.num_rows and others.num_rows:
            a_ids, a_labels, a, ids, labels, b = _sides(own, others)
            marks = own["mark"].to_numpy()
            for code in np.unique(a_labels):
                mine, theirs = np.flatnonzero(a_labels == code), np.flatnonzero(labels == code)
                for part, scores in _tiles(a[mine], b[theirs]):
                    there = ids[theirs[part]]
                    for row, line in zip(mine, scores, strict=True):
                        other = there != a_ids[row]
                        best, s = _best(there[other], line[other], positives)
                        for column, x in zip(out, (a_ids[row], marks[row], best, s), strict=True):
                            column.append(np.broadcast_to(x, best.shape))
        return table(out, found_schema)

    def in_window(own: pa.Table, others: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if own.num_rows and others.num_rows:
            a_ids, a_labels, a, ids, labels, b = _sides(own, others)
            marks, windows = own["mark"].to_numpy(), [np.array(w, dtype=object) for w in own["windows"].to_pylist()]
            for part, scores in _tiles(a, b):
                for row, line in enumerate(scores):
                    own_windows = windows[row]
                    floors = [-(-low * p // 100) for p in own_windows]
                    here = np.flatnonzero((labels[part] != a_labels[row]) & (ids[part] != a_ids[row]) & (line >= min(floors)) & (line <= max(own_windows)))
                    if not len(here):
                        continue
                    there, s = _best(ids[part][here], line[here], len(here))
                    for p, floor in zip(own_windows, floors, strict=True):
                        fits = np.flatnonzero((s <= p) & (s >= floor))[:negatives]
                        for column, x in zip(out, (a_ids[row], marks[row], p, there[fits], s[fits]), strict=True):
                            column.append(np.broadcast_to(np.asarray(x, dtype=np.int64), fits.shape))
        return table(out, window_schema)

    near = _grid(anchors, rows, anchor_rows, candidate_rows).applyInArrow(same_label, "anchor_id long, anchor_mark long, positive_id long, score long")
    mine = stored(_heap(near.distinct(), ["anchor_id", "anchor_mark"], "positive_id", positives).drop("rank"), "positives")
    windows = mine.groupBy(F.col("anchor_id").alias("id"), F.col("anchor_mark").alias("mark")).agg(F.collect_set("score").alias("windows"))
    asked = stored(anchors.join(windows, ["id", "mark"]), "windows")
    met = _grid(asked, rows, anchor_rows, candidate_rows).applyInArrow(in_window, "anchor_id long, anchor_mark long, positive_score long, negative_id long, score long")
    owner = ["anchor_id", "anchor_mark", "positive_score"]
    ranked = _heap(met.distinct(), owner, "negative_id", negatives)
    out = mine.withColumnRenamed("score", "positive_score").join(ranked, owner)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score"))
