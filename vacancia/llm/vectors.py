"""Vectors as whole numbers and their exact inner products, for the operators on embeddings."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import emit

FLOAT_EXACT, LONG_EXACT = 2.0**53, 2.0**62
LEAST, MOST = -(1 << 63), (1 << 63) - 1
Product = Callable[[np.ndarray, np.ndarray], np.ndarray]


def whole_vectors(vectors: DataFrame, key: str, vector: str, scale: int = 256, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, dim, v, *keep): components floor(scale * x), each x as a double, as doubles in a binary.

    ``scale`` is a power of two, so every such double is exact. Vectors null, empty or with a null or non-finite component
    and rows without id are left out; components may be as large as a double holds.
    """
    finite = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vec"), *keep).where("id is not null and size(vec) > 0")
    rows = rows.where(F.coalesce(finite, F.lit(False))).select("id", F.col("vec").cast("array<double>").alias("vec"), *keep)
    kept = [f for f in rows.schema if f.name in keep]
    columns = ", ".join(["id long", "dim int", "v binary", *(f"{f.name} {f.dataType.simpleString()}" for f in kept)])

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [np.floor(v.values.to_numpy() * scale) + 0.0 for v in b.column(1)]  # -0.0 becomes 0.0
            schema = pa.schema([("id", pa.int64()), ("dim", pa.int32()), ("v", pa.binary()), *(b.schema.field(2 + i) for i in range(len(kept)))])
            yield emit(schema, [b.column(0), [len(r) for r in rows], [r.astype("<f8").tobytes() for r in rows], *b.columns[2:]])

    return rows.mapInArrow(pack, columns)


def as_matrix(blobs: Iterable[bytes]) -> np.ndarray:
    rows = [np.frombuffer(b, dtype="<f8") for b in blobs]
    return np.stack(rows) if rows else np.zeros((0, 0))


def blas(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of 64-bit integers, in floating point where no sum can leave its exact range."""
    if a.dtype != object and float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1]) < FLOAT_EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def products(a: np.ndarray, b: np.ndarray, multiply: Product = blas) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and of ``b`` (whole numbers as doubles), as 64-bit integers.

    ``multiply`` gets 64-bit integers wherever their sums fit; rows with larger components are multiplied as Python
    integers, and a product that leaves 64 bits becomes the nearest number that has them.
    """
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    if not out.size:
        return out
    most = (LONG_EXACT / a.shape[1]) ** 0.5
    small_a, small_b = np.abs(a).max(axis=1) < most, np.abs(b).max(axis=1) < most
    for rows, own in ((small_a, True), (~small_a, False)):
        for columns, other in ((small_b, True), (~small_b, False)):
            if not rows.any() or not columns.any():
                continue
            x, y = a[rows], b[columns].T
            if own and other:
                part = multiply(x.astype(np.int64), y.astype(np.int64))
            else:
                whole = np.frompyfunc(int, 1, 1)
                part = np.clip(multiply(whole(x), whole(y)), LEAST, MOST).astype(np.int64)
            out[np.ix_(rows, columns)] = part
    return out
