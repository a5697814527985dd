"""Shared storage between steps, row keys, connected components."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where it is unset a local session gets a temporary folder; on a cluster that is an error,
    because files in a machine's own folder are not seen by the others.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="vacancia-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors.

    The files go when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Collect the driver's garbage, so that Spark's cleaner removes the shuffle files of data frames that nobody holds any
    more: of steps whose result is in a table. Twice, with a pause: the first time lets go of the query, the second of
    what it held."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def discard(df: DataFrame) -> None:
    """Delete a table made by ``stored`` that a later one has replaced."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def emit(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[str | None]:
    """One text at a time, so that a batch is not held twice."""
    return (v.as_py() for v in batch.column(column))


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the edges; root is the smallest node reachable.

    Alternates the large-star and small-star steps until the edges stay as they are. Each step takes the least
    neighbour by partial aggregation, so a node with many neighbours is no large group; its edges meet
    the result in an ordinary join that Spark can split. Only counts and hash sums reach the driver.
    """
    now = stored(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(), "edges")
    state = None
    while True:
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == state or not found[0]:
            break
        state = found
        both = now.union(now.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = stored(small.union(low).distinct(), "edges")
        discard(now)
        now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
