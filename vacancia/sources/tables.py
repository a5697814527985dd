"""Reading and writing tables."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from vacancia.session import scratch_folder
from vacancia.sources.schemas import MULTILINE, SCHEMAS


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, on whichever file system it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header, quoted fields with doubled quotes, columns found by name.

    Columns are read as text and cast: numbers come as ``12.0`` where a column has
    gaps, and a value that is no number becomes null rather than a bad row. Columns the
    file lacks are null.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    header = reader.csv(path).columns
    raw = reader.schema(StructType([StructField(c, StringType()) for c in header])).csv(path)
    out = []
    for f in schema.fields:
        if f.name not in header:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (LongType, IntegerType)):
            # "12" directly (exact for long ids), "12.0" by way of double
            exact = c.try_cast(f.dataType)
            c = F.coalesce(exact, c.try_cast("double").try_cast(f.dataType))
        elif isinstance(f.dataType, DoubleType):
            d = c.try_cast("double")
            c = F.when(~F.isnan(d), d)
        out.append(c.alias(f.name))
    return raw.select(*out)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None, multi_line: bool = False):
    """Parquet, or CSV where the path says so."""
    if path.rstrip("/").endswith(".csv"):
        if schema is None:
            return spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path)
        return read_csv(spark, path, schema, multi_line)
    return spark.read.parquet(path)


def load_tables(
    spark: SparkSession,
    folder: str,
    schemas: Mapping[str, StructType] = SCHEMAS,
    missing: str = "error",
    fmt: str = "csv",
) -> dict[str, DataFrame]:
    """All named tables of a folder. ``missing='skip'`` warns about absent ones and goes on."""
    if missing not in ("error", "skip"):
        raise ValueError(f"missing must be 'error' or 'skip', not {missing!r}")
    out = {}
    for name, schema in schemas.items():
        path = f"{folder}/{name}.{fmt}"
        if not exists(spark, path):
            if missing == "error":
                raise FileNotFoundError(path)
            warnings.warn(f"{path} not found, left out", stacklevel=2)
            continue
        out[name] = read_table(spark, path, schema, name in MULTILINE)
    return out


def to_parquet(tables: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Write every table as Parquet once and read it from there: CSV neither splits well nor prunes columns."""
    return {name: materialize(df, f"{folder}/{name}.parquet") for name, df in tables.items()}


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    writer = df.write.mode(mode).partitionBy(*partition_by) if partition_by else df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write to the shared folder and read back: used where a result feeds many others. Survives lost executors."""
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``materialize`` in a new scratch folder that goes when the application ends."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return materialize(df, path)


def first_available(
    spark: SparkSession, paths: Sequence[str], schema: StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """The first of the paths that exists: the full source, then its stand-ins."""
    for path in paths:
        if exists(spark, path):
            return read_table(spark, path, schema, multi_line)
    raise FileNotFoundError(", ".join(paths))


def preview(df: DataFrame, n: int = 5) -> tuple[list[str], DataFrame]:
    return df.columns, df.limit(n)


def data_dictionary(df: DataFrame, descriptions: Mapping[str, str] | None = None) -> DataFrame:
    """(position, column_name, dtype, description). Descriptions come from the call, else from the column's comment."""
    descriptions = descriptions or {}
    rows = [
        (i, f.name, f.dataType.simpleString(), descriptions.get(f.name) or (f.metadata or {}).get("comment"))
        for i, f in enumerate(df.schema.fields, 1)
    ]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, dtype string, description string")
