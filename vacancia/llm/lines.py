"""Line deduplication by a suffix array over line ids, DataFrame operations only (operator 3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vacancia.llm.common import discard, stored


def ranked(keys: DataFrame, by: list[str]) -> DataFrame:
    """``keys`` (distinct rows) with their place in the order of ``by``, as ``rank``: a running count over ranges.

    The rows are dealt by range and counted within their partition; only the partitions' sizes meet in one place.
    """
    dealt = stored(keys.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("p", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("p").agg(F.count("*").alias("n"))
    before = sizes.select("p", (F.sum("n").over(Window.orderBy("p")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("p").orderBy(*by))
    return dealt.withColumn("r", within).join(F.broadcast(before), "p").withColumn("rank", F.col("before") + F.col("r") - 1).drop("p", "r", "before")


def suffix_ranks(lines: DataFrame, depth: int) -> DataFrame:
    """(doc, at, rank): the suffix array of line-id sequences, sorted to ``depth`` lines by prefix doubling.

    ``lines`` has (doc, at, id). A round ranks pairs (rank of the first k lines, rank of the next ones), which makes
    2k, until depth is reached; the last round overlaps where depth is no power of two. Equal ranks are an interval of
    the suffix array whose longest common prefix is depth lines or more. Suffixes that differ from all others within
    depth, or end before it, are dropped as soon as that shows.
    """
    ids = lines.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    now = stored(lines.join(ranked(ids, ["id"]), "id").select("doc", "at", "rank"), "ranks")
    k = 1
    while k < depth:
        step = min(k, depth - k)
        # the rank of the suffix `step` lines on, null where that is alone or past the end
        ahead = Window.partitionBy("doc").orderBy("at").rangeBetween(step, step)
        pairs = now.withColumn("next", F.max("rank").over(ahead)).where("next is not null").withColumnRenamed("rank", "first")
        shared = pairs.groupBy("first", "next").agg(F.count("*").alias("n")).where("n > 1").select("first", "next")
        after = stored(pairs.join(ranked(shared, ["first", "next"]), ["first", "next"]).select("doc", "at", "rank"), "ranks")
        discard(now)
        now, k = after, k + step
    return now


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_lines: int = 3) -> DataFrame:
    """(id, h, gone): per distinct document (id and text, h is the text's hash) the positions of lines to delete, from 0.

    A line goes if it stands in a run of ``min_lines`` lines or more that also starts earlier, in a document of smaller id
    (null first) or further up in the same one. Maximal repeated runs are what such starts next to each other add up to.
    """
    row = F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"))
    parts = F.transform(F.split(F.col(text), "\n"), lambda x: F.unhex(F.md5(x.cast("binary"))))
    sequences = docs.where(F.col(text).isNotNull()).select(row.alias("doc"), parts.alias("ids")).where(F.size("ids") >= min_lines)
    lines = stored(sequences.dropDuplicates(["doc"]).select("doc", F.posexplode("ids").alias("at", "id")), "lines")
    runs = suffix_ranks(lines, min_lines)
    place = F.struct("doc", "at")
    first = runs.groupBy("rank").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("rank", "first")
    later = runs.join(first, "rank").where(place > F.col("first"))
    covered = F.flatten(F.collect_list(F.sequence("at", F.col("at") + (min_lines - 1))))  # of one document
    return later.groupBy("doc").agg(F.array_distinct(covered).alias("gone")).select("doc.id", "doc.h", "gone")


def drop_repeated(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_lines: int = 3) -> DataFrame:
    """``docs`` with three more columns: kept (the text without later copies of line runs), n_removed (lines) and
    n_runs (maximal deleted runs).

    Rows of equal id and text are one document and all get its result. Null text stays null, texts of fewer than
    ``min_lines`` lines stay as they are; an empty line is a line. Other columns don't matter and are kept.
    """
    gone = repeated_runs(docs, id_col, text, min_lines)
    gone = gone.select(F.col("id").alias("__id"), F.col("h").alias("__h"), F.array_sort("gone").alias("__gone"))
    hit = F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__h"))
    lines = F.split(F.col(text), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    rest = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    starts = F.size(F.array_except(F.col("__gone"), F.transform("__gone", lambda i: i + 1)))
    return (
        docs.join(gone, hit, "left")
        .withColumn("kept", F.when(F.col("__gone").isNull(), F.col(text)).otherwise(rest))
        .withColumn("n_removed", F.coalesce(F.size("__gone"), F.lit(0)).cast("long"))
        .withColumn("n_runs", F.coalesce(starts, F.lit(0)).cast("long"))
        .drop("__id", "__h", "__gone")
    )


def keep_first_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_lines: int = 3) -> DataFrame:
    """``docs`` with later copies of line runs cut out of the text; rows of which nothing but white space is left go.

    All columns keep their names and order. Rows that had no text before stay.
    """
    out = drop_repeated(docs.select(F.struct("*").alias("__all"), F.col(id_col).alias("__key"), F.col(text).alias("__text")), "__key", "__text", min_lines)
    out = out.where("n_removed = 0 or trim(translate(kept, '\\n\\t\\r', '   ')) <> ''")
    return out.select(*(F.col("kept").alias(text) if c == text else F.col(f"__all.`{c}`") for c in docs.columns))
