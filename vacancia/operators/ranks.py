"""Exact order statistics that never bring a whole group into one task.

``percentile`` keeps every distinct value of a group in one buffer, and a running
sum over a whole table sorts it in one task. Neither survives a group that holds
a third of a very large table. Both are done here in steps: a mergeable
sketch says where to look, exact counts of cells narrow that down, and what is
left is sorted cell by cell.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The sketch is right within n / SKETCH ranks. Groups of up to SKETCH rows are taken whole.
SKETCH = 10_000
# A bracket's values are ranked in this many cells, each by itself.
CELLS = 64
# A group's rows meet its figures in this many tasks, where the figures are too many to broadcast.
SPREAD = 8


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)))


def with_group(rows: DataFrame, side: DataFrame, by: Sequence[str], mix: str, spread: int = SPREAD) -> DataFrame:
    """``rows`` with the other columns of their group's one row in ``side``; null keys are equal, rows without a group go.

    Spark broadcasts the side where its size allows. Where it does not, a hot group must not arrive in one task: rows are
    dealt over ``spread`` salts (by ``mix`` and the map task, so that a frequent value is dealt out as well, and the
    same way when a task is repeated), and every salt gets a copy of the side.
    """
    by = list(by)
    if not by:
        return rows.withColumn("_s", side.select(F.struct(*side.columns)).scalar()).select(*rows.columns, "_s.*")
    renamed = [f"_k{i}" for i in range(len(by))]
    more = [c for c in side.columns if c not in by]
    copies = F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("_copy")
    side = side.select(*(F.col(k).alias(r) for k, r in zip(by, renamed)), *more, copies)
    salt = F.pmod(F.xxhash64(mix) + F.spark_partition_id(), F.lit(spread)).cast("int")
    met = rows.withColumn("_salt", salt).join(side, _same(by, renamed) & (F.col("_salt") == F.col("_copy")))
    return met.select(*rows.columns, *more)


def quantiles(
    df: DataFrame,
    value: str | Column,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    approx: bool = False,
    sketch: int = SKETCH,
) -> DataFrame:
    """Linearly interpolated quantiles, one column per entry of ``probs``.

    One row per group, or exactly one row when ``by`` is empty (nulls over no values).
    Nulls and NaN of ``value`` are left out; a null group is a group.

    Pass 1 sketches each group (bounded state, merged map-side). Around each wanted rank the sketch gives a
    bracket holding about 8 / ``sketch`` of the group. Pass 2 counts values: rows outside all brackets are folded into the
    bracket end below them before anything is shuffled. Then ranks are found in rounds: the counts of CELLS cells
    per bracket (a bounded number of rows per group) say which cells hold a wanted rank, and only those cells are
    sorted, each by itself. No window sees a group, or a whole column, of data rows.
    """
    by = list(by)
    v = F.col(value) if isinstance(value, str) else value
    rows = df.select(*by, v.cast("double").alias("_v")).where(F.col("_v") <= F.lit(math.inf))  # NaN sorts above all
    if approx:
        wanted = F.percentile_approx("_v", list(probs.values()), sketch)
        out = rows.groupBy(*by).agg(wanted.alias("_q"))
        return out.select(*by, *(F.col("_q")[i].alias(name) for i, name in enumerate(probs)))

    margin = 4.0 / sketch
    points = sorted(set(probs.values()))
    cuts = [c for p in points for c in (max(0.0, p - margin), min(1.0, p + margin))]
    sketched = rows.groupBy(*by).agg(
        F.count("*").alias("_n"),
        F.percentile_approx("_v", cuts, sketch).alias("_a"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
    )
    small = F.col("_n") <= sketch

    def bounds(i: int, p: float) -> list[Column]:
        low = F.col("_min") if p - margin <= 0 else F.when(small, F.col("_min")).otherwise(F.col("_a")[2 * i])
        high = F.col("_max") if p + margin >= 1 else F.when(small, F.col("_max")).otherwise(F.col("_a")[2 * i + 1])
        return [low.alias(f"_lo{i}"), high.alias(f"_hi{i}")]

    side = sketched.select(*by, "_n", *(c for i, p in enumerate(points) for c in bounds(i, p)))
    placed = with_group(rows, side, by, "_v")
    lo, hi = ([F.col(f"_{end}{i}") for i in range(len(points))] for end in ("lo", "hi"))
    inside = reduce(lambda a, b: a | b, (F.col("_v").between(a, b) for a, b in zip(lo, hi)))
    below = [F.when(h < F.col("_v"), h).otherwise(F.lit(-math.inf)) for h in hi]
    folded = F.when(inside, F.col("_v")).otherwise(F.greatest(*below) if len(below) > 1 else below[0])
    at = placed.select(*by, "_n", *lo, *hi, folded.alias("_x"), inside.cast("long").alias("_in"))

    def cell(i: int) -> Column:
        """Place of a value in bracket i; over a range of no width or of infinite width it is the first cell."""
        share = F.try_divide(F.col("_x") - lo[i], hi[i] - lo[i])
        share = F.nanvl(F.coalesce(share, F.lit(0.0)), F.lit(0.0))
        return F.when(F.col("_x").between(lo[i], hi[i]), i * CELLS + F.least(F.floor(share * CELLS), F.lit(CELLS - 1)))

    # The first bracket that has a value gives its cell, so cells rise with the values even where brackets overlap.
    cells = F.coalesce(*(cell(i) for i in range(len(points))), F.lit(-1)).cast("int")
    counted = at.select(*by, "_n", "_x", "_in", cells.alias("_cell")).groupBy(*by, "_n", "_cell", "_x")
    counted = counted.agg(F.count("*").alias("_c"), F.sum("_in").alias("_own"))

    def ranks(p: float) -> list[Column]:
        t = (F.col("_n") - 1) * F.lit(float(p))
        return [F.floor(t), F.ceil(t)]

    # At most len(points) * CELLS + 1 rows per group.
    upto = F.sum("_c").over(W.partitionBy(*by).orderBy("_cell").rowsBetween(W.unboundedPreceding, W.currentRow))
    # Both uses of the counts read all of their columns, so that Spark computes them once (a reused exchange).
    totals = counted.groupBy(*by, "_n", "_cell").agg(F.sum("_c").alias("_c"), F.sum("_own").alias("_o"))
    totals = totals.withColumn("_before", upto - F.col("_c")).where("_o >= 0")
    wanted = reduce(
        lambda a, b: a | b,
        ((F.col("_before") <= r) & (r < F.col("_before") + F.col("_c")) for p in points for r in ranks(p)),
    )
    renamed = [f"_k{i}" for i in range(len(by))]
    hit = totals.where(wanted).select(*(F.col(k).alias(r) for k, r in zip(by, renamed)), F.col("_cell").alias("_hit"), "_before")
    same_cell = F.col("_cell") == F.col("_hit")
    few = counted.join(hit, _same(by, renamed) & same_cell if by else same_cell).drop("_hit", *renamed)
    within = W.partitionBy(*by, "_cell").orderBy("_x").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = few.withColumn("_before", F.col("_before") + F.sum("_c").over(within) - F.col("_c"))

    def value_of(rank: Column) -> Column:
        own = (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_own"))
        return F.max(F.when(own, F.col("_x")))

    picks = []
    for name, p in probs.items():
        low, high = ranks(p)
        picks += [value_of(low).alias(f"_f_{name}"), value_of(high).alias(f"_c_{name}")]
    picked = ranked.groupBy(*by).agg(F.max("_n").alias("_n"), *picks)

    def interpolated(name: str, p: float) -> Column:
        t = (F.col("_n") - 1) * F.lit(float(p))
        f, c = F.col(f"_f_{name}"), F.col(f"_c_{name}")
        value_at = f + (c - f) * (t - F.floor(t))
        missed = F.col("_n").isNotNull() & value_at.isNull()
        return F.when(missed, F.raise_error(F.lit("quantile bracket missed its rank"))).otherwise(value_at).alias(name)

    return picked.select(*by, *(interpolated(name, p) for name, p in probs.items()))


def column_quantiles(df: DataFrame, wanted: Mapping[str, tuple[str, float]], approx: bool = False, sketch: int = SKETCH) -> DataFrame:
    """One row with a quantile per entry of ``wanted`` (name: (column, probability)): all columns share the two scans."""
    columns = sorted({c for c, _ in wanted.values()})
    points = {f"p{i}": p for i, p in enumerate(sorted({p for _, p in wanted.values()}))}
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_value")) for c in columns))).alias("e")
    long = df.select(pairs).select("e.*")
    found = quantiles(long, "_value", points, ["_column"], approx, sketch)
    at = {p: name for name, p in points.items()}
    picks = [F.max(F.when(F.col("_column") == c, F.col(at[p]))).alias(name) for name, (c, p) in wanted.items()]
    return found.agg(*picks)


def quantile(df: DataFrame, value: str | Column, p: float, approx: bool = False) -> Column:
    """One quantile of the whole column as a scalar subquery, usable in any expression."""
    return quantiles(df, value, {"q": p}, approx=approx).scalar()


def running_sums(
    df: DataFrame, value: str, sums: Sequence[str], descending: bool = False, buckets: int = 256
) -> DataFrame:
    """Adds ``cum_<s>`` for every s in ``sums``: the sum over all rows up to this one in ``value`` order.

    ``value`` must be unique (group first). Rows go to ``buckets`` equally filled
    value ranges; the ranges are summed up in ``buckets`` rows, and each range sorts by itself.
    The range ends are read once (at most ``buckets`` numbers), so both uses agree on them.
    """
    sign = -1.0 if descending else 1.0
    keyed = df.withColumn("_o", F.col(value).cast("double") * F.lit(sign))
    ends = keyed.agg(F.percentile_approx("_o", [i / buckets for i in range(1, buckets)], SKETCH)).first()[0] or []
    ends = sorted(set(ends))
    bucket = F.lit(0)
    if ends:
        bucket = F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e < F.col("_o")))
    keyed = keyed.withColumn("_b", bucket)
    totals = keyed.groupBy("_b").agg(*(F.sum(s).alias(f"_t_{s}") for s in sums))
    earlier = W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("_b", *(F.coalesce(F.sum(f"_t_{s}").over(earlier), F.lit(0)).alias(f"_s_{s}") for s in sums))
    within = W.partitionBy("_b").orderBy("_o").rowsBetween(W.unboundedPreceding, W.currentRow)
    out = keyed.join(F.broadcast(offsets), "_b")  # at most `buckets` rows
    for s in sums:
        out = out.withColumn(f"cum_{s}", F.sum(s).over(within) + F.col(f"_s_{s}"))
    return out.drop("_b", "_o", *(f"_s_{s}" for s in sums))


# Hashes spread evenly, so a hash range of 1 / HASH_CELLS holds that share of any group.
HASH_CELLS = 65_536


def key_hash(keys: Sequence[str | Column], seed: int) -> Column:
    """52 even bits from the key: the first 13 hex digits of the MD5 of ``key|...|seed``, a null key as nothing.

    The same on any partitioning and in any engine, and exact as a double.
    """
    text = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws("|", *text, F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def first_by_hash(df: DataFrame, keys: Sequence[str], count: Column, seed: int, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``_picked``: true for the ``count`` rows of each group with the smallest key hash.

    ``count`` may use ``_n``, the group's rows. Exact: cells of the hash range are
    counted (bounded per group), and only the one cell holding the cut is ranked. ``by`` names classes: their cuts go to the
    rows, as a join by class would put each class into one task.
    ``keys`` must tell rows apart; rows with the same keys are picked together.
    """
    by = list(by)
    hashed = df.withColumn("_h", key_hash(keys, seed)).withColumn(
        "_cell", F.shiftrightunsigned(F.col("_h"), 36).cast("int")
    )
    cells = hashed.groupBy(*by, "_cell").agg(F.count("*").alias("_c"))
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    run = group.orderBy("_cell").rowsBetween(W.unboundedPreceding, W.currentRow)
    cut = (
        cells.withColumn("_upto", F.sum("_c").over(run))
        .withColumn("_n", F.sum("_c").over(group))
        .withColumn("_want", F.least(count, F.col("_n")))
        .where((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_c") < F.col("_want")))
        .select(*by, F.col("_cell").alias("_cut"), (F.col("_want") - F.col("_upto") + F.col("_c")).alias("_rest"))
    )
    if by:
        renamed = [f"_k{i}" for i in range(len(by))]
        side = cut.select(*(F.col(k).alias(r) for k, r in zip(by, renamed)), "_cut", "_rest")
        edge = hashed.join(F.broadcast(side), _same(by, renamed)).where(F.col("_cell") == F.col("_cut"))
    else:
        one = cut.select(F.struct("_cut", "_rest").alias("_s"))
        edge = hashed.withColumn("_s", one.scalar()).where(F.col("_cell") == F.col("_s._cut")).select("*", "_s.*")
    rank = F.row_number().over(group.orderBy("_h"))
    bound = (
        edge.select(*by, "_h", "_cut", "_rest")
        .withColumn("_r", rank)
        .where(F.col("_r") <= F.col("_rest"))
        .groupBy(*by)
        .agg(F.max("_h").alias("_bound"))
    )
    if by:
        side = bound.select(*(F.col(k).alias(r) for k, r in zip(by, renamed)), "_bound")
        marked = hashed.join(F.broadcast(side), _same(by, renamed), "left")
    else:
        marked = hashed.withColumn("_bound", bound.select("_bound").scalar())
    return marked.select(*df.columns, F.coalesce(F.col("_h") <= F.col("_bound"), F.lit(False)).alias("_picked"))
