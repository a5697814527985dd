"""Sharding by a k-d tree of distributed weighted medians, DataFrame operations only (operator 6)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vacancia.llm.common import stored

STEPS = 1 << 16  # steps of a coordinate and of each digit of the order within a step
PARTS = 8  # a group that no shard can hold is dealt out in this many pieces a shard


@dataclass
class Node:
    """Of the tree: ``shards`` leaves from ``first`` on. ``cut`` has the digits of the first unit that goes right."""

    id: int
    first: int
    shards: int
    axis: str = ""
    cut: list[int] = field(default_factory=list)

    def children(self) -> tuple[Node, Node]:
        left = self.shards // 2
        return Node(2 * self.id, self.first, left), Node(2 * self.id + 1, self.first + left, self.shards - left)


def literal(spark: SparkSession, columns: dict[str, str], rows: Sequence[Sequence[float | int | None]]) -> DataFrame:
    """A few rows of numbers as SQL VALUES: part of the plan, without a job or Python on the executors."""
    typed = lambda v, t: f"CAST({'NULL' if v is None else repr(str(v))} AS {t})"
    body = ", ".join("(" + ", ".join(typed(v, t) for v, t in zip(r, columns.values(), strict=True)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def scaled(units: DataFrame, axes: Sequence[str]) -> DataFrame:
    """Each axis as an integer from 0 to STEPS - 1 between its least and greatest value; null and constant axes are 0."""
    span = units.agg(*(f(F.col(a).cast("double")).alias(f"{n}_{a}") for a in axes for n, f in (("low", F.min), ("high", F.max)))).first()
    out = {}
    for a in axes:
        low, high = span[f"low_{a}"], span[f"high_{a}"]
        wide = low is not None and high > low
        at = (F.col(a).cast("double") - F.lit(low)) / F.lit(high - low) * (STEPS - 1) if wide else F.lit(0.0)
        out[a] = F.coalesce(at, F.lit(0.0)).cast("int")
    return units.withColumns(out)


def codes(column: str) -> Column:
    """A text column as a number that keeps its order: the values' first bytes, compared like a base-256 number."""
    return F.conv(F.rpad(F.hex(F.col(column).cast("binary")), 12, "0").substr(1, 12), 16, 10).cast("double")


def _ordered(units: DataFrame, nodes: list[Node], axes: Sequence[str], digits: Sequence[str]) -> DataFrame:
    """Units of the nodes with p0, p1, ...: their place along the node's axis, and c0, c1, ...: the node's cut so far.

    The side table has a row per node of one level, at most one per shard.
    """
    width = len(digits) + 1
    known = [(n.id, *n.cut, *[None] * (width - len(n.cut))) for n in nodes]
    side = literal(units.sparkSession, {"node": "long", **{f"c{i}": "int" for i in range(width)}}, known)
    value = F.coalesce(*(F.when(F.col("node").isin([n.id for n in nodes if n.axis == a]), F.col(a)) for a in axes))
    place = {"p0": value, **{f"p{i + 1}": F.col(d) for i, d in enumerate(digits)}}
    return units.withColumns(place).join(F.broadcast(side), "node")


def _find_cuts(level: list[Node], units: DataFrame, axes: Sequence[str], digits: Sequence[str], exact: float) -> None:
    """Finds axis and cut of each node: the weighted quantile at which its left child gets its share.

    The order along an axis is its step, then the ``digits``. One pass sums bytes by the first of them; where the cell at the
    cut is heavier than ``exact`` bytes and holds several units, the next pass sums that cell by the next digit. Each pass sends
    at most STEPS sums per node through the shuffle, and one row per node to the driver.
    """
    wide = units.groupBy("node").agg(F.sum("bytes").alias("bytes"), *((F.max(a) - F.min(a)).alias(a) for a in axes))
    spans = {s.node: s for s in wide.collect()}
    todo = {}
    for n in level:
        if n.id in spans:
            n.axis = max(axes, key=lambda a, s=spans[n.id]: s[a])
            todo[n.id] = (n, spans[n.id].bytes * (n.shards // 2) / n.shards)
    for depth in range(len(digits) + 1):
        if not todo:
            return
        here = _ordered(units, [n for n, _ in todo.values()], axes, digits)
        for i in range(depth):
            here = here.where(F.col(f"p{i}") == F.col(f"c{i}"))
        sums = here.groupBy("node", F.col(f"p{depth}").alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        want = literal(units.sparkSession, {"node": "long", "want": "double"}, [(i, float(w)) for i, (_, w) in todo.items()])
        upto = F.sum("bytes").over(Window.partitionBy("node").orderBy("cell")) - F.col("bytes")  # at most STEPS rows a node
        reached = sums.withColumn("before", upto).join(F.broadcast(want), "node").where("before <= want")
        for r in reached.groupBy("node").agg(F.max(F.struct("cell", "before", "bytes", "n")).alias("c")).collect():
            n, w = todo[r.node]
            n.cut.append(r.c.cell)
            if r.c.bytes > exact and r.c.n > 1 and depth < len(digits):
                todo[r.node] = (n, w - r.c.before)
            else:  # the cell goes to the side that leaves the smaller error
                n.cut[-1] += w - r.c.before > r.c.bytes / 2
                del todo[r.node]


def kd_shards(units: DataFrame, axes: Sequence[str], digits: Sequence[str], shards: int, tolerance: float = 0.0005) -> DataFrame:
    """``units`` (with ``bytes`` and integer ``axes``, ``digits`` below STEPS) and their ``shard``, 0 to shards - 1.

    A node of s shards is cut along its widest axis, so that the left side gets s // 2 of s parts of its bytes; level by
    level, ceil(log2(shards)) in all. ``tolerance`` is the error of a cut as a share of a shard's bytes, where no unit is larger.
    """
    whole = units.agg(F.sum("bytes")).first()[0] or 0
    exact = tolerance * whole / shards
    now, level, leaves = units.withColumn("node", F.lit(1).cast("long")), [Node(1, 0, shards)], []
    width = len(digits) + 1
    while level:
        leaves += [n for n in level if n.shards == 1]
        inner = [n for n in level if n.shards > 1]
        _find_cuts(inner, now, axes, digits, exact)
        parted = [n for n in inner if n.cut]  # the others have no units
        if parted:
            below = F.lit(False)  # a shorter cut precedes what it begins
            for i in reversed(range(width)):
                below = (F.col(f"p{i}") < F.col(f"c{i}")) | ((F.col(f"p{i}") == F.col(f"c{i}")) & below)
            side = F.when(F.coalesce(below, F.lit(False)), 0).otherwise(1)
            moved = _ordered(now, parted, axes, digits).withColumn("node", 2 * F.col("node") + side)
            rest = now.where(~F.col("node").isin([n.id for n in parted]))
            now = stored(moved.select(now.columns).unionByName(rest), "level")
        level = [c for n in inner for c in n.children()]
    ends = literal(units.sparkSession, {"node": "long", "shard": "int"}, [(n.id, n.first) for n in leaves])
    return now.join(F.broadcast(ends), "node").drop("node")


def slots(rows: DataFrame, shard: str, order: Column, rows_a_group: int = 10_000) -> DataFrame:
    """``rows`` with ``slot``: gapless from 0 within each shard, in hash order.

    A shard is numbered in groups of about ``rows_a_group`` rows, by ranges of a 31-bit hash in ``order``, so no task gets a shard
    whole; the groups' counts are summed up apart.
    """
    groups = max(1, rows.count() // rows_a_group)
    made = rows.withColumn("__h", order).withColumn("__g", F.shiftright(F.col("__h") * groups, 31))
    counts = made.groupBy(shard, "__g").agg(F.count("*").alias("n"))
    before = counts.select(shard, "__g", (F.sum("n").over(Window.partitionBy(shard).orderBy("__g")) - F.col("n")).alias("__b"))
    own = F.row_number().over(Window.partitionBy(shard, "__g").orderBy("__h", "row"))
    return made.withColumn("__r", own).join(before, [shard, "__g"]).withColumn("slot", (F.col("__b") + F.col("__r") - 1).cast("long")).drop("__h", "__g", "__b", "__r")


def _large_groups(rows: DataFrame, text_key: list[str], shards: int) -> DataFrame:
    """Groups of equal texts that exceed a shard's bytes, or hold over 1 / (4 * shards) of the rows: under 5 * shards of them.

    ``pieces`` are what the tree may deal to different shards (1 where a shard can hold the group), ``salts`` what a
    piece's rows are spread over in the join.
    """
    every = rows.agg(F.sum("size").alias("all_bytes"), F.count("*").alias("all_rows"))
    groups = rows.groupBy(text_key).agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).join(F.broadcast(every))
    part = F.col("bytes") * shards / F.col("all_bytes")
    pieces = F.when(part > 1, F.ceil(part * PARTS)).otherwise(1).cast("int")
    salts = F.ceil(F.col("n") * (4 * shards) / F.col("all_rows") / pieces).cast("int")
    return groups.select(*text_key, pieces.alias("pieces"), salts.alias("salts")).where("pieces > 1 or salts > 1")


def shard_documents(
    docs: DataFrame, shards: int = 40, target_bytes: int | None = None, id_col: str = "doc_id", text: str = "text", axes: Sequence[str] = ("lang", "n_chars")
) -> DataFrame:
    """(id, size, text_crc32, shard, slot), one row per row of ``docs``; with ``target_bytes`` as many shards as give leaves of that size.

    Size is the text's UTF-8 bytes (null: none) plus 16. The tree splits the ``axes`` (metadata columns, numbers or text, of
    a group of equal texts the least value) and the text's size. Its units are whole groups of equal texts, so a group stays in
    one shard and a shard's bytes are near the mean to about half of the group at its cut. Only a group of more bytes than a
    shard is dealt out, in ``PARTS`` pieces a shard. Null counts as least value, a null text as an empty one; repeated rows are
    rows like any other, and an empty table gives none.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    kinds = dict(docs.dtypes)
    names = {f"axis{i}": codes(a) if kinds[a] == "string" else F.col(a).cast("double") for i, a in enumerate(axes)}
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("mark"),
        *(c.alias(n) for n, c in names.items()),
    ).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "narrow")
    if target_bytes:
        shards = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    text_key = ["mark", "text_crc32", "size"]
    large = F.broadcast(_large_groups(rows, text_key, shards))
    dealt = lambda n, seed: F.coalesce(F.pmod(F.xxhash64("id", "row", F.lit(seed)), F.col(n)).cast("int"), F.lit(0))
    rows = rows.join(large, text_key, "left").withColumns({"piece": dealt("pieces", 1), "salt": dealt("salts", 2)})
    units = rows.groupBy(*text_key, "piece").agg(
        F.sum("size").alias("bytes"), F.max(F.coalesce("salts", F.lit(1))).alias("salts"), *(F.min(n).alias(n) for n in names)
    )
    digit = lambda bits: F.shiftrightunsigned("mark", bits).bitwiseAND(F.lit(STEPS - 1)).cast("int")
    places = {"axis_size": F.log2(F.col("size").cast("double")), "by_text": digit(0), "by_text2": digit(16)}
    every = [*names, "axis_size"]
    units = scaled(stored(units.withColumns(places), "units"), every)
    placed = kd_shards(units, every, ["by_text", "by_text2", "piece"], shards)
    placed = placed.select(*text_key, "piece", "shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    placed = stored(rows.join(placed, [*text_key, "piece", "salt"]).select("id", "size", "text_crc32", "shard", "row"), "placed")
    numbered = slots(placed, "shard", F.shiftrightunsigned(F.xxhash64("id", "row"), 33))
    return numbered.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")
