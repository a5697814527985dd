"""Reply-ordered conversations by linking quotations to their originals (operator 1)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import md5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vacancia.llm.common import discard, stored

MARKS = re.compile(r"[ \t]*((?:>[ \t]?)+)")
ATTRIBUTION = re.compile(r"(?i)^\s*on\b.*\bwrote:\s*$")
SPAN = 1024  # turns counted together


def passage_hash(lines: list[str]) -> bytes | None:
    """Of a passage in lower case with its words one blank apart, however its lines are broken. None if it has no word."""
    words = " ".join(lines).lower().split()
    return md5(" ".join(words).encode("utf-8", "surrogatepass")).digest() if words else None


def parse(text: str | None) -> tuple[str, list[bytes], list[tuple[int, bytes]]]:
    """(own text, hashes of its passages, (level, hash) of quoted passages).

    A line's level is the number of ``>`` it begins with. Passages are neighbouring lines of one level, parted by blank
    lines. The own text is the lines of level 0 without the line that introduces a quotation.
    """
    levels, bodies = [], []
    for line in (text or "").split("\n"):
        m = MARKS.match(line)
        levels.append(m[1].count(">") if m else 0)
        bodies.append(line[m.end() :] if m else line)
    keep, own, quoted, run = [], [], [], []
    for i, (level, body) in enumerate(zip(levels, bodies, strict=True)):
        after = levels[i + 1] if i + 1 < len(levels) else 0
        opens = level < after and ATTRIBUTION.match(body) is not None
        if level == 0 and not opens:
            keep.append(body)
        if body.strip() and not opens:
            run.append(body)
        if after != level or not body.strip() or i + 1 == len(levels):
            digest = passage_hash(run)
            if digest:
                own.append(digest) if level == 0 else quoted.append((level, digest))
            run = []
    return "\n".join(keep).strip("\n"), list(dict.fromkeys(own)), list(dict.fromkeys(quoted))


def parsed(messages: DataFrame) -> DataFrame:
    """``messages`` (conv, turn, role, text, copies) with own, passages and quoted in place of the text."""
    schema = pa.schema([
        ("conv", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("copies", pa.int64()), ("own", pa.string()),
        ("passages", pa.list_(pa.binary())), ("quoted", pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.binary())]))),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [parse(t.as_py()) for t in b.column(4)]
            columns = [*(b.column(i) for i in range(4)), [f[0] for f in found], [f[1] for f in found], [[{"level": n, "hash": h} for n, h in f[2]] for f in found]]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    rows = messages.select("conv", "turn", "role", "copies", "text")
    return rows.mapInArrow(run, "conv long, turn long, role string, copies long, own string, passages array<binary>, quoted array<struct<level:int,hash:binary>>")


def linked(messages: DataFrame) -> DataFrame:
    """(conv, turn, level, hash, source): for each quoted passage the latest earlier turn of its conversation that says it.

    Turns are taken in spans: the last source within each span first, so that a passage said over and over in one
    conversation is no group of all its turns.
    """
    placed = messages.where("conv is not null and turn is not null")
    quotes = placed.select("conv", "turn", F.explode("quoted").alias("q")).select("conv", "turn", "q.level", "q.hash").distinct()
    said = placed.select("conv", "turn", F.explode("passages").alias("hash")).distinct()
    said = said.join(quotes.select("conv", "hash").distinct(), ["conv", "hash"], "left_semi")
    none = F.lit(None).cast("long")
    both = quotes.select("conv", "hash", "turn", "level", none.alias("source")).union(said.select("conv", "hash", "turn", F.lit(None).cast("int"), F.col("turn")))
    both = stored(both.withColumn("span", F.floor(F.col("turn") / SPAN)), "passages")
    key = ["conv", "hash"]
    spans = both.groupBy(*key, "span").agg(F.max("source").alias("last"))
    earlier = F.max("last").over(Window.partitionBy(*key).orderBy("span").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select(*key, "span", earlier.alias("earlier"))
    before = F.max("source").over(Window.partitionBy(*key, "span").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1))
    inside = both.withColumn("inside", before).where("level is not null")
    return inside.join(spans, [*key, "span"]).select("conv", "turn", "level", "hash", F.coalesce("inside", "earlier").alias("source"))


def threads(parents: DataFrame) -> DataFrame:
    """(conv, turn, reply_to, thread, depth) for messages that reply: root and distance by pointer doubling."""
    now = stored(parents.select("conv", "turn", "reply_to", F.col("reply_to").alias("up"), F.lit(1).cast("long").alias("steps")), "threads")
    while True:
        top = now.select("conv", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"))
        if now.join(top, ["conv", "up"], "left_semi").isEmpty():
            return now.withColumnsRenamed({"up": "thread", "steps": "depth"})
        met = now.join(top, ["conv", "up"], "left")
        after = stored(met.select("conv", "turn", "reply_to", F.coalesce("next", "up").alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")), "threads")
        discard(now)
        now = after


def positioned(rows: DataFrame) -> DataFrame:
    """``rows`` with ``position``, gapless from 0 in the conversation by (thread, turn): counts of spans of threads and of turns
    are summed up first, so a conversation of any length is never in one task. Null where conv or turn is."""
    spans = rows.withColumns({"ts": F.floor(F.col("thread") / SPAN), "us": F.floor(F.col("turn") / SPAN)})
    many = spans.where("conv is not null and turn is not null").groupBy("conv", "ts", "thread", "us").agg(F.count("*").alias("n"))
    less = lambda w: F.sum("n").over(w) - F.col("n")
    few = many.groupBy("conv", "ts").agg(F.sum("n").alias("n"))
    outer = few.select("conv", "ts", less(Window.partitionBy("conv").orderBy("ts")).alias("b1"))
    inner = many.select("conv", "ts", "thread", "us", less(Window.partitionBy("conv", "ts").orderBy("thread", "us")).alias("b2"))
    own = F.row_number().over(Window.partitionBy("conv", "ts", "thread", "us").orderBy("turn", "role", F.md5(F.col("own").cast("binary"))))
    out = spans.withColumn("r", own).join(inner, ["conv", "ts", "thread", "us"], "left").join(outer, ["conv", "ts"], "left")
    return out.withColumn("position", F.col("b1") + F.col("b2") + F.col("r") - 1).drop("ts", "us", "r", "b1", "b2")


def reply_order(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, position, turn, role, text, reply_to, thread, depth, n_quoted, n_linked, copies).

    text has no quotations left. A message replies to the latest turn its outermost linked quotation comes from; without one it
    begins a thread. position orders a conversation so that a reply follows what it replies to: threads by their
    first turn, then turns. Equal rows are one message with that many copies; different messages of one turn share
    their links. Null text is empty; messages without conversation or turn come out unlinked, without position.
    """
    rows = messages.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    said = stored(parsed(rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))), "messages")
    links = stored(linked(said).where("source is not null"), "links")
    outermost = links.groupBy("conv", "turn").agg(F.min(F.struct("level", (-F.col("source")).alias("back"))).alias("m"), F.count_distinct("level", "hash").alias("n_linked"))
    replies = stored(outermost.select("conv", "turn", (-F.col("m.back")).alias("reply_to"), "n_linked"), "replies")
    placed = threads(replies).join(replies.select("conv", "turn", "n_linked"), ["conv", "turn"])
    out = said.join(placed, ["conv", "turn"], "left").withColumns({
        "thread": F.coalesce("thread", "turn"), "depth": F.coalesce("depth", F.lit(0)),
        "n_linked": F.coalesce("n_linked", F.lit(0)), "n_quoted": F.size("quoted").cast("long"),
    })
    return positioned(out.drop("passages", "quoted")).select(
        F.col("conv").alias(conv), "position", F.col("turn").alias(turn), F.col("role").alias(role), F.col("own").alias(text), "reply_to", "thread", "depth", "n_quoted", "n_linked", "copies"
    )
