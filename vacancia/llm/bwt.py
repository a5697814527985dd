"""Exact removal of repeated byte strings by threshold-bounded interval expansion (operator 10).

Minimizers deal the work out: every 50-byte window is owned by the 20-byte string in it of least hash, its anchor, so equal
windows have equal anchors at equal offsets and meet. Neighbouring windows of one anchor travel as one piece. Among the
pieces of an anchor, suffixes that begin with it form one interval; expanding it symbol by symbol, to the left by the bytes
that precede its members (its part of the Burrows-Wheeler transform) and likewise to the right, derives
common lengths by increasing value, breadth first over all anchors of a batch, and stops at the threshold. Intervals with one
member are dropped at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vacancia.llm.common import emit, stored, sweep

LENGTH, ANCHOR = 50, 20
SPAN = LENGTH - ANCHOR  # bytes of a window beside its anchor; an anchor owns at most SPAN + 1 windows in a row
CHUNK, ROWS = 1 << 18, 1 << 21
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _gram_hashes(x: np.ndarray) -> np.ndarray:
    """Of the ANCHOR bytes from each position on: 1, 2, 4, ... bytes, put together as ANCHOR's binary digits ask."""
    step, width, out, done = x, 1, None, 0
    while True:
        if ANCHOR & width:
            part = step[: len(x) - ANCHOR + 1] if out is None else step[done : done + len(x) - ANCHOR + 1]
            out = part if out is None else out * np.uint64(pow(int(BASE), width, 1 << 64)) + part
            done += width
        width *= 2
        if width > ANCHOR:
            return _mixed(out)
        half = width // 2
        step = step[:-half] * np.uint64(pow(int(BASE), half, 1 << 64)) + step[half:]


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Least of each n neighbours."""
    width = 1
    while 2 * width <= n:
        x, width = np.minimum(x[:-width], x[width:]), 2 * width
    return np.minimum(x[: len(x) - (n - width)], x[n - width :]) if n > width else x


def pieces(data: bytes, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor hash, content hash, start, windows, document) of each piece in documents joined to one array."""
    x = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    if len(x) < LENGTH:
        return tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    grams = _gram_hashes(x)
    anchor = (_least((grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64), SPAN + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    doc = np.searchsorted(ends, np.arange(len(anchor)), side="right")
    whole = np.arange(len(anchor)) + LENGTH <= ends[doc]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (whole[1:] != whole[:-1])]))
    last = np.append(first[1:], len(anchor)) - 1
    first, last = first[whole[first]], last[whole[first]]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * _powers(BASE, len(x)))])
    content = _mixed((sums[last + LENGTH] - sums[first]) * _powers(INVERSE, len(x))[first] + (last - first).astype(np.uint64))
    return grams[anchor[first]], content, first, last - first + 1, doc[first]


def _place(mark: np.ndarray | Column, start, windows):
    """Mark of the text (28 bits), start (31 bits) and number of windows (5 bits) as one long."""
    return mark * (1 << 36) + start * (1 << 5) + (windows - 1)


def text_mark(text: str) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(text).bitwiseAND(F.lit((1 << 27) - 1))


def owned_pieces(docs: DataFrame) -> DataFrame:
    """(h, e, doc, place, gone) of all pieces of ``docs`` (doc, mark, text as binary).

    Pieces of equal content that meet in a task are combined: those of larger doc are gone already and travel with
    a scattered key; so of a large group of copies each task sends one on.
    """
    schema = pa.schema([("h", pa.int64()), ("e", pa.int64()), ("doc", pa.int64()), ("place", pa.int64()), ("gone", pa.bool_())])

    def combined(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        h, e, doc, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((doc, e, h))
        h, e, doc, place = h[order], e[order], doc[order], place[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (e[1:] != e[:-1])])
        gone = doc > doc[new][np.cumsum(new) - 1]
        h = np.where(gone, _mixed(place.view(np.uint64) ^ _mixed(doc.view(np.uint64))), h)
        return emit(schema, [h.view(np.int64), e.view(np.int64), doc, place, gone])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            joined, sizes, first = [], [], 0
            for r, t in enumerate(batch.column(2)):
                t = t.as_py()
                joined.append(t)
                sizes.append(len(t))
                if sum(sizes) < CHUNK and r < batch.num_rows - 1 and len(sizes) < 512:
                    continue
                h, e, start, windows, at = pieces(b"".join(joined), np.cumsum(sizes))
                begin = np.cumsum(sizes)[at] - np.array(sizes)[at]
                own = at + first
                held.append((h, e, ids[own], _place(marks[own], start - begin, windows)))
                rows += len(h)
                joined, sizes, first = [], [], r + 1
                if rows > ROWS:
                    yield combined(held)
                    held, rows = [], 0
        if rows:
            yield combined(held)

    return docs.select("doc", "mark", "text").mapInArrow(run, "h long, e long, doc long, place long, gone boolean")


def _names(before: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """One expansion: members of an interval that have the same next symbol stay together; -1 for those alone or at their end."""
    out = np.full(len(before), -1, dtype=np.int64)
    alive = np.flatnonzero((before >= 0) & (symbols >= 0))
    if len(alive):
        _, name, count = np.unique(before[alive] * 256 + symbols[alive], return_inverse=True, return_counts=True)
        out[alive] = np.where(count[name] > 1, name, -1)
    return out


def expand(group: np.ndarray, doc: np.ndarray, parts: list[bytes], offset: np.ndarray) -> np.ndarray:
    """Which windows are in a smaller document too, as an array of members by offset of the anchor in the window.

    ``parts`` are the members' bytes, ``offset`` where the anchor stands in them; members of a ``group`` share the anchor.
    """
    n = len(parts)
    size = np.array([len(p) for p in parts])
    flat = np.frombuffer(b"".join(parts), dtype=np.uint8)
    begin = np.cumsum(size) - size

    def symbol(at: np.ndarray) -> np.ndarray:
        inside = (at >= 0) & (at < size)
        return np.where(inside, flat[np.where(inside, begin + at, 0)].astype(np.int64), -1)

    # equal hashes are not yet equal anchors
    right = np.unique(group, return_inverse=True)[1].astype(np.int64)
    for i in range(ANCHOR):
        right = _names(right, symbol(offset + i))
    left, lefts = right, [right]
    for i in range(1, SPAN + 1):
        left = _names(left, symbol(offset - i))
        lefts.append(left)
    out = np.zeros((n, SPAN + 1), dtype=bool)
    for i in range(SPAN + 1):  # i bytes to the right, the rest to the left
        if i:
            right = _names(right, symbol(offset + ANCHOR + i - 1))
        both = np.flatnonzero((right >= 0) & (lefts[SPAN - i] >= 0))
        if not len(both):
            continue
        _, name = np.unique(right[both] * (n + 1) + lefts[SPAN - i][both], return_inverse=True)
        least = np.full(name.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, name, doc[both])
        out[both, SPAN - i] = doc[both] > least[name]
    return out


def anchors_in(parts: list[bytes]) -> np.ndarray:
    """Where each piece's anchor stands: the leftmost of least hash that all its windows hold."""
    size = np.array([len(p) for p in parts])
    grams = _gram_hashes(np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.uint64) + np.uint64(1)) >> np.uint64(32)
    at = (size - LENGTH)[:, None] + np.arange(SPAN + 1)[None, :]
    within = np.minimum((np.cumsum(size) - size)[:, None] + at, len(grams) - 1)
    return size - LENGTH + np.where(at <= SPAN, grams[within], np.uint64(1 << 40)).argmin(axis=1)


def shared_pieces(docs: DataFrame) -> DataFrame:
    """(doc, mark, at, h, gone): pieces that an earlier document has (gone) or whose anchor other pieces have too."""
    rows = owned_pieces(docs).repartition("h")
    same, anchor = Window.partitionBy("h", "e"), Window.partitionBy("h")
    judged = rows.withColumn("least", F.min("doc").over(same)).withColumn("low", F.min("e").over(anchor)).withColumn("high", F.max("e").over(anchor))
    judged = judged.withColumn("gone", F.col("gone") | (F.col("doc") > F.col("least"))).where("gone or low <> high")
    return judged.select("doc", F.shiftright("place", 36).alias("mark"), F.col("place").bitwiseAND(F.lit((1 << 36) - 1)).alias("at"), "h", "gone")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc, mark, starts): places of windows to remove, packed as start and number, per text that has any."""
    found = stored(shared_pieces(docs), "pieces")
    sweep(docs.sparkSession)

    # pieces whose content is new but whose anchor is not: their bytes go to the anchor's group
    asked = found.where("not gone").groupBy("doc", "mark").agg(F.collect_list(F.struct("at", "h")).alias("asked"))  # of one text
    cut = pa.schema([("h", pa.int64()), ("doc", pa.int64()), ("mark", pa.int64()), ("at", pa.int64()), ("part", pa.binary())])

    def cut_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, mark, text, some in zip(b.column(0), b.column(1), b.column(2), b.column(3), strict=True):
                raw, at = text.as_py(), some.values.field("at").to_numpy()
                parts = [raw[x >> 5 : (x >> 5) + LENGTH + (x & 31)] for x in at.tolist()]
                yield emit(cut, [some.values.field("h"), [doc.as_py()] * len(at), [mark.as_py()] * len(at), at, parts])

    strings = docs.join(asked, ["doc", "mark"]).select("doc", "mark", "text", "asked").mapInArrow(cut_out, "h long, doc long, mark long, at long, part binary")
    runs = pa.schema([("doc", pa.int64()), ("mark", pa.int64()), ("at", pa.int64())])

    def expanded(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        h, doc, mark, at = (t.column(i).to_numpy() for i in range(4))
        parts = t.column(4).to_pylist()
        offset = anchors_in(parts)
        hit = expand(h, doc, parts, offset)
        # offsets next to each other are windows next to each other, the other way round
        edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        member, low = np.nonzero(edge == 1)
        high = np.nonzero(edge == -1)[1] - 1
        return emit(runs, [doc[member], mark[member], _place(0, (at[member] >> 5) + offset[member] - high, high - low + 1)])

    def expand_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if size + batch.num_rows > 200_000 and held:  # up to the last whole group
                h = batch.column(0).to_numpy()
                change = np.flatnonzero(np.concatenate([[held[-1].column(0)[-1].as_py() != h[0]], h[1:] != h[:-1]]))
                if len(change):
                    yield expanded([*held, batch.slice(0, change[-1])])
                    batch = batch.slice(change[-1])
                    held, size = [], 0
            held.append(batch)
            size += batch.num_rows
        if held:
            yield expanded(held)

    grown = strings.repartition("h").sortWithinPartitions("h").mapInArrow(expand_groups, "doc long, mark long, at long")
    grown = stored(grown, "grown")
    del asked, strings
    sweep(docs.sparkSession)
    every = found.where("gone").select("doc", "mark", "at").union(grown)
    return every.groupBy("doc", "mark").agg(F.collect_list("at").alias("starts"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) per row of ``docs``; kept is the rest of the text's bytes.

    A byte goes if a LENGTH-byte string over it also starts in a document of smaller id, judged on the input. Null text is an
    empty one. Rows of equal id are one document's: they don't remove from each other. A row without id is
    no source and stays whole. Texts must be under 2 GB.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), text_mark(text).alias("mark"), body.alias("text"))
    long_ = rows.where(F.col("doc").isNotNull() & (F.octet_length("text") >= LENGTH))
    starts = repeated_windows(long_)
    schema = pa.schema([("doc", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, size = [], 0
            for doc, t, at in zip(b.column(0), b.column(1), b.column(2), strict=True):
                raw, removed, spans = t.as_py(), 0, 0
                n_bytes = len(raw)
                if at.is_valid:
                    x = at.values.to_numpy()
                    change = np.zeros(len(raw) + 1, dtype=np.int64)
                    np.add.at(change, x >> 5, 1)
                    np.add.at(change, (x >> 5) + (x & 31) + LENGTH, -1)
                    covered = np.cumsum(change[:-1]) > 0
                    removed = int(covered.sum())
                    spans = int(covered[0]) + int((covered[1:] & ~covered[:-1]).sum())
                    raw = np.frombuffer(raw, dtype=np.uint8)[~covered].tobytes()
                out.append((doc.as_py(), n_bytes, removed, spans, raw))
                size += n_bytes
                if size > CHUNK * 16:
                    yield emit(schema, list(zip(*out, strict=True)))
                    out, size = [], 0
            if out:
                yield emit(schema, list(zip(*out, strict=True)))

    marked = rows.join(starts.withColumnRenamed("doc", "d").withColumnRenamed("mark", "m"), F.expr("doc <=> d and mark <=> m"), "left")
    return marked.select("doc", "text", "starts").mapInArrow(run, "doc long, n_bytes long, n_removed long, n_spans long, kept binary").withColumnRenamed("doc", id_col)
