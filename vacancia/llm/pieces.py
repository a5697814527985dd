"""SentencePiece encoding by a table of distinct marked words (operator 5)."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import emit, texts

MARK = "▁"
#: A marked word: its run of blanks and what follows up to the next run.
MARKED = re.compile(" +[^ ]*")
MOST_KEPT, LONG_WORD = 400_000, 64


def marked_words(text: str | None) -> list[str]:
    """The marked words of a text, each without its first marker, which the library adds by itself."""
    if not text:
        return []
    if MARK in text:  # to the model a marker in the text is a blank
        text = text.replace(MARK, " ")
    words = text.split(" ")
    return [w[1:] for w in MARKED.findall(" " + text)] if "" in words else words


class Segmenter:
    """Ids of whole texts, each distinct marked word segmented once while the table holds it.

    Right for a model none of whose pieces has a marker after another character: then no piece
    crosses from one marked word to the next. Other models are refused. The table holds ``MOST_KEPT`` words of up to
    ``LONG_WORD`` characters; a full one is begun anew and longer words are segmented each time, so memory is bounded.
    """

    def __init__(self, model: bytes):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        for i in range(self.sp.get_piece_size()):
            piece = self.sp.id_to_piece(i)
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} crosses a white space marker")
        if self.sp.encode("a  b ", out_type=str)[0][0] != MARK or "".join(self.sp.encode("a  b ", out_type=str)) != f"{MARK}a{MARK * 2}b{MARK}":
            raise ValueError("the model does not keep white space behind a leading marker")
        self.table: dict[str, bytes] = {}
        self.alone = self._packed([self.sp.piece_to_id(MARK)])
        self.ends = self._packed([self.sp.bos_id()]), self._packed([self.sp.eos_id()])

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    def _segment(self, words: list[str]) -> None:
        self.table.update(zip(words, map(self._packed, self.sp.encode(words, num_threads=1)), strict=True))
        self.table[""] = self.alone  # the library gives no marker to an empty text

    def encode(self, some: list[str | None]) -> list[bytes]:
        """Ids of whole texts with begin and end, as little-endian 32-bit integers. Null counts as empty."""
        words = [marked_words(t) for t in some]
        new = set(filterfalse(self.table.__contains__, chain.from_iterable(words)))
        if new and len(self.table) + len(new) > MOST_KEPT:
            self.table.clear()
            new = set(chain.from_iterable(words))
        self._segment(list(new))
        out = [b"".join([self.ends[0], *map(self.table.__getitem__, w), self.ends[1]]) for w in words]
        for w in new:
            if len(w) > LONG_WORD:
                del self.table[w]
        if len(self.table) > MOST_KEPT:  # these texts alone have more words than the table may hold
            self.table.clear()
        return out

    def decode(self, ids: bytes) -> str:
        return self.sp.decode(np.frombuffer(ids, dtype="<u4").tolist())


def portions(some: Iterable[str | None], chars: int = 1 << 20) -> Iterator[list[str | None]]:
    """Texts in lists of about ``chars`` characters."""
    held, size = [], 0
    for t in some:
        held.append(t)
        size += len(t or "") + 64
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def model_bytes(path: str) -> bytes:
    """Of the tokenizer file; it is small and sent to the tasks, so that executors need not have it."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded) per row: ids are an array of ints with begin and end, decoded is their text. Null counts as empty."""
    schema = pa.schema([("key", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Segmenter(model)
        for batch in batches:
            start = 0
            for part in portions(texts(batch)):
                ids = own.encode(part)
                flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                ends = pa.array(np.cumsum([0, *(len(x) // 4 for x in ids)]), pa.int32())
                keys = batch.column(0).slice(start, len(part)).cast(pa.int64())
                start += len(part)
                yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(ends, flat), pa.array([own.decode(x) for x in ids])], schema=schema)

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, "key long, ids array<int>, decoded string").withColumnRenamed("key", key)


def digests(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of ``encode``, without sending ids and texts out of the task."""
    schema = pa.schema([("key", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Segmenter(model)
        for batch in batches:
            n, a, b = [], [], []
            for ids in (x for part in portions(texts(batch)) for x in own.encode(part)):
                n.append(len(ids) // 4)
                a.append(sha256(ids).hexdigest())
                b.append(sha256(own.decode(ids).encode()).hexdigest())
            yield emit(schema, [batch.column(0), n, a, b])

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(
        run, "key long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    ).withColumnRenamed("key", key)
