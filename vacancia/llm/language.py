"""Language by compression: the dictionary that packs a text best names it (operator 2)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vacancia.llm.common import emit, texts

UNKNOWN = "und"
SHORT = 256  # bytes


def crc_remainder(id_col: str, by: int) -> Column:
    """CRC-32 of the id as text, modulo ``by``: a fold that any engine can compute. Null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % by


def train(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    dictionary_bytes: int = 64 << 10,
    sample: int = 64,
    most_bytes: int = 32 << 20,
) -> dict[str, bytes]:
    """A raw-content dictionary per language, from a bounded sample of the labelled rows.

    Per language the ``sample`` distinct texts of least hash are joined until ``dictionary_bytes`` are full. The
    dictionaries of all languages together hold ``most_bytes`` at most, which bounds what the driver gets and the tasks are
    sent. Rows with null or blank text or null language are not used; no usable row gives no dictionary.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and trim(text) <> ''")
    rows = rows.withColumn("h", F.xxhash64("text"))
    least = Window.partitionBy("lang").orderBy("h")  # narrow rows, each language cut down before the shuffle
    chosen = rows.select("lang", "h").distinct().withColumn("r", F.row_number().over(least)).where(F.col("r") <= sample).select("lang", "h").collect()
    size = min(dictionary_bytes, most_bytes // max(1, len({c.lang for c in chosen})))
    picked = F.broadcast(labelled.sparkSession.createDataFrame(chosen, "lang string, h long"))
    texts_ = rows.join(picked, ["lang", "h"], "left_semi").select("lang", "h", F.substring("text", 1, size).alias("text")).distinct()
    parts: dict[str, bytes] = {}
    for row in texts_.orderBy("lang", "h").toLocalIterator():
        parts[row.lang] = (folded(row.text) + b"\n" + parts.get(row.lang, b""))[:size]
    return parts


def folded(text: str) -> bytes:
    """In lower case, so that headings and shouting match the dictionary too, and with words closed by blanks."""
    return f" {text.lower()} ".encode("utf-8", "surrogatepass")


def packers(dictionaries: Mapping[str, bytes], level: int) -> dict[str, zstandard.ZstdCompressor]:
    out = {}
    for lang in sorted(dictionaries):
        d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        out[lang] = zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
    return out


def packed_sizes(text: str, by: Mapping[str, zstandard.ZstdCompressor], block: int) -> dict[str, int]:
    """Bytes of the text under each dictionary. It is cut into blocks that are packed one by one; in one
    piece a long text would soon be its own dictionary. A text of a few bytes is repeated: the packer would only store it,
    while of a repeated one the first copy alone costs, by what the dictionary has of it."""
    raw = folded(text)
    raw *= max(1, SHORT // len(raw))
    cuts = [raw[i : i + block] for i in range(0, len(raw), block)]
    return {lang: sum(len(c.compress(x)) for x in cuts) for lang, c in by.items()}


def judge(text: str | None, by: Mapping[str, zstandard.ZstdCompressor], block: int) -> tuple[str, float]:
    """The language that packs the text smallest (ties: first name) and the share of bytes it saves against the second."""
    if not by or not text or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    ranked = sorted((n, lang) for lang, n in packed_sizes(text, by, block).items())
    return ranked[0][1], (ranked[1][0] - ranked[0][0]) / ranked[1][0] if len(ranked) > 1 else 1.0


def rejects(lang: str, score: float, min_margin: float) -> bool:
    return lang == UNKNOWN or score < min_margin


def classify(
    docs: DataFrame,
    dictionaries: Mapping[str, bytes],
    key: str = "doc_id",
    text: str = "text",
    min_margin: float = 0.005,
    block: int = 4096,
    level: int = 6,
) -> DataFrame:
    """(key, lang_pred, score, rejected) per row.

    lang_pred is the language whose dictionary packs the whole text smallest; ties go to the first name. score is the share
    of bytes that the best saves against the second (0 to 1; 1 where there is but one dictionary). A row is rejected
    if score is under ``min_margin`` or nothing could be said: null text, a text without a letter, or no dictionary give
    ``und`` and score 0.
    """
    schema = pa.schema([("key", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = packers(dictionaries, level)
        for batch in batches:
            judged = [judge(t, by, block) for t in texts(batch)]
            yield emit(schema, [batch.column(0), *(zip(*judged, strict=True) if judged else ([], [])), [rejects(*j, min_margin) for j in judged]])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "key long, lang_pred string, score double, rejected boolean").withColumnRenamed("key", key)


def keep_known(
    docs: DataFrame, dictionaries: Mapping[str, bytes], text: str = "text", min_margin: float = 0.005, block: int = 4096, level: int = 6
) -> DataFrame:
    """Rows of ``docs`` that ``classify`` does not reject, all columns as they are."""

    @F.pandas_udf("boolean")
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        by = packers(dictionaries, level)
        for batch in batches:
            yield pd.Series([not rejects(*judge(t, by, block), min_margin) for t in batch], dtype=bool)

    return docs.where(known(F.col(text)))
