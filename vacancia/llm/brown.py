"""Class-based n-gram scoring: exchange clustering, class transitions and word emissions (operator 4)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import emit, stored, texts

END = b" "  # no word has a blank
FLUSH = 200_000  # distinct words counted in a task before they are sent on


def words(text: str | None) -> list[bytes]:
    """A-Z in lower case, between ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, c) over all texts, with one END each; counted in the tasks first, so a frequent word is a few rows."""
    schema = pa.schema([("word", pa.binary()), ("c", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for t in texts(batch):
                seen.update(words(t))
                seen[END] += 1
                if len(seen) > FLUSH:
                    yield emit(schema, [list(seen.keys()), list(seen.values())])
                    seen.clear()
        yield emit(schema, [list(seen.keys()), list(seen.values())])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Units:
    """What the exchange moves: the most frequent words by number, all other words in groups by their ending.

    A word past the first ``len(frequent)`` belongs to one of ``rare`` groups by its last three bytes and its length. A group is
    a unit like a word: exchange gives it its class, and with it all its words. So the exchange works on a bounded number of
    units while it places every word of the corpus, and counts, emissions and scores cover each word.
    """

    frequent: dict[bytes, int]
    rare: int

    @property
    def n(self) -> int:
        return len(self.frequent) + self.rare

    def of(self, word: bytes) -> int:
        unit = self.frequent.get(word)
        return len(self.frequent) + crc32(word[-3:] + bytes([min(len(word), 12) // 4])) % self.rare if unit is None else unit


def unit_bigrams(docs: DataFrame, units: Units, text: str = "text") -> DataFrame:
    """(a, b, n): how often unit b follows unit a; a text begins after and closes with END."""
    schema = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])
    n = units.n

    def flat(pairs: np.ndarray) -> pa.RecordBatch:
        keys, counts = np.unique(pairs, return_counts=True)
        return emit(schema, [keys // n, keys % n, counts])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        end = units.frequent[END]
        known: dict[bytes, int] = {}
        for batch in batches:
            for t in texts(batch):
                tokens = words(t)
                known.update((w, units.of(w)) for w in set(tokens).difference(known))
                ids = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
                seq = np.concatenate([[end], ids, [end]])
                held.append(seq[:-1] * n + seq[1:])
                size += len(seq)
                if len(known) > FLUSH:
                    known.clear()
                if size > 1 << 21:
                    yield flat(np.concatenate(held))
                    held, size = [], 0
        if held:
            yield flat(np.concatenate(held))

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "a int, b int, n long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def neighbours(bigrams: DataFrame) -> DataFrame:
    """(unit, before, n_before, after, n_after): a unit's neighbours on each side as packed int32 numbers, their counts as int64.

    A row has at most two entries per unit, so its size is bounded whatever the corpus. Packed, a scan hands whole arrays to
    the tasks' numpy and converts no single entry.
    """
    schema = pa.schema([("unit", pa.int32()), *((c, pa.binary()) for c in ("before", "n_before", "after", "n_after"))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(4)]
            for other, n, side in zip(b.column(1), b.column(2), b.column(3), strict=True):
                other, n, side = (np.asarray(x.values) for x in (other, n, side))
                for i in (0, 1):
                    out[2 * i].append(other[side == i].astype(np.int32).tobytes())
                    out[2 * i + 1].append(n[side == i].astype(np.int64).tobytes())
            yield emit(schema, [b.column(0), *out])

    both = bigrams.select(F.col("a").alias("unit"), F.col("b").alias("other"), "n", F.lit(1).alias("side")).union(
        bigrams.select(F.col("b"), F.col("a"), "n", F.lit(0))
    )
    lists = both.groupBy("unit").agg(F.collect_list(F.struct("other", "n", "side")).alias("x"))
    return lists.select("unit", "x.other", "x.n", "x.side").mapInArrow(run, "unit int, before binary, n_before binary, after binary, n_after binary")


def class_bigrams(by_unit: DataFrame, tried: list[np.ndarray], n_classes: int) -> list[np.ndarray]:
    """Counts of class after class under each of some assignments, in one scan: n_classes squared numbers each, whatever the corpus."""
    schema = pa.schema([("k", pa.int32()), ("n", pa.int64())])
    states = np.array(tried)
    each, rows = len(states) * n_classes, np.arange(len(states))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(states), n_classes, n_classes), dtype=np.int64)
        for b in batches:
            for unit, after, n in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                after, n = np.frombuffer(after.as_buffer(), np.int32), np.frombuffer(n.as_buffer(), np.int64)
                cells = states[:, after] + rows[:, None] * n_classes
                # sums of whole numbers below 2 ** 53 are exact
                found = np.bincount(cells.ravel(), np.tile(n, len(states)), each).reshape(-1, n_classes)
                total[rows, states[:, unit]] += found.astype(np.int64)
        some = np.flatnonzero(total)
        yield emit(schema, [some, total.ravel()[some]])

    out = np.zeros(len(states) * n_classes * n_classes, dtype=np.int64)
    counts = by_unit.select("unit", "after", "n_after").mapInArrow(run, "k int, n long")
    found = counts.groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out[found.column("k").to_numpy()] = found.column("n").to_numpy()
    return list(out.reshape(len(states), n_classes, n_classes))


def _entropy(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(pairs: np.ndarray) -> float:
    """What the classes change of the corpus' log likelihood under class bigrams."""
    return float(_entropy(pairs).sum() - _entropy(pairs.sum(0)).sum() - _entropy(pairs.sum(1)).sum())


def proposals(by_unit: DataFrame, classes: np.ndarray, pairs: np.ndarray, open_classes: int) -> DataFrame:
    """(unit, to, gain): for each unit the one of the first ``open_classes`` it would best be exchanged into, all others held.

    ``by_unit`` is from ``neighbours``. A unit of another class (END) stays where it is.
    """
    schema = pa.schema([("unit", pa.int32()), ("to", pa.int32()), ("gain", pa.float64())])
    n = len(pairs)
    rows, columns = pairs.sum(1), pairs.sum(0)
    whole, numbers = _entropy(pairs), np.arange(n)

    def change(old: np.ndarray, add: np.ndarray) -> np.ndarray:
        return _entropy(old + add) - _entropy(old)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            units, to, gain = [], [], []
            for unit, *sides in zip(b.column(0).to_pylist(), *b.columns[1:], strict=True):
                own = classes[unit]
                if own >= open_classes:
                    continue
                (left_of, n_left), (right_of, n_right) = (
                    (np.frombuffer(ids.as_buffer(), np.int32), np.frombuffer(ns.as_buffer(), np.int64)) for ids, ns in (sides[:2], sides[2:])
                )
                itself = int(n_right[right_of == unit].sum())
                before, after = np.bincount(classes[left_of], n_left, n), np.bincount(classes[right_of], n_right, n)
                before[own] -= itself
                after[own] -= itself
                left, known = pairs.astype(np.float64), whole.copy()
                left[:, own] -= before
                left[own, :] -= after
                left[own, own] -= itself
                known[:, own], known[own, :] = _entropy(left[:, own]), _entropy(left[own, :])
                # the likelihood gained by putting the unit into each class, from a state where it is in none; only
                # classes that neighbour it change anything
                diagonal = np.diag(left)
                met, meets = np.flatnonzero(before), np.flatnonzero(after)
                into = (_entropy(left[met] + before[met, None]) - known[met]).sum(0)
                into += (_entropy(left[:, meets] + after[meets]) - known[:, meets]).sum(1)
                into += change(diagonal, before + after + itself) - change(diagonal, before) - change(diagonal, after)
                into -= change(columns - (numbers == own) * (before.sum() + itself), before.sum() + itself)
                into -= change(rows - (numbers == own) * (after.sum() + itself), after.sum() + itself)
                best = int(into[:open_classes].argmax())
                if best != own and into[best] > into[own] + 1e-6:
                    units.append(unit)
                    to.append(best)
                    gain.append(into[best] - into[own])
            yield emit(schema, [units, to, gain])

    return by_unit.mapInArrow(run, "unit int, to int, gain double")


@dataclass
class Model:
    """Everything of bounded size that scoring needs; counts of words that are not frequent stay in a table."""

    units: Units
    classes: np.ndarray
    logp: np.ndarray
    emitted: np.ndarray
    kinds: np.ndarray
    common: dict[bytes, int]
    tokens: int
    types: int


def exchange(by_unit: DataFrame, units: Units, n_classes: int, rounds: int) -> np.ndarray:
    """The class of every unit, from their ``neighbours``. Units start dealt out, words by frequency; only END keeps a class of its own.

    A round proposes for all units against the same state and counts the likelihood anew with the best half of the proposals, with a
    quarter of those and so on down to the best one alone, all in one scan; the likeliest state is the next. The best
    one alone cannot fail, so rounds end at a state that no single exchange improves, or at ``rounds``.
    """
    f, n = len(units.frequent), n_classes + 1
    end = units.frequent[END]
    classes = np.concatenate([np.arange(f) % n_classes, np.arange(units.rare) % n_classes])
    classes[end] = n - 1
    pairs = class_bigrams(by_unit, [classes], n)[0]
    for _ in range(rounds):
        wanted = sorted((-r.gain, r.unit, r.to) for r in proposals(by_unit, classes, pairs, n_classes).collect())
        if not wanted:
            break
        tried, taken = [], -(-len(wanted) // 2)
        while True:
            state = classes.copy()
            for _, unit, to in wanted[:taken]:
                state[unit] = to
            tried.append(state)
            if taken == 1:
                break
            taken = -(-taken // 4)
        after = class_bigrams(by_unit, tried, n)
        best = max(range(len(tried)), key=lambda i: likelihood(after[i]))
        if likelihood(after[best]) <= likelihood(pairs):
            break
        classes, pairs = tried[best], after[best]
    return classes


def most_common(own: DataFrame, n: int) -> list[tuple[bytes, int]]:
    """The n most frequent words with their counts, ties by word."""
    # the count from which on words are taken whole: found on (count, words that have it), not on the words
    least, left = None, n
    for r in own.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(n).toLocalIterator():
        if r.n > left:
            tied = own.where(F.col("c") == r.c).orderBy("word").limit(left).collect() if left else []
            break
        least, left = r.c, left - r.n
    else:
        tied = []
    top = own.where(F.col("c") >= least).collect() if least else []
    return sorted(((bytes(r.word), r.c) for r in [*top, *tied]), key=lambda x: (-x[1], x[0]))


def train(
    learn: DataFrame, counts: DataFrame, text: str = "text", clustered: int = 4000, common: int = 100_000, n_classes: int = 128, rare: int = 2048, rounds: int = 20
) -> Model:
    """From texts ``learn`` and their ``word_counts``. ``clustered`` words and ``rare`` groups of the others are exchanged between
    ``n_classes`` classes, the ``common`` most frequent words' counts (ties by word) go to the tasks; all bound what the driver
    holds, none what is counted or clustered."""
    size = counts.agg(F.sum("c").alias("tokens"), F.count("*").alias("types")).first()
    end = counts.where(F.col("word") == END).collect()
    known = {bytes(r.word): r.c for r in end} | dict(most_common(counts.where(F.col("word") != END), common))
    known.setdefault(END, 0)
    units = Units({w: i for i, w in enumerate(list(known)[: clustered + 1])}, rare)
    by_unit = stored(neighbours(stored(unit_bigrams(learn, units, text), "bigrams")), "by_unit")
    classes = exchange(by_unit, units, n_classes, rounds)
    n = n_classes + 1
    pairs = class_bigrams(by_unit, [classes], n)[0].astype(np.float64)
    # absolute counts plus a share of the class's own frequency: smoothed transitions
    usual = (pairs.sum(0) + 1) / (pairs.sum() + n)
    logp = np.log10((pairs + 8 * usual[None, :]) / (pairs.sum(1, keepdims=True) + 8))
    kinds = np.bincount(classes[: len(units.frequent)], minlength=n).astype(np.int64)
    schema = pa.schema([("k", pa.int32()), ("n", pa.int64())])

    def rare_kinds(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = Counter(units.of(w) for w in b.column(0).to_pylist())
            yield emit(schema, [list(seen.keys()), list(seen.values())])

    for r in counts.select("word").mapInArrow(rare_kinds, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        if r.k >= len(units.frequent):
            kinds[classes[r.k]] += r.n
    return Model(units, classes, logp, pairs.sum(0), kinds, known, size.tokens or 0, size.types or 0)


def score(docs: DataFrame, model: Model, counts: DataFrame, key: str = "doc_id", text: str = "text", extra: tuple = ()) -> DataFrame:
    """(key, n_tokens, n_known, base_score, score, perplexity and ``extra`` columns) per row of ``docs``.

    score is log10 of the product over tokens of P(class | class before) * P(word | class), both smoothed; base_score that of
    add-one word frequencies. Counts of common words are at hand in the task; the others' are joined by word. Null
    counts as empty: the end alone is scored. Repeated rows are scored each.
    """
    schema = pa.schema([("row", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("own", pa.float64()), ("words", pa.list_(pa.binary())), ("ns", pa.list_(pa.int32()))])
    rows = stored(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *extra).withColumn("row", F.monotonically_increasing_id()), "texts")
    end = model.units.frequent[END]
    below = np.log10(model.emitted + model.kinds + 1)
    floor = np.log10(model.tokens + model.types + 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}  # unit and count in one number: counts are below 2 ** 40, and -1 where the word is not common
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                out: list[list] = [[] for _ in range(6)]
                for t in texts(part, "text"):
                    tokens = words(t)
                    known.update((w, (model.units.of(w) << 40) + model.common.get(w, -1) + 1) for w in set(tokens).difference(known))
                    found = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
                    ids = np.append(found >> 40, end)
                    c = np.append((found & ((1 << 40) - 1)) - 1, model.common[END])
                    classes = model.classes[ids]
                    logs = np.log10(np.maximum(c, 0) + 1).sum()
                    before = np.concatenate([[model.classes[end]], classes[:-1]])
                    rest = Counter(map(tokens.__getitem__, np.flatnonzero(c < 0).tolist()))
                    for col, v in zip(out, (len(c), int((c > 0).sum()), logs - len(c) * floor, logs + float(model.logp[before, classes].sum() - below[classes].sum()), list(rest.keys()), list(rest.values())), strict=True):
                        col.append(v)
                    if len(known) > FLUSH:
                        known.clear()
                yield emit(schema, [part.column(0), *out])

    partly = stored(rows.select("row", "text").mapInArrow(run, "row long, n_tokens long, n_known long, base double, own double, words array<binary>, ns array<int>"), "partly")
    if len(model.common) < model.types:  # else all words are common
        open_ = partly.select("row", F.explode(F.arrays_zip("words", "ns")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.ns").alias("n"))
        met = open_.join(counts.where(~F.col("word").isin([END])), "word").groupBy("row").agg(F.sum("n").alias("seen"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("logs"))
        partly = partly.join(met, "row", "left")
    else:
        partly = partly.withColumns({"seen": F.lit(0), "logs": F.lit(0.0)})
    logs, names = F.coalesce("logs", F.lit(0.0)), [c for c in rows.columns if c not in ("key", "text", "row")]
    scored = partly.select("row", "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"), (F.col("base") + logs).alias("base_score"), (F.col("own") + logs).alias("score"))
    out = rows.drop("text").join(scored, "row").withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
    return out.select(F.col("key").alias(key), *names, "n_tokens", "n_known", "base_score", "score", "perplexity")
