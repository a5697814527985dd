"""Every operator of the subpackage against a brute-force version, with nulls, empty texts, ties, repeated rows and clashing columns."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from vacancia.llm import brown, bwt, covertree, language, leaks, lines, negatives, pieces, quotes, shards, simhash
from vacancia.llm.common import connected

WORDS = "the of and to in is that was with from alpha beta gamma delta river stone cloud paper table green".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for i in range(60):
        t = "\n".join(prose(rng, rng.randint(1, 14)) for _ in range(rng.randint(1, 12)))
        out.append((i, t))
    shared = "\n".join(prose(rng, 12) for _ in range(4))
    out += [(100 + i, out[i][1]) for i in range(8)]
    out += [(120 + i, out[i][1] + " extra") for i in range(8)]
    out += [(140 + i, prose(rng, 20) + "\n" + shared + "\n" + prose(rng, 9)) for i in range(6)]
    out += [(200, None), (201, ""), (202, " \n\t "), (203, "x" * 300_000), (204, "é日本😀 " * 40), (5, out[5][1]), (None, out[7][1])]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    made = spark.createDataFrame([(i, t, 1, "z", 2.0, "q") for i, t in rows], "doc_id long, text string, row int, key string, score double, h string")
    return made.repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, n_chars long")


def bag(df, *columns):
    return collections.Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(i, i + 1) for i in range(200, 260)] + [(300, i) for i in range(301, 340)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {a for a, b in edges if a == b}
    assert {k: v for k, v in got.items() if k not in alone} == {k: v for k, v in root.items() if k in got and k not in alone}


def test_quotes(spark):
    said = [
        (1, 0, "a", "Hello there.\n\nSecond para here"), (1, 1, "b", "> hello   THERE.\nYes indeed"), (1, 1, "b", "> hello   THERE.\nYes indeed"),
        (1, 2, "a", "on Monday x wrote:\n> > Hello there.\n> Yes\n> indeed\n\nThird"), (1, 3, "c", "unrelated"), (1, 4, "d", "> second para\n> here\nre"),
        (2, 5000, "a", "Yes indeed"), (2, 9000, "b", "> yes indeed\nok"), (None, 1, "x", "> q"), (2, None, "y", None), (3, 0, None, ""), (3, 1, "z", "> unknown\nok"),
    ]
    df = spark.createDataFrame([(*r, 7) for r in said], "conv_id long, turn long, role string, text string, thread int")
    got = {(r.conv_id, r.turn): r for r in quotes.reply_order(df).collect()}
    assert [(got[1, t].position, got[1, t].reply_to, got[1, t].depth, got[1, t].text) for t in range(5)] == [
        (0, None, 0, "Hello there.\n\nSecond para here"), (1, 0, 1, "Yes indeed"), (2, 1, 2, "Third"), (4, None, 0, "unrelated"), (3, 0, 1, "re"),
    ]
    assert got[1, 1].copies == 2 and got[1, 2].n_linked == 2 and got[2, 9000].reply_to == 5000
    assert got[None, 1].position is None and got[2, None].text == "" and got[3, 1].reply_to is None
    assert quotes.reply_order(df.limit(0)).count() == 0


def test_language(spark, empty):
    rng = random.Random(4)
    make = {"xx": lambda: prose(rng, 60), "yy": lambda: " ".join(rng.choice(["der", "und", "nicht", "schön", "ung"]) + rng.choice(["en", "er"]) for _ in range(60))}
    rows = [(i, make[lang](), lang) for i in range(80) for lang in [rng.choice(["xx", "yy"])]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df.where("doc_id < 40"), dictionary_bytes=8000)
    found = {r.doc_id: r for r in language.classify(df, model).collect()}
    assert sum(found[i].lang_pred == lang for i, _, lang in rows if i >= 40) >= 38
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 --"), (4, "a"), (5, prose(rng, 20000))], "doc_id long, text string")
    got = {r.doc_id: r for r in language.classify(odd, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[5].lang_pred == "xx" and all(0 <= r.score <= 1 for r in got.values())
    assert {r.doc_id for r in language.keep_known(odd, model).collect()} == {i for i, r in got.items() if not r.rejected}
    assert language.train(empty) == {} and language.classify(odd, {}).where("rejected").count() == 5


def test_line_runs(docs, rows, empty):
    def brute(m=3):
        first, out = set(), {}
        for i, t in sorted({x for x in rows if x[1] is not None}, key=lambda x: (x[0] is not None, x[0] or 0)):
            own, gone = t.split("\n"), set()
            for p in range(len(own) - m + 1):
                run = tuple(own[p : p + m])
                if run in first:
                    gone.update(range(p, p + m))
                first.add(run)
            out[i, t] = ("\n".join(x for k, x in enumerate(own) if k not in gone), len(gone), len(gone - {g + 1 for g in gone}))
        return out

    want = brute()
    got = bag(lines.drop_repeated(docs), "doc_id", "kept", "n_removed", "n_runs")
    assert got == collections.Counter((i, *want[i, t]) if t is not None else (i, None, 0, 0) for i, t in rows)
    kept = lines.keep_first_runs(docs)
    assert kept.columns == docs.columns
    assert bag(kept, "doc_id", "text") == collections.Counter((i, want[i, t][0] if t is not None else None) for i, t in rows if t is None or want[i, t][1] == 0 or want[i, t][0].strip())
    assert lines.keep_first_runs(empty).count() == 0


def test_brown(spark, docs, rows, empty):
    learn = docs.where("doc_id % 7 <> 2 or doc_id is null")
    counts = brown.word_counts(learn)
    model = brown.train(learn, counts, clustered=20, common=30, n_classes=4, rare=3, rounds=2)
    c = collections.Counter()
    for i, t in rows:
        if i is None or i % 7 != 2:
            c.update(brown.words(t))
            c[brown.END] += 1
    n, v = sum(c.values()), len(c)
    assert (model.tokens, model.types) == (n, v)
    got = collections.defaultdict(list)
    for r in brown.score(docs, model, counts).collect():
        got[r.doc_id].append(r)
    for i, t in rows:
        own = [*brown.words(t), brown.END]
        base = sum(np.log10((c[w] + 1) / (n + v + 1)) for w in own)
        before, score = model.classes[model.units.frequent[brown.END]], 0.0
        for w in own:
            g = model.classes[model.units.of(w)]
            score += model.logp[before, g] + np.log10((c[w] + 1) / (model.emitted[g] + model.kinds[g] + 1))
            before = g
        for r in got[i]:
            assert (r.n_tokens, r.n_known) == (len(own), sum(c[w] > 0 for w in own))
            assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
    assert np.allclose((10**model.logp).sum(axis=1), 1)
    none = brown.word_counts(empty)
    assert brown.score(docs, brown.train(empty, none), none).where("n_known = 0").count() == len(rows)


def test_exchange_equals_brute_force(spark, docs, rows):
    """Every proposal is the best class by the likelihood counted anew, and the end state has no better single exchange."""
    units = brown.Units({w: i for i, w in enumerate([brown.END, *sorted(x.encode() for x in WORDS)[:25]])}, 5)
    pairs = brown.unit_bigrams(docs, units).cache()
    table = {(r.a, r.b): r.n for r in pairs.collect()}

    def likelihood(classes):
        counts = np.zeros((5, 5))
        for (a, b), n in table.items():
            counts[classes[a], classes[b]] += n
        return brown.likelihood(counts)

    def best(classes, unit):
        tried = []
        for c in range(4):
            other = classes.copy()
            other[unit] = c
            tried.append(likelihood(other))
        return tried

    by_unit = brown.neighbours(pairs).cache()
    start = brown.exchange(by_unit, units, 4, 0)
    end = brown.exchange(by_unit, units, 4, 1000)
    assert start[0] == end[0] == 4 and max(start[1:]) < 4  # END keeps its class, groups of rare words take part
    assert likelihood(end) > likelihood(start)
    for unit in range(1, units.n):
        assert max(best(end, unit)) <= likelihood(end) + 1e-5
    found = {r.unit: r for r in brown.proposals(by_unit, start, brown.class_bigrams(by_unit, [start], 5)[0], 4).collect()}
    assert found
    for unit in {u for pair in table for u in pair} - {0}:
        tried = best(start, unit)
        gain = max(tried) - likelihood(start)
        assert (unit in found) == (gain > 1e-6)
        if unit in found:
            assert found[unit].gain == pytest.approx(gain, abs=1e-6) and tried[found[unit].to] == pytest.approx(max(tried), abs=1e-6)


def test_most_common_words_with_ties(spark):
    rows = [(w.encode(), c) for w, c in (("a", 5), ("d", 2), ("b", 2), ("c", 2), ("e", 1))]
    counts = spark.createDataFrame(rows, "word binary, c long")
    want = [(w.encode(), c) for w, c in (("a", 5), ("b", 2), ("c", 2), ("d", 2), ("e", 1))]
    for n in range(1, 7):
        assert brown.most_common(counts, n) == want[:n]
    assert brown.most_common(counts.where("c > 9"), 3) == []


def test_pieces(docs, rows, empty):
    model = pieces.model_bytes(public_tokenizers.path("piece_bpe_32k.model"))
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(5)
    odd = ["  a  b   ", "▁", "▁▁a▁ b", "<s> </s> <0x0A>", "\x00a", "a b　c", "\t\r\n"] + ["".join(rng.choice(" ▁ab\n<é日😀") for _ in range(30)) for _ in range(300)]
    own = pieces.Segmenter(model)
    for t, ids in zip(odd, own.encode(odd), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == [1, *sp.encode(t), 2]
    want = collections.Counter()
    for i, t in rows:
        ids = [1, *sp.encode(t or ""), 2]
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()] += 1
    assert bag(pieces.digests(docs, model), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert bag(pieces.encode(docs, model).select("doc_id", F.size("ids").alias("n"), F.sha2(F.col("decoded").cast("binary"), 256).alias("d")), "doc_id", "n", "d") == collections.Counter(
        {(i, n, d): c for (i, n, _, d), c in want.items()}
    )
    assert pieces.digests(empty, model).count() == 0


def kd_by_hand(units, shards):
    """Shard of each unit (bytes, axis values, digits): split at the weighted quantile along the widest axis; equal places stay together."""
    out = {}

    def split(own, first, n):
        if n == 1 or not own:
            out.update((u, first) for u in own)
            return
        spread = [max(units[u][1][a] for u in own) - min(units[u][1][a] for u in own) for a in range(2)]
        axis = spread.index(max(spread))
        cells = collections.defaultdict(list)
        for u in own:
            cells[(units[u][1][axis], *units[u][2])].append(u)
        want, before, left = sum(units[u][0] for u in own) * (n // 2) / n, 0, []
        for place in sorted(cells):
            heavy = sum(units[u][0] for u in cells[place])
            if before + heavy > want and not want - before > heavy / 2:
                break
            left += cells[place]
            before += heavy
            if before > want:
                break
        split(left, first, n // 2)
        split([u for u in own if u not in set(left)], first + n // 2, n - n // 2)

    split(list(units), 0, shards)
    return out


@pytest.mark.parametrize("shards_", [1, 2, 7, 12])
def test_kd_tree_by_brute_force(spark, shards_):
    rng = random.Random(shards_)
    units = {i: (rng.choice([16, 17, 40, 900, 30_000]), (rng.randint(0, 5), rng.choice([0, 3, 60_000])), (rng.randint(0, 9), rng.randint(0, 4))) for i in range(300)}
    df = spark.createDataFrame([(i, w, *a, *d) for i, (w, a, d) in units.items()], "unit int, bytes long, a int, b int, d int, e int")
    got = {r.unit: r.shard for r in shards.kd_shards(df, ["a", "b"], ["d", "e"], shards_, tolerance=0).collect()}
    assert got == kd_by_hand(units, shards_)


def test_shards(spark, docs, rows, empty):
    long = [(900, "y" * 2_000_000), (901, "y" * 2_000_000), *((1000 + i, "again and again " * 5) for i in range(400)), *((2000 + i, "") for i in range(400))]
    more = spark.createDataFrame([(i, t, 1, "z", 2.0, "q") for i, t in long], docs.schema)
    df = docs.union(more).withColumn("lang", F.when(F.col("doc_id") > 30, "en")).withColumn("n_chars", F.length("text")).withColumn("shard", F.lit(3))
    out = shards.shard_documents(df, 5).collect()
    every = [*rows, *long]
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in out) == collections.Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in every
    )
    by, groups = collections.defaultdict(list), collections.defaultdict(set)
    for r in out:
        by[r.shard].append(r)
        groups[r.text_crc32, r.size].add(r.shard)
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
    share = sum(r.size for r in out) / 5
    large = {k for k, x in groups.items() if len(x) > 1}
    assert large <= {(zlib.crc32(b"y" * 2_000_000), 2_000_016)} and 4_000_032 > share
    small = shards.shard_documents(df.where("length(text) < 300 or text is null"), 5).collect()
    sizes = collections.Counter()
    for r in small:
        sizes[r.shard] += r.size
    assert len(sizes) == 5 and max(sizes.values()) < 1.2 * min(sizes.values())  # the copies, two thirds of the rows, are dealt out
    assert shards.shard_documents(empty, 5).count() == 0
    assert {r.shard for r in shards.shard_documents(df.limit(1), 5).collect()} <= set(range(5))


def test_cover_tree(spark):
    rng = np.random.default_rng(2)
    vecs = [(i, [float(x) for x in rng.normal(size=8).round(2)]) for i in range(300)]
    vecs += [(300 + i, vecs[0][1]) for i in range(40)] + [(400, None), (401, [1.0, None] * 4), (402, [float("nan")] * 8), (403, []), (404, [1.0, 2.0]), (450, [3.0, 4.0]), (None, vecs[1][1]), vecs[3]]
    df = spark.createDataFrame([(*v, 1) for v in vecs], "vec_id long, embedding array<float>, score int")
    good = {i: np.floor(256 * np.array(v, dtype=np.float32).astype(np.float64)).astype(np.int64) for i, v in vecs if i is not None and v and None not in v and np.isfinite(v).all()}
    want = set()
    for q in good:
        if q % 50 == 0:
            ranked = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:5]
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked)}
    got = covertree.top_k(df, "id % 50 = 0", leaves=16, sample=64, block=16)
    assert set(bag(got, "query_id", "rank", "id", "score")) == want
    assert covertree.top_k(df.limit(0), "id % 50 = 0").count() == 0


def whole(v):
    """Components floor(256 * x) as Python integers; None where the vector takes no part."""
    x = None if not v or None in v else np.array(v, dtype=np.float32).astype(np.float64)
    return None if x is None or not np.isfinite(x).all() else [int(c) for c in np.floor(256 * x)]


def inner(a, b):
    return min(max(sum(x * y for x, y in zip(a, b, strict=True)), -(1 << 63)), (1 << 63) - 1)


def large_vectors(rng):
    """Components past 31, 53 and 63 bits once scaled: none of them may fall out or lose a digit."""
    out = [(700, [5e6, 1.0, 0.0, -3e7, 2.0, 0.5, 0.0, 1.0]), (701, [3e38] * 8), (702, [-3e38] * 8), (750, [1e15, -1e15, 0.25, 0.0, 0.0, 0.0, 0.0, 7.0])]
    return out + [(710 + i, [float(np.float32(x)) for x in rng.normal(size=8) * 10.0 ** rng.integers(5, 12)]) for i in range(20)]


def test_cover_tree_large_components(spark):
    rng = np.random.default_rng(6)
    vecs = [(i, [float(x) for x in rng.normal(size=8).round(2)]) for i in range(200)] + large_vectors(rng)
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<float>")
    good = {i: whole(v) for i, v in vecs}
    want = set()
    for q in good:
        if q % 50 == 0:
            ranked = sorted((-inner(good[q], v), i) for i, v in good.items() if i != q)[:5]
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked)}
    got = covertree.top_k(df, "id % 50 = 0", leaves=16, sample=64, block=16)
    assert set(bag(got, "query_id", "rank", "id", "score")) == want and any(q < 700 <= i for q, _, i, _ in want)


def test_strassen():
    rng = np.random.default_rng(3)
    for m, k, n in [(1, 1, 1), (17, 18, 19), (64, 64, 64), (33, 70, 129), (100, 64, 1), (40, 33, 35)]:
        a, b = rng.integers(-(1 << 20), 1 << 20, (m, k)), rng.integers(-(1 << 20), 1 << 20, (k, n))
        assert (negatives.strassen(a, b) == a @ b).all()
        x, y = a.astype(object) ** 5, b.astype(object) ** 5
        assert (negatives.strassen(x, y) == x @ y).all()
    wide = rng.integers(-(1 << 62), 1 << 62, (40, 40))  # wraps round, as the plain product does
    assert (negatives.strassen(wide, wide) == wide @ wide).all()


def negatives_by_hand(rows):
    """rows: distinct (id, label, vector)."""
    good = sorted({(i, c, tuple(whole(v))) for i, c, v in rows if i is not None and c is not None and whole(v)})
    out = collections.Counter()
    for i, c, v in good:
        if i % 100 == 0:
            scores = [(-inner(v, w), j, d) for j, d, w in good if j != i and len(w) == len(v)]
            for s, j, _ in sorted(x for x in scores if x[2] == c)[:5]:
                inside = sorted(x for x in scores if x[2] != c and -80 * s <= -100 * x[0] <= -100 * s)[:5]
                out.update((i, j, n + 1, m, -s, -t) for n, (t, m, _) in enumerate(inside))
    return out


NEGATIVE = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_negatives(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(3, 8))
    rows = [(i, int(rng.integers(0, 4)), [float(x) for x in (centres[i % 3] + rng.normal(size=8) * 0.1).round(1)]) for i in range(900)]
    rows += [(1000 + 100 * i, i % 3, rows[i][2]) for i in range(6)] + [(2000 + i, i % 4, rows[0][2]) for i in range(60)]  # ties
    rows += [(i, i % 2, v) for i, v in large_vectors(rng) if i != 700] + [(10_000, 0, [1e9] * 8), (10_001, 0, [1e9] * 8), (10_002, 1, [9e8] * 8)]
    rows += [(3000, None, rows[1][2]), (3100, 1, None), (3200, 1, []), (3300, 1, [1.0, None] * 4), (3400, 1, [float("nan")] * 8), (3500, 1, [float("inf")] * 8), (None, 1, rows[2][2])]
    rows += [(3600, 1, [1.0, 2.0]), (3601, 1, [1.0, 2.0]), (3602, 2, [1.0, 1.75]), (3700, 8, rows[4][2]), (3800, 9, [0.0] * 8), (3801, 9, [0.0] * 8), rows[0], rows[5]]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, label int, embedding array<float>, mark int, score int, dim int").repartition(5)
    got = bag(negatives.hard_negatives(df, "id % 100 = 0", anchor_rows=4, candidate_rows=100), *NEGATIVE)
    assert got == negatives_by_hand(rows) and max(got.values()) == 1
    assert {r[0] for r in got} >= {100, 1100, 3600, 3800, 10_000} and 3700 not in {r[0] for r in got}  # without positives: no rows
    assert negatives.hard_negatives(df.limit(0), "id % 100 = 0").count() == 0
    assert negatives.hard_negatives(df.where("vec_id % 100 <> 0"), "id % 100 = 0").count() == 0


def test_simhash(docs, rows, empty):
    def fingerprint(t):
        w = (t or "").encode().lower().split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))

    fps = [(i, fingerprint(t)) for i, t in rows]
    root = list(range(len(fps)))
    for _ in range(len(fps)):
        for a in range(len(fps)):
            for b in range(a):
                if (fps[a][1] ^ fps[b][1]).bit_count() <= 2:
                    root[a] = root[b] = min(root[a], root[b])
        if all(root[a] == root[root[a]] for a in range(len(fps))):
            break
    least = collections.defaultdict(list)
    for (i, _), r in zip(fps, root, strict=True):
        least[r].append(i)
    want = collections.Counter((i, f"{f:016x}", min((x for x in least[r] if x is not None), default=None)) for (i, f), r in zip(fps, root, strict=True))
    assert bag(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == want
    assert simhash.near_duplicates(empty).count() == 0


def test_link_group_large():
    rng = np.random.default_rng(1)
    fps = np.unique(rng.integers(0, 1 << 16, 900).astype(np.int64))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    label = np.arange(len(fps))
    for _ in range(len(fps)):
        label = np.where(near, label[None, :], len(fps)).min(axis=1)
    assert (simhash.link_group(fps, 2) == fps[label]).all()


def test_keep_one(docs, rows, empty):
    want = {}
    for r in simhash.near_duplicates(docs).collect():
        want.setdefault(r.component_id, set()).add(r.doc_id)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)  # the least id of each component, once
    assert max(map(len, want.values())) > 1 and None in set.union(*want.values())
    alone = docs.where("doc_id is null").union(docs.where("doc_id is null"))
    assert [r.doc_id for r in simhash.keep_one(alone).collect()] == [None]
    assert simhash.keep_one(empty).count() == 0


def test_leaks(spark, docs, empty):
    rng = random.Random(9)
    items = [(i, " ".join(f"{rng.choice('bcdfg')}{rng.randint(100, 999)}" for _ in range(rng.choice([12, 30, 90]))) + ". Short answer " + str(i) + ".") for i in range(30)]
    texts = [(i, prose(rng, rng.randint(0, 200)) + " " + items[i][1].upper() + " " + prose(rng, 150)) for i in range(30)]
    texts += [(50, prose(rng, 500)), (51, None), (52, ""), (53, items[3][1] + prose(rng, 90) + " " + items[4][1]), (54, " ".join(items[5][1].split()[:5])), texts[0]]
    df = spark.createDataFrame([(*t, 0.5) for t in texts], "doc_id long, text string, score double")
    bench = spark.createDataFrame([*items, (98, None), (99, " "), (None, "abc")], "item_id long, text string")
    want = collections.Counter([*((i, i) for i in range(30)), (53, 3), (53, 4), (0, 0)])
    assert bag(leaks.leaks(df, bench), "doc_id", "item_id") == want
    assert {r.doc_id for r in leaks.keep_clean(df, bench).collect()} == {50, 51, 52, 54}
    assert leaks.leaks(df, bench.limit(0)).count() == 0 and leaks.leaks(empty, bench).count() == 0


def test_repeats(docs, rows, empty):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49 if i is not None else 0):
            w = b[p : p + 50]
            first[w] = min(i, first.get(w, i))
    want = collections.Counter()
    for i, t in rows:
        b = (t or "").encode()
        c = bytearray(len(b))
        for p in range(len(b) - 49 if i is not None else 0):
            if first[b[p : p + 50]] < i:
                c[p : p + 50] = b"\1" * 50
        spans = sum(c[p] and not (p and c[p - 1]) for p in range(len(b)))
        want[i, len(b), sum(c), spans, bytes(x for x, y in zip(b, c, strict=True) if not y)] += 1
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in bwt.remove_repeats(docs).collect())
    assert got == want
    assert bwt.remove_repeats(empty).count() == 0
