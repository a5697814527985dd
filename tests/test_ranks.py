import numpy as np
import pytest
from pyspark.sql import functions as F

from vacancia.operators.ranks import column_quantiles, first_by_hash, quantiles, running_sums
from vacancia.operators.stats import box_stats

PROBS = {"lo": 0.01, "q1": 0.25, "mid": 0.5, "q3": 0.75, "hi": 0.99, "first": 0.0, "last": 1.0}


def _check(rows, groups):
    for r in rows:
        v = groups[r["g"]]
        for name, p in PROBS.items():
            assert r[name] == pytest.approx(np.quantile(v, p), abs=1e-9), (r["g"], name)


def test_quantiles_with_a_hot_group(spark):
    """One group holds most rows and is far above the sketch size; others are tiny or hold one value."""
    rng = np.random.default_rng(1)
    groups = {
        "hot": np.round(rng.lognormal(10, 2, 30_000), 2),
        "ties": rng.integers(0, 5, 4_000).astype(float),
        "same": np.full(900, 7.0),
        "one": np.array([3.5]),
        "two": np.array([1.0, 2.0]),
        "negative": -rng.random(700),
    }
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("hot", None), ("hot", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    _check(quantiles(df, "v", PROBS, ["g"], sketch=200).collect(), groups)


def test_quantiles_of_everything_and_of_nothing(spark):
    v = np.round(np.random.default_rng(2).normal(0, 100, 20_000), 1)
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    got = quantiles(df, "v", PROBS, sketch=100).first()
    for name, p in PROBS.items():
        assert got[name] == pytest.approx(np.quantile(v, p), abs=1e-9)
    empty = quantiles(df.where("v > 1e9"), "v", PROBS).collect()
    assert len(empty) == 1 and all(x is None for x in empty[0])


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    got = {r["g"]: r["m"] for r in quantiles(df, "v", {"m": 0.5}, ["g"]).collect()}
    assert got == {None: 2.0, "a": 5.0}


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums(spark, descending):
    rng = np.random.default_rng(3)
    v = np.unique(np.round(rng.normal(0, 1, 5_000), 4))
    w = rng.integers(1, 9, len(v))
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(v, w)], "v double, w bigint").repartition(5)
    got = {r["v"]: r["cum_w"] for r in running_sums(df, "v", ["w"], descending, buckets=16).collect()}
    order = np.argsort(-v if descending else v)
    assert got == dict(zip(v[order].tolist(), np.cumsum(w[order]).tolist()))


def test_first_by_hash_counts_and_partitions(spark):
    df = spark.range(10_000).select("id", (F.col("id") % 3 == 0).alias("g"))
    share = F.ceil(F.col("_n") * F.lit(0.2))
    a = first_by_hash(df, ["id"], share, 42, ["g"]).where("_picked")
    b = first_by_hash(df.repartition(13), ["id"], share, 42, ["g"]).where("_picked")
    assert {r["g"]: r["count"] for r in a.groupBy("g").count().collect()} == {True: 667, False: 1334}
    assert {r["id"] for r in a.collect()} == {r["id"] for r in b.collect()}
    for n in (0, 1, 777, 10_000, 20_000):
        assert first_by_hash(df, ["id"], F.lit(n), 7).where("_picked").count() == min(n, 10_000)


def test_quantile_plan_has_no_cartesian_product(spark):
    df = spark.range(1000).select("id", (F.col("id") % 5).alias("g"))
    plan = quantiles(df, "id", {"m": 0.5}, ["g"])._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_infinite_values_and_heavy_tails(spark):
    v = np.concatenate([np.random.default_rng(4).pareto(0.1, 3_000), [np.inf] * 40, [-np.inf] * 40, np.zeros(500)])
    df = spark.createDataFrame([(float(x),) for x in v], "v double").repartition(4)
    got = quantiles(df, "v", {"a": 0.0, "b": 0.3, "c": 0.5, "d": 0.9, "e": 1.0}, sketch=100).first()
    want = np.sort(v)
    for name, p in {"a": 0.0, "b": 0.3, "c": 0.5, "d": 0.9, "e": 1.0}.items():
        t = (len(v) - 1) * p
        low, high = want[int(np.floor(t))], want[int(np.ceil(t))]
        assert got[name] == pytest.approx(low if low == high else low + (high - low) * (t - np.floor(t))) or np.isinf(low)


@pytest.fixture
def without_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def _raw_exchanges(df):
    """Partitionings of the exchanges below which no aggregate has reduced the rows."""
    out = []

    def walk(node):
        name = node.nodeName()
        children = node.children()
        below = [walk(children.apply(i)) for i in range(children.size())]
        if name == "AdaptiveSparkPlan":
            below = [walk(node.initialPlan())]
        raw = any(below) or not below
        if "Aggregate" in name:
            raw = False
        if "Exchange" in name and raw:
            out.append(node.outputPartitioning().toString())
        return raw

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_hot_groups_are_dealt_out_without_broadcast(spark, without_broadcast, tmp_path):
    rng = np.random.default_rng(5)
    groups = {"hot": np.round(rng.normal(0, 10, 20_000), 2), "b": rng.random(500), "c": np.full(300, 2.0)}
    rows = [(g, float(x)) for g, v in groups.items() for x in v]
    spark.createDataFrame(rows, "g string, v double").repartition(4).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = quantiles(df, "v", PROBS, ["g"], sketch=100)
    raw = _raw_exchanges(found)
    assert raw and all("_salt" in x for x in raw)
    _check(found.collect(), groups)
    boxes = box_stats(df, "g", "v")
    assert all("_salt" in x for x in _raw_exchanges(boxes)) and {r.g for r in boxes.collect()} == set(groups)


def test_quantiles_of_several_columns_in_one_scan(spark):
    rng = np.random.default_rng(6)
    a, b = rng.normal(0, 1, 5_000), rng.integers(0, 50, 5_000)
    rows = [(float(x), int(y) if i % 3 else None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b int")
    got = column_quantiles(df, {"a_mid": ("a", 0.5), "b_mid": ("b", 0.5), "b_top": ("b", 0.9), "b_low": ("b", 0.9)}, sketch=100)
    known = np.array([y for _, y in rows if y is not None])
    r = got.first()
    assert (r.a_mid, r.b_mid, r.b_top, r.b_low) == pytest.approx((np.quantile(a, 0.5), np.quantile(known, 0.5), *[np.quantile(known, 0.9)] * 2))
    none = column_quantiles(df.limit(0), {"a_mid": ("a", 0.5)}).collect()
    assert len(none) == 1 and none[0].a_mid is None
