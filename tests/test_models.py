import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from vacancia.operators import evaluate, models, prepare
from vacancia.operators.text import tfidf, with_tokens
from vacancia.sources.models import load_model, save_model


@pytest.fixture(scope="module")
def jobs(spark):
    rng = np.random.default_rng(9)
    titles = ["data engineer", "senior data engineer", "nurse", "sales clerk", "senior nurse"]
    rows = []
    for i in range(600):
        t = titles[int(rng.integers(5))]
        n = float(rng.integers(1, 12))
        pay = 40000 + 30000 * ("engineer" in t) + 20000 * ("senior" in t) + 1500 * n + rng.normal(0, 2000)
        rows.append((i, t, ["Full", "Part", None][int(rng.integers(3))], n if i % 9 else None, float(pay), int(pay > 70000)))
    return spark.createDataFrame(rows, "job_id bigint, title string, kind string, n double, pay double, hot int").cache()


SPEC = dict(text="title", categories=["kind"], numbers=["n"], max_features=8, ngrams=(1, 2), sublinear=True, accents=True)


def test_ridge_equals_the_closed_form(spark, jobs):
    f = prepare.fit_features(jobs, prepare.text_spec(**SPEC))
    ridge = models.fit_ridge(jobs, "pay", f, alpha=10.0)
    rows = f.transform(jobs).select("features", "pay").collect()
    x = np.array([r["features"].toArray() for r in rows])
    y = np.log1p([r["pay"] for r in rows])
    xc = x - x.mean(0)
    beta = np.linalg.solve(xc.T @ xc + 10.0 * np.eye(x.shape[1]), xc.T @ (y - y.mean()))
    assert np.allclose(ridge.model.coefficients.toArray(), beta, atol=1e-6)
    assert len(f.names()) == x.shape[1] and f.names()[-1] == "num__n"


def test_logistic_is_at_the_optimum(spark, jobs):
    f = prepare.fit_features(jobs, prepare.text_spec(**SPEC))
    fit = models.fit_logistic(jobs, "hot", f)
    rows = f.transform(prepare.balanced_weights(jobs, "hot", "w")).select("features", "hot", "w").collect()
    x = np.array([r["features"].toArray() for r in rows])
    y, w = np.array([r["hot"] for r in rows]), np.array([r["w"] for r in rows])
    beta = fit.model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ beta + fit.model.intercept)))
    # the gradient of the weighted loss plus half the squared coefficients
    assert np.allclose(x.T @ (w * (p - y)) + beta, 0, atol=0.05)
    assert w.sum() == pytest.approx(len(w))


def test_models_fit_score_and_reload(spark, jobs, tmp_path):
    train, test = prepare.split(jobs, ["job_id"], 0.25, 42)
    assert train.count() + test.count() == 600 and 100 < test.count() < 200
    f = prepare.fit_features(train, prepare.text_spec(**SPEC))
    fits = {
        "ridge": models.fit_ridge(train, "pay", f),
        "rf": models.fit_forest_reg(train, "pay", f, trees=10, depth=6),
        "gbt": models.fit_gbt(train, "pay", f, iters=10, depth=4),
        "tree": models.fit_tree(train, "pay", f, depth=6),
    }
    table = {r["model"]: r for r in models.benchmark(fits, test, "pay").collect()}
    assert all(r["r2"] > 0.8 for r in table.values()), table
    best = models.choose_champion(models.benchmark(fits, test, "pay"), "r2").first()
    assert best["r2"] == max(r["r2"] for r in table.values())
    scored = models.score_salaries(test, fits, best["model"], target="pay")
    assert scored.where(F.abs(F.col("pay") - F.col("pred_salary_best") - F.col("residual_best")) > 1e-6).count() == 0
    assert models.feature_importance(fits["rf"], 5).count() == 5
    save_model(fits["ridge"], str(tmp_path / "m"))
    again = load_model(str(tmp_path / "m")).predict(test, "p").orderBy("job_id").collect()
    assert [r["p"] for r in again] == [r["pred_salary_ridge"] for r in scored.orderBy("job_id").collect()]
    unseen = spark.createDataFrame([(1, "astronaut", "Night", None)], "job_id bigint, title string, kind string, n double")
    assert fits["ridge"].predict(unseen, "p").first()["p"] > 0


def test_what_if_fills_defaults(spark, jobs):
    f = prepare.fit_features(jobs, prepare.text_spec(**SPEC))
    pay, hot = models.fit_ridge(jobs, "pay", f), models.fit_forest_clf(jobs, "hot", f, trees=5, depth=5)
    rows = spark.createDataFrame([("senior data engineer",), ("sales clerk",)], "title string")
    got = {r["title"]: r for r in models.score_what_if(rows, {"kind": "Full", "n": 5.0}, pay, hot).collect()}
    a, b = got["senior data engineer"], got["sales clerk"]
    assert a["pred_salary"] > b["pred_salary"] and a["hot_advice"] == "strong" and b["hot_advice"] == "improve"
    assert a["salary_low"] == pytest.approx(a["pred_salary"] * 0.9)


def test_segments_find_three_clouds(spark):
    rng = np.random.default_rng(4)
    rows = [(i, float(c * 50 + rng.normal()), float(-c * 30 + rng.normal())) for i, c in enumerate([0, 1, 2] * 60)]
    df = spark.createDataFrame(rows, "id bigint, a double, b double")
    scaled = models.segment_features(df, ["a", "b"])
    found = models.fit_kmeans(scaled, ["id"], ks=[2, 3, 4], n_init=3)
    assert found.best_k == 3
    sizes = evaluate.cluster_sizes(found.assign(scaled)).collect()
    assert [r["n"] for r in sizes] == [60, 60, 60]


def test_silhouette_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    x, c = rng.normal(size=(90, 3)), np.array([0, 1, 2, 2, 1] * 18)
    c[0] = 7  # a cluster of one scores 0
    df = spark.createDataFrame([(i, x[i].tolist(), int(c[i])) for i in range(90)], "id bigint, f array<double>, c int")
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    s = []
    for i in range(90):
        mine = (c == c[i]) & (np.arange(90) != i)
        if not mine.any():
            s.append(0.0)
            continue
        a = d[i][mine].mean()
        b = min(d[i][c == k].mean() for k in set(c.tolist()) - {c[i]})
        s.append((b - a) / max(a, b))
    got = evaluate.silhouette(df, "f", "c", ["id"]).first()
    assert got["n"] == 90 and got["silhouette"] == pytest.approx(np.mean(s), abs=1e-9)


def test_curve_and_area_agree(spark):
    rng = np.random.default_rng(8)
    y = rng.integers(0, 2, 800)
    score = np.round(np.clip(y * 0.2 + rng.random(800) * 0.8, 0, 1), 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, score)], "y int, s double")
    pts = evaluate.roc_curve(df, "y", "s").orderBy("fpr", "tpr").collect()
    area = np.trapezoid([p["tpr"] for p in pts], [p["fpr"] for p in pts])
    assert evaluate.auc(df, "y", "s").first()["auc"] == pytest.approx(area, abs=1e-9)
    assert (pts[0]["fpr"], pts[-1]["tpr"]) == (0.0, 1.0)


def test_tokens_and_weights(spark):
    df = spark.createDataFrame([(1, "Élan vital, the ÉLAN!"), (2, "a b c"), (3, None), (4, "ﬁne x2 co_op")], "id int, t string")
    got = {r["id"]: r["w"] for r in with_tokens(df, "t", "w", True, (1, 2), ["the"]).collect()}
    assert got[1] == ["elan", "vital", "elan", "elan vital", "vital elan"] and got[2] == [] and got[3] == []
    assert "x2" in got[4] and "co_op" in got[4]
    unit = tfidf(df, "id", "t").groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(r["n"] == pytest.approx(1.0) for r in unit)


def test_level_guard(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError):
        prepare.check_levels(df, ["c"], limit=100)


def test_standardize_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert sorted(map(tuple, prepare.standardize(df, ["a", "b"]).collect())) == [(-1.0, 0.0), (1.0, 0.0)]


def test_silhouette_of_all_rows_by_brute_force(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(c, 1.0, (60, 3)) for c in (0, 4, 9)] + [np.zeros((1, 3)), np.full((4, 3), 7.0)])
    c = [i // 60 for i in range(180)] + [7] + [8] * 4
    df = spark.createDataFrame([(int(k), [float(v) for v in p]) for k, p in zip(c, x)] + [(None, [1.0] * 3), (2, None)], "c int, f array<double>").repartition(3)
    c, gap, total = np.array(c), ((x[:, None] - x[None]) ** 2).sum(axis=2), 0.0
    for i in range(len(x)):
        if (c == c[i]).sum() > 1:
            a = gap[i][c == c[i]].sum() / ((c == c[i]).sum() - 1)
            b = min(gap[i][c == k].mean() for k in set(c) - {c[i]})
            total += (b - a) / max(a, b)
    got = evaluate.silhouette_all(df, "f", "c").first()
    assert (got.silhouette, got.n) == (pytest.approx(total / len(x)), len(x))
    one = evaluate.silhouette_all(df.where("c = 0"), "f", "c").first()
    assert one.silhouette is None and one.n == 60
    assert evaluate.silhouette_all(df.limit(0), "f", "c").first().n == 0


def test_shared_scans_equal_separate_runs(spark):
    from vacancia.operators import kmeans

    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(m, 1.0, size=(80, 2)) for m in (0, 4, 9)])
    rows = [(i, *map(float, v)) for i, v in enumerate(x)] + [(900, 0.0, 0.0)] * 5
    df = models.segment_features(spark.createDataFrame(rows, "id bigint, a double, b double").repartition(7), ["a", "b"])
    together = kmeans.fit_all(df, ["id"], [2, 3, 5], 4)
    points = np.array([r.features.toArray() for r in df.select("features").collect()])
    assert len(together) == 12
    for r in together:
        alone = [o for o in kmeans.fit_all(df.coalesce(2), ["id"], [r.k], r.start + 1) if o.start == r.start] if r.start == 1 else [r]
        assert alone[0].cost == pytest.approx(r.cost, rel=1e-9)
        # plain iterations from the centres found move nothing
        square = ((points[:, None] - r.centres[None]) ** 2).sum(2)
        near = square.argmin(1)
        assert square.min(1).sum() == pytest.approx(r.cost, rel=1e-9)
        for c in set(near.tolist()):
            assert np.allclose(points[near == c].mean(0), r.centres[c], atol=1e-3)
    best = min((r for r in together if r.k == 3), key=lambda r: r.cost)
    got = {tuple(np.round(r.f, 9)): r.cluster for r in kmeans.nearest(df, best.centres).select("cluster", vector_to_array("features").alias("f")).collect()}
    assert all(got[tuple(np.round(p, 9))] == ((p - best.centres) ** 2).sum(1).argmin() for p in points)


def test_fewer_points_than_clusters_and_no_rows(spark):
    from vacancia.operators import kmeans

    rows = [(i, float(i % 2)) for i in range(6)]
    df = models.segment_features(spark.createDataFrame(rows, "id bigint, a double"), ["a"])
    runs = kmeans.fit_all(df, ["id"], [2, 4], 2)
    assert all(r.cost == pytest.approx(0.0) for r in runs)
    assert kmeans.fit_all(df.where("id < 0"), ["id"], [2], 2) == []


def test_text_vectors_are_sparse_tfidf(spark, jobs):
    f = prepare.fit_features(jobs, prepare.text_spec(**SPEC))
    words = with_tokens(jobs.select("job_id", "title"), "title", "_t", True, (1, 2))
    odd = spark.createDataFrame([(-1, ["data", "data", "unheard"]), (-2, [])], "job_id bigint, _t array<string>")
    for sublinear in (True, False):
        f.spec.sublinear = sublinear
        got = prepare._text_vector(words.select("job_id", "_t").union(odd), f)
        rows = {r.job_id: (r._text, list(r._t)) for r in got.join(words.select("job_id", "_t").union(odd), "job_id").collect()}
        for vector, tokens in rows.values():
            n = np.array([tokens.count(t) for t in f.terms], float)
            want = np.where(n > 0, np.log(np.maximum(n, 1)) + 1 if sublinear else n, 0) * f.idf
            assert len(vector.indices) == (n > 0).sum()  # no entry for a term that is not there
            assert np.allclose(vector.toArray(), want / (np.linalg.norm(want) or 1))


def test_ridge_with_more_features_than_the_normal_equations_take(spark):
    """Over 4,096 features the fit iterates; it meets the closed form (worked out on the rows, of which there are few)."""
    rng = np.random.default_rng(3)
    n, d = 60, 4200
    at = rng.integers(0, d, (n, 5))
    rows = [(Vectors.sparse(d, {int(j): 1.0 for j in a}), float(40000 + 900 * i)) for i, a in enumerate(at)]
    table = spark.createDataFrame(rows, ["features", "pay"]).cache()
    fit = models.fit_ridge(table, "pay", None, alpha=2.0)
    x = np.array([v.toArray() for v, _ in rows])
    y = np.log1p([p for _, p in rows])
    xc = x - x.mean(0)
    beta = xc.T @ np.linalg.solve(xc @ xc.T + 2.0 * np.eye(n), y - y.mean())
    assert fit.model.coefficients.size == d
    assert np.allclose(fit.model.coefficients.toArray(), beta, atol=1e-4)


def test_class_weights_and_class_cuts_leave_rows_where_they_are(spark):
    """No task gets a whole class, also where Spark would not broadcast by itself: the fit keeps the partitions of its rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(0, 3000, 1, 6).selectExpr("id", "cast(id % 3 = 0 as int) as y")
        weighted = prepare.balanced_weights(df, "y")
        train, test = prepare.split(df, ["id"], 0.2, 42, stratify="y")
        for rows in (weighted, train, test):
            assert rows.rdd.getNumPartitions() == 6
            assert max(len(p) for p in rows.rdd.glom().collect()) <= 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {r.y: r.weight for r in weighted.select("y", "weight").distinct().collect()} == {0: 0.75, 1: 1.5}
    assert {r.y: r["count"] for r in test.groupBy("y").count().collect()} == {0: 400, 1: 200}


def test_models_are_fitted_when_asked_for(spark, jobs):
    from vacancia.plans.reports_models import _Fits

    made = []
    how = {n: lambda train, target, f, n=n: made.append((n, train.columns)) or n for n in ("a", "b", "c")}
    fits = _Fits(jobs, dict(categories=["kind"], numbers=["n"]), "pay", how)
    assert made == [] and fits("b") == {"b": "b"} and [n for n, _ in made] == ["b"]
    assert list(fits()) == ["a", "b", "c"] and [n for n, _ in made] == ["b", "a", "c"]
    assert made[0][1] == ["pay", "features"]


def test_kmeans_counts_equal_points_once(spark, monkeypatch):
    """Scans read each distinct point once with its rows; sums, costs and ties are those of all rows."""
    from vacancia.operators import kmeans

    rng = np.random.default_rng(12)
    few = rng.integers(0, 6, (40, 2)).astype(float)
    rows = [(i, *few[i % 40].tolist()) for i in range(2000)]
    df = models.segment_features(spark.createDataFrame(rows, "id bigint, a double, b double").repartition(5), ["a", "b"])
    read, advance = [], kmeans._advance
    monkeypatch.setattr(kmeans, "_advance", lambda r, runs: read.append(r.count()) or advance(r, runs))
    found = kmeans.fit_all(df, ["id"], [2, 4], 3)
    assert set(read) == {len(np.unique(few, axis=0))}
    points = np.array([r.features.toArray() for r in df.select("features").collect()])
    for r in found:
        square = ((points[:, None] - r.centres[None]) ** 2).sum(2)
        assert square.min(1).sum() == pytest.approx(r.cost, rel=1e-9)
    tied, centres = np.array([[0.0, 0.0], [1.0, 0.0], [3.0, 4.0]]), np.array([[2.0, 0.0], [-2.0, 0.0], [0.0, 2.0], [2.0, 0.0]])
    near, square = kmeans._assigned(tied, centres, (centres**2).sum(1)[:, None] - 2 * centres @ tied.T)
    assert near.tolist() == [0, 0, 2] and square.tolist() == [4.0, 1.0, 13.0]


def test_vocabulary_counts_without_sorting_texts(spark, monkeypatch):
    from vacancia.operators.text import vocabulary

    def refused(*_):
        raise AssertionError("the words of a text are not sorted")

    monkeypatch.setattr(F, "array_sort", refused)
    docs = spark.createDataFrame([(["b", "a", "b"],), (["b"],), (["c", "c"],), ([],)], "t array<string>")
    got = {r["term"]: (r["term_no"], r["idf"]) for r in vocabulary(docs, "t", 2).collect()}
    assert got == {"b": (0, pytest.approx(np.log(5 / 3) + 1)), "c": (1, pytest.approx(np.log(5 / 2) + 1))}


def test_models_of_one_preparation_prepare_rows_once(spark, jobs, monkeypatch):
    f = prepare.fit_features(jobs, prepare.text_spec(**SPEC))
    fits = {"a": models.fit_ridge(jobs, "pay", f), "b": models.fit_tree(jobs, "pay", f, depth=3)}
    alone = {n: evaluate.regression_metrics(m.predict(jobs, "p"), "pay", "p").first().asDict() for n, m in fits.items()}
    calls, transform = [], prepare.Features.transform
    monkeypatch.setattr(prepare.Features, "transform", lambda self, df: calls.append(1) or transform(self, df))
    table = models.benchmark(fits, jobs, "pay").collect()
    assert len(calls) == 1 and [r["model"] for r in table] == ["a", "b"]
    for r in table:
        assert {c: r[c] for c in ("mae", "rmse", "r2")} == pytest.approx(alone[r["model"]])
    scored = models.score_salaries(jobs, fits, "b", target="pay")
    assert len(calls) == 2 and "features" not in scored.columns


def test_preparation_reads_kept_training_rows(spark, jobs, monkeypatch):
    from vacancia.plans import reports_models

    seen, fit = [], prepare.fit_features
    monkeypatch.setattr(prepare, "fit_features", lambda rows, spec: seen.append((rows.is_cached, rows.columns)) or fit(rows, spec))
    fits = reports_models._Fits(jobs, SPEC, "pay", {"tree": lambda *t: models.fit_tree(*t, depth=3)})
    assert seen == [(True, ["pay", "title", "kind", "n"])]
    assert list(fits()) == ["tree"]


def test_silhouette_takes_every_row(spark):
    """More rows than the 5,000 that were once sampled, dealt out in several groups; a sample is one on request."""
    rng = np.random.default_rng(13)
    x, c = rng.normal(size=(5300, 2)), rng.integers(0, 3, 5300)
    df = spark.createDataFrame([(i, [float(v) for v in p], int(k)) for i, (p, k) in enumerate(zip(x, c))], "id bigint, f array<double>, c int")
    apart = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)) @ np.eye(3)[c]
    at, n = np.arange(len(x)), np.bincount(c)
    inner, outer = apart[at, c] / (n[c] - 1), apart / n
    outer[at, c] = np.inf
    s = (outer.min(axis=1) - inner) / np.maximum(outer.min(axis=1), inner)
    got = evaluate.silhouette(df.repartition(5), "f", "c", ["id"]).first()
    assert (got.silhouette, got.n) == (pytest.approx(s.mean(), abs=1e-9), 5300)
    assert evaluate.silhouette(df, "f", "c", ["id"], 100).first().n == 100
    assert evaluate.silhouette(df.limit(0), "f", "c", ["id"]).first().n == 0


def test_salary_models_have_the_published_sizes(spark, jobs, monkeypatch):
    from vacancia.plans import reports_models

    asked = {}
    monkeypatch.setattr(reports_models, "_model_table", lambda spark, d: jobs.selectExpr("job_id", "50000.0D as normalized_salary"))
    monkeypatch.setattr(reports_models, "_Fits", lambda train, spec, target, how: how)
    for name in ("fit_ridge", "fit_forest_reg", "fit_gbt"):
        monkeypatch.setattr(models, name, lambda *t, name=name, **kw: asked.update({name: kw}))
    for fit in reports_models.salary_models.__wrapped__(spark, "")[0].values():
        fit(None, None, None)
    assert asked["fit_ridge"] == {"alpha": 10.0} and asked["fit_forest_reg"] == {"trees": 300, "depth": 25, "leaf": 2}
    assert asked["fit_gbt"]["iters"] == 300 and asked["fit_gbt"]["bins"] == 255 and asked["fit_gbt"]["leaf"] == 2


def test_silhouettes_of_all_runs_come_from_one_scan(spark, monkeypatch):
    """They are those of every row, with points that repeat, a point alone in its cluster and a centre without rows."""
    from vacancia.operators import kmeans

    rng = np.random.default_rng(21)
    x = [*rng.normal(0, 1, (60, 2)).tolist(), *[[4.0, 4.0]] * 7, [90.0, 0.0]]
    df = models.segment_features(spark.createDataFrame([(i, *p) for i, p in enumerate(x)], "id bigint, a double, b double").repartition(4), ["a", "b"])
    runs, cheapest = kmeans.fit_measured(df, ["id"], [2, 4], 3, silhouette=True)
    cell = lambda r: kmeans.nearest(df, r.centres).select("cluster", vector_to_array("features").alias("f"))
    for run, got in cheapest.values():
        assert run.cost == pytest.approx(min(r.cost for r in runs if r.k == run.k), rel=1e-11)
        assert got == pytest.approx(evaluate.silhouette_all(cell(run), "f", "cluster").first().silhouette, abs=1e-9)
    far = np.vstack([cheapest[2][0].centres, [500.0, 500.0]])
    points = kmeans.distinct_points(kmeans._flat(df, ["id"]))
    for centres in (far, far[1:] * 0 + [[0.0, 0.0], [500.0, 500.0]]):
        run = kmeans.Run(len(centres), 0, centres)
        run.end(kmeans._advance(points, [run])[0])
        want = evaluate.silhouette_all(cell(run), "f", "cluster").first().silhouette
        assert kmeans.silhouettes(points, [run]) == [None if want is None else pytest.approx(want, abs=1e-9)]
    monkeypatch.setattr(evaluate, "silhouette_all", None)  # six passes over all rows, each k for itself, before
    assert models.fit_kmeans(df, ["id"], [2, 4], 3).table.count() == 2


def test_training_rows_are_dealt_out_by_what_a_forest_keeps_of_them(spark, jobs, monkeypatch):
    """A few packed files are a few parts, however many rows they hold; the order of the rows dealt out is fixed."""
    from vacancia.plans import reports_models

    one, how = jobs.coalesce(1), {"tree": lambda *t: models.fit_tree(*t, depth=3)}
    assert reports_models._Fits(one, SPEC, "pay", how).train.rdd.getNumPartitions() == 1
    monkeypatch.setattr(reports_models, "_PART_BYTES", 200 * jobs.count() // 4)
    fits = reports_models._Fits(one, SPEC, "pay", how)
    sizes = fits.train.rdd.glom().map(len).collect()
    assert sum(sizes) == jobs.count() and len(sizes) > 4 and max(sizes) < jobs.count() // 2
    assert fits.train.collect() == reports_models._Fits(jobs.repartition(1), SPEC, "pay", how).train.collect()


def test_class_models_score_in_a_session_that_has_observed(spark, jobs):
    from pyspark.sql import Observation

    seen = Observation()
    jobs.observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == jobs.count()
    f = prepare.fit_features(jobs, prepare.text_spec(**SPEC))
    for model in (models.fit_logistic(jobs, "hot", f, iters=20), models.fit_forest_clf(jobs, "hot", f, trees=3, depth=3)):
        assert model.predict(jobs, "p", "prob").where("prob between 0 and 1").count() == jobs.count()
        assert len(model.predict(jobs.limit(3), "p", "prob").select("p", "prob").collect()) == 3
