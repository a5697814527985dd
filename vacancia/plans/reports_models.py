"""Registered queries: feature preparation, models, scoring, evaluation."""

from __future__ import annotations

from functools import cache

from pyspark.sql import functions as F

from vacancia.operators import evaluate, keys, models, prepare
from vacancia.operators import features as ft
from vacancia.plans import shared as q
from vacancia.plans import standins as s
from vacancia.plans.master import build_master
from vacancia.plans.registry import query, rounded, with_
from vacancia.session import scratch_folder
from vacancia.sources.models import load_model, save_model
from vacancia.sources.tables import materialize

# --- preparation --------------------------------------------------------------------------


@query(
    "train_test_split",
    "K1",
    with_(
        q.P,
        select=f"SELECT job_id, views, CASE WHEN {q.key_hash('job_id', 42)} % 10000 < 2000 THEN 'test' ELSE 'train' END AS part FROM p",
    ),
)
def train_test_split(spark, d):
    train, test = prepare.split(s.postings(spark, d).select("job_id", "views"), ["job_id"], 0.2, 42)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "stratified_split",
    "K2",
    with_(
        q.P, q.PRICED,
        "c AS (SELECT job_id, CASE WHEN normalized_salary > 0 THEN 1 ELSE 0 END AS has_salary FROM priced)",
        f"""r AS (SELECT *, row_number() OVER (PARTITION BY has_salary ORDER BY {q.key_hash('job_id', 42)}) AS r,
  count(*) OVER (PARTITION BY has_salary) AS n FROM c)""",
        select="SELECT job_id, has_salary, CASE WHEN r <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS part FROM r",
    ),
)
def stratified_split(spark, d):
    from vacancia.plans.master import etl_salary

    df = ft.disclosure(etl_salary(s.postings(spark, d))).select("job_id", "has_salary")
    train, test = prepare.split(df, ["job_id"], 0.2, 42, stratify="has_salary")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "stratified_split_sizes",
    "K2",
    with_(
        q.P, q.PRICED,
        "c AS (SELECT CASE WHEN normalized_salary > 0 THEN 1 ELSE 0 END AS has_salary, count(*) AS n FROM priced GROUP BY 1)",
        select="""SELECT has_salary, 'test' AS part, CAST(ceil(n * 0.2) AS BIGINT) AS n FROM c
  UNION ALL SELECT has_salary, 'train', n - CAST(ceil(n * 0.2) AS BIGINT) FROM c""",
    ),
)
def stratified_split_sizes(spark, d):
    from vacancia.plans.master import etl_salary

    df = ft.disclosure(etl_salary(s.postings(spark, d))).select("job_id", "has_salary")
    train, test = prepare.split(df, ["job_id"], 0.2, 42, stratify="has_salary")
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("has_salary", "part").agg(F.count("*").alias("n"))


@query(
    "encoded_level_counts",
    "K3 D18",
    with_(
        q.P,
        select="""SELECT 'formatted_work_type' AS feature, formatted_work_type AS level, count(*) AS n FROM p GROUP BY 2
  UNION ALL SELECT 'formatted_experience_level', COALESCE(formatted_experience_level, 'Unknown'), count(*) FROM p GROUP BY 2
  UNION ALL SELECT 'remote_allowed', COALESCE(CAST(remote_allowed AS VARCHAR), 'Unknown'), count(*) FROM p GROUP BY 2""",
    ),
)
def encoded_level_counts(spark, d):
    cols = ["formatted_work_type", "formatted_experience_level", "remote_allowed"]
    return prepare.onehot_counts(s.postings(spark, d), cols)


@query(
    "median_imputed",
    "K4",
    with_(
        q.P,
        select="""SELECT job_id, round(COALESCE(CAST(views AS DOUBLE), (SELECT median(views) FROM p)), 4) AS views,
  round(COALESCE(CAST(applies AS DOUBLE), (SELECT median(applies) FROM p)), 4) AS applies FROM p""",
    ),
)
def median_imputed(spark, d):
    df = s.postings(spark, d).select("job_id", "views", "applies")
    return rounded(prepare.impute_median(df, ["views", "applies"]))


@query(
    "standardized_prices",
    "K5",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem), 4) AS quantity,
  round((l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem))
    / (SELECT stddev_pop(l_extendedprice) FROM lineitem), 4) AS price FROM lineitem""",
)
def standardized_prices(spark, d):
    df = s.raw(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
    )
    return rounded(prepare.standardize(df, ["quantity", "price"]))


@query(
    "feature_statistics",
    "K6",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
)
def feature_statistics(spark, d):
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    return rounded(prepare.feature_stats(s.raw(spark, d, "lineitem"), cols))


@query(
    "class_weights",
    "K10",
    """SELECT doc_id, quality, round((SELECT count(*) FROM labels)
  / (2.0 * count(*) OVER (PARTITION BY quality)), 6) AS weight FROM labels""",
)
def class_weights(spark, d):
    return rounded(prepare.balanced_weights(s.raw(spark, d, "labels").select("doc_id", "quality"), "quality"), 6)


# --- metrics over stored scores -----------------------------------------------------------

_SCORED = """sc AS (SELECT doc_id, quality AS y, (n_chars % 1000) / 1000.0 AS score,
  CASE WHEN (n_chars % 1000) / 1000.0 > 0.5 THEN 1 ELSE 0 END AS pred FROM labels JOIN documents USING (doc_id))"""


def _scored(spark, d):
    docs = s.raw(spark, d, "documents").select("doc_id", "n_chars")
    joined = s.raw(spark, d, "labels").join(docs, "doc_id")
    return joined.selectExpr("doc_id", "quality AS y", "(n_chars % 1000) / 1000.0D AS score").withColumn(
        "pred", F.when(F.col("score") > 0.5, 1).otherwise(0)
    )


_GUESSED = "g AS (SELECT o_orderkey, o_totalprice AS y, o_totalprice * 0.75 + o_custkey % 1000 * 50 AS pred FROM orders)"


def _guessed(spark, d):
    return s.raw(spark, d, "orders").selectExpr(
        "o_orderkey", "o_totalprice AS y", "o_totalprice * 0.75 + o_custkey % 1000 * 50 AS pred"
    )


_REG = """round(avg(abs(y - pred)), 4) AS mae, round(sqrt(avg((y - pred) * (y - pred))), 4) AS rmse,
  round(1 - avg((y - pred) * (y - pred)) / (SELECT var_pop(y) FROM g), 6) AS r2"""


@query("regression_metrics", "M1", f"WITH {_GUESSED} SELECT {_REG} FROM g")
def regression_metrics(spark, d):
    m = evaluate.regression_metrics(_guessed(spark, d), "y", "pred")
    return m.select(F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"))


@query(
    "classification_metrics",
    "M2",
    f"""WITH {_SCORED}, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE y = pred) AS ok,
  CAST(count(*) FILTER (WHERE y = 1 AND pred = 1) AS DOUBLE) AS tp, count(*) FILTER (WHERE pred = 1) AS said,
  count(*) FILTER (WHERE y = 1) AS was FROM sc)
SELECT round(ok / CAST(n AS DOUBLE), 6) AS accuracy, round(tp / said, 6) AS precision, round(tp / was, 6) AS recall,
  round(2 * (tp / said) * (tp / was) / (tp / said + tp / was), 6) AS f1 FROM c""",
)
def classification_metrics(spark, d):
    return rounded(evaluate.classification_metrics(_scored(spark, d), "y", "pred"), 6)


@query(
    "confusion_matrix",
    "M3",
    f"""WITH {_SCORED} SELECT actual, predicted, count(y) AS n
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(actual, predicted) LEFT JOIN sc ON y = actual AND pred = predicted
GROUP BY 1, 2""",
)
def confusion_matrix(spark, d):
    return evaluate.confusion(_scored(spark, d), "y", "pred")


@query(
    "roc_curve",
    "M4",
    f"""WITH {_SCORED}, t AS (SELECT score, sum(y) AS p, sum(1 - y) AS n FROM sc GROUP BY 1)
SELECT CAST(score AS DOUBLE) AS threshold,
  round(sum(n) OVER (ORDER BY score DESC) / CAST((SELECT sum(1 - y) FROM sc) AS DOUBLE), 6) AS fpr,
  round(sum(p) OVER (ORDER BY score DESC) / CAST((SELECT sum(y) FROM sc) AS DOUBLE), 6) AS tpr FROM t
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""",
)
def roc_curve(spark, d):
    curve = evaluate.roc_curve(_scored(spark, d), "y", "score")
    return curve.select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@query(
    "area_under_curve",
    "M5",
    f"""WITH {_SCORED} SELECT round(avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END), 6)
  AS auc FROM sc a JOIN sc b ON a.y = 1 AND b.y = 0""",
)
def area_under_curve(spark, d):
    return rounded(evaluate.auc(_scored(spark, d), "y", "score"), 6)


def _vectors(spark, d):
    return s.raw(spark, d, "embeddings").select("vec_id", F.col("label").alias("cluster"), "embedding")


@query(
    "cluster_silhouette",
    "M6",
    """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pairs AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.v, b.v)) AS dist, count(*) AS n
  FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
ab AS (SELECT vec_id, max(dist / n) FILTER (WHERE other = label) AS inner_d, min(dist / n) FILTER (WHERE other <> label) AS outer_d
  FROM pairs GROUP BY 1)
SELECT round(avg(CASE WHEN inner_d IS NULL THEN 0 ELSE (outer_d - inner_d) / greatest(inner_d, outer_d) END), 6)
  AS silhouette, count(*) AS n FROM ab""",
)
def cluster_silhouette(spark, d):
    return rounded(evaluate.silhouette(_vectors(spark, d), "embedding", "cluster", ["vec_id"]), 6)


_POINT = ["coalesce(views, 0)", "coalesce(applies, 0)", "sponsored * 10"]
_GROUP = "CAST(sponsored + COALESCE(remote_allowed, 0) * 2 + CASE WHEN views > 100 THEN 4 ELSE 0 END AS INTEGER)"


@query(
    "cluster_silhouette_all",
    "M6",
    with_(
        q.P,
        f"e AS (SELECT job_id, {_GROUP} AS c, {_POINT[0]} AS x, {_POINT[1]} AS y, {_POINT[2]} AS z FROM p)",
        # Equal points of a cluster count together; the distances are still those of every pair of points.
        "g AS (SELECT c, x, y, z, count(*) AS n FROM e GROUP BY ALL)",
        """pairs AS (SELECT a.c, a.x, a.y, a.z, a.n, b.c AS other, sum(b.n * ((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2)) AS dist,
    sum(b.n) AS m FROM g a CROSS JOIN g b GROUP BY a.c, a.x, a.y, a.z, a.n, b.c)""",
        """ab AS (SELECT n, max(m) FILTER (WHERE other = c) AS own, max(dist / greatest(m - 1, 1)) FILTER (WHERE other = c) AS i,
    min(dist / m) FILTER (WHERE other <> c) AS o FROM pairs GROUP BY c, x, y, z, n)""",
        select="""SELECT round(sum(n * CASE WHEN own = 1 OR greatest(i, o) = 0 THEN 0 ELSE (o - i) / greatest(i, o) END) / sum(n), 6) AS silhouette,
  CAST(sum(n) AS BIGINT) AS n FROM ab""",
    ),
)
def cluster_silhouette_all(spark, d):
    points = F.array(*(F.expr(x).cast("double") for x in _POINT))
    rows = s.postings(spark, d).select(F.expr(_GROUP).alias("cluster"), points.alias("features"))
    return rounded(evaluate.silhouette_all(rows, "features", "cluster"), 6)


@query(
    "cluster_inertia",
    "M7",
    """WITH x AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM x GROUP BY 1, 2)
SELECT round(sum((x - m) * (x - m)), 4) AS inertia FROM x JOIN c USING (label, i)""",
)
def cluster_inertia(spark, d):
    return rounded(evaluate.inertia(_vectors(spark, d), "embedding", "cluster"))


@query(
    "cluster_sizes",
    "M8 G6",
    """SELECT label AS cluster, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM embeddings), 4) AS pct
FROM embeddings GROUP BY 1""",
)
def cluster_sizes(spark, d):
    return rounded(evaluate.cluster_sizes(_vectors(spark, d)))


_SEGMENT = "CAST(sponsored + COALESCE(remote_allowed, 0) * 2 AS INTEGER)"


@query(
    "cluster_profiles",
    "M9 H9",
    with_(
        q.P, q.PRICED,
        select=f"""SELECT cluster, round(normalized_salary, 4) AS normalized_salary, round(views, 4) AS views,
  CASE WHEN normalized_salary > 100000 THEN 'Premium / Expert' WHEN normalized_salary > 50000
    THEN 'Mid-Market / Professional' ELSE 'Entry / Volume' END AS cluster_name,
  CASE cluster WHEN 0 THEN 'Corporate' WHEN 1 THEN 'Enterprise' ELSE 'Unknown' END AS given_name
  FROM (SELECT {_SEGMENT} AS cluster, avg(normalized_salary) AS normalized_salary, avg(views) AS views FROM priced GROUP BY 1)""",
    ),
)
def cluster_profiles(spark, d):
    from vacancia.plans.master import etl_salary

    df = etl_salary(s.postings(spark, d)).withColumn("cluster", F.expr(_SEGMENT))
    named = ft.name_clusters(evaluate.cluster_profile(df, ["normalized_salary", "views"]))
    given = ft.label_clusters(named.select("cluster"), {0: "Corporate", 1: "Enterprise"})
    out = named.join(given.withColumnRenamed("cluster_name", "given_name"), "cluster")
    return rounded(out)


@query(
    "residual_histogram",
    "M10 F16",
    f"""WITH {_GUESSED}, b AS (SELECT min(y - pred) AS lo, max(y - pred) AS hi FROM g),
c AS (SELECT least(CAST(floor((y - pred - lo) / (hi - lo) * 50) AS INTEGER), 49) AS bin, count(*) AS n FROM g, b GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(lo + i * ((hi - lo) / 50), 7) AS left_edge,
  round(lo + (i + 1) * ((hi - lo) / 50), 7) AS right_edge, COALESCE(n, 0) AS n
FROM b, range(50) r(i) LEFT JOIN c ON c.bin = i""",
)
def residual_histogram(spark, d):
    return rounded(evaluate.residual_hist(_guessed(spark, d), "y", "pred"), 7)


@query(
    "actual_vs_predicted_line",
    "M10 F19",
    f"""WITH {_GUESSED} SELECT round(regr_slope(pred, y), 6) AS slope, round(regr_intercept(pred, y), 4) AS intercept,
  CAST(regr_count(pred, y) AS BIGINT) AS n FROM g""",
)
def actual_vs_predicted_line(spark, d):
    out = evaluate.actual_vs_predicted(_guessed(spark, d), "y", "pred")
    return out.select(F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"), "n")


@query(
    "champion_of_two",
    "L9",
    f"""WITH {_GUESSED}, h AS (SELECT o_orderkey, y, y * 0.9 AS pred FROM g)
SELECT * FROM (SELECT 'shifted' AS model, {_REG} FROM g UNION ALL
  SELECT 'scaled', {_REG} FROM h) ORDER BY r2 DESC, model LIMIT 1""",
)
def champion_of_two(spark, d):
    g = _guessed(spark, d)
    lines = [("shifted", g), ("scaled", g.withColumn("pred", F.col("y") * 0.9))]
    rows = [evaluate.regression_metrics(df, "y", "pred").select(F.lit(n).alias("model"), "*") for n, df in lines]
    best = models.choose_champion(rows[0].unionByName(rows[1]), "r2")
    return best.select("model", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"))


@query(
    "salary_range_and_advice",
    "L14",
    """SELECT o_orderkey, round(o_totalprice * 0.9, 4) AS salary_low, round(o_totalprice * 1.1, 4) AS salary_high,
  CASE WHEN o_custkey % 100 / 100.0 > 0.6 THEN 'strong' ELSE 'improve' END AS hot_advice FROM orders""",
)
def salary_range_and_advice(spark, d):
    df = s.raw(spark, d, "orders").selectExpr(
        "o_orderkey", "o_totalprice AS pred_salary", "o_custkey % 100 / 100.0D AS hot_job_prob"
    )
    out = models.hot_advice(models.salary_range(df))
    return rounded(out.select("o_orderkey", "salary_low", "salary_high", "hot_advice"))


# --- models --------------------------------------------------------------------------------
# Fitting is a run of its own, so the fitted models of a folder are kept for the queries below.

SALARY_SPEC = dict(
    text="title",
    categories=["formatted_work_type", "formatted_experience_level", "primary_industry_name", "is_remote", "is_sponsored"],
    numbers=["benefit_count", "skill_count", "description_length", "employee_count"],
    max_features=300,
    ngrams=(1, 2),
    sublinear=True,
    accents=True,
)
# The published sizes. Histogram boosting grows 31 leaves a tree, of 255 bins; five full levels have 32.
SALARY_FOREST = dict(trees=300, depth=25, leaf=2)
SALARY_BOOSTING = dict(iters=300, depth=5, bins=255, leaf=2)
PLAIN_SALARY_SPEC = dict(
    categories=["work_type_clean", "experience_group_clean", "is_remote", "is_sponsored"],
    numbers=["skill_count", "benefit_count", "description_length"],
)
HOT_SPEC = dict(
    text="title",
    categories=["primary_industry_name", "formatted_work_type", "formatted_experience_level", "is_remote", "is_sponsored"],
    numbers=["skill_count", "benefit_count", "description_length", "employee_count"],
    max_features=500,
    stop_words="english",
)
DISCLOSURE_SPEC = dict(
    categories=["primary_industry_name", "work_type_clean", "experience_group_clean", "is_remote", "is_sponsored"],
    numbers=["skill_count", "benefit_count", "description_length"],
)
LEAKAGE = ["views", "applies", "is_high_views", "is_high_applies", "salary_band", "salary_band_clean"]
SEGMENT_COLS = ["normalized_salary", "skill_count", "benefit_count", "engagement_score", "is_remote", "is_sponsored"]


@cache
def _model_table(spark, d):
    """The master with titles, written once, with the columns that any fit or score reads.

    Columns that none reads are not worked out: the hot-job flag of the master alone takes two scans of the postings.
    """
    master = keys.enrich(build_master(s.tables(spark, d), "etl"), s.titles(spark, d), "job_id", ["title"])
    specs = (SALARY_SPEC, PLAIN_SALARY_SPEC, HOT_SPEC, DISCLOSURE_SPEC)
    read = [c for spec in specs for c in prepare.text_spec(**spec).columns()]
    cols = list(dict.fromkeys(["job_id", "has_salary", "views", *SEGMENT_COLS, *read]))
    return materialize(master.select(*cols), scratch_folder(spark, "master"))


def _spec(kw) -> prepare.FeatureSpec:
    return prepare.text_spec(**{**kw, "categories": prepare.drop_leakage(kw["categories"], LEAKAGE)})


# Bytes that a forest may keep of a partition of training rows: some 200 a row, and four for every feature, zeros too.
_PART_BYTES = 64_000_000


def _dealt(rows, n, features):
    """The rows in parts that a forest can hold one by one. Files are packed, and a part of few of their bytes may have millions of rows.

    Rows stay as they are where they are in so many parts already. Their order is fixed, as a forest draws its bags by it.
    """
    parts = -(-n * (200 + 4 * features) // _PART_BYTES)
    if rows.rdd.getNumPartitions() >= parts:
        return rows
    by = F.xxhash64(*rows.columns)
    return rows.repartition(parts, by).sortWithinPartitions(by)


class _Fits:
    """The models over one training table, each fitted when it is first asked for and then kept.

    The preparation reads the training rows many times, so what it needs of them is cut out of the table once.
    """

    def __init__(self, train, spec, target, how):
        spec = _spec(spec)
        rows = train.select(*dict.fromkeys([target, *spec.columns()])).persist()
        self.features = prepare.fit_features(rows, spec)
        n = rows.count()
        rows.unpersist()
        dealt = _dealt(train.select(rows.columns), n, len(self.features.names()))
        self.train = self.features.transform(dealt).select(target, "features")
        self.target, self.how, self.found = target, how, {}

    def __call__(self, *names):
        """The named models, all without names, in the order of ``how``."""
        wanted = [n for n in self.how if n in names or not names]
        missing = [n for n in wanted if n not in self.found]
        if missing:
            self.train.persist()
            for n in missing:
                self.found[n] = self.how[n](self.train, self.target, self.features)
            self.train.unpersist()
        return {n: self.found[n] for n in wanted}


@cache
def salary_models(spark, d):
    paid = keys.valid_salary(_model_table(spark, d), low=20_000, high=400_000)
    train, test = prepare.split(paid, ["job_id"], 0.2, 42)
    how = {
        "ridge": lambda *t: models.fit_ridge(*t, alpha=10.0),
        "rf": lambda *t: models.fit_forest_reg(*t, **SALARY_FOREST),
        "gbt": lambda *t: models.fit_gbt(*t, **SALARY_BOOSTING),
    }
    return _Fits(train, SALARY_SPEC, "normalized_salary", how), paid, test


@cache
def plain_salary_models(spark, d):
    paid = keys.valid_salary(_model_table(spark, d), low=20_000, high=400_000)
    train, test = prepare.split(paid, ["job_id"], 0.2, 42)
    how = {
        "DecisionTree": lambda *t: models.fit_tree(*t, depth=10),
        "RandomForest": lambda *t: models.fit_forest_reg(*t, trees=20, depth=10, leaf=1),
        "GradientBoosting": lambda *t: models.fit_gbt(*t, iters=20, step=0.1, depth=5),
    }
    return _Fits(train, PLAIN_SALARY_SPEC, "normalized_salary", how), test


@cache
def hot_models(spark, d):
    seen = _model_table(spark, d).na.drop(subset=["views"])
    seen = ft.threshold_flag(seen, "views", 8, "is_hot_job")
    train, test = prepare.split(seen, ["job_id"], 0.2, 42, stratify="is_hot_job")
    how = {
        "LogisticRegression": lambda *t: models.fit_logistic(*t, iters=1000),
        "RandomForest": lambda *t: models.fit_forest_clf(*t, trees=20, depth=10),
    }
    return _Fits(train, HOT_SPEC, "is_hot_job", how), seen, test


@cache
def disclosure_model(spark, d):
    df = _model_table(spark, d)
    train, test = prepare.split(df, ["job_id"], 0.2, 42, stratify="has_salary")
    return _Fits(train, DISCLOSURE_SPEC, "has_salary", {"LogisticRegression": lambda *t: models.fit_logistic(*t, iters=1000)}), test


@cache
def segments(spark, d):
    scaled = models.segment_features(_model_table(spark, d).select("job_id", "has_salary", *SEGMENT_COLS), SEGMENT_COLS)
    return models.fit_kmeans(scaled, ["job_id"]), scaled


@query("salary_model_metrics", "L1 L2 L3 L9 M1 K1 K7 K9 C8")
def salary_model_metrics(spark, d):
    fits, _, test = salary_models(spark, d)
    return rounded(models.benchmark(fits(), test, "normalized_salary"))


@query("salary_predictions", "L12 D17 I7")
def salary_predictions(spark, d):
    fits, paid, test = salary_models(spark, d)
    fits = fits()
    best = models.choose_champion(models.benchmark(fits, test, "normalized_salary"), "r2").first()["model"]
    scored = models.score_salaries(paid, fits, best)
    return rounded(
        scored.select(
            "job_id", "normalized_salary", *(f"pred_salary_{n}" for n in fits), "pred_salary_best", "residual_best",
            "title", "formatted_experience_level", "primary_industry_name", "is_remote",
        ),
        2,
    )


@query("salary_feature_importance", "L10")
def salary_feature_importance(spark, d):
    return rounded(models.feature_importance(salary_models(spark, d)[0]("rf")["rf"], 20), 6)


@query("plain_salary_model_metrics", "L2 L4 L5 L9")
def plain_salary_model_metrics(spark, d):
    fits, test = plain_salary_models(spark, d)
    return rounded(models.benchmark(fits(), test, "normalized_salary"))


@query("plain_salary_champion", "L9")
def plain_salary_champion(spark, d):
    return models.choose_champion(plain_salary_model_metrics(spark, d), "r2")


@query("hot_job_model_metrics", "L6 L7 L9 M2 M5 K2 K8 K10")
def hot_job_model_metrics(spark, d):
    fits, _, test = hot_models(spark, d)
    return rounded(models.benchmark(fits(), test, "is_hot_job"))


@query("hot_job_predictions", "L12")
def hot_job_predictions(spark, d):
    fits, seen, _ = hot_models(spark, d)
    scored = models.score_hot(seen, fits("RandomForest")["RandomForest"])
    cols = ["job_id", "title", "views", "is_hot_job", "hot_job_prob", "hot_job_pred", "primary_industry_name"]
    return rounded(scored.select(*cols, "formatted_experience_level"))


@query("hot_job_feature_importance", "L10")
def hot_job_feature_importance(spark, d):
    return rounded(models.feature_importance(hot_models(spark, d)[0]("RandomForest")["RandomForest"], 20), 6)


@query("disclosure_model_metrics", "L6 M2 M5")
def disclosure_model_metrics(spark, d):
    fits, test = disclosure_model(spark, d)
    return rounded(models.benchmark(fits(), test, "has_salary"))


@query("disclosure_drivers", "L11 E10")
def disclosure_drivers(spark, d):
    return rounded(models.drivers(disclosure_model(spark, d)[0]()["LogisticRegression"], 10), 6)


@query("segment_search", "L8 M6 M7")
def segment_search(spark, d):
    return rounded(segments(spark, d)[0].table)


@query("segment_profiles", "L8 M8 M9 H9")
def segment_profiles(spark, d):
    found, scaled = segments(spark, d)
    assigned = found.assign(scaled).select("cluster", "has_salary", *SEGMENT_COLS)
    profile = ft.name_clusters(evaluate.cluster_profile(assigned, [*SEGMENT_COLS, "has_salary"]))
    return rounded(profile.join(evaluate.cluster_sizes(assigned), "cluster"))


WHAT_IF_DEFAULTS = {
    "formatted_work_type": "full-time", "formatted_experience_level": "Unknown", "primary_industry_name": "Unknown",
    "is_remote": 0, "is_sponsored": 0, "benefit_count": 3, "skill_count": 5, "description_length": 1500,
    "employee_count": 1000,
}


@query("what_if_postings", "L13 L14")
def what_if_postings(spark, d):
    """Every part name as a hypothetical posting, the other fields at their defaults, through stored models."""
    salary = salary_models(spark, d)[0]("ridge")["ridge"]
    hot = hot_models(spark, d)[0]("RandomForest")["RandomForest"]
    rows = s.raw(spark, d, "part").selectExpr("p_partkey", "p_name AS title", "CAST(p_size % 2 AS INT) AS is_remote")
    # Few bytes and much work a row: as many tasks as there are cores, whatever the files.
    rows = rows.repartition(2 * spark.sparkContext.defaultParallelism, "p_partkey")
    out = models.score_what_if(rows, WHAT_IF_DEFAULTS, salary, hot)
    return rounded(out.select("p_partkey", "title", "pred_salary", "salary_low", "salary_high", "hot_job_prob", "hot_advice"))


@query("reloaded_model_scores", "A7 L12")
def reloaded_model_scores(spark, d):
    """Save the model, load it, score the table with both; the difference is none."""
    fits, paid, _ = salary_models(spark, d)
    ridge = fits("ridge")["ridge"]
    path = scratch_folder(spark, "model")
    save_model(ridge, path)
    both = load_model(path).predict(ridge.predict(paid, "kept"), "loaded")
    gap = F.max(F.abs(F.col("kept") - F.col("loaded")))
    return both.agg(F.count("*").alias("n"), F.round(gap, 6).alias("largest_difference"))
