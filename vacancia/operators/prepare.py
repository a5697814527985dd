"""Splits, imputation, scaling, class weights and feature vectors."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    OneHotEncoder,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from vacancia.functions import as_category
from vacancia.operators.ranks import first_by_hash, key_hash, quantiles
from vacancia.operators.text import stop_list, vocabulary, with_tokens


def split(df: DataFrame, keys: Sequence[str], test_share: float, seed: int, stratify: str | None = None):
    """(train, test) by key hash: the same rows on any partitioning, and no shuffle.

    ``stratify`` gives every class exactly its rounded-up share, by an exact cut in the
    hash order of each class; no class is brought to one task for it.
    """
    if stratify is None:
        cells = 10_000
        test = F.pmod(key_hash(keys, seed), F.lit(cells)) < int(round(test_share * cells))
        return df.where(~test), df.where(test)
    want = F.ceil(F.col("_n") * F.lit(test_share))
    marked = first_by_hash(df, keys, want, seed, by=[stratify])
    return marked.where(~F.col("_picked")).drop("_picked"), marked.where("_picked").drop("_picked")


def drop_leakage(cols: Sequence[str], banned: Sequence[str]) -> list[str]:
    return [c for c in cols if c not in set(banned)]


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols]
    return df.select(F.explode(F.array(*pairs)).alias("e")).select("e.*")


def medians(df: DataFrame, cols: Sequence[str], approx: bool = False) -> dict[str, float]:
    """The exact median of each column, all in one job: one number per column."""
    rows = quantiles(_long(df, cols), "value", {"m": 0.5}, ["feature"], approx).collect()
    return {r["feature"]: r["m"] for r in rows}


def impute_median(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Missing numbers become the median of their column."""
    found = medians(df, cols, approx)
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(found.get(c)).cast("double")) for c in cols}
    )


def feature_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation per column, one row each."""
    wide = df.agg(*(f(c).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_pop))))
    lines = [F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"), F.col(f"s_{c}").alias("std")) for c in cols]
    return wide.select(F.explode(F.array(*lines)).alias("e")).select("e.*")


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / population standard deviation; a constant column divides by 1."""
    wide = df.agg(*(f(c).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("m", F.avg), ("s", F.stddev_pop))))
    stats = wide.select(F.struct("*").alias("s")).scalar()
    scaled = df.withColumn("_s", stats)
    out = {}
    for i, c in enumerate(cols):
        std = F.when(F.col(f"_s.s{i}") == 0, 1.0).otherwise(F.col(f"_s.s{i}"))
        out[c] = (F.col(c) - F.col(f"_s.m{i}")) / std
    return scaled.withColumns(out).drop("_s")


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Adds rows / (classes * rows of the class). The class counts are a few rows, not a window over the data.

    They go to the rows: a join by label would put each class into one task, and the fit after it.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("_c"))
    total = counts.agg(F.struct(F.sum("_c").alias("n"), F.count("*").alias("k")).alias("t")).scalar()
    weights = counts.withColumn("_t", total).select(
        F.col(label).alias("_l"), (F.col("_t.n") / (F.col("_t.k") * F.col("_c"))).alias(name)
    )
    return df.join(F.broadcast(weights), F.col(label) == F.col("_l"), "left").drop("_l")


MAX_LEVELS = 100_000


def onehot(cols: Sequence[str], suffix: str = "_vec") -> list:
    """Encoder stages: every level its own slot in alphabetical order, an unseen level all zeros.

    The indexer gives unseen levels the last index and the encoder drops the last slot.
    """
    index = StringIndexer(
        inputCols=list(cols),
        outputCols=[c + "_idx" for c in cols],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    code = OneHotEncoder(
        inputCols=[c + "_idx" for c in cols], outputCols=[c + suffix for c in cols], dropLast=True
    )
    return [index, code]


def check_levels(df: DataFrame, cols: Sequence[str], limit: int = MAX_LEVELS) -> None:
    """An encoder keeps all levels of a column on the driver; refuse columns that are no categories."""
    if not cols:
        return
    found = df.agg(*(F.approx_count_distinct(c).alias(c) for c in cols)).first()
    wide = {c: found[c] for c in cols if found[c] > limit}
    if wide:
        raise ValueError(f"too many levels to encode: {wide}")


def onehot_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per encoded level: (feature, level, n), from the encoded vectors themselves."""
    clean = df.select(*(as_category(c).alias(c) for c in cols))
    check_levels(clean, cols)
    model = Pipeline(stages=onehot(cols)).fit(clean)
    labels = dict(zip(cols, model.stages[0].labelsArray))
    slots = F.array(
        *(
            F.struct(
                F.lit(c).alias("feature"),
                F.array(*map(F.lit, labels[c]))[F.col(c + "_idx").cast("int")].alias("level"),
                vector_to_array(c + "_vec")[F.col(c + "_idx").cast("int")].alias("hit"),
            )
            for c in cols
        )
    )
    hits = model.transform(clean).select(F.explode(slots).alias("e")).select("e.*")
    return hits.groupBy("feature", "level").agg(F.sum("hit").cast("long").alias("n"))


@dataclass
class FeatureSpec:
    """Which columns feed a model and how the title text is cut."""

    categories: list[str]
    numbers: list[str]
    text: str | None = None
    max_features: int = 300
    ngrams: tuple[int, int] = (1, 1)
    sublinear: bool = False
    accents: bool = False
    stop_words: list[str] = field(default_factory=list)


    def columns(self) -> list[str]:
        """The columns that the preparation reads."""
        return list(dict.fromkeys([*([self.text] if self.text else []), *self.categories, *self.numbers]))


@dataclass
class Features:
    """Fitted preparation. Holds at most ``max_features`` terms, the category levels and two numbers per column."""

    spec: FeatureSpec
    terms: list[str]
    idf: list[float]
    median: dict[str, float]
    mean: dict[str, float]
    std: dict[str, float]
    encoder: PipelineModel

    def names(self) -> list[str]:
        """Feature names in vector order."""
        out = [f"text__{t}" for t in self.terms]
        if self.spec.categories:
            for c, labels in zip(self.spec.categories, self.encoder.stages[0].labelsArray):
                out += [f"cat__{c}_{x}" for x in labels]
        return out + [f"num__{c}" for c in self.spec.numbers]

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``features``; row by row, without a shuffle."""
        return _assemble(df, self)

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.encoder.write().overwrite().save(f"{path}/encoder")
        state = {k: getattr(self, k) for k in ("terms", "idf", "median", "mean", "std")}
        text = json.dumps({"spec": asdict(self.spec), **state})
        spark.createDataFrame([(text,)], "state string").coalesce(1).write.mode("overwrite").text(f"{path}/state")

    @staticmethod
    def load(path: str) -> Features:
        spark = SparkSession.active()
        state = json.loads(spark.read.text(f"{path}/state", wholetext=False).first()[0])
        spec = FeatureSpec(**{**state.pop("spec")})
        spec.ngrams = tuple(spec.ngrams)
        return Features(spec=spec, encoder=PipelineModel.load(f"{path}/encoder"), **state)


def _prepared(df: DataFrame, spec: FeatureSpec, median, mean, std) -> DataFrame:
    cols = {f"_c_{c}": as_category(c) for c in spec.categories}
    for c in spec.numbers:
        filled = F.coalesce(F.col(c).cast("double"), F.lit(median.get(c, 0.0)))
        cols[f"_n_{c}"] = (filled - F.lit(mean[c])) / F.lit(std[c] or 1.0)
    df = df.withColumns(cols)
    return with_tokens(df, spec.text, "_t", spec.accents, spec.ngrams, spec.stop_words) if spec.text else df


def _damped(vector: str) -> Column:
    """1 + ln(x) of the entries of a sparse vector, which stays sparse.

    SQL has no constructor of sparse vectors; the JSON reader makes one from the four fields it is stored as. An entry
    of 1 stays 1, so that only rows that repeat a term take this way.
    """
    parts = F.unwrap_udt(vector)
    damped = parts.withField("values", F.transform(parts["values"], lambda x: F.log(x) + 1))
    redone = F.from_json(F.to_json(F.struct(damped.alias("v"))), StructType([StructField("v", VectorUDT())]))["v"]
    return F.when(F.array_max(parts["values"]) > 1, redone).otherwise(F.col(vector))


def _text_vector(df: DataFrame, f: Features) -> DataFrame:
    """Adds ``_text``: sparse and of unit length, with one entry per term that the row has."""
    out = CountVectorizerModel.from_vocabulary(f.terms, inputCol="_t", outputCol="_tf").transform(df)
    if f.spec.sublinear:
        out = out.withColumn("_tf", _damped("_tf"))
    weigh = ElementwiseProduct(scalingVec=Vectors.dense(f.idf), inputCol="_tf", outputCol="_w")
    return Normalizer(inputCol="_w", outputCol="_text").transform(weigh.transform(out)).drop("_t", "_tf", "_w")


def _assemble(df: DataFrame, f: Features) -> DataFrame:
    out = _prepared(df, f.spec, f.median, f.mean, f.std)
    if f.spec.text and f.terms:
        out = _text_vector(out, f)
    out = f.encoder.transform(out)
    return out.drop(*[c for c in out.columns if c not in df.columns and c != "features"])


def fit_features(train: DataFrame, spec: FeatureSpec) -> Features:
    """Learn terms, levels, medians and scales from the training rows."""
    median = medians(train, spec.numbers) if spec.numbers else {}
    filled = train.select(
        *(F.coalesce(F.col(c).cast("double"), F.lit(median.get(c, 0.0))).alias(c) for c in spec.numbers)
    )
    stats = {r["feature"]: r for r in feature_stats(filled, spec.numbers).collect()} if spec.numbers else {}
    mean = {c: stats[c]["mean"] for c in spec.numbers}
    std = {c: stats[c]["std"] for c in spec.numbers}
    terms, idf = [], []
    if spec.text:
        docs = with_tokens(train.select(spec.text), spec.text, "_t", spec.accents, spec.ngrams, spec.stop_words)
        rows = vocabulary(docs, "_t", spec.max_features).orderBy("term_no").collect()  # max_features rows
        terms, idf = [r["term"] for r in rows], [r["idf"] for r in rows]
    ready = _prepared(train, spec, median, mean, std)
    cats = [f"_c_{c}" for c in spec.categories]
    check_levels(ready, cats)
    inputs = (["_text"] if terms else []) + [c + "_vec" for c in cats] + [f"_n_{c}" for c in spec.numbers]
    stages = (onehot(cats) if cats else []) + [VectorAssembler(inputCols=inputs, outputCol="features")]
    fitted = Features(spec, terms, idf, median, mean, std, None)
    ready = _text_vector(ready, fitted) if terms else ready
    fitted.encoder = Pipeline(stages=stages).fit(ready)
    return fitted


def text_spec(stop_words: str | Sequence[str] | None = None, **kw) -> FeatureSpec:
    return FeatureSpec(stop_words=stop_list(stop_words), **kw)
