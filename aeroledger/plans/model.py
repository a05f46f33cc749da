"""Training, scoring and storing of delay models with Spark ML."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import Imputer, RobustScaler, SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import lsh
from ..operators.neighbours import distinct_vectors, nearest, vector_id, weighted_vote
from ..session import ensure_checkpoint_dir, read_in_tasks, reliable_checkpoint, stored
from . import evaluation, features
from .kernels import FourierFeatures

SEED = 42
# Columns of one category, the one for all rarer levels included.
MAX_CATEGORIES = 20
INFREQUENT = "(infrequent)"
# How neighbours are found: through hashed cells (all rows), or exactly (at most ``MAX_EXACT_ROWS`` labelled rows).
SEARCHES = ("hashed", "exact")
MAX_EXACT_ROWS = 100_000
# Rows of a task that a learner passes over again and again; smaller tasks only add their start.
FIT_ROWS = 25_000
# Most rows of such a task: some 400 bytes each, held in memory by every task that runs.
TASK_ROWS = 250_000
# Ranges of values within which the values of a column are ordered.
VALUE_RANGES = 64


# ---- splitting ---------------------------------------------------------------

def hash_share(key: list[str], seed: int = SEED) -> Column:
    """A number in [0, 1) that depends only on the key."""
    return F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1_000_000)) / 1_000_000.0


def split(
    df: DataFrame, key: list[str], test_share: float = 0.25, seed: int = SEED, label: str = "delay"
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows: of each label the share with the smallest key hashes is test.

    Both classes get the same share to the row, and no row moves between runs or partitions. Rows are counted
    per label and hash bucket; whole buckets stay where they are and only the bucket at the cut is ordered.
    """
    hashed = df.withColumn("_h", features.key_hash(key, seed)).withColumns({
        "_bucket": F.shiftrightunsigned(F.col("_h"), features.HASH_BITS - features.BUCKET_BITS),
        "_label": F.coalesce(F.col(label).cast("long"), F.lit(-1)),
    })
    counts = hashed.groupBy("_label", "_bucket").agg(F.count(F.lit(1)).alias("_in_bucket"))
    # At most 2**16 rows per label, by construction.
    of_label = W.partitionBy("_label")
    ahead = of_label.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    wanted = F.floor(F.sum("_in_bucket").over(of_label) * F.lit(test_share))
    before = F.coalesce(F.sum("_in_bucket").over(ahead), F.lit(0))
    # Per label the last bucket that begins within the test rows, and how many of its rows are test.
    cuts = reliable_checkpoint(
        counts.withColumns({"_wanted": wanted, "_before": before}).filter(F.col("_before") <= F.col("_wanted")).groupBy("_label").agg(
            F.max("_bucket").alias("_cut"), F.max_by(F.col("_wanted") - F.col("_before"), "_bucket").alias("_inside")
        )
    )
    placed = hashed.join(F.broadcast(cuts), "_label")
    inside = F.row_number().over(W.partitionBy("_label").orderBy("_h", *key))
    # Written, so that rows of one key lie on one side only.
    edge = reliable_checkpoint(placed.filter("_bucket = _cut").withColumn("_place", inside).select(*df.columns, "_place", "_inside"))
    train = placed.filter("_bucket > _cut").select(*df.columns).unionByName(edge.filter("_place > _inside").select(*df.columns))
    test = placed.filter("_bucket < _cut").select(*df.columns).unionByName(edge.filter("_place <= _inside").select(*df.columns))
    return train, test


def split_stored(
    df: DataFrame, key: list[str], test_share: float = 0.25, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Both parts of ``split``, written once with what a model reads: a fit and its curves pass over them many times."""
    train, test = split(df, key, test_share, seed)
    return stored(train.select(*features.MODEL_COLUMNS), "train"), stored(test.select(*features.MODEL_COLUMNS), "test")


def with_folds(df: DataFrame, key: list[str], folds: int, seed: int = SEED + 1, label: str = "delay") -> DataFrame:
    """Rows with ``fold``; every fold holds the same share of each label."""
    placed = features.ranked(df, key, seed, label)
    return placed.withColumn("fold", F.floor((F.col("_rank") - 1) * folds / F.col("_n"))).drop("_rank", "_n")


def with_class_weights(df: DataFrame, label: str = "delay") -> DataFrame:
    """Weight n / (classes * n_class): both classes count the same in total."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = W.partitionBy()
    # One row per class.
    weights = counts.select(
        label, (F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n"))).alias("weight")
    )
    return df.join(F.broadcast(weights), label)


def imbalance_ratio(df: DataFrame, label: str = "delay") -> DataFrame:
    return df.agg(F.try_divide(
        F.count(F.when(F.col(label) == 0, 1)), F.count(F.when(F.col(label) == 1, 1))
    ).alias("ratio"))


# ---- preprocessing -----------------------------------------------------------

def category_levels(train: DataFrame, columns: list[str], limit: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted values of each categorical column.

    With more than ``limit`` values the most frequent ``limit - 1`` stay and ``INFREQUENT``
    comes last, for all others.
    """
    pairs = train.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).alias("level")) for c in columns
    ])).alias("p")).select("p.*").filter("level is not null")
    counts = pairs.groupBy("name", "level").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(W.partitionBy("name").orderBy(F.desc("n"), "level"))
    # At most ``limit + 1`` rows per column.
    rows = counts.withColumn("place", place).filter(F.col("place") <= limit + 1).collect()
    levels = {}
    for c in columns:
        own = sorted((r["place"], r["level"]) for r in rows if r["name"] == c)
        many = len(own) > limit
        levels[c] = sorted(level for _, level in (own[: limit - 1] if many else own)) + [INFREQUENT] * many
    return levels


def preprocessor(levels: dict[str, list[str]], error: float = 0.001) -> list:
    """Stages that turn a feature frame into one vector column; medians and quartiles are exact to ``error`` in rank.

    Numbers: median for missing, then robust scaling. Categories: one indicator
    per level but the first; a value outside the levels sets the infrequent column if
    there is one, else none. Ordered: place in the fixed order, -1 if unknown.
    """
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def holds(column: str, level: str, values: list[str]) -> str:
        if level == INFREQUENT:
            return f"{column} NOT IN ({', '.join(map(quoted, values[:-1]))})"
        return f"{column} = {quoted(level)}"

    indicators = {
        f"{c}={level}": f"CAST(coalesce({holds(c, level, values)}, false) AS DOUBLE)"
        for c, values in levels.items() for level in values[1:]
    }
    orders = [features.VISIBILITY_ORDER] * 2 + [features.SKY_COVER_ORDER] * 2
    ordered = {
        f"ord_{c}": f"CAST(coalesce(nullif(array_position(array({', '.join(map(quoted, order))}), {c}), 0), 0) - 1 AS DOUBLE)"
        for c, order in zip(features.ORDERED, orders)
    }
    numbers = {f"num_{c}": f"CAST({c} AS DOUBLE)" for c in features.NUMERIC}
    made = {**numbers, **indicators, **ordered}
    statement = "SELECT *, " + ", ".join(f"{sql} AS `{name}`" for name, sql in made.items()) + " FROM __THIS__"
    filled = [f"fill_{c}" for c in features.NUMERIC]
    return [
        SQLTransformer(statement=statement),
        Imputer(strategy="median", inputCols=list(numbers), outputCols=filled, relativeError=error),
        VectorAssembler(inputCols=filled, outputCol="numbers"),
        RobustScaler(inputCol="numbers", outputCol="scaled", withCentering=True, withScaling=True, relativeError=error),
        VectorAssembler(inputCols=["scaled", *indicators, *ordered], outputCol="features"),
    ]


def exact_quantiles(counts: DataFrame, shares: tuple[float, ...]) -> DataFrame:
    """``name, q``: per name the values of rank ``ceil(share * rows)``, from ``name, value, n`` of distinct values.

    Values are ordered within ranges and the ranges' rows are cumulated, so no task orders all values of a name.
    """
    cuts = [i / VALUE_RANGES for i in range(1, VALUE_RANGES)]
    bounds = counts.groupBy("name").agg(F.percentile_approx("value", cuts, 1000).alias("bounds"))
    ranged = reliable_checkpoint(counts.join(F.broadcast(bounds), "name").select(
        "name", "value", "n", F.size(F.filter("bounds", lambda b: b < F.col("value"))).alias("range")
    ))
    # At most VALUE_RANGES rows per name.
    of_name = W.partitionBy("name")
    ahead = of_name.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranged.groupBy("name", "range").agg(F.sum("n").alias("rows")).select(
        "name", "range", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("ahead"), F.sum("rows").over(of_name).alias("rows")
    )
    inside = W.partitionBy("name", "range").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    ranked = ranged.join(F.broadcast(offsets), ["name", "range"]).withColumn("upto", F.col("ahead") + F.sum("n").over(inside))
    return ranked.groupBy("name").agg(F.array(*[
        F.min(F.when(F.col("upto") >= F.ceil(F.col("rows") * F.lit(share)), F.col("value"))) for share in shares
    ]).alias("q"))


def fit_preprocessor(train: DataFrame, levels: dict[str, list[str]], error: float = 0.001) -> PipelineModel:
    """The fitted stages of ``preprocessor``.

    Without an error a sketch would hold every value. Then values are counted, and the stages are fitted on five rows
    that have the median and quartiles of all rows.
    """
    stages = preprocessor(levels, error)
    if error:
        return Pipeline(stages=stages).fit(train)
    numbers = [F.col(c).cast("double") for c in features.NUMERIC]
    pairs = train.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("name"), F.when(~F.isnan(number), number).alias("value")) for c, number in zip(features.NUMERIC, numbers)
    ])))
    counts = reliable_checkpoint(pairs.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n")))
    medians = exact_quantiles(counts.filter("value is not null"), (0.5,)).select("name", F.col("q")[0].alias("median"))
    # Missing values stand at the median when the quartiles are taken.
    filled = counts.join(F.broadcast(medians), "name", "left").groupBy("name", F.coalesce("value", "median").alias("value")).agg(F.sum("n").alias("n"))
    quartiles = exact_quantiles(reliable_checkpoint(filled.filter("value is not null")), (0.25, 0.5, 0.75))
    # One row per column.
    found = {r["name"]: r["q"] for r in quartiles.collect()}
    rows = [{c: found[c][at] if c in found else None for c in features.NUMERIC} for at in (0, 0, 1, 2, 2)]
    texts = [*levels, *features.ORDERED]
    schema = ", ".join([*(f"{c} double" for c in features.NUMERIC), *(f"{c} string" for c in texts)])
    few = train.sparkSession.createDataFrame([{**row, **dict.fromkeys(texts)} for row in rows], schema)
    return Pipeline(stages=stages).fit(few)


def feature_names(levels: dict[str, list[str]]) -> list[str]:
    """Readable names in vector order."""
    return [
        *features.NUMERIC,
        *[f"{c}={level}" for c, values in levels.items() for level in values[1:]],
        *features.ORDERED,
    ]


# ---- learners ----------------------------------------------------------------

@dataclass(frozen=True)
class Learner:
    """A named classifier preset."""

    name: str
    params: dict = field(default_factory=dict)

    def with_params(self, **params) -> "Learner":
        return replace(self, params={**self.params, **params})


# Presets by model name, in Spark parameters.
PRESETS = {
    "decision_tree": {"maxDepth": 10, "minInstancesPerNode": 10},
    "random_forest": {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 10},
    "logistic_regression": {"maxIter": 1000, "regParam": 0.0},
    "svm": {"regParam": 0.01, "maxIter": 100, "kernel": "rbf", "components": 200},
    "knn": {"k": 5, "search": "hashed"},
    "xgboost": {"maxIter": 2000, "maxDepth": 4, "stepSize": 0.05, "subsamplingRate": 0.7,
                "featureSubsetStrategy": "0.7", "minInstancesPerNode": 10, "minInfoGain": 0.0, "validation_share": 0.1,
                "validationTol": 0.001},
    "xgboost_tuned": {"maxIter": 300, "maxDepth": 4, "stepSize": 0.05, "subsamplingRate": 0.8,
                      "featureSubsetStrategy": "0.8"},
    "lightgbm": {"maxIter": 100, "maxDepth": 4, "stepSize": 0.1},
}


def learner(name: str = "xgboost_tuned", **params) -> Learner:
    if name not in PRESETS:
        raise ValueError(f"unknown model {name!r}; known: {sorted(PRESETS)}")
    return Learner(name, {**PRESETS[name], **params})


def _estimator(spec: Learner, weighted: bool):
    common = {"featuresCol": "features", "labelCol": "delay"}
    if weighted:
        common["weightCol"] = "weight"
    if spec.name == "decision_tree":
        return DecisionTreeClassifier(seed=SEED, **common, **spec.params)
    if spec.name == "random_forest":
        return RandomForestClassifier(seed=SEED, **common, **spec.params)
    if spec.name == "logistic_regression":
        return LogisticRegression(**common, **spec.params)
    params = {n: v for n, v in spec.params.items() if n != "validation_share"}
    if spec.params.get("validation_share"):
        # Rounds end once the held rows gain no more.
        common["validationIndicatorCol"] = "held"
    # Long boosting runs grow a long lineage; it is cut in the shared folder. A row finds its node of a shallow tree
    # faster than a stored node is read, written and checkpointed for every level of every round.
    return GBTClassifier(seed=SEED, cacheNodeIds=False, checkpointInterval=10, **common, **params)


@dataclass
class Fitted:
    """Preprocessing and classifier that together score a feature frame."""

    spec: Learner
    prepare: PipelineModel
    classify: PipelineModel | None
    levels: dict[str, list[str]]
    base: DataFrame | None = None

    def score(self, frame: DataFrame) -> DataFrame:
        """``frame`` with ``score``, the probability of a delay."""
        return self.score_vectors(self.prepare.transform(frame))

    def score_vectors(self, ready: DataFrame) -> DataFrame:
        if self.classify is None:
            return _knn_scores(ready, self.base, self.spec.params["k"], self.spec.params.get("search", "exact"))
        out = self.classify.transform(ready)
        return out.withColumn("score", vector_to_array("probability")[1]).drop(
            "rawPrediction", "probability", "prediction", "side", "margin", "margins", "waves"
        )


def neighbour_search(search: str):
    """``(queries, base, k) -> neighbours``."""
    if search not in SEARCHES:
        raise ValueError(f"unknown search {search!r}; known: {SEARCHES}")
    return lsh.approximate if search == "hashed" else nearest


def _knn_scores(ready: DataFrame, base: DataFrame, k: int, search: str) -> DataFrame:
    """Vote of the nearest training rows; equal vectors are asked once."""
    near = neighbour_search(search)
    asked = ready.withColumn("vector", vector_to_array("features")).withColumn("qid", vector_id("vector"))
    votes = weighted_vote(near(asked.select("qid", "vector").dropDuplicates(["qid"]), base, k), k)
    return asked.join(votes, "qid", "left").drop("qid", "vector")


def fourier_stage(ready: DataFrame, spec: Learner) -> FourierFeatures:
    """The map of an RBF kernel; without ``gamma`` it is one over the number of features times their variance."""
    gamma = spec.params.get("gamma")
    if gamma is None:
        values = ready.select(vector_to_array("features").alias("v")).select(F.size("v").alias("n"), F.explode("v").alias("x"))
        found = values.agg(F.max("n").alias("n"), F.var_pop("x").alias("variance")).first()
        gamma = 1.0 / (found["n"] * found["variance"]) if found["variance"] else 1.0
    return FourierFeatures(gamma=float(gamma), components=spec.params.get("components", 200), seed=SEED)


def _fit_classifier(spec: Learner, ready: DataFrame, weighted: bool) -> PipelineModel | None:
    if spec.name == "knn":
        return None
    if spec.name == "svm":
        # The kernel is a linear margin over random Fourier features. A logistic fit turns the margin into a probability.
        params = {n: v for n, v in spec.params.items() if n not in ("kernel", "components", "gamma")}
        mapped = spec.params.get("kernel", "linear") == "rbf"
        stages = [fourier_stage(ready, spec)] if mapped else []
        stages += [
            LinearSVC(
                featuresCol="waves" if mapped else "features", labelCol="delay", rawPredictionCol="margin", predictionCol="side",
                **({"weightCol": "weight"} if weighted else {}), **params,
            ),
            SQLTransformer(statement="SELECT *, margin AS margins FROM __THIS__"),
            LogisticRegression(featuresCol="margins", labelCol="delay", maxIter=100),
        ]
        return Pipeline(stages=stages).fit(ready)
    return Pipeline(stages=[_estimator(spec, weighted)]).fit(ready)


def fit(train: DataFrame, spec: Learner, balance: str = "weights") -> Fitted:
    """Fit preprocessing and classifier on a feature frame with ``delay``.

    ``balance``: ``weights`` (default), ``resample`` (synthetic minority rows, then
    edited neighbours) or ``none``.
    """
    levels = category_levels(train, features.CATEGORICAL)
    prepare = fit_preprocessor(train, levels)
    ready = prepare.transform(train).select("features", "delay")
    return fit_vectors(ready, spec, balance, prepare, levels)


def fit_vectors(
    ready: DataFrame, spec: Learner, balance: str, prepare: PipelineModel, levels: dict[str, list[str]]
) -> Fitted:
    search = spec.params.get("search", "hashed")
    if search == "exact" and (spec.name == "knn" or balance == "resample"):
        ready = fit_rows(ready)
    if balance == "resample":
        ready = resample(ready, search=search)
    base = None
    if spec.name == "knn":
        base = reliable_checkpoint(distinct_vectors(
            ready.select(vector_to_array("features").alias("vector"), F.col("delay").alias("label"))
        ))
    weighted = balance == "weights"
    if weighted and spec.name != "knn":
        ready = with_class_weights(ready)
    if spec.params.get("validation_share"):
        text = F.concat_ws(",", vector_to_array("features").cast("array<string>"))
        ready = ready.withColumn("_text", text)
        ready = ready.withColumn("held", hash_share(["_text", "delay"], SEED + 5) < spec.params["validation_share"]).drop("_text")
    # Learners pass over the rows many times and keep them in their own form (bins or blocks), so no second copy is cached here.
    ready = in_few_tasks(ready)
    ensure_checkpoint_dir(ready.sparkSession)
    # Bytes of compressed columns do not tell how many rows a task would hold, the number of files does.
    with read_in_tasks(ready.sparkSession, len(ready.inputFiles())):
        classify = _fit_classifier(spec, ready, weighted)
    return Fitted(spec, prepare, classify, levels, base)


def in_few_tasks(ready: DataFrame, rows: int = FIT_ROWS, most: int = TASK_ROWS) -> DataFrame:
    """``ready`` in no more partitions than its number of rows asks for; written once, as it is counted and then read.

    No file has more than ``most`` rows.
    """
    kept = stored(ready, "ready", most)
    return kept.coalesce(max(1, -(-kept.count() // rows)))


def fit_rows(ready: DataFrame, most: int = MAX_EXACT_ROWS) -> DataFrame:
    """At most ``most`` labelled rows, chosen by hash, for the search that compares rows pair by pair.

    Only what is fitted on is bounded; every row is scored.
    """
    text = F.concat_ws(",", vector_to_array("features").cast("array<string>"))
    named = ready.withColumn("_text", text)
    return features.sample_rows(named, most, ["_text", "delay"], SEED).drop("_text")


# ---- rebalancing -------------------------------------------------------------

def resample(ready: DataFrame, k: int = 3, seed: int = SEED, search: str = "hashed") -> DataFrame:
    """Synthetic minority rows, then removal of rows their neighbours contradict.

    Each synthetic row lies between a minority row and one of its ``k`` nearest
    minority rows. Then a row stays only if its three nearest other rows all
    have its label. If a class has too few rows the input is returned.
    """
    rows = reliable_checkpoint(
        ready.select(vector_to_array("features").alias("vector"), F.col("delay").cast("int").alias("label"))
    )
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2 or min(counts.values()) <= k:
        return ready
    minor = min(counts, key=lambda c: counts[c])
    wanted = max(counts.values()) - counts[minor]
    near = neighbour_search(search)
    grown = rows.unionByName(_synthetic(rows.filter(F.col("label") == minor), counts[minor], wanted, minor, k, seed, near))
    kept = _edited(reliable_checkpoint(grown), 3, near)
    return kept.select(array_to_vector("vector").alias("features"), F.col("label").alias("delay"))


def _synthetic(minority: DataFrame, n: int, wanted: int, label: int, k: int, seed: int, find) -> DataFrame:
    base = reliable_checkpoint(distinct_vectors(minority))
    queries = base.select(vector_id("vector").alias("qid"), "vector")
    partners = (
        find(queries, base, k + 1).filter("distance > 0").groupBy("qid")
        # At most k + 1 neighbours per vector.
        .agg(F.sort_array(F.collect_list(F.struct("distance", "vector"))).alias("near"))
        .select("qid", F.slice(F.col("near.vector"), 1, k).alias("near"))
    )
    # Each distinct vector makes its share of the wanted rows, remainders by hash.
    share = F.col("copies") * F.lit(wanted / n)
    extra = (hash_share(["vector"], seed) < share - F.floor(share)).cast("long")
    made = (
        base.withColumn("times", F.floor(share) + extra).filter("times > 0")
        .withColumn("qid", vector_id("vector"))
        .join(partners, "qid", "left")
        .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("times"))))
    )
    pick = F.pmod(F.xxhash64(F.lit(seed), "vector", "i"), F.greatest(F.size("near"), F.lit(1))) + 1
    gap = F.pmod(F.xxhash64(F.lit(seed + 1), "vector", "i"), F.lit(1_000_000)) / 1_000_000.0
    other = F.when(F.size("near") > 0, F.try_element_at("near", pick.cast("int")))
    between = F.zip_with("vector", F.coalesce(other, "vector"), lambda a, b: a + (b - a) * F.col("gap"))
    return made.withColumn("gap", gap).select(between.alias("vector"), F.lit(label).alias("label"))


def _edited(rows: DataFrame, k: int, find) -> DataFrame:
    """Rows whose ``k`` nearest other rows all share their label."""
    base = reliable_checkpoint(distinct_vectors(rows))
    queries = base.select(vector_id("vector").alias("qid"), "vector")
    near = find(queries, base, k + 1)
    by_place = W.partitionBy("qid").orderBy("place")
    before = F.coalesce(F.sum("copies").over(by_place.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    # A row is its own nearest neighbour once; it does not judge itself.
    judged = near.withColumn("used", F.least(F.col("copies"), F.lit(k + 1) - before)).groupBy("qid").agg(
        F.sum(F.when(F.col("positives") > 0, F.col("used")).otherwise(0)).alias("with_pos"),
        F.sum(F.when(F.col("positives") < F.col("copies"), F.col("used")).otherwise(0)).alias("with_neg"),
    )
    verdict = judged.select(
        "qid",
        (F.col("with_neg") == 0).alias("all_positive"), (F.col("with_pos") == 0).alias("all_negative"),
    )
    agrees = F.when(F.col("label") == 1, F.col("all_positive")).otherwise(F.col("all_negative"))
    return rows.withColumn("qid", vector_id("vector")).join(verdict, "qid").filter(agrees).select("vector", "label")


# ---- training ----------------------------------------------------------------

@dataclass
class Trained:
    fitted: Fitted
    threshold: float
    risk_low: float
    risk_high: float
    delay_threshold: int
    test_metrics: DataFrame
    overfit: DataFrame
    test_scores: DataFrame


def scored(fitted: Fitted, frame: DataFrame) -> DataFrame:
    return fitted.score(frame).select(F.col("delay").alias("label"), "score")


def train(
    frame: DataFrame, key: list[str], model: str = "xgboost_tuned", balance: str = "weights",
    delay_threshold: int = 15, cv_folds: int = 0, **params,
) -> Trained:
    """Split, fit, choose threshold and risk bands on the test part, compare both parts.

    With ``cv_folds`` the comparison also states mean and spread of each metric over the folds of the training part.
    """
    parts = split(frame, key) if cv_folds else split_stored(frame, key)
    train_part, test_part = parts
    fitted = fit(train_part, learner(model, **params), balance)
    # Scores are used many times below; the files also survive a lost executor.
    test_scores = reliable_checkpoint(scored(fitted, test_part))
    train_scores = reliable_checkpoint(scored(fitted, train_part))
    bands = evaluation.risk_bands(evaluation.curve(test_scores)).first()
    threshold = bands["risk_threshold_high"]
    test_metrics = evaluation.metrics(test_scores, threshold)
    overfit = evaluation.overfit_gaps(evaluation.metrics(train_scores, threshold), test_metrics)
    if cv_folds:
        spread = stability(cross_validation(train_part, key, learner(model, **params), cv_folds, balance))
        # One row per metric.
        values = {f"cv_{r['metric']}_{n}": r[n] for r in spread.collect() for n in ("mean", "std")}
        overfit = overfit.withColumns({name: F.lit(value) for name, value in values.items()})
    return Trained(
        fitted, threshold, bands["risk_threshold_low"], threshold, delay_threshold, test_metrics, overfit, test_scores
    )


def cross_validation(
    frame: DataFrame, key: list[str], spec: Learner, folds: int = 5, balance: str = "weights"
) -> DataFrame:
    """Metrics at 0.5 per fold. Folds are fixed by hash within the label and come from unbalanced data."""
    parts = []
    placed = reliable_checkpoint(with_folds(frame, key, folds))
    for fold in range(folds):
        fitted = fit(placed.filter(F.col("fold") != fold).drop("fold"), spec, balance)
        held = reliable_checkpoint(scored(fitted, placed.filter(F.col("fold") == fold)))
        parts.append(evaluation.metrics(held, 0.5).select(
            F.lit(fold).alias("fold"), "roc_auc", F.col("f1_score").alias("f1"), "precision", "recall"
        ))
    return reliable_checkpoint(reduce(DataFrame.unionByName, parts))


def stability(folds: DataFrame) -> DataFrame:
    """Mean, spread, range and variation in percent of each metric over the folds."""
    names = ("roc_auc", "f1", "precision", "recall")
    long = folds.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names
    ])).alias("m")).select("m.*")
    mean, std = F.avg("value"), F.stddev_pop("value")
    return long.groupBy("metric").agg(
        mean.alias("mean"), std.alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.when(mean > 0, std / mean * 100).otherwise(0.0).alias("stability"),
    )


def learning_curve(
    frame: DataFrame, key: list[str], spec: Learner, shares: tuple[float, ...] = tuple(i / 10 for i in range(1, 11)),
) -> DataFrame:
    """ROC area on train and held-out rows for growing training shares."""
    train_part, held = split(frame, key, 0.2, SEED + 2)
    rows = []
    for share in shares:
        part = train_part.filter(hash_share(key, SEED + 3) < share)
        rows.append(_areas_row(part, held, fit(part, spec)).withColumn("train_share", F.lit(float(share))))
    return reduce(DataFrame.unionByName, rows)


# Parameter grids of the validation curve.
GRIDS = {
    "trees": [50, 100, 200, 300, 500, 800],
    "maxDepth": [3, 5, 7, 10, 15, 20],
    "C": [0.01, 0.1, 1, 10, 100, 1000],
    "k": [3, 5, 7, 10, 15, 20],
}


def grid_parameter(spec: Learner) -> tuple[str, str]:
    """The parameter to vary for a learner, and the grid it uses."""
    if spec.name == "random_forest":
        return "numTrees", "trees"
    if spec.name == "decision_tree":
        return "maxDepth", "maxDepth"
    if spec.name in ("logistic_regression", "svm"):
        return "regParam", "C"
    if spec.name == "knn":
        return "k", "k"
    return "maxIter", "trees"


def boosted(spec: Learner) -> bool:
    return grid_parameter(spec)[0] == "maxIter"


def staged(fitted: Fitted, rounds: int) -> Fitted:
    """The model after its first ``rounds`` rounds, without another fit."""
    whole = fitted.classify.stages[-1]
    java = whole._java_obj
    rounds = min(rounds, whole.getNumTrees)
    gateway = SparkSession.active().sparkContext._gateway
    trees = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for n in range(rounds):
        trees[n], weights[n] = java.trees()[n], java.treeWeights()[n]
    first = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{java.uid()}_{rounds}", trees, weights)
    part = GBTClassificationModel(first)
    for name in ("featuresCol", "probabilityCol", "rawPredictionCol", "predictionCol"):
        part.set(part.getParam(name), whole.getOrDefault(name))
    return replace(fitted, classify=PipelineModel([part]))


def boosting_curve(frame: DataFrame, key: list[str], spec: Learner, balance: str = "none") -> DataFrame:
    """Loss of every boosting round on train and held-out rows, from one fit, and the round that was best on the held ones.

    Columns ``round, train_loss, held_loss, chosen``; the loss is the mean logistic loss of all rows.
    """
    train_part, held = split_stored(frame, key, 0.2, SEED + 2)
    fitted = fit(train_part, spec, balance)
    whole = fitted.classify.stages[-1]
    losses = []
    for part in (train_part, held):
        ready = reliable_checkpoint(fitted.prepare.transform(part).select("features", F.col("delay").cast("double").alias("delay")))
        # One number per round.
        losses.append([float(x) for x in whole.evaluateEachIteration(ready)])
    best = min(range(len(losses[1])), key=lambda n: (losses[1][n], n))
    rows = [(n + 1, a, b, n == best) for n, (a, b) in enumerate(zip(*losses))]
    return frame.sparkSession.createDataFrame(rows, "round int, train_loss double, held_loss double, chosen boolean")


def validation_curve(
    frame: DataFrame, key: list[str], spec: Learner, values: list | None = None
) -> DataFrame:
    """ROC area on train and held-out rows per value of the learner's main parameter.

    Boosted learners are fitted once, with the most rounds; fewer rounds are the first trees of that fit.
    """
    name, grid = grid_parameter(spec)
    train_part, held = split_stored(frame, key, 0.2, SEED + 2)
    rows, values = [], values or GRIDS[grid]
    longest = fit(train_part, spec.with_params(maxIter=max(values))) if boosted(spec) else None
    for value in values:
        setting = 1.0 / value if grid == "C" else value
        fitted = staged(longest, value) if longest else fit(train_part, spec.with_params(**{name: setting}))
        rows.append(_areas_row(train_part, held, fitted).select(
            F.lit(name).alias("parameter"), F.lit(float(value)).alias("value"), "train_roc_auc", "test_roc_auc"
        ))
    return reduce(DataFrame.unionByName, rows)


def _areas_row(train_part: DataFrame, held: DataFrame, fitted: Fitted) -> DataFrame:
    def area(part: DataFrame, name: str) -> DataFrame:
        return evaluation.areas(evaluation.curve(scored(fitted, part))).select(F.col("roc_auc").alias(name))

    left, right = area(train_part, "train_roc_auc"), area(held, "test_roc_auc")
    return left.unionByName(right, allowMissingColumns=True).agg(
        F.max("train_roc_auc").alias("train_roc_auc"), F.max("test_roc_auc").alias("test_roc_auc")
    )


def feature_importance(spark: SparkSession, fitted: Fitted) -> DataFrame | None:
    """Importance per readable feature name, for learners that state one."""
    last: Model | None = fitted.classify.stages[-1] if fitted.classify is not None else None
    if last is None or not hasattr(last, "featureImportances"):
        return None
    values = [float(v) for v in last.featureImportances.toArray()]
    names = feature_names(fitted.levels)
    return spark.createDataFrame(list(zip(names, values)), "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


# ---- scoring -----------------------------------------------------------------

def predict(fitted: Fitted, frame: DataFrame, threshold: float) -> DataFrame:
    return fitted.score(frame).withColumn("prediction", (F.col("score") >= threshold).cast("int"))


def predict_flights(
    trained: Trained, view: DataFrame, airports: DataFrame, tables: dict[str, DataFrame] | None = None,
    key: str = "f_id",
) -> DataFrame:
    """Id, prediction, risk level and probability for rows of the wide view."""
    frame = features.prepare(view, airports, for_training=False, tables=tables, key=key)
    return predict(trained.fitted, frame, trained.threshold).select(
        key, "prediction",
        evaluation.risk_level(F.col("score"), trained.risk_low, trained.risk_high).alias("risk_level"),
        F.col("score").alias("delay_probability"),
    )


def score_and_store(
    trained: Trained, flights: DataFrame, view: DataFrame, airports: DataFrame, ids: DataFrame,
    tables: dict[str, DataFrame] | None = None, key: str = "id",
) -> tuple[DataFrame, DataFrame]:
    """Score the listed flights and write the result back: (new flight table, summary)."""
    from ..operators.merge import write_back_predictions
    from .views import flights_by_ids

    chosen = flights_by_ids(view, ids)
    predictions = reliable_checkpoint(predict_flights(trained, chosen, airports, tables))
    updated = write_back_predictions(flights, predictions.withColumnRenamed("f_id", key), key)
    return updated, evaluation.prediction_summary(predictions)


# ---- storage -----------------------------------------------------------------

def save(trained: Trained, root: str, version: str, tables: dict[str, DataFrame] | None = None) -> str:
    """Write models, frequency tables and a one-row configuration below ``root``."""
    spark = trained.test_scores.sparkSession
    fitted = trained.fitted
    path = f"{root.rstrip('/')}/model={version}"
    fitted.prepare.write().overwrite().save(f"{path}/prepare")
    if fitted.classify is not None:
        fitted.classify.write().overwrite().save(f"{path}/classify")
    else:
        fitted.base.write.mode("overwrite").parquet(f"{path}/base")
    for name, table in (tables or {}).items():
        table.write.mode("overwrite").parquet(f"{path}/frequency_{name}")
    importance = feature_importance(spark, fitted)
    if importance is not None:
        importance.write.mode("overwrite").csv(f"{path}/importance", header=True)
    for part in ("test_metrics", "overfit", "test_scores"):
        getattr(trained, part).write.mode("overwrite").parquet(f"{path}/{part}")
    config = {
        "version": version, "path": path, "spec": json.dumps(asdict(fitted.spec)),
        "levels": json.dumps(fitted.levels), "optimal_threshold": float(trained.threshold),
        "risk_threshold_low": float(trained.risk_low), "risk_threshold_high": float(trained.risk_high),
        "delay_threshold": int(trained.delay_threshold), "tables": json.dumps(sorted(tables or {})),
    }
    # Written last: a version without configuration is not complete.
    spark.createDataFrame([config], CONFIG).coalesce(1).write.mode("overwrite").json(
        f"{root.rstrip('/')}/config/version={version}"
    )
    return path


CONFIG = (
    "version string, path string, spec string, levels string, optimal_threshold double, "
    "risk_threshold_low double, risk_threshold_high double, delay_threshold int, tables string"
)


def newest_config(spark: SparkSession, root: str) -> DataFrame:
    """The configuration with the highest version."""
    configs = spark.read.schema(CONFIG).json(f"{root.rstrip('/')}/config/*")
    return configs.orderBy(F.desc("version")).limit(1)


def load(spark: SparkSession, root: str) -> tuple[Trained, dict[str, DataFrame]]:
    """The newest stored model, ready to score, and its frequency tables."""
    row = newest_config(spark, root).first()
    spec = Learner(**json.loads(row["spec"]))
    knn = spec.name == "knn"
    fitted = Fitted(
        spec, PipelineModel.load(f"{row['path']}/prepare"),
        None if knn else PipelineModel.load(f"{row['path']}/classify"), json.loads(row["levels"]),
        spark.read.parquet(f"{row['path']}/base") if knn else None,
    )
    tables = {
        name: spark.read.parquet(f"{row['path']}/frequency_{name}") for name in json.loads(row["tables"])
    }
    parts = [spark.read.parquet(f"{row['path']}/{part}") for part in ("test_metrics", "overfit", "test_scores")]
    return Trained(
        fitted, row["optimal_threshold"], row["risk_threshold_low"], row["risk_threshold_high"],
        row["delay_threshold"], *parts,
    ), tables
