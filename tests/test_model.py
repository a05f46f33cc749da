import datetime as dt
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from aeroledger.operators import neighbours
from aeroledger.plans import evaluation, features, model

T0 = dt.datetime(2025, 10, 1)


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "label int, score double")


def brute_curve(pairs):
    out = {}
    for s in {s for _, s in pairs}:
        out[s] = (sum(1 for l, x in pairs if x >= s and l), sum(1 for l, x in pairs if x >= s and not l))
    return out


@pytest.mark.parametrize("n", [1, 7, 500])
def test_curve(spark, n):
    rng = random.Random(n)
    pairs = [(rng.randrange(2), round(rng.random() ** 3, 2 if n < 100 else 4)) for _ in range(n)]
    got = {r["score"]: (r["tp"], r["fp"]) for r in evaluation.curve(scored(spark, pairs)).collect()}
    assert got == brute_curve(pairs)


def test_areas_and_thresholds(spark):
    pairs = [(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8), (1, 0.4), (0, 0.0)]
    points = evaluation.curve(scored(spark, pairs))
    area = evaluation.areas(points).first()
    pos, neg = [s for l, s in pairs if l], [s for l, s in pairs if not l]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(area["roc_auc"] - auc) < 1e-12
    curve = brute_curve(pairs)
    previous, ap = 0, 0.0
    for s in sorted(curve, reverse=True):
        tp, fp = curve[s]
        ap += (tp - previous) / len(pos) * tp / (tp + fp)
        previous = tp
    assert abs(area["pr_auc"] - ap) < 1e-12
    bands = evaluation.risk_bands(points).first()
    assert (bands["risk_threshold_low"], bands["risk_threshold_high"]) == (0.1, 0.35)
    row = evaluation.metrics(scored(spark, pairs), 0.4).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (2, 1, 1, 2)


def test_threshold_tie_takes_lowest(spark):
    # F1 is 2/3 at both thresholds.
    points = evaluation.curve(scored(spark, [(1, 0.9), (0, 0.5), (0, 0.4), (1, 0.3)]))
    assert evaluation.best_threshold(points).first()["threshold"] == 0.3


def test_one_class(spark):
    points = evaluation.curve(scored(spark, [(0, 0.2), (0, 0.3)]))
    assert tuple(evaluation.areas(points).first()) == (None, None)
    assert evaluation.median_of_negatives(points).first()[0] == 0.25


def test_calibration_edges(spark):
    got = evaluation.calibration(scored(spark, [(0, 0.0), (1, 0.1), (0, 0.11), (1, 1.0), (1, 0.3)]))
    assert rows(got, "bin", "n") == [(0, 2), (1, 1), (2, 1), (9, 1)]
    assert abs(evaluation.brier(scored(spark, [(1, 0.5), (0, 0.1)])).first()[0] - 0.13) < 1e-12


def test_histogram(spark):
    got = evaluation.histogram(scored(spark, [(0, 0.0), (0, 1.0), (0, 0.5), (1, 0.7)]), 4)
    assert rows(got) == [(0, 0, 1), (0, 2, 1), (0, 3, 1), (1, 0, 1)]


def test_gaps(spark):
    flights = spark.createDataFrame([
        (1, T0, None), (2, T0 + dt.timedelta(minutes=5), " "), (3, T0 + dt.timedelta(minutes=9), "NULL"),
        (4, T0 + dt.timedelta(hours=1), None), (5, T0 + dt.timedelta(hours=1, minutes=59), "LANDED"), (6, None, "LANDED"),
    ], "id long, departure_scheduled_utc timestamp_ntz, status_final string")
    assert rows(features.remove_gaps(flights), "id") == [(4,), (5,)]
    late = flights.withColumn("departure_scheduled_utc", F.expr("departure_scheduled_utc + make_interval(0, 0, 0, 0, cast(id * 8 as int))"))
    assert rows(features.settled(late), "id") == [(1,), (2,)]


def test_frequencies(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None), (None, "x")], "p string, q string")
    for tables in (features.frequency_tables(df, ["p", "q"]), {c: features.frequencies(df, c) for c in ("p", "q")}):
        assert rows(tables["p"]) == [("a", 2 / 3), ("b", 1 / 3)]
        assert rows(tables["q"]) == [("x", 2 / 3), ("y", 1 / 3)]


def test_visibility_and_severity(spark):
    df = spark.createDataFrame([(0, None), (1, 0.5), (2, 1.0), (3, 4.99), (4, 5.0)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(features.visibility_class(F.col("v"))).collect()]
    assert got == [None, "<1", "<2", "<5", ">=5"]


def test_target_boundaries(spark):
    df = spark.createDataFrame([(0, 14.0), (1, 15.0), (2, 16.0), (3, None)], "i int, delay_min double")
    assert rows(features.target(df), "i", "delay") == [(0, 0), (1, 0), (2, 1), (3, 0)]


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(1000).repartition(7)
    for n in (0, 1, 137, 1000, 5000):
        got = rows(features.sample_rows(df, n, ["id"]))
        assert len(got) == min(n, 1000) and got == rows(features.sample_rows(df.repartition(3), n, ["id"]))


def vectors(spark, n, d, seed, labels=True):
    rng = np.random.default_rng(seed)
    data = [(i, [float(x) for x in rng.integers(0, 6, d)], int(rng.integers(0, 2))) for i in range(n)]
    return data, spark.createDataFrame(data, "qid long, vector array<double>, label int")


@pytest.mark.parametrize("pivots,block", [(1, 1000), (6, 7)])
def test_nearest_against_brute_force(spark, pivots, block):
    data, df = vectors(spark, 120, 3, 1)
    asked, queries = vectors(spark, 25, 3, 2)
    base = neighbours.distinct_vectors(df)
    near = neighbours.nearest(queries, base, 5, pivots, block)
    distinct = {}
    for _, v, l in data:
        distinct.setdefault(tuple(v), []).append(l)
    for qid, q, _ in asked:
        order = sorted(distinct, key=lambda v: (sum((a - b) ** 2 for a, b in zip(v, q)), v))
        want, held = [], 0
        for v in order:
            if held >= 5:
                break
            want.append((v, len(distinct[v]), sum(distinct[v])))
            held += len(distinct[v])
        got = [
            (tuple(r["vector"]), r["copies"], r["positives"])
            for r in near.filter(F.col("qid") == qid).orderBy("place").collect()
        ] if qid < 5 else None
        assert got is None or got == want


def test_vote(spark):
    base = spark.createDataFrame([([0.0], 1), ([1.0], 0), ([3.0], 1)], "vector array<double>, label int")
    queries = spark.createDataFrame([(1, [0.0]), (2, [2.0])], "qid long, vector array<double>")
    near = neighbours.nearest(queries, neighbours.distinct_vectors(base), 2)
    got = {r["qid"]: r["score"] for r in neighbours.weighted_vote(near, 2).collect()}
    assert got == {1: 1.0, 2: 0.5}


def frame(spark, n=600):
    """A small feature frame in which wind and visibility decide."""
    rng = random.Random(3)
    out = []
    for i in range(n):
        wind, vis = rng.randrange(40), rng.choice(features.VISIBILITY_ORDER)
        late = int(wind + (10 if vis in ("<1", "<2") else 0) + rng.randrange(8) > 34)
        out.append((i, late, float(wind) if i % 9 else None, vis, rng.choice(["FOG", "CLEAR", "RAIN"])))
    df = spark.createDataFrame(out, "f_id long, delay int, wind_speed_kt double, visibility_statute_mi string, w string")
    for c in features.NUMERIC:
        if c not in df.columns:
            df = df.withColumn(c, F.pmod(F.xxhash64(F.lit(c), "f_id"), F.lit(5)).cast("double"))
    for c in features.CATEGORICAL:
        df = df.withColumn(c, F.col("w"))
    for c in features.ORDERED:
        if c not in df.columns:
            df = df.withColumn(c, F.lit("FEW" if "sky" in c else ">=5"))
    return df


def test_preprocessing(spark):
    from pyspark.ml import Pipeline

    df = frame(spark, 60)
    levels = model.category_levels(df, features.CATEGORICAL)
    assert levels["dep_weather_simplified"] == ["CLEAR", "FOG", "RAIN"]
    fitted = Pipeline(stages=model.preprocessor(levels)).fit(df)
    odd = df.limit(1).withColumn("dep_weather_simplified", F.lit("NEW")).withColumn("msc_sky_cover", F.lit("??"))
    vector = fitted.transform(odd).first()["features"]
    names = model.feature_names(levels)
    assert len(vector) == len(names)
    value = dict(zip(names, vector))
    assert value["dep_weather_simplified=FOG"] == value["dep_weather_simplified=RAIN"] == 0.0
    assert value["msc_sky_cover"] == -1.0 and value["tsc_sky_cover"] == 4.0


def test_train_save_load_score(spark, tmp_path):
    df = frame(spark).cache()
    trained = model.train(df, ["f_id"], "decision_tree", maxDepth=4)
    row = trained.test_metrics.first()
    assert row["roc_auc"] > 0.8 and row["n_samples"] == row["tn"] + row["fp"] + row["fn"] + row["tp"]
    assert trained.overfit.first()["overfitting_status"] in [s for _, s in evaluation.STATUSES]
    importance = model.feature_importance(spark, trained.fitted)
    assert importance.first()["feature"] == "wind_speed_kt"
    top = evaluation.cumulative_importance(importance, 3).collect()
    assert len(top) == 3 and top[2]["cumulative_percent"] >= top[0]["percent"]
    model.save(trained, str(tmp_path), "20250101_000000")
    model.save(trained, str(tmp_path), "20250102_000000", {"p": spark.range(1)})
    loaded, tables = model.load(spark, str(tmp_path))
    assert model.newest_config(spark, str(tmp_path)).first()["version"] == "20250102_000000" and list(tables) == ["p"]
    a = rows(model.predict(trained.fitted, df, trained.threshold), "f_id", "score", "prediction")
    b = rows(model.predict(loaded.fitted, df, loaded.threshold), "f_id", "score", "prediction")
    assert a == b


@pytest.mark.parametrize("name,params", [
    ("logistic_regression", {"maxIter": 10}), ("svm", {"maxIter": 10}), ("lightgbm", {"maxIter": 3}), ("knn", {}),
])
def test_learners(spark, name, params):
    trained = model.train(frame(spark, 300), ["f_id"], name, **params)
    scores = trained.test_scores.agg(F.min("score"), F.max("score"), F.count("score")).first()
    assert 0.0 <= scores[0] <= scores[1] <= 1.0 and scores[2] > 40


def test_resample_balances(spark):
    from pyspark.ml.functions import array_to_vector

    data = [([float(i % 20), float(i % 7)], 0) for i in range(140)] + [([50.0 + i, 3.0 + i % 3], 1) for i in range(12)]
    ready = spark.createDataFrame(data, "v array<double>, delay int").select(array_to_vector("v").alias("features"), "delay")
    counts = {r["delay"]: r["count"] for r in model.resample(ready).groupBy("delay").count().collect()}
    assert abs(counts[1] - 140) <= 20 and counts[0] == 140
    few = ready.filter("delay = 0")
    assert model.resample(few).count() == 140


def test_split_and_folds(spark):
    df = frame(spark, 400)
    train, test = model.split(df, ["f_id"])
    assert train.count() + test.count() == 400 and 60 < test.count() < 140
    folds = model.cross_validation(df, ["f_id"], model.learner("decision_tree", maxDepth=3), 2)
    assert rows(folds, "fold") == [(0,), (1,)]
    assert model.stability(folds).count() == 4
    curve = model.learning_curve(df, ["f_id"], model.learner("decision_tree", maxDepth=3), (0.5,))
    assert curve.count() == 1
    grid = model.validation_curve(df, ["f_id"], model.learner("decision_tree"), [2])
    assert rows(grid, "parameter", "value") == [("maxDepth", 2.0)]


def test_unknown_model():
    with pytest.raises(ValueError):
        model.learner("nope")


def test_split_and_folds_within_the_label(spark):
    df = spark.range(20_000).select(F.col("id").alias("f_id"), (F.col("id") % 1000 == 0).cast("int").alias("delay"))
    train, test = model.split(df, ["f_id"])
    assert rows(test.groupBy("delay").count()) == [(0, 4995), (1, 5)] and train.count() == 15_000
    assert rows(test, "f_id") == rows(model.split(df.repartition(5), ["f_id"])[1], "f_id")
    folds = model.with_folds(df, ["f_id"], 4).groupBy("fold", "delay").count()
    assert rows(folds) == [(f, d, n) for f in range(4) for d, n in ((0, 4995), (1, 5))]


def test_rare_levels_share_a_column(spark):
    data = [(i, f"v{i % 25:02d}") for i in range(500)] + [(900 + i, "v07") for i in range(9)] + [(999, None)]
    df = spark.createDataFrame(data, "f_id long, w string")
    levels = model.category_levels(df, ["w"])["w"]
    assert len(levels) == 20 and levels[-1] == model.INFREQUENT and "v07" in levels
    assert model.category_levels(df, ["w"], 25)["w"] == [f"v{i:02d}" for i in range(25)]
    rare = sorted({f"v{i:02d}" for i in range(25)} - set(levels))[0]
    full = frame(spark, 40)
    names = {c: levels for c in features.CATEGORICAL}
    from pyspark.ml import Pipeline

    fitted = Pipeline(stages=model.preprocessor(names)).fit(full)
    odd = full.limit(1).withColumn("dep_weather_impact", F.lit(rare)).withColumn("arr_weather_impact", F.lit(None).cast("string"))
    value = dict(zip(model.feature_names(names), fitted.transform(odd).first()["features"]))
    assert value[f"dep_weather_impact={model.INFREQUENT}"] == 1.0 and value[f"arr_weather_impact={model.INFREQUENT}"] == 0.0
    assert sum(v for n, v in value.items() if n.startswith("dep_weather_impact=")) == 1.0


def test_comparison_with_cross_validation(spark):
    trained = model.train(frame(spark, 400), ["f_id"], "decision_tree", maxDepth=3, cv_folds=2)
    row = trained.overfit.first()
    assert 0 <= row["cv_roc_auc_mean"] <= 1 and row["cv_f1_std"] >= 0


def test_bounded_rows_for_neighbours(spark):
    from pyspark.ml.functions import array_to_vector

    ready = spark.range(500).select(array_to_vector(F.array((F.col("id") % 50).cast("double"))).alias("features"), (F.col("id") % 2).cast("int").alias("delay"))
    assert model.fit_rows(ready, 100).count() == 100 and model.fit_rows(ready, 1000).count() == 500


def test_loaded_model_has_its_own_figures(spark, tmp_path):
    trained = model.train(frame(spark, 300), ["f_id"], "decision_tree", maxDepth=3)
    model.save(trained, str(tmp_path), "1")
    loaded, _ = model.load(spark, str(tmp_path))
    for part in ("test_metrics", "overfit", "test_scores"):
        assert rows(getattr(loaded, part)) == rows(getattr(trained, part))


def test_split_is_that_of_the_ranks(spark):
    """The rows with the smallest hashes of each label, copies of a key told apart, without ordering whole labels."""
    df = spark.range(3000).selectExpr("id % 2900 as f_id", "cast(if(id % 7 = 0, null, id % 7 < 3) as int) as delay")
    for share in (0.0, 0.001, 0.25, 1.0):
        placed = features.ranked(df, ["f_id"], 42, "delay")
        wanted = placed.filter(F.col("_rank") <= F.floor(F.col("_n") * F.lit(share))).drop("_rank", "_n")
        train, test = model.split(df, ["f_id"], share)
        assert rows(test) == rows(wanted) and sorted(rows(train) + rows(test), key=repr) == rows(df)
    assert "Window" not in "".join(
        p._jdf.queryExecution().optimizedPlan().toString() for p in model.split(df, ["f_id"])
    )


def test_exact_quantiles_from_counts(spark):
    rng = random.Random(5)
    data = {"a": [rng.randrange(9) / 2 for _ in range(1000)], "b": [rng.random() for _ in range(777)], "c": [4.0]}
    counts = spark.createDataFrame([(n, v) for n, own in data.items() for v in own], "name string, value double").groupBy(
        "name", "value").agg(F.count(F.lit(1)).alias("n"))
    got = {r["name"]: r["q"] for r in model.exact_quantiles(counts, (0.25, 0.5, 0.75)).collect()}
    assert got == {n: [sorted(own)[int(np.ceil(q * len(own))) - 1] for q in (0.25, 0.5, 0.75)] for n, own in data.items()}


def test_exact_preprocessing_is_that_of_the_stages(spark):
    from pyspark.ml import Pipeline

    df = frame(spark, 300)
    levels = model.category_levels(df, features.CATEGORICAL)
    exact, whole = model.fit_preprocessor(df, levels, 0.0), Pipeline(stages=model.preprocessor(levels, 0.0)).fit(df)
    assert rows(exact.transform(df), "f_id", "features") == rows(whole.transform(df), "f_id", "features")


def test_few_rows_are_fitted_in_few_tasks(spark):
    few = model.in_few_tasks(spark.range(100).repartition(40), 30)
    assert few.rdd.getNumPartitions() <= 4 and few.count() == 100
