import numpy as np
import pytest
from conftest import rows
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from aeroledger.operators import lsh, neighbours
from aeroledger.plans import evaluation, kernels, model


def vectors(spark, points):
    data = [(p.tolist(), int(n % 3 == 0)) for n, p in enumerate(points)]
    return spark.createDataFrame(data, "vector array<double>, label int")


def clustered(seed=1, size=1500, dimensions=8):
    """Dense and sparse regions, some points many times."""
    rng = np.random.default_rng(seed)
    spread = rng.choice([0.01, 0.3, 5.0], size)[:, None]
    points = rng.normal(0, 1, (12, dimensions))[rng.integers(0, 12, size)] * 4 + rng.normal(0, 1, (size, dimensions)) * spread
    return np.concatenate([points, np.repeat(points[:3], 40, axis=0)])


# ---- hashed neighbours ------------------------------------------------------------------

def test_recall_against_the_exact_search(spark):
    base = neighbours.distinct_vectors(vectors(spark, clustered())).persist()
    queries = base.select(neighbours.vector_id("vector").alias("qid"), "vector").where(F.pmod(F.xxhash64("qid"), F.lit(5)) == 0)
    exact = neighbours.nearest(queries, base, 5)
    found = lsh.approximate(queries, base, 5, most=100).persist()
    assert lsh.recall(exact, exact) == 1.0 and 0.9 <= lsh.recall(found, exact) <= 1.0
    # Every query has its rows, itself first, in order and without repeats.
    per = found.groupBy("qid").agg(F.sum("copies").alias("n"), F.min("distance").alias("d"), F.count_distinct("vector").alias("v"), F.max("place").alias("p"))
    bad = per.where("n < 5 or d > 1e-12 or v <> p")
    assert bad.count() == 0 and per.count() == queries.count()


def test_dense_cells_are_cut_or_dealt_out(spark):
    """A third of all vectors in one spot: cut as far as allowed, then compared in blocks, and still right."""
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(0, 1e-9, (400, 3)), rng.normal(0, 10, (800, 3))])
    base = neighbours.distinct_vectors(vectors(spark, points))
    queries = base.select(neighbours.vector_id("vector").alias("qid"), "vector").where(F.pmod(F.xxhash64("qid"), F.lit(6)) == 0)
    found = lsh.approximate(queries, base, 3, tables=6, most=50, cuts=6)
    assert lsh.recall(found, neighbours.nearest(queries, base, 3)) >= 0.9


def test_far_queries_are_answered_exactly(spark):
    base = neighbours.distinct_vectors(vectors(spark, clustered(3, 600)))
    far = spark.createDataFrame([(n, [1e6 + n] * 8) for n in range(4)], "qid int, vector array<double>")
    found = lsh.approximate(far, base, 2, most=50)
    assert rows(found, "qid", "distance") == rows(neighbours.nearest(far, base, 2), "qid", "distance")


def test_a_small_base_is_searched_exactly(spark):
    base = neighbours.distinct_vectors(vectors(spark, clustered(4, 200)))
    queries = base.select(neighbours.vector_id("vector").alias("qid"), "vector").limit(20)
    assert rows(lsh.approximate(queries, base, 3), "qid", "distance") == rows(neighbours.nearest(queries, base, 3), "qid", "distance")


def test_resampling_covers_all_rows(spark, monkeypatch):
    monkeypatch.setattr(model, "MAX_EXACT_ROWS", 50)
    data = [([float(i % 40), float(i % 7)], 0) for i in range(280)] + [([90.0 + i, 3.0 + i % 3], 1) for i in range(24)]
    ready = spark.createDataFrame(data, "v array<double>, delay int").select(array_to_vector("v").alias("features"), "delay")
    counts = {r["delay"]: r["count"] for r in model.resample(ready).groupBy("delay").count().collect()}
    assert counts[0] == 280 and abs(counts[1] - 280) <= 40
    with pytest.raises(ValueError, match="unknown search"):
        model.resample(ready, search="guess")


# ---- kernel -----------------------------------------------------------------------------

def test_inner_products_are_close_to_the_kernel(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(0, 1, (40, 4))
    frame = spark.createDataFrame([(n, p.tolist()) for n, p in enumerate(points)], "n int, v array<double>").repartition(3)
    waves = np.array([r["w"] for r in kernels.fourier(frame, "v", "w", 0.3, 4000, 1).orderBy("n").collect()])
    distance = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    assert np.abs(waves @ waves.T - np.exp(-0.3 * distance)).max() < 0.08


def ring(spark, size=600):
    """Late flights lie within a ring of the others, where no line divides them."""
    rng = np.random.default_rng(6)
    radius = np.where(np.arange(size) % 2, rng.uniform(0, 1, size), rng.uniform(2, 3, size))
    angle = rng.uniform(0, 2 * np.pi, size)
    data = [([float(r * np.cos(a)), float(r * np.sin(a))], n % 2) for n, (r, a) in enumerate(zip(radius, angle))]
    return spark.createDataFrame(data, "v array<double>, delay int").select(array_to_vector("v").alias("features"), "delay").persist()


def test_kernel_separates_what_a_line_cannot(spark, tmp_path):
    ready = ring(spark)
    areas = {}
    for kernel in ("linear", "rbf"):
        fitted = model.fit_vectors(ready, model.learner("svm", kernel=kernel, maxIter=30), "weights", None, {})
        scores = fitted.score_vectors(ready).select(F.col("delay").alias("label"), "score")
        areas[kernel] = evaluation.areas(evaluation.curve(scores)).first()["roc_auc"]
        assert fitted.score_vectors(ready).columns == ["features", "delay", "score"]
        fitted.classify.write().overwrite().save(str(tmp_path / kernel))
        again = type(fitted.classify).load(str(tmp_path / kernel))
        kept = model.Fitted(fitted.spec, None, again, {}).score_vectors(ready)
        assert rows(kept, "score") == rows(fitted.score_vectors(ready), "score")
    assert areas["rbf"] > 0.98 and areas["linear"] < 0.7


# ---- boosting ---------------------------------------------------------------------------

def noisy(spark, size=500):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (size, 5))
    late = (x[:, 0] * x[:, 1] + rng.normal(0, 1.2, size) > 0.3).astype(int)
    data = [(p.tolist(), int(y)) for p, y in zip(x, late)]
    return spark.createDataFrame(data, "v array<double>, delay int").select(array_to_vector("v").alias("features"), "delay").persist()


def test_first_rounds_of_a_fit_are_the_shorter_fit(spark):
    ready = noisy(spark)
    long, short = (
        model.fit_vectors(ready, model.learner("lightgbm", maxIter=n), "none", None, {}) for n in (8, 3)
    )
    cut = model.staged(long, 3)
    assert cut.classify.stages[-1].getNumTrees == 3
    assert rows(cut.score_vectors(ready), "score") == rows(short.score_vectors(ready), "score")
    assert rows(model.staged(long, 99).score_vectors(ready), "score") == rows(long.score_vectors(ready), "score")


def test_rounds_end_when_held_rows_gain_no_more(spark):
    ready = noisy(spark)
    spec = model.learner("lightgbm", maxIter=60, stepSize=0.5, maxDepth=5)
    early = model.fit_vectors(ready, spec.with_params(validation_share=0.3, validationTol=0.01), "weights", None, {})
    assert 1 <= early.classify.stages[-1].getNumTrees < 60
    assert "validation_share" in model.PRESETS["xgboost"]


def test_curve_of_all_rounds_from_one_fit(spark):
    from test_model import frame

    curve = model.boosting_curve(frame(spark, 300), ["f_id"], model.learner("lightgbm", maxIter=6))
    found = curve.orderBy("round").collect()
    assert [r["round"] for r in found] == list(range(1, 7)) and sum(r["chosen"] for r in found) == 1
    best = min(found, key=lambda r: (r["held_loss"], r["round"]))
    assert best["chosen"] and found[-1]["train_loss"] < found[0]["train_loss"]
    grid = model.validation_curve(frame(spark, 300), ["f_id"], model.learner("lightgbm"), [2, 4])
    assert rows(grid, "parameter", "value") == [("maxIter", 2.0), ("maxIter", 4.0)]


def test_median_and_quartiles_are_exact(spark):
    from test_model import frame

    df = frame(spark, 81)
    names = {c: ["a", "b"] for c in model.features.CATEGORICAL}
    fitted = Pipeline(stages=model.preprocessor(names, 0.0)).fit(df)
    place = model.feature_names(names).index("flight_duration_minutes")
    values = np.array([r[0] for r in df.select("flight_duration_minutes").collect()], dtype=float)
    low, middle, high = np.quantile(values, [0.25, 0.5, 0.75], method="inverted_cdf")
    got = sorted(float(r["features"][place]) for r in fitted.transform(df).collect())
    want = (values - middle) / (high - low) if high > low else np.zeros(len(values))
    assert np.allclose(got, sorted(want))
