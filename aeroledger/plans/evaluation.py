"""Quality of scores against labels: curves, thresholds, calibration.

Input is a frame with ``label`` (0 or 1) and ``score``. Everything starts from
counts per distinct score, cumulated in two steps (within score ranges and over
the ranges), so no task sees the whole curve.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

# Distinct scores per range aimed at, and the most ranges.
RANGE_SCORES = 20_000
MAX_RANGES = 1024


def _range_of(score: Column, bounds: list[float], first: int = 0) -> Column:
    """Number of bounds below the score, found by halving: a few comparisons per row."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(score > bounds[middle], _range_of(score, bounds[middle + 1:], first + middle + 1)).otherwise(
        _range_of(score, bounds[:middle], first)
    )


def curve(scored: DataFrame) -> DataFrame:
    """Per distinct score: positives, negatives, and running tp and fp from the top."""
    counts = scored.groupBy("score").agg(
        F.sum(F.col("label").cast("long")).alias("pos"),
        F.sum(1 - F.col("label").cast("long")).alias("neg"),
    )
    counts = reliable_checkpoint(counts)
    ranges = min(MAX_RANGES, max(8, counts.count() // RANGE_SCORES))
    cuts = [i / ranges for i in range(1, ranges)]
    # One row with at most MAX_RANGES numbers.
    bounds = counts.agg(F.percentile_approx("score", cuts, 10_000).alias("b")).first()["b"]
    ranged = counts.withColumn("range", _range_of(F.col("score"), sorted(set(bounds or []))))
    sums = ranged.groupBy("range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    above = W.orderBy(F.desc("range")).rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    # At most MAX_RANGES rows from here to the join.
    offsets = sums.select(
        "range",
        F.coalesce(F.sum("p").over(above), F.lit(0)).alias("p_above"),
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"),
        F.sum("p").over(everything).alias("positives"),
        F.sum("n").over(everything).alias("negatives"),
    )
    down = W.partitionBy("range").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, 0)
    return ranged.join(F.broadcast(offsets), "range").select(
        "score", "pos", "neg",
        (F.col("p_above") + F.sum("pos").over(down)).alias("tp"),
        (F.col("n_above") + F.sum("neg").over(down)).alias("fp"),
        "positives", "negatives",
    )


def curve_points(points: DataFrame) -> DataFrame:
    """Precision, recall, true and false positive rate at each threshold."""
    return points.select(
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide("tp", "positives").alias("recall"),
        F.try_divide("tp", "positives").alias("tpr"),
        F.try_divide("fp", "negatives").alias("fpr"),
    )


def areas(points: DataFrame) -> DataFrame:
    """Exact ROC area (ties count half) and step-wise average precision.

    Null if only one class is present.
    """
    return points.agg(*_area_sums()).select(*_areas())


def _area_sums() -> list[Column]:
    # Twice the trapezoid in whole numbers, so that order does not matter.
    doubled = F.col("neg").cast("decimal(38,0)") * (2 * F.col("tp") - F.col("pos"))
    step = F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return [
        F.sum(doubled).cast("double").alias("doubled"), F.sum(step).alias("steps"),
        F.max("positives").alias("p"), F.max("negatives").alias("n"),
    ]


def _areas() -> list[Column]:
    both = (F.col("p") > 0) & (F.col("n") > 0)
    return [
        F.when(both, F.col("doubled") / (2.0 * F.col("p") * F.col("n"))).alias("roc_auc"),
        F.when(F.col("p") > 0, F.col("steps") / F.col("p")).alias("pr_auc"),
    ]


def _best() -> Column:
    """Aggregate: the point with the highest F1, the lowest threshold on a tie."""
    f1 = 2 * F.col("tp") / (F.col("tp") + F.col("fp") + F.col("positives"))
    return F.max(F.struct(f1.alias("f1"), (-F.col("score")).alias("low"), "tp", "fp")).alias("best")


def best_threshold(points: DataFrame) -> DataFrame:
    """Threshold with the highest F1; the lowest such threshold on a tie."""
    best = points.agg(_best())
    return best.select((-F.col("best.low")).alias("threshold"), F.col("best.f1").alias("f1"))


def _median() -> Column:
    """Aggregate: exact median score of the negatives, read off the running counts."""
    first = F.col("negatives") - F.col("fp")

    def holds(rank: Column) -> Column:
        return (F.col("neg") > 0) & (first <= rank) & (rank < first + F.col("neg"))

    low = F.floor((F.col("negatives") - 1) / 2)
    high = F.ceil((F.col("negatives") - 1) / 2)
    return (F.max(F.when(holds(low), F.col("score"))) + F.max(F.when(holds(high), F.col("score")))) / 2.0


def median_of_negatives(points: DataFrame) -> DataFrame:
    return points.agg(_median().alias("median"))


def risk_bands(points: DataFrame) -> DataFrame:
    """Low band limit (median score of the negatives) and high one (best threshold)."""
    row = points.agg(_median().alias("risk_threshold_low"), _best())
    return row.select("risk_threshold_low", (-F.col("best.low")).alias("risk_threshold_high"))


def _side_by_side(*frames: DataFrame) -> DataFrame:
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def risk_level(score: Column, low: float, high: float) -> Column:
    return F.when(score < low, "low").when(score < high, "medium").otherwise("high")


def metrics(scored: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row: areas, F1, precision, recall, confusion counts, class counts.

    All figures come from one aggregate over the curve.
    """
    points = curve(scored)
    if threshold is None:
        sums = points.agg(*_area_sums(), _best()).select(
            "*", (-F.col("best.low")).alias("limit"), F.col("best.tp").alias("tp"), F.col("best.fp").alias("fp")
        )
    else:
        said = F.col("score") >= F.lit(threshold)
        sums = points.agg(
            *_area_sums(), *[F.coalesce(F.sum(F.when(said, F.col(c))), F.lit(0)).alias(n) for c, n in (("pos", "tp"), ("neg", "fp"))]
        ).withColumn("limit", F.lit(threshold))
    limit = F.col("limit")
    row = sums.select(
        *_areas(), "limit", "tp", "fp", (F.col("n") - F.col("fp")).alias("tn"), (F.col("p") - F.col("tp")).alias("fn"),
        F.col("p").alias("positives"), F.col("n").alias("negatives"),
    )
    precision = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.coalesce(
        F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0)
    )
    return row.select(
        "roc_auc", "pr_auc", f1.alias("f1_score"), precision.alias("precision"), recall.alias("recall"),
        limit.alias("optimal_threshold"), "tn", "fp", "fn", "tp",
        (F.col("positives") + F.col("negatives")).alias("n_samples"), "positives", "negatives",
    )


COMPARED = ["roc_auc", "pr_auc", "f1_score", "precision", "recall"]

# Overfit status by mean absolute gap in percent.
STATUSES = [(5, "Excellent"), (10, "Bon"), (20, "Moyen"), (None, "Problématique")]


def overfit_gaps(train: DataFrame, test: DataFrame) -> DataFrame:
    """Train against test metrics (one-row frames): gap, gap in percent, overall status."""
    row = _side_by_side(
        train.select(*[F.col(c).alias(f"train_{c}") for c in COMPARED]),
        test.select(*[F.col(c).alias(f"test_{c}") for c in COMPARED]),
    )
    for c in COMPARED:
        gap = F.col(f"train_{c}") - F.col(f"test_{c}")
        row = row.withColumns({
            f"{c}_gap": gap,
            f"{c}_gap_percent": F.when(F.col(f"train_{c}") > 0, gap / F.col(f"train_{c}") * 100).otherwise(0.0),
        })
    mean = reduce(lambda a, b: a + b, [F.abs(F.col(f"{c}_gap_percent")) for c in COMPARED]) / len(COMPARED)
    status = F.lit(STATUSES[-1][1])
    for limit, name in reversed(STATUSES[:-1]):
        status = F.when(F.col("average_gap_percent") < limit, name).otherwise(status)
    return row.withColumn("average_gap_percent", mean).withColumn("overfitting_status", status)


def calibration(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Mean score and share of positives per equal bin of [0, 1]; empty bins are absent.

    A score on an inner edge belongs to the bin below it.
    """
    edges = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    return (
        scored.groupBy(F.size(F.filter(edges, lambda e: e < F.col("score"))).alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score"),
            F.avg(F.col("label").cast("double")).alias("positive_rate"),
        )
        .orderBy("bin")
    )


def brier(scored: DataFrame) -> DataFrame:
    return scored.agg(F.avg(F.pow(F.col("score") - F.col("label"), 2)).alias("brier_score"))


def histogram(scored: DataFrame, bins: int = 30) -> DataFrame:
    """Scores per class in equal bins between the class's smallest and largest score."""
    limits = scored.groupBy("label").agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.when(width > 0, F.least(F.floor((F.col("score") - F.col("lo")) / width), F.lit(bins - 1)))
    return (
        # Two classes, so two rows.
        scored.join(F.broadcast(limits), "label")
        .groupBy("label", F.coalesce(place, F.lit(0)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("label", "bin")
    )


def residual_histogram(scored: DataFrame, bins: int = 30) -> DataFrame:
    residuals = scored.select(F.lit(0).alias("label"), (F.col("label") - F.col("score")).alias("score"))
    return histogram(residuals, bins).drop("label")


def prediction_summary(predictions: DataFrame) -> DataFrame:
    """Counts and shares by prediction and risk level, and spread of the probability.

    The median comes from the running counts of the curve, not from a task that
    holds all values.
    """
    p = F.col("delay_probability")

    def share(n: str) -> Column:
        return F.try_divide(F.col(n) * 100.0, F.col("flights")).alias(f"{n}_pct")

    counts = predictions.agg(
        F.count(F.lit(1)).alias("flights"),
        F.count(F.when(F.col("prediction") == 1, 1)).alias("late"),
        F.count(F.when(F.col("prediction") == 0, 1)).alias("on_time"),
        *[F.count(F.when(F.col("risk_level") == r, 1)).alias(r) for r in ("low", "medium", "high")],
        F.avg(p).alias("mean_probability"), F.min(p).alias("min_probability"), F.max(p).alias("max_probability"),
    )
    flat = predictions.select(F.lit(0).alias("label"), p.alias("score")).filter("score is not null")
    median = median_of_negatives(curve(flat)).select(F.col("median").alias("median_probability"))
    row = _side_by_side(counts, median)
    return row.select(*row.columns, *[share(n) for n in ("late", "on_time", "low", "medium", "high")])


def cumulative_importance(importance: DataFrame, top: int = 15) -> DataFrame:
    """Top features with their share of all importance and the running share.

    One row per model feature, so the window is small by construction.
    """
    everything = W.partitionBy()
    down = W.orderBy(F.desc("importance"), "feature").rowsBetween(W.unboundedPreceding, 0)
    total = F.sum("importance").over(everything)
    return importance.select(
        "feature", "importance", (F.col("importance") / total * 100).alias("percent"),
        (F.sum("importance").over(down) / total * 100).alias("cumulative_percent"),
    ).orderBy(F.desc("importance"), "feature").limit(top)
