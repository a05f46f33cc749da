import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeroledger.llm import queries, ranking
from tests.llm.helpers import MESSY, messy, table


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op8_ranking(spark, folder)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows.values())
    for doc, row in rows.items():
        assert row["held_out"] == (zlib.crc32(str(doc).encode()) % 5 == 0)
        assert row["predicted"] == int(row["score"] >= 0.3)
    held = [r for r in table(spark, "labels", folder).collect() if rows[r["doc_id"]]["held_out"]]
    right = [rows[r["doc_id"]]["predicted"] == r["quality"] for r in held]
    assert len(held) > 50 and np.mean(right) > 0.9
    good = [rows[r["doc_id"]]["score"] for r in held if r["quality"] == 1]
    bad = [rows[r["doc_id"]]["score"] for r in held if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    vectors = ranking.features(table(spark, "documents")).cache()
    labels = table(spark, "labels")
    fold = ranking.fold(labels["doc_id"])
    assert ranking.train(vectors, labels) == ranking.train(vectors, labels.where(fold != 0))


def test_pairs_rank_and_the_cut_is_a_quantile():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(1, 1, (300, 3)), rng.normal(-1, 1, (200, 3))
    weights = ranking.fit_pairs(good, bad)
    scores = np.concatenate([good, bad]) @ weights
    labels = np.repeat([1, 0], [300, 200])
    cut = ranking.best_cut(scores, labels)
    assert np.mean((scores >= cut) == labels) > 0.93
    best = max(np.mean((scores >= c) == labels) for c in np.sort(scores))
    assert np.mean((scores >= cut) == labels) >= best - 0.01


def test_features_of_odd_texts():
    for _, text in MESSY:
        vector = ranking.features_of(text or "")
        assert len(vector) == len(ranking.FEATURES) and np.isfinite(vector).all()
    assert not ranking.features_of("").any() or ranking.features_of("")[-2] > 0


def test_messy_rows(spark):
    labels = labelled(spark, [(1, 1, 0), (1, 0, 0), (1, 1, 0), (2, 1, 0), (6, 0, 1), (11, 0, 0), (12, None, 0), (None, 0, 0), (99, 1, 0)])
    found = ranking.score_documents(messy(spark), labels).collect()
    assert sorted(repr(r["doc_id"]) for r in found) == sorted(repr(d) for d, _ in MESSY)
    assert all(0 <= r["score"] <= 1 for r in found)
    kept = ranking.keep_good(messy(spark), labels)
    assert kept.columns == messy(spark).columns
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted(repr(r["doc_id"]) for r in found if r["predicted"])


@pytest.mark.parametrize("rows", [[], [(1, 1, 0), (2, 1, 0)]])
def test_without_labels_of_both_kinds_nothing_is_rejected(spark, rows):
    labels = labelled(spark, rows)
    assert {r["predicted"] for r in ranking.score_documents(messy(spark), labels).collect()} == {1}
    assert ranking.keep_good(messy(spark), labels).count() == len(MESSY)


def test_empty_table(spark):
    labels = labelled(spark, [(1, 1, 0), (2, 0, 0)])
    assert ranking.score_documents(messy(spark).limit(0), labels).count() == 0
    assert ranking.keep_good(messy(spark).limit(0), labels).count() == 0


# ---- against plain loops -----------------------------------------------------------------

def slow_slope(difference, weights):
    """Slope of the mean logistic loss of pairs, one pair after another."""
    slope = [0.0] * len(weights)
    for row in difference.tolist():
        margin = max(-30.0, min(30.0, sum(x * w for x, w in zip(row, weights))))
        for at, x in enumerate(row):
            slope[at] -= x / (1 + math.exp(margin)) / len(difference)
    return [s + ranking.DECAY * w for s, w in zip(slope, weights)]


def slow_fit(good, bad, steps, pairs):
    rng = np.random.default_rng(ranking.SEED)
    weights, speed, square = ([0.0] * good.shape[1] for _ in range(3))
    for step in range(1, steps + 1):
        first = good[rng.integers(len(good), size=pairs)]
        slope = slow_slope(first - bad[rng.integers(len(bad), size=pairs)], weights)
        for at, s in enumerate(slope):
            speed[at] = 0.9 * speed[at] + 0.1 * s
            square[at] = 0.999 * square[at] + 0.001 * s * s
            weights[at] -= ranking.LEARNING_RATE * (speed[at] / (1 - 0.9**step)) / (math.sqrt(square[at] / (1 - 0.999**step)) + 1e-8)
    return weights


def test_pairs_and_gradient_against_plain_loops(monkeypatch):
    monkeypatch.setattr(ranking, "STEPS", 40)
    monkeypatch.setattr(ranking, "PAIRS_PER_STEP", 30)
    rng = np.random.default_rng(3)
    good, bad = rng.normal(0.4, 1, (50, 6)), rng.normal(-0.4, 1, (35, 6))
    weights = ranking.fit_pairs(good, bad)
    assert np.allclose(weights, slow_fit(good, bad, 40, 30), atol=1e-9)
    # The slope is that of the loss.
    difference, point = good[:30] - bad[:30], rng.normal(0, 0.3, 6)

    def loss(w):
        return np.log1p(np.exp(-(difference @ w))).mean() + ranking.DECAY / 2 * (w @ w)

    for at, slope in enumerate(slow_slope(difference, point.tolist())):
        move = np.eye(6)[at] * 1e-6
        assert abs((loss(point + move) - loss(point - move)) / 2e-6 - slope) < 1e-6


def test_cut_against_all_cuts():
    rng = np.random.default_rng(5)
    for size in (2, 7, 120):
        labels = np.array([0, 1] + rng.integers(0, 2, size - 2).tolist())
        scores = np.round(rng.normal(labels, 1.0), 1)
        cut = ranking.best_cut(scores, labels)

        def right(at):
            return int(sum((s >= at) == (label == 1) for s, label in zip(scores, labels)))

        ordered = sorted(scores)
        cuts = [ordered[0] - 1, *((a + b) / 2 for a, b in zip(ordered, ordered[1:]))]
        assert right(cut) == max(map(right, cuts))


def test_scores_in_columns_against_plain_loops(spark):
    documents = messy(spark)
    labels = labelled(spark, [(1, 1, 0), (2, 1, 0), (11, 0, 0), (12, 1, 0), (6, 0, 0), (9, 1, 0)])
    ranker = ranking.train(ranking.features(documents), labels)
    for row in ranking.score_documents(documents, labels).join(documents.select("doc_id", "text"), "doc_id").collect():
        options = []
        for text in (t for d, t in MESSY if d == row["doc_id"]):
            total = sum(x * w for x, w in zip(ranking.features_of(text or "").tolist(), ranker.weights)) - ranker.cut
            options.append(1 / (1 + math.exp(-max(-700.0, min(700.0, total + math.log(0.3 / 0.7))))))
        assert any(abs(row["score"] - o) < 1e-9 for o in options)


def test_all_labelled_ids_are_fitted(spark):
    """The feature tells nothing on the ids of the lowest hashes."""
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 32).cast("double") / float(1 << 32)
    rows = spark.range(400).select(F.col("id").alias("doc_id")).withColumn("low", place < 0.3).withColumn("quality", (F.col("doc_id") % 2).cast("int"))
    vectors = rows.select("doc_id", F.array(F.when(F.col("low"), 0.5).otherwise(F.col("quality").cast("double")), F.lit(1.0)).alias("features"))
    found = ranking.train(vectors, rows.select("doc_id", "quality"), 40)
    assert found.weights[0] > 0 and found.weights[1] == 0


def test_the_cut_is_counted_in_spark(spark):
    rng = np.random.default_rng(3)
    for n, digits in ((7, 1), (300, 1), (1500, 6)):
        labels = np.concatenate([[0, 1], rng.integers(0, 2, n)])
        scores = np.round(labels + rng.normal(0, 1, n + 2), digits)
        rows = spark.createDataFrame(list(zip(labels.tolist(), scores.tolist())), "label int, score double")
        assert ranking.best_cut_of(rows) == ranking.best_cut(scores, labels)
