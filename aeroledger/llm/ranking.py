"""Quality scores by Bradley-Terry ranking.

Each text has a vector of surface features. A document of label 1 is preferred to one of label 0;
weights are learned by logistic loss on the feature differences of such pairs, so that the weighted
sum ranks documents. The cut is a quantile of the training scores, chosen for the most right labels, and
the logistic function shifts the cut to the fixed probability ``CUT``.

All labelled ids are fitted, with one row each. They are dealt by hash to trainers of about ``MAX_LABELLED`` ids;
the weights of the trainers are averaged by their rows. The scaling, and the scores that the cut is chosen from, are
those of all labelled ids, counted in Spark. Label, language, source, stored length and id are no inputs of a score.

Cases: null text is empty and is scored; repeated labels of a document count by their majority (a tie
is label 1), null labels not at all; rows with equal ids each have their score; without labels of both kinds
nothing can be ranked, every score is ``1 - CUT`` and no row is rejected; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import evaluation
from ..session import reliable_checkpoint, ship_package
from . import common

# Labelled ids of one trainer, about (55 numbers each).
MAX_LABELLED = 40_000
FOLDS = 5
CUT = 0.3
PAIRS_PER_STEP = 4096
STEPS = 1500
LEARNING_RATE = 0.05
DECAY = 1e-4
QUANTILES = 400
SEED = 7

#: Marks of ordinary prose, and the kinds of a code point.
PROSE_MARKS = ".,;:?'\"()-–—¿¡«»“”‘’…"
LOWER, UPPER, DIGIT, SPACE, MARK, BAR, BANG, SYMBOL = range(8)

RATIOS = (
    "upper", "digit", "space", "mark", "bar", "bang", "symbol", "repeated_words", "same_as_before", "top_word",
    "repeated_triples", "repeated_lines", "wordless", "odd_ends", "unfinished_lines", "mixed_case", "single_letters",
)
SIZES = ("word_length", "words", "lines", "line_length")
# Every ratio as it is, as its root (small shares count) and as a mark of presence.
FEATURES = [*RATIOS, *(f"root_{r}" for r in RATIOS), *(f"any_{r}" for r in RATIOS), *SIZES]


class Kinds(dict):
    """Kind of each code point, for ``str.translate``."""

    def __missing__(self, point: int) -> str:
        char = chr(point)
        kind = (
            SPACE if char.isspace() else DIGIT if char.isnumeric() else BAR if char == "|" else BANG if char == "!"
            else MARK if char in PROSE_MARKS else UPPER if char.isupper() else LOWER if char.isalpha() else SYMBOL
        )
        self[point] = value = chr(kind)
        return value


_KINDS = Kinds()


def share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def features_of(text: str) -> np.ndarray:
    """Feature vector of a whole text."""
    kinds = np.bincount(np.frombuffer(text.translate(_KINDS).encode("latin-1"), dtype=np.uint8), minlength=8)
    size = len(text)
    letters = kinds[LOWER] + kinds[UPPER]
    words = text.split()
    lines = text.split("\n")
    count = len(words)
    seen: dict[str, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    triples = len(set(zip(words, words[1:], words[2:])))
    ratios = [
        share(kinds[UPPER], letters), *(share(kinds[k], size) for k in (DIGIT, SPACE, MARK, BAR, BANG, SYMBOL)),
        1 - share(len(seen), count) if count else 0.0,
        share(sum(map(str.__eq__, words, words[1:])), count),
        share(max(seen.values(), default=0), count),
        1 - share(triples, count - 2) if count > 2 else 0.0,
        1 - share(len(set(lines)), len(lines)),
        share(sum(not word[0].isalnum() and not any(map(str.isalnum, word)) for word in words), count),
        share(sum(not word[-1].isalnum() and word[-1] not in PROSE_MARKS for word in words), count),
        share(sum(not line.rstrip().endswith((".", "?", "…", '"')) for line in lines), len(lines)),
        share(sum(word[1:] != word[1:].lower() for word in words), count),
        share(sum(len(word) == 1 for word in words), count),
    ]
    ratios = np.array(ratios)
    sizes = np.log1p([share(letters, count), count, len(lines), share(size, len(lines))])
    return np.concatenate([ratios, np.sqrt(ratios), ratios > 0, sizes])


def feature_column(text: Column) -> Column:
    """Features of a text column as an array of doubles."""

    @F.pandas_udf("array<double>")
    def compute(raw: pd.Series) -> pd.Series:
        return pd.Series([features_of(common.decode(value)) for value in raw])

    return compute(F.coalesce(text, F.lit("")).cast("binary"))


def features(documents: DataFrame) -> DataFrame:
    """``doc_id, features`` per row."""
    common.prepare(documents.sparkSession)
    return documents.select("doc_id", feature_column(F.col("text")).alias("features"))


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    """Remainder of the id's CRC-32; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


@dataclass(frozen=True)
class Ranker:
    """A linear ranking; ``cut`` is the score from which a document is kept."""

    weights: tuple[float, ...]
    cut: float

    def score(self, vector: Column) -> Column:
        """Probability-like score in a feature array, ``CUT`` at the cut."""
        if not self.weights:
            return F.lit(1 - CUT)
        total = F.lit(-self.cut + float(np.log(CUT / (1 - CUT))))
        for index, weight in enumerate(self.weights):
            total = total + F.get(vector, F.lit(index)) * F.lit(weight)
        return 1 / (1 + F.exp(-total))


def fit_pairs(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Weights that rank rows of ``good`` over rows of ``bad``; pairs are drawn anew each step."""
    rng = np.random.default_rng(SEED)
    weights = np.zeros(good.shape[1])
    speed, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, STEPS + 1):
        difference = good[rng.integers(len(good), size=PAIRS_PER_STEP)] - bad[rng.integers(len(bad), size=PAIRS_PER_STEP)]
        margin = np.clip(difference @ weights, -30, 30)
        slope = -(difference.T @ (1 / (1 + np.exp(margin)))) / PAIRS_PER_STEP + DECAY * weights
        speed = 0.9 * speed + 0.1 * slope
        square = 0.999 * square + 0.001 * slope * slope
        weights -= LEARNING_RATE * (speed / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return weights


def best_cut(scores: np.ndarray, labels: np.ndarray) -> float:
    """The quantile of the scores that labels most rows rightly when it and all above are kept."""
    order = np.sort(scores)
    places = np.unique(np.linspace(0, len(order) - 1, QUANTILES).astype(int))
    kept_good = np.sort(scores[labels == 1])
    lost_bad = np.sort(scores[labels == 0])
    cuts = np.array([(order[p - 1] + order[p]) / 2 if p else order[0] - 1 for p in places])
    right = len(kept_good) - np.searchsorted(kept_good, cuts) + np.searchsorted(lost_bad, cuts)
    return float(cuts[np.argmax(right)])


def best_cut_of(scored: DataFrame) -> float:
    """``best_cut`` of ``label, score`` rows, from running counts per distinct score; the driver gets the quantiles."""
    points = reliable_checkpoint(evaluation.curve(scored))
    good, bad = points.select("positives", "negatives").first()
    count = good + bad
    places = np.unique(np.linspace(0, count - 1, QUANTILES).astype(int)).tolist()
    # A score stands at the places ``first`` to ``end - 1`` of all in order.
    ranked = points.select("score", (F.lit(count) - F.col("tp") - F.col("fp")).alias("first"), "pos", "neg", "tp", "fp").withColumn(
        "end", F.col("first") + F.col("pos") + F.col("neg")
    )
    asked = F.array(*[F.lit(p).cast("long") for p in sorted({q for p in places for q in (max(p - 1, 0), p)})])
    rows = sorted(ranked.where(F.exists(asked, lambda p: (p >= F.col("first")) & (p < F.col("end")))).collect(), key=lambda r: r["first"])
    firsts = np.array([r["first"] for r in rows])
    at = [rows[int(np.searchsorted(firsts, p, side="right")) - 1] for p in places]
    below = [rows[int(np.searchsorted(firsts, max(p - 1, 0), side="right")) - 1] for p in places]
    cuts = [(b["score"] + a["score"]) / 2 if p else a["score"] - 1 for p, b, a in zip(places, below, at)]
    right = [a["tp"] + bad - a["fp"] for a in at]
    return float(cuts[int(np.argmax(right))])


def train(vectors: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Ranker:
    """Fit on ``doc_id, features`` rows outside fold 0 that have a quality label, about ``max_labelled`` ids a trainer."""
    ship_package(vectors.sparkSession)
    marked = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("int").alias("label")
    )
    usable = vectors.join(marked.where(fold(F.col("doc_id")) != 0), "doc_id")
    # One row per labelled id, so rows that repeat an id count once.
    rows = reliable_checkpoint(
        usable.groupBy("doc_id", "label").agg(F.min_by("features", F.xxhash64("features")).alias("features"))
    )
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Ranker((), 0.0)
    # One row per feature.
    moments = rows.select(F.posexplode("features")).groupBy("pos").agg(F.avg("col").alias("m"), F.stddev_pop("col").alias("s")).orderBy("pos").collect()
    centre, spread = np.array([r["m"] for r in moments]), np.array([r["s"] for r in moments])
    # A constant differs from its mean by rounding only.
    spread[spread <= 1e-12 * np.maximum(1, np.abs(centre))] = 1
    # Every trainer needs some of both labels.
    trainers = max(1, min(-(-sum(counts.values()) // max_labelled), min(counts.values()) // 4))

    def fit_part(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc_id")
        scaled, label = (np.stack(part["features"].to_numpy()) - centre) / spread, part["label"].to_numpy()
        if len(np.unique(label)) < 2:
            return pd.DataFrame({"trainer": [], "seen": [], "weights": []})
        return pd.DataFrame({"trainer": part["trainer"].iloc[:1], "seen": [len(part)], "weights": [fit_pairs(scaled[label == 1], scaled[label == 0])]})

    # By a hash of the id; a part that has one label only has no pairs.
    dealt = rows.withColumn("trainer", F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(trainers)).cast("int"))
    fitted = dealt.groupBy("trainer").applyInPandas(fit_part, "trainer int, seen long, weights array<double>")
    # 55 numbers per trainer.
    found = fitted.orderBy("trainer").collect()
    if not found:
        return Ranker((), 0.0)
    weights = np.average([r["weights"] for r in found], axis=0, weights=[r["seen"] for r in found])
    own = weights / spread
    score = F.lit(0.0)
    for index, weight in enumerate(own.tolist()):
        score = score + F.get("features", F.lit(index)) * F.lit(weight)
    return Ranker(tuple(map(float, own)), best_cut_of(rows.select("label", score.alias("score"))))


def score_documents(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    vectors = reliable_checkpoint(features(documents))
    ranker = train(vectors, labels, max_labelled)
    scored = vectors.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), ranker.score(F.col("features")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows that the ranking does not reject, all columns kept and no row moved."""
    vectors = reliable_checkpoint(
        features(documents.join(labels.select("doc_id").distinct(), "doc_id", "left_semi"))
    )
    ranker = train(vectors, labels, max_labelled)
    name = common.free_name(documents, "quality_score")
    vector = common.free_name(documents, "quality_features")
    scored = documents.withColumn(vector, feature_column(F.col("text"))).withColumn(name, ranker.score(F.col(vector)))
    return scored.where(F.col(name) >= CUT).select(*documents.columns)
