"""Home-win model: features, temporal split, random forest, evaluation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leaguelake.functions import difference_or_zero
from leaguelake.scale import scratch_path, stored

LABEL = "home_label"
TRAIN_ROWS = 500_000  # rows of one partition the forest is grown from
LEAST_PARTITIONS = 8

# Fixed list and order of the model inputs.
FEATURES = [
    "home_win_rate",
    "home_avg_points",
    "home_avg_points_against",
    "home_win_rate_last5",
    "home_avg_points_last5",
    "home_rest_days",
    "away_win_rate",
    "away_avg_points",
    "away_avg_points_against",
    "away_win_rate_last5",
    "away_avg_points_last5",
    "away_rest_days",
    "win_rate_diff",
    "avg_points_diff",
    "avg_points_against_diff",
    "rest_days_diff",
    "form_last5_diff",
    "home_advantage",
]

# Fixed columns of the prediction table ahead of the features.
PREDICTION_HEAD = [
    "game_id",
    "game_date",
    "home_team_id",
    "visitor_team_id",
    "home_team_score",
    "visitor_team_score",
    "home_win",
    "home_team_name",
    "away_team_name",
    "win_probability_home",
    "prediction",
]

# Neutral inputs for missing history, and the bonus per rest day of the home team.
NEUTRAL_WIN_RATE = 0.5
NEUTRAL_POINTS = 100.0
NEUTRAL_OTHER = 2.0
REST_BONUS = 0.02


def match_features(matches: DataFrame) -> DataFrame:
    """Add the label and the six engineered features.

    Differences against a missing side are 0.0, except the rest-day difference, which stays NULL.
    """

    def diff(plus: str, minus: str):
        return difference_or_zero(F.col(plus), F.col(minus))

    return matches.withColumns(
        {
            LABEL: F.col("home_win"),
            "win_rate_diff": diff("home_win_rate", "away_win_rate"),
            "avg_points_diff": diff("home_avg_points", "away_avg_points"),
            "avg_points_against_diff": diff("away_avg_points_against", "home_avg_points_against"),
            "rest_days_diff": F.col("home_rest_days") - F.col("away_rest_days"),
            "form_last5_diff": diff("home_win_rate_last5", "away_win_rate_last5"),
            "home_advantage": F.col("home_rest_days") * REST_BONUS,
        }
    )


def neutral_value(feature: str) -> float:
    """What stands in for a missing value, by the name of the feature."""
    if "win_rate" in feature:
        return NEUTRAL_WIN_RATE
    if "points" in feature:
        return NEUTRAL_POINTS
    return NEUTRAL_OTHER


def imputed(features: DataFrame) -> DataFrame:
    """All model inputs as doubles without NULL or NaN."""
    doubles = features.withColumns({c: F.col(c).cast("double") for c in FEATURES})
    return doubles.na.fill({c: neutral_value(c) for c in FEATURES})


def temporal_split(df: DataFrame, cutoff: str, day: str = "game_date") -> tuple[DataFrame, DataFrame]:
    """Labelled rows before ``cutoff`` and from it on."""
    labelled = df.where(F.col(LABEL).isNotNull())
    at = F.lit(cutoff).cast("date")
    return labelled.where(F.col(day) < at), labelled.where(F.col(day) >= at)


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    train: DataFrame
    test: DataFrame
    eval_on: str  # "test", or "train" when no row is dated from the cutoff on


def train(matches: DataFrame, cutoff: str, trees: int = 10, depth: int = 3, seed: int = 42) -> Trained:
    """Fit the forest on the matches before ``cutoff``.

    The inputs are written once, because they are read for training and for scoring. The forest's samples
    are drawn by partition and position, so training rows are dealt by a hash of the game into a number
    of partitions that follows from their count, and sorted there: the same matches and seed give the same
    forest, however many cores there are and however files are cut.
    """
    rows = stored(imputed(match_features(matches)), "features")
    before, after = temporal_split(rows, cutoff)
    if before.isEmpty():
        raise RuntimeError(f"no training rows before {cutoff}")
    eval_on = "train" if after.isEmpty() else "test"
    stages = [
        VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="skip"),
        RandomForestClassifier(
            featuresCol="features", labelCol=LABEL, numTrees=trees, maxDepth=depth, seed=seed
        ),
    ]
    parts = max(LEAST_PARTITIONS, -(-before.count() // TRAIN_ROWS))
    model = Pipeline(stages=stages).fit(before.repartition(parts, "game_id").sortWithinPartitions("game_id"))
    # a copy has no training summary, which holds the session: tasks that score would have to take it along
    return Trained(model.copy(), before, before if eval_on == "train" else after, eval_on)


def score(trained: Trained, rows: DataFrame) -> DataFrame:
    """Add ``win_probability_home`` and ``prediction``."""
    home = F.get(vector_to_array("probability"), F.lit(1))
    return trained.model.transform(rows).withColumn("win_probability_home", home)


def predictions(trained: Trained) -> DataFrame:
    """The prediction table: rows from the cutoff on."""
    return score(trained, trained.test).select(*PREDICTION_HEAD, *FEATURES)


def evaluate(trained: Trained) -> dict[str, float]:
    """AUC and accuracy on the training rows and on the evaluation rows."""
    auc = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="rawPrediction")
    accuracy = MulticlassClassificationEvaluator(
        labelCol=LABEL, predictionCol="prediction", metricName="accuracy"
    )
    result = {}
    parts = {"train": trained.train, trained.eval_on: trained.test}  # one part if there is no other
    for name, rows in parts.items():
        # Both measures read the scores, so the trees are evaluated once.
        scored = stored(
            score(trained, rows).select(LABEL, "rawPrediction", "prediction"), "scored"
        )
        result[f"{name}_auc"] = auc.evaluate(scored)
        result[f"{name}_accuracy"] = accuracy.evaluate(scored)
    return result


def importances(trained: Trained) -> DataFrame:
    """Importance of every feature, by name."""
    weights = trained.model.stages[-1].featureImportances.toArray()
    rows = [(name, float(weight)) for name, weight in zip(FEATURES, weights, strict=True)]
    spark = trained.train.sparkSession
    return spark.createDataFrame(rows, "feature string, importance double")


def forest_nodes(trained: Trained) -> DataFrame:
    """The trained trees as a table, one row per node: a row of matches goes ``left`` where its ``feature`` is at
    most ``threshold``, else ``right``; leaves have no feature. ``n`` and ``home_share`` are of the training
    rows that came here, ``gain`` is what the split gains."""
    spark = trained.train.sparkSession
    path = scratch_path(spark, "forest")
    trained.model.stages[-1].write().save(path)
    saved = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    inner = F.col("leftChild") >= 0
    names = F.array(*[F.lit(c) for c in FEATURES])
    stats = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    return stored(
        saved.select(
            F.col("treeID").alias("tree"),
            F.col("id").alias("node"),
            F.when(inner, F.get(names, F.col("split.featureIndex"))).alias("feature"),
            F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
            F.when(inner, F.col("leftChild")).alias("left"),
            F.when(inner, F.col("rightChild")).alias("right"),
            F.when(inner, F.col("gain")).alias("gain"),
            stats.alias("n"),
            (F.get("impurityStats", F.lit(1)) / stats).alias("home_share"),
        ),
        "forest-nodes",
    )


def score_by_nodes(rows: DataFrame, nodes: DataFrame, key: str = "game_id", depth: int = 3) -> DataFrame:
    """``key`` and ``win_probability_home`` from the node table: every row goes down all trees, one join a level.

    ``nodes`` has at most 2 ** (depth + 1) rows a tree; a row of ``rows`` is as many rows as there are trees
    until their shares are averaged.
    """
    trees = [r["tree"] for r in nodes.select("tree").distinct().collect()]
    table = F.broadcast(nodes.select("tree", "node", "feature", "threshold", "left", "right", "home_share"))
    values = F.create_map(*[x for c in FEATURES for x in (F.lit(c), F.col(c))])
    at = rows.select(key, values.alias("values"), F.explode(F.array(*map(F.lit, trees))).alias("tree"), F.lit(0).alias("node"))
    for _ in range(depth):
        below = F.when(F.col("values")[F.col("feature")] <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = at.join(table, ["tree", "node"]).select(
            key, "values", "tree", F.when(F.col("feature").isNull(), F.col("node")).otherwise(below).alias("node")
        )
    leaves = at.join(table, ["tree", "node"]).select(key, "home_share")
    return leaves.groupBy(key).agg(F.avg("home_share").alias("win_probability_home"))


def importances_by_nodes(nodes: DataFrame) -> DataFrame:
    """Importance of every feature from the node table: what its splits gain, per tree and then together."""
    gains = nodes.where("feature IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("n")).alias("gain"))
    # a row per feature and tree
    of_tree = gains.withColumn("share", F.col("gain") / F.sum("gain").over(Window.partitionBy("tree")))
    shares = of_tree.groupBy("feature").agg(F.sum("share").alias("share"))
    total = F.sum("share").over(Window.partitionBy())
    return shares.select("feature", (F.col("share") / total).alias("importance"))


def confusion(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    return scored.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def accuracy(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    hit = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    return scored.agg(F.avg(hit).alias("accuracy"))
