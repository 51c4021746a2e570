from __future__ import annotations

import pytest
from league import GAMES, random_games
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from leaguelake.operators.ranking import rank_auc
from leaguelake.plans import metrics, model
from leaguelake.scale import stored

CUTOFF = "2024-03-15"


@pytest.fixture(scope="module")
def matches(spark):
    games = spark.createDataFrame(random_games(600, 8, 100, seed=21), GAMES)
    dim = spark.createDataFrame([(i, f"Team {i}") for i in range(8)], "team_id long, team_name string")
    return stored(metrics.match_metrics(metrics.team_rows(games), dim), "matches")


def test_first_game_is_filled_with_neutral_values(matches):
    first = matches.where("home_win_rate is null and away_win_rate is null").limit(1)
    row = model.imputed(model.match_features(first)).first()
    for name in model.FEATURES[:12]:
        want = 0.5 if "win_rate" in name else 100.0 if "points" in name else 2.0
        assert row[name] == want, name
    for name in ("win_rate_diff", "avg_points_diff", "avg_points_against_diff", "form_last5_diff"):
        assert row[name] == 0.0, name
    assert row.rest_days_diff == 2.0 and row.home_advantage == 2.0


def test_nan_is_filled_too(matches):
    odd = matches.limit(1).withColumn("home_win_rate", F.lit(float("nan")))
    assert model.imputed(model.match_features(odd)).first().home_win_rate == 0.5


def test_known_values_are_kept(matches):
    full = matches.where("home_rest_days is not null and away_rest_days is not null").limit(1)
    row = model.imputed(model.match_features(full)).first()
    assert row.home_advantage == pytest.approx(row.home_rest_days * 0.02)
    assert row.rest_days_diff == row.home_rest_days - row.away_rest_days
    assert row.avg_points_against_diff == pytest.approx(
        row.away_avg_points_against - row.home_avg_points_against
    )


def test_train_predict_evaluate(matches):
    trained = model.train(matches, CUTOFF)
    assert trained.eval_on == "test"
    predicted = model.predictions(trained)
    assert len(predicted.columns) == 29
    assert predicted.where("game_date < DATE'2024-03-15'").isEmpty()
    assert predicted.count() == matches.where("game_date >= DATE'2024-03-15'").count()
    assert predicted.where("not win_probability_home between 0 and 1").isEmpty()
    assert predicted.where("(win_probability_home > 0.5) <> (prediction = 1)").isEmpty()
    weights = {r.feature: r.importance for r in model.importances(trained).collect()}
    assert list(weights) == model.FEATURES and sum(weights.values()) == pytest.approx(1.0)
    scores = model.evaluate(trained)
    assert set(scores) == {"train_auc", "train_accuracy", "test_auc", "test_accuracy"}
    assert all(0 <= v <= 1 for v in scores.values())
    table = model.confusion(predicted, "home_win", "prediction").collect()
    right = sum(r.n for r in table if r.home_win == r.prediction)
    assert right / predicted.count() == pytest.approx(scores["test_accuracy"])
    assert model.accuracy(predicted, "home_win", "prediction").first()[0] == pytest.approx(
        scores["test_accuracy"]
    )


def test_same_seed_same_probabilities(matches):
    first, second = (
        {r.game_id: r.win_probability_home for r in model.predictions(model.train(matches, CUTOFF)).collect()}
        for _ in range(2)
    )
    assert first == second


def test_empty_splits(matches):
    trained = model.train(matches, "2030-01-01")
    assert trained.eval_on == "train"
    assert set(model.evaluate(trained)) == {"train_auc", "train_accuracy"}
    with pytest.raises(RuntimeError):
        model.train(matches, "2000-01-01")


def test_rank_auc_equals_the_evaluator(matches):
    scored = matches.select(
        F.col("home_win").cast("double").alias("label"),
        F.round(F.coalesce("home_win_rate", F.lit(0.5)), 2).alias("p"),
    ).withColumn("raw", array_to_vector(F.array(1 - F.col("p"), "p")))
    evaluator = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="raw", numBins=0)
    assert rank_auc(scored, "p", "label").first()[0] == pytest.approx(evaluator.evaluate(scored))


NODES_SQL = """
WITH RECURSIVE walk AS (
    SELECT game_id, v, tree, 0 AS node FROM given, (SELECT DISTINCT tree FROM nodes)
    UNION ALL
    SELECT game_id, v, walk.tree, CASE WHEN v[nodes.feature] <= nodes.threshold THEN nodes."left" ELSE nodes."right" END
    FROM walk JOIN nodes ON nodes.tree = walk.tree AND nodes.node = walk.node WHERE nodes.feature IS NOT NULL),
scored AS (
    SELECT game_id, avg(home_share) AS p FROM walk JOIN nodes USING (tree, node) WHERE nodes.feature IS NULL GROUP BY game_id)
SELECT game_id, p, CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END FROM scored ORDER BY game_id"""

GAINS_SQL = """
SELECT feature, sum(share) / sum(sum(share)) OVER () FROM (
    SELECT feature, sum(gain * n) / sum(sum(gain * n)) OVER (PARTITION BY tree) AS share
    FROM nodes WHERE feature IS NOT NULL GROUP BY tree, feature) GROUP BY feature ORDER BY feature"""


def test_forest_equals_sql_over_its_node_table(spark, matches):
    """Probabilities, predictions and importances, by a second engine that walks down the trees."""
    import duckdb

    trained = model.train(matches, CUTOFF)
    nodes_frame = model.forest_nodes(trained)
    names = "[" + ", ".join(f"'{c}'" for c in model.FEATURES) + "]"
    con = duckdb.connect()
    con.register("nodes", nodes_frame.toPandas().astype({"left": "Int64", "right": "Int64"}))
    con.register("wide", trained.test.select("game_id", *model.FEATURES).toPandas())
    con.execute(f"CREATE VIEW given AS SELECT game_id, map({names}, [{', '.join(model.FEATURES)}]) AS v FROM wide")
    expected = con.execute(NODES_SQL).fetchall()
    found = model.predictions(trained)
    assert found.columns == [*model.PREDICTION_HEAD, *model.FEATURES] and len(found.columns) == 29
    rows = {r.game_id: r for r in found.collect()}
    assert len(expected) == len(rows) > 50 and len({round(p, 9) for _, p, _ in expected}) > 10
    for game, p, called in expected:
        assert rows[game].win_probability_home == pytest.approx(p, abs=1e-12)
        assert rows[game].prediction == called or p == pytest.approx(0.5)
    own = {r.feature: r.importance for r in model.importances(trained).collect()}
    gains = dict(con.execute(GAINS_SQL).fetchall())
    assert {f for f, x in own.items() if x > 0} == set(gains)
    assert all(own[f] == pytest.approx(gains[f], abs=1e-9) for f in gains)
    ours = {r.feature: r.importance for r in model.importances_by_nodes(nodes_frame).collect()}
    assert ours == pytest.approx(gains)


def test_joins_down_the_trees_equal_the_model(spark, matches):
    trained = model.train(matches, CUTOFF)
    nodes = model.forest_nodes(trained)
    assert nodes.groupBy("tree").count().count() == 10 and nodes.agg(F.max("node")).first()[0] <= 14
    joined = {r.game_id: r.win_probability_home for r in model.score_by_nodes(trained.test, nodes).collect()}
    assert joined == pytest.approx({r.game_id: r.win_probability_home for r in model.predictions(trained).collect()})


def test_the_forest_does_not_depend_on_how_files_are_cut(spark, matches):
    def forest():
        rows = model.forest_nodes(model.train(matches, CUTOFF)).collect()
        return sorted((r.tree, r.node, str(r.feature), r.threshold or 0.0, r.n, r.home_share) for r in rows)

    first = forest()
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.shuffle.partitions")
    old = {k: spark.conf.get(k) for k in names}
    try:
        for name, value in zip(names, ("9000", "1", "3"), strict=True):
            spark.conf.set(name, value)
        assert forest() == first
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
