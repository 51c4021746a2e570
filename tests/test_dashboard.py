from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from leaguelake.operators.buckets import date_histogram, histogram, ranges, split_terms, terms
from leaguelake.operators.ranking import rank_auc, rank_desc
from leaguelake.plans import dashboard

def n():
    return F.count(F.lit(1))


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(0.0, 0), (0.1, 0), (0.3, 1), (0.5, 1), (0.5, 0), (0.7, 1), (1.0, 1), (None, 1)]
    return spark.createDataFrame(rows, "win_probability_home double, home_win int")


def test_terms_skip_missing_keys_and_break_ties_by_key(spark):
    df = spark.createDataFrame(
        [("b", 1.0), ("a", 1.0), ("c", None), (None, 9.0), ("d", 0.5), ("d", None)], "k string, v double"
    )
    top = terms(df, "k", {"m": F.avg("v")}, 10, "m").collect()
    assert [tuple(r) for r in top] == [("a", 1.0), ("b", 1.0), ("d", 0.5), ("c", None)]
    assert [r.k for r in terms(df, "k", {"m": n()}, 2).collect()] == ["a", "b"]


def test_terms_sort_only_the_top(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id AS v")
    plan = terms(df, "k", {"m": F.avg("v")}, 3, "m")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_split_terms(spark):
    df = spark.createDataFrame(
        [("e", "a", 1), ("e", "b", 3), ("e", "c", 2), ("w", "d", 1), (None, "x", 9)],
        "c string, k string, v int",
    )
    rows = split_terms(df, "c", "k", {"m": F.sum("v")}, 2, "m").collect()
    assert sorted((r.c, r.position, r.k) for r in rows) == [("e", 1, "b"), ("e", 2, "c"), ("w", 1, "d")]


def test_probability_histogram_has_eleven_buckets(scored):
    rows = dashboard.probability_histogram(scored).orderBy("bucket").collect()
    assert [r.bucket for r in rows] == [i / 10 for i in range(11)]
    assert [r.matches for r in rows] == [1, 1, 0, 1, 0, 2, 0, 1, 0, 0, 1]


def test_histogram_bounds_never_cut_data(spark):
    df = spark.createDataFrame([(-7,), (-5,), (0,), (4,), (12,)], "v int")
    rows = histogram(df, "v", 5, {"n": n()}, (0, 5)).orderBy("bucket").collect()
    assert [tuple(r) for r in rows] == [
        (-10.0, 1), (-5.0, 1), (0.0, 2), (5.0, None), (10.0, 1),
    ]
    plain = histogram(df, "v", 5, {"n": n()}).orderBy("bucket").collect()
    assert [r.bucket for r in plain] == [-10.0, -5.0, 0.0, 10.0]


def test_histogram_of_nothing_still_shows_the_bounds(spark):
    empty = spark.createDataFrame([], "v double")
    assert histogram(empty, "v", 0.1, {"n": n()}, (0.0, 1.0)).count() == 11


def test_ranges_are_half_open_and_keep_empty_ones(scored):
    rows = ranges(scored, "win_probability_home", (0.0, 0.5, 0.9, 1.0), {"n": n()}).orderBy("range_from")
    assert [tuple(r) for r in rows.collect()] == [(0.0, 0.5, 3), (0.5, 0.9, 3), (0.9, 1.0, 1)]
    none = ranges(scored.limit(0), "win_probability_home", (0.0, 1.0), {"n": n()})
    assert [tuple(r) for r in none.collect()] == [(0.0, 1.0, None)]


def test_calibration_and_confidence(scored):
    rows = {r.range_from: (r.matches, r.home_win_rate) for r in dashboard.calibration(scored).collect()}
    assert rows == {0.0: (2, 0.0), 0.2: (1, 1.0), 0.4: (2, 0.5), 0.6: (1, 1.0), 0.8: (1, 1.0)}
    assert dashboard.confidence(scored).first()[0] == pytest.approx((1 + 0.8 + 0.4 + 0 + 0 + 0.4 + 1) / 7, abs=1e-6)


def test_accuracy_treats_one_half_both_ways(scored):
    row = dashboard.prediction_accuracy(scored.where("win_probability_home is not null")).first()
    assert row.accuracy == pytest.approx(5 / 7, abs=1e-6)
    assert row.accuracy_strict == pytest.approx(4 / 7, abs=1e-6)


def test_date_histogram(spark):
    df = spark.sql("SELECT DATE'2024-01-31' AS d, 1 AS v UNION ALL SELECT DATE'2024-02-01', 3 UNION ALL SELECT NULL, 9")
    rows = date_histogram(df, "d", "month", {"n": F.sum("v")}).collect()
    assert [(str(r.month), r.n) for r in rows] == [("2024-01-01", 1), ("2024-02-01", 3)]


def test_filters_combine(spark):
    df = spark.sql(
        "SELECT 2024 AS season, 'a' AS team_name, DATE'2024-12-01' AS game_date "
        "UNION ALL SELECT 2024, 'b', DATE'2024-12-31' UNION ALL SELECT 2023, 'a', DATE'2024-12-31'"
    )
    assert dashboard.filtered(df, seasons=[2024], teams=["a"]).count() == 1
    assert dashboard.filtered(df, start="2024-12-31", end="2024-12-31").count() == 2
    assert dashboard.last_days(df, "2024-12-31", 30).count() == 3
    assert dashboard.last_days(df, "2024-12-31", 29).count() == 2


@pytest.mark.parametrize("max_rows", [None, 3])
def test_ranks_equal_sql_rank(spark, max_rows):
    df = spark.range(200).selectExpr("id", "(id * 37 % 50) / 40.0 AS v").withColumn("v", F.col("v").cast("double"))
    df.unionByName(spark.sql("SELECT -1L AS id, CAST(NULL AS DOUBLE) AS v")).createOrReplaceTempView("t")
    ranked = rank_desc(spark.table("t"), "v", "r", max_rows=max_rows)
    expected = spark.sql("SELECT id, CASE WHEN v IS NOT NULL THEN rank() OVER (ORDER BY v DESC) END AS r FROM t")
    assert sorted(map(tuple, ranked.select("id", "r").collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("max_rows", [None, 2])
def test_auc_by_counting_pairs(scored, max_rows):
    rows = [r for r in scored.collect() if r[0] is not None]
    pairs = [(p[0], n[0]) for p in rows if p[1] for n in rows if not n[1]]
    wins = sum((p > n) + (p == n) / 2 for p, n in pairs)
    found = rank_auc(scored, "win_probability_home", "home_win", max_rows).first()[0]
    assert found == pytest.approx(wins / len(pairs))


def test_wide_value_ranges_are_planned_in_few_steps(spark):
    df = spark.range(300).select("id", (F.pow(F.lit(1.2), F.col("id")) - 1e9).alias("v"))
    ranked = rank_desc(df, "v", "r", max_rows=20)
    assert ranked.where("r <> 300 - id").isEmpty()
    same = df.withColumn("v", F.lit(2.5))
    assert rank_desc(same, "v", "r", max_rows=20).where("r <> 1").isEmpty()
    assert rank_desc(df.limit(0), "v", "r").count() == 0
