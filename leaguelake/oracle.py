"""The catalog's questions in SQL, for a second engine to answer on the same tables."""

from __future__ import annotations

# --- building blocks: name -> (blocks it reads, SQL) ---------------------------------------------

_BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {
    "games": (
        (),
        """
        SELECT o_orderkey AS game_id,
               CAST(o_orderdate AS DATE) AS game_date,
               CAST(YEAR(o_orderdate) AS INT) AS season,
               CAST(c_nationkey AS INT) AS home_team_id,
               CAST((c_nationkey + 1 + o_orderkey % 24) % 25 AS INT) AS visitor_team_id,
               CAST(80 + CAST(FLOOR(o_totalprice) AS BIGINT) % 61 AS INT) AS home_team_score,
               CAST(80 + (o_custkey * 7 + o_orderkey * 13) % 59 AS INT) AS visitor_team_score,
               LOWER(o_orderstatus) AS status
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    ),
    "raw_games": (
        ("games",),
        """
        SELECT game_id AS id, strftime(game_date, '%Y-%m-%d') || 'T00:00:00.000Z' AS date,
               CAST(season AS VARCHAR) AS season, UPPER(status) AS status,
               CAST(home_team_id AS BIGINT) AS home_id,
               CAST(visitor_team_id AS BIGINT) AS visitor_id,
               CAST(home_team_score AS VARCHAR) AS home_team_score,
               CAST(visitor_team_score AS VARCHAR) AS visitor_team_score
        FROM games""",
    ),
    "runs": (
        ("games",),
        """
        SELECT *, DATE '2001-09-01' AS dt FROM games WHERE season <= 1998
        UNION ALL
        SELECT * REPLACE ('final' AS status), DATE '2001-09-02' AS dt FROM games
        WHERE season >= 1998""",
    ),
    "current_games": (
        ("games",),
        """
        SELECT * REPLACE (CASE WHEN season >= 1998 THEN 'final' ELSE status END AS status)
        FROM games""",
    ),
    "teams": (
        (),
        """
        SELECT CAST(n_nationkey AS BIGINT) AS team_id, n_name AS team_name,
               regexp_replace(lower(n_name), '[^a-z0-9]+', '', 'g') AS team_name_norm,
               n_name AS city, 'T' || n_nationkey AS abbreviation, r_name AS conference,
               r_name || '-' || (n_nationkey % 2) AS division
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
    "raw_venues": (
        (),
        """
        SELECT CAST(k AS VARCHAR) AS "idTeam",
               CASE WHEN n_nationkey % 7 = 0 THEN 'Old ' ELSE '  ' END
                   || replace(n_name, '_', ' - ') || '! ' AS "strTeam",
               'Arena ' || k AS "strStadium", n_name AS "strLocation",
               CASE WHEN k % 5 = 0 THEN 'n/a' ELSE CAST(10000 + k * 37 AS VARCHAR) END
                   AS "intStadiumCapacity",
               'https://venue.example/' || k AS "strWebsite", CAST(NULL AS VARCHAR) AS "strBadge"
        FROM (SELECT s_nationkey, MIN(s_suppkey) AS k FROM supplier GROUP BY s_nationkey)
        JOIN nation ON s_nationkey = n_nationkey""",
    ),
    "venues": (
        ("raw_venues",),
        """
        SELECT "idTeam" AS thesportsdb_team_id, "strTeam" AS thesportsdb_team_name,
               regexp_replace(lower("strTeam"), '[^a-z0-9]+', '', 'g') AS team_name_norm,
               "strStadium" AS venue_name, "strLocation" AS venue_city,
               TRY_CAST("intStadiumCapacity" AS INT) AS venue_capacity,
               "strWebsite" AS team_website, "strBadge" AS team_badge
        FROM raw_venues""",
    ),
    "dim": (
        ("teams", "venues"),
        "SELECT * FROM teams LEFT JOIN venues USING (team_name_norm)",
    ),
    "sides": (
        ("games",),
        """
        SELECT game_id, game_date, season, home_team_id AS team_id,
               visitor_team_id AS opponent_id, home_team_score AS points_for,
               visitor_team_score AS points_against, 1 AS is_home,
               CASE WHEN home_team_score > visitor_team_score THEN 1 ELSE 0 END AS is_win
        FROM games
        UNION ALL
        SELECT game_id, game_date, season, visitor_team_id, home_team_id, visitor_team_score,
               home_team_score, 0,
               CASE WHEN visitor_team_score > home_team_score THEN 1 ELSE 0 END
        FROM games""",
    ),
    "sums": (
        ("sides",),
        """
        SELECT *,
               CAST(row_number() OVER w AS BIGINT) AS game_number,
               CAST(row_number() OVER w - 1 AS BIGINT) AS games_played,
               CAST(SUM(points_for) OVER past AS BIGINT) AS points_for_cum,
               CAST(SUM(points_against) OVER past AS BIGINT) AS points_against_cum,
               CAST(SUM(is_win) OVER past AS BIGINT) AS is_win_cum,
               CAST(SUM(points_for) OVER five AS BIGINT) AS points_for_last5,
               CAST(SUM(points_against) OVER five AS BIGINT) AS points_against_last5,
               CAST(SUM(is_win) OVER five AS BIGINT) AS is_win_last5,
               CAST(date_diff('day', LAG(game_date) OVER w, game_date) AS INT) AS rest_days
        FROM sides
        WINDOW w AS (PARTITION BY team_id ORDER BY game_date, game_id),
               past AS (PARTITION BY team_id ORDER BY game_date, game_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
               five AS (PARTITION BY team_id ORDER BY game_date, game_id
                        ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)""",
    ),
    "form": (
        ("sums",),
        """
        SELECT *,
               CASE WHEN games_played > 0 THEN is_win_cum / CAST(games_played AS DOUBLE) END
                   AS win_rate,
               CASE WHEN games_played > 0 THEN points_for_cum / CAST(games_played AS DOUBLE) END
                   AS avg_points_for,
               CASE WHEN games_played > 0
                    THEN points_against_cum / CAST(games_played AS DOUBLE) END
                   AS avg_points_against,
               is_win_last5 / 5.0E0 AS win_rate_last5,
               points_for_last5 / 5.0E0 AS avg_points_last5
        FROM sums""",
    ),
    "team": (
        ("form", "dim"),
        """
        SELECT game_id, game_date, season, team_id, team_name, conference, division, is_home,
               points_for, points_against, is_win, win_rate, avg_points_for, avg_points_against,
               win_rate_last5, avg_points_last5, rest_days,
               CAST(1.0 AS FLOAT) AS schedule_difficulty_next5,
               2.5E0 AS home_games_next5, 2.5E0 AS away_games_next5
        FROM form LEFT JOIN dim USING (team_id)""",
    ),
    "matches": (
        ("games", "team"),
        """
        SELECT g.game_id, g.game_date, g.season, g.home_team_id, g.visitor_team_id,
               g.home_team_score, g.visitor_team_score,
               CASE WHEN g.home_team_score > g.visitor_team_score THEN 1 ELSE 0 END AS home_win,
               h.team_name AS home_team_name, h.win_rate AS home_win_rate,
               h.avg_points_for AS home_avg_points,
               h.avg_points_against AS home_avg_points_against,
               h.win_rate_last5 AS home_win_rate_last5,
               h.avg_points_last5 AS home_avg_points_last5, h.rest_days AS home_rest_days,
               h.schedule_difficulty_next5 AS home_schedule_difficulty,
               h.home_games_next5 AS home_home_games_next5,
               h.away_games_next5 AS home_away_games_next5,
               a.team_name AS away_team_name, a.win_rate AS away_win_rate,
               a.avg_points_for AS away_avg_points,
               a.avg_points_against AS away_avg_points_against,
               a.win_rate_last5 AS away_win_rate_last5,
               a.avg_points_last5 AS away_avg_points_last5, a.rest_days AS away_rest_days,
               a.schedule_difficulty_next5 AS away_schedule_difficulty,
               a.home_games_next5 AS away_home_games_next5,
               a.away_games_next5 AS away_away_games_next5
        FROM games g
        LEFT JOIN team h ON h.game_id = g.game_id AND h.team_id = g.home_team_id AND h.is_home = 1
        LEFT JOIN team a
               ON a.game_id = g.game_id AND a.team_id = g.visitor_team_id AND a.is_home = 0""",
    ),
    "scored": (
        ("matches",),
        """
        SELECT *, ROUND(0.5E0 + 0.5E0 * (coalesce(home_win_rate, 0.5E0)
                                         - coalesce(away_win_rate, 0.5E0)), 6)
                  AS win_probability_home
        FROM matches""",
    ),
    "features": (
        ("matches",),
        """
        SELECT *, home_win AS home_label,
               coalesce(home_win_rate - away_win_rate, 0.0E0) AS win_rate_diff,
               coalesce(home_avg_points - away_avg_points, 0.0E0) AS avg_points_diff,
               coalesce(away_avg_points_against - home_avg_points_against, 0.0E0)
                   AS avg_points_against_diff,
               home_rest_days - away_rest_days AS rest_days_diff,
               coalesce(home_win_rate_last5 - away_win_rate_last5, 0.0E0) AS form_last5_diff,
               home_rest_days * 0.02E0 AS home_advantage
        FROM matches""",
    ),
    # Last known form of a team on a day, several games a day settled by the last of them.
    "daily": (
        ("form",),
        """
        SELECT team_id, game_date, arg_max(win_rate_last5, game_id) AS opponent_form
        FROM form WHERE win_rate_last5 IS NOT NULL GROUP BY team_id, game_date""",
    ),
    "numbered": (
        ("sides",),
        """
        SELECT *, row_number() OVER w AS seq,
               CASE WHEN date_diff('day', LAG(game_date) OVER w, game_date) <= 1 THEN 1 ELSE 0 END
                   AS is_b2b
        FROM sides WINDOW w AS (PARTITION BY team_id ORDER BY game_date, game_id)""",
    ),
}


def _strength_block(horizon: int) -> tuple[tuple[str, ...], str]:
    return (
        ("numbered", "daily"),
        f"""
        SELECT game_id, x.team_id, x.game_date,
               CAST(COUNT(n_is_home) FILTER (WHERE n_is_home = 1) AS INT)
                   AS home_games_next{horizon},
               CAST(COUNT(n_is_home) FILTER (WHERE n_is_home = 0) AS INT)
                   AS away_games_next{horizon},
               CAST(COUNT(n_is_home) FILTER (WHERE n_is_b2b = 1) AS INT)
                   AS b2b_games_next{horizon},
               AVG(opponent_form * (1 + 0.20E0 * (1 - n_is_home))
                   * (1 + 0.20E0 * n_is_b2b)) AS schedule_difficulty_next{horizon}
        FROM (SELECT t.game_id, t.team_id, t.game_date, n.is_home AS n_is_home,
                     n.is_b2b AS n_is_b2b, n.opponent_id AS n_opponent
              FROM numbered t LEFT JOIN numbered n
                ON n.team_id = t.team_id AND n.seq > t.seq AND n.seq <= t.seq + {horizon}) x
        ASOF LEFT JOIN daily d ON d.team_id = x.n_opponent AND d.game_date <= x.game_date
        GROUP BY game_id, x.team_id, x.game_date""",
    )


_BLOCKS["strength5"] = _strength_block(5)
_BLOCKS["strength10"] = _strength_block(10)
_BLOCKS["team_strength"] = (
    ("form", "dim", "strength5"),
    """
    SELECT f.game_id, team_name,
           CAST(s.schedule_difficulty_next5 AS FLOAT) AS schedule_difficulty_next5,
           CAST(s.home_games_next5 AS DOUBLE) AS home_games_next5,
           CAST(s.away_games_next5 AS DOUBLE) AS away_games_next5
    FROM form f JOIN strength5 s ON s.game_id = f.game_id AND s.team_id = f.team_id
    LEFT JOIN dim d ON d.team_id = f.team_id""",
)


def _needed(names: tuple[str, ...]) -> list[str]:
    found: list[str] = []
    for name in names:
        for inner in (*_needed(_BLOCKS[name][0]), name):
            if inner not in found:
                found.append(inner)
    return found


def _sql(*blocks: str, select: str) -> str:
    order = _needed(blocks)
    if not order:
        return select
    parts = [f"{name} AS ({_BLOCKS[name][1]})" for name in order]
    return f"WITH {', '.join(parts)}\n{select}"


def _avg(column: str) -> str:
    return f"ROUND(AVG({column}), 6)"


_RANKING = f"""{_avg("win_rate_last5")} AS win_rate, {_avg("avg_points_last5")} AS avg_points,
       ROUND(AVG(is_win) FILTER (WHERE is_home = 1) - AVG(is_win) FILTER (WHERE is_home = 0), 6)
           AS home_away_diff,
       {_avg("rest_days")} AS avg_rest_days"""

_RATES = "win_rate, avg_points_for, avg_points_against"
_NEXT5 = "schedule_difficulty_next5, home_games_next5, away_games_next5"
_LEADS = ", ".join(f"LEAD(is_home, {i}) OVER w AS next_is_home_{i}" for i in range(1, 6))
_HOME5 = " + ".join(f"coalesce(next_is_home_{i}, 0)" for i in range(1, 6))
_SIMPLE_DIFFICULTY = "ROUND(CAST(CAST(((5 - {x}.home5) * 0.20E0 + 5) / 5 AS FLOAT) AS DOUBLE), 6)"
_BLOCKS["simple5"] = (
    ("sides",),
    f"""
    SELECT game_id, team_id, {_HOME5} AS home5
    FROM (SELECT game_id, team_id, {_LEADS} FROM sides
          WINDOW w AS (PARTITION BY team_id ORDER BY game_date, game_id))""",
)

_HISTORY = ["win_rate", "avg_points", "avg_points_against", "win_rate_last5", "avg_points_last5",
            "rest_days"]
_INPUTS = [f"{side}_{c}" for side in ("home", "away") for c in _HISTORY] + [
    "win_rate_diff", "avg_points_diff", "avg_points_against_diff", "rest_days_diff",
    "form_last5_diff", "home_advantage",
]


def _filled(column: str) -> str:
    neutral = "0.5E0" if "win_rate" in column else "100.0E0" if "points" in column else "2.0E0"
    return f"coalesce(CAST({column} AS DOUBLE), {neutral}) AS {column}"


def _top(metric: str, column: str, size: int, key: str = "team_name", block: str = "team") -> str:
    return _sql(
        block,
        select=f"""SELECT {key}, {_avg(column)} AS {metric} FROM {block} WHERE {key} IS NOT NULL
        GROUP BY {key} ORDER BY {metric} DESC NULLS LAST, {key} LIMIT {size}""",
    )


_AUC = _sql(
    "scored",
    select="""SELECT ROUND((SUM(r) FILTER (WHERE home_win = 1)
               - CAST(SUM(home_win) AS DOUBLE) * (SUM(home_win) + 1) / 2)
              / (CAST(SUM(home_win) AS DOUBLE) * SUM(1 - home_win)), 6) AS auc
    FROM (SELECT home_win, rank() OVER (ORDER BY win_probability_home)
                 + (COUNT(*) OVER (PARTITION BY win_probability_home) - 1) / 2.0E0 AS r
          FROM scored)""",
)

_FORMATTED = """game_id, game_date, season, CAST(home_team_id AS BIGINT) AS home_team_id,
       CAST(visitor_team_id AS BIGINT) AS visitor_team_id, home_team_score, visitor_team_score,
       status"""

_STRENGTH_COLUMNS = """game_id, team_id,
       ROUND(schedule_difficulty_next{n}, 6) AS schedule_difficulty_next{n},
       home_games_next{n}, away_games_next{n}, b2b_games_next{n}"""


def _outcomes_sql(source: str, number: str, rows: int, faults: str) -> str:
    """What becomes of the records of dirty pages, of which every fourth breaks off."""
    return f"""SELECT outcome, CAST(COUNT(DISTINCT CASE WHEN outcome = 'unreadable payload' THEN id // {rows} ELSE -1 - id END) AS BIGINT) AS n,
        CAST(SUM(CASE WHEN outcome = 'good' THEN id END) AS BIGINT) AS id_sum,
        CAST(COUNT(DISTINCT CASE WHEN outcome = 'unreadable payload' THEN id // {rows} ELSE -1 - id END) AS BIGINT) AS n_consistent
        FROM (SELECT {number} AS id, CASE WHEN {number} // {rows} % 4 = 1 THEN 'unreadable payload' {faults} ELSE 'good' END AS outcome
              FROM {source}) GROUP BY outcome"""


ORACLE: dict[str, str] = {
    # sources
    "src_json_games": _sql("raw_games", select="SELECT * FROM raw_games"),
    "src_json_all_runs": _sql(
        "raw_games",
        select="""SELECT *, DATE '2001-09-01' AS dt FROM raw_games WHERE CAST(season AS INT) <= 1998
        UNION ALL
        SELECT * REPLACE ('FINAL' AS status), DATE '2001-09-02' FROM raw_games
        WHERE CAST(season AS INT) >= 1998""",
    ),
    "src_json_teams": _sql(
        "teams",
        select="""SELECT team_id AS id, team_name AS full_name, city, abbreviation, conference,
        division FROM teams""",
    ),
    "src_json_venues": _sql("raw_venues", select="SELECT * FROM raw_venues"),
    "src_parquet_run": _sql(
        "runs", select="SELECT * EXCLUDE (dt) FROM runs WHERE dt = DATE '2001-09-02'"
    ),
    "src_parquet_all_runs": _sql("runs", select="SELECT * FROM runs"),
    "json_unwrap": _sql("raw_games", select="SELECT * FROM raw_games"),
    "page_union": _sql("raw_games", select="SELECT * FROM raw_games"),
    "filter_season": _sql(
        "games", select="SELECT * FROM games WHERE season BETWEEN 1996 AND 1998"
    ),
    "filter_date_range": _sql(
        "games",
        select="""SELECT * FROM games
        WHERE game_date BETWEEN DATE '1997-03-01' AND DATE '1999-06-30'""",
    ),
    "incremental_slice": _sql(
        "games",
        select="""SELECT * FROM games
        WHERE game_date > (SELECT MAX(game_date) FROM games WHERE season <= 1998)""",
    ),
    "high_water_mark": _sql(
        "games",
        select="""SELECT strftime(MAX(game_date), '%Y-%m-%d') AS last_date,
        COUNT(*) AS last_game_count FROM games""",
    ),
    "raw_quarantine": _sql(
        "games",
        select="""SELECT CASE WHEN game_id // 100 % 10 = 3 THEN 'unreadable payload'
                           WHEN game_id % 50 = 7 THEN 'no id' ELSE 'good' END AS outcome,
               COUNT(DISTINCT CASE WHEN game_id // 100 % 10 = 3 THEN game_id // 100
                                   ELSE -1 - game_id END) AS n,
               CAST(SUM(CASE WHEN game_id // 100 % 10 <> 3 AND game_id % 50 <> 7
                             THEN game_id END) AS BIGINT) AS id_sum
        FROM games GROUP BY 1""",
    ),
    "raw_quarantine_teams": _sql("teams", select=_outcomes_sql("teams", "team_id", 5, "WHEN team_id % 7 = 3 THEN 'no id'")),
    "raw_quarantine_venues": _sql(
        "venues", select=_outcomes_sql("venues", "CAST(thesportsdb_team_id AS BIGINT)", 4, "WHEN CAST(thesportsdb_team_id AS BIGINT) % 6 = 2 THEN 'no id'")
    ),
    "raw_mistyped_games": _sql(
        "games",
        select=_outcomes_sql(
            "games",
            "game_id",
            100,
            "WHEN game_id % 40 = 3 THEN 'unreadable field: home_team' WHEN game_id % 40 = 9 THEN 'unreadable field: visitor_team'",
        ),
    ),
    "high_water_mark_dirty": _sql(
        "games",
        select="""SELECT strftime(MAX(game_date) FILTER (WHERE game_id % 11 <> 0), '%Y-%m-%d')
                      AS last_date, COUNT(*) AS last_game_count FROM games""",
    ),
    "dims_of_run": _sql("teams", select="SELECT * FROM teams"),
    "guard_nonempty": _sql(
        "games",
        "venues",
        select="""SELECT 'games' AS source, COUNT(*) AS n_rows FROM games
        UNION ALL SELECT 'venues', COUNT(*) FROM venues""",
    ),
    # sinks
    "sink_parquet_roundtrip": _sql("runs", select="SELECT * FROM runs"),
    "doc_json": _sql(
        "team",
        select="""SELECT team.*,
        CAST(20 - (CASE WHEN win_rate IS NULL THEN 1 ELSE 0 END)
                - (CASE WHEN avg_points_for IS NULL THEN 1 ELSE 0 END)
                - (CASE WHEN avg_points_against IS NULL THEN 1 ELSE 0 END)
                - (CASE WHEN win_rate_last5 IS NULL THEN 1 ELSE 0 END)
                - (CASE WHEN avg_points_last5 IS NULL THEN 1 ELSE 0 END)
                - (CASE WHEN rest_days IS NULL THEN 1 ELSE 0 END) AS INT) AS n_fields
        FROM team""",
    ),
    "doc_json_keep_nulls": _sql(
        "strength5",
        select="""SELECT game_id, team_id, game_date, home_games_next5, away_games_next5,
        b2b_games_next5, ROUND(schedule_difficulty_next5, 6) AS schedule_difficulty_next5,
        CAST(7 AS INT) AS n_fields FROM strength5""",
    ),
    "sink_bulk_ndjson": _sql("matches", select="SELECT * FROM matches"),
    "sink_bulk_requests": _sql(
        "games", select="SELECT COUNT(*) AS documents, COUNT(*) AS actions, TRUE AS within FROM games"
    ),
    "doc_batches": _sql(
        "games",
        select="""SELECT batch, COUNT(*) AS docs, MIN(game_date) AS first_date,
        MAX(game_date) AS last_date, CAST(SUM(game_id) AS BIGINT) AS id_sum
        FROM (SELECT *, CAST((row_number() OVER (ORDER BY game_date, game_id) - 1) // 500 AS BIGINT)
                     AS batch FROM games) GROUP BY batch""",
    ),
    "doc_batches_split": _sql(
        "games",
        select="""SELECT game_id,
        CAST((row_number() OVER (ORDER BY game_date, game_id) - 1) // 500 AS BIGINT) AS batch
        FROM games""",
    ),
    # cleaning
    "format_games": _sql("games", select=f"SELECT {_FORMATTED} FROM games"),
    "format_teams": _sql("teams", select="SELECT * FROM teams"),
    "format_venues": _sql("venues", select="SELECT * FROM venues"),
    "cast_date": """SELECT o_orderkey,
        CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS game_date
        FROM orders""",
    "cast_int": """SELECT s_suppkey,
        CAST(CASE WHEN s_suppkey % 5 <> 0 THEN 10000 + s_suppkey * 37 END AS INT) AS capacity
        FROM supplier""",
    "normalize_name": """SELECT c_custkey,
        regexp_replace(lower(c_name), '[^a-z0-9]+', '', 'g') AS name_norm FROM customer""",
    "home_win_flag": _sql(
        "games",
        select="""SELECT game_id,
        CASE WHEN home_team_score > visitor_team_score THEN 1 ELSE 0 END AS home_win
        FROM games""",
    ),
    # reshape and dedup
    "side_split": _sql("sides", select="SELECT * FROM sides"),
    "union_by_name": _sql("sides", select="SELECT * FROM sides"),
    "dedup_games": _sql(
        "runs",
        select="""SELECT * FROM runs
        QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY dt DESC) = 1""",
    ),
    "dedup_team_game": _sql("sides", select="SELECT * FROM sides"),
    "consolidate_runs": _sql("current_games", select=f"SELECT {_FORMATTED} FROM current_games"),
    # joins
    "team_dim": _sql("dim", select="SELECT * FROM dim"),
    "team_metrics": _sql("team", select="SELECT * FROM team"),
    "match_metrics": _sql("matches", select="SELECT * FROM matches"),
    "team_metrics_strength": _sql(
        "team",
        "strength5",
        "strength10",
        select="""SELECT t.* REPLACE (
            ROUND(CAST(CAST(s.schedule_difficulty_next5 AS FLOAT) AS DOUBLE), 6)
                AS schedule_difficulty_next5,
            CAST(s.home_games_next5 AS DOUBLE) AS home_games_next5,
            CAST(s.away_games_next5 AS DOUBLE) AS away_games_next5),
            ROUND(x.schedule_difficulty_next10, 6) AS schedule_difficulty_next10,
            s.b2b_games_next5, sos_rank
        FROM team t JOIN strength5 s ON s.game_id = t.game_id AND s.team_id = t.team_id
        JOIN strength10 x ON x.game_id = t.game_id AND x.team_id = t.team_id
        LEFT JOIN (SELECT team_id, rank() OVER (ORDER BY d DESC) AS sos_rank
              FROM (SELECT team_id, ROUND(schedule_difficulty_next5, 6) AS d,
                           row_number() OVER (PARTITION BY team_id
                                              ORDER BY game_date DESC, game_id DESC) AS k
                    FROM strength5 WHERE schedule_difficulty_next5 IS NOT NULL)
              WHERE k = 1) r ON r.team_id = t.team_id""",
    ),
    "match_metrics_simple": _sql(
        "matches",
        "simple5",
        select=f"""SELECT m.* REPLACE (
            {_SIMPLE_DIFFICULTY.format(x="h")} AS home_schedule_difficulty,
            CAST(h.home5 AS DOUBLE) AS home_home_games_next5,
            CAST(5 - h.home5 AS DOUBLE) AS home_away_games_next5,
            {_SIMPLE_DIFFICULTY.format(x="a")} AS away_schedule_difficulty,
            CAST(a.home5 AS DOUBLE) AS away_home_games_next5,
            CAST(5 - a.home5 AS DOUBLE) AS away_away_games_next5)
        FROM matches m
        JOIN simple5 h ON h.game_id = m.game_id AND h.team_id = m.home_team_id
        JOIN simple5 a ON a.game_id = m.game_id AND a.team_id = m.visitor_team_id""",
    ),
    "opponent_form_asof": _sql(
        "sides",
        "daily",
        select="""SELECT s.game_id, s.team_id, s.opponent_id, d.opponent_form
        FROM sides s ASOF LEFT JOIN daily d
          ON d.team_id = s.opponent_id AND d.game_date <= s.game_date""",
    ),
    # windows
    "game_number": _sql("sums", select="SELECT game_id, team_id, game_number FROM sums"),
    "prior_cumulative": _sql(
        "sums",
        select="""SELECT game_id, team_id, games_played, points_for_cum, points_against_cum,
        is_win_cum FROM sums""",
    ),
    "entering_rates": _sql("form", select=f"SELECT game_id, team_id, {_RATES} FROM form"),
    "rolling_last5": _sql(
        "sums",
        select="""SELECT game_id, team_id, points_for_last5, points_against_last5, is_win_last5
        FROM sums""",
    ),
    "form_last5": _sql(
        "form", select="SELECT game_id, team_id, win_rate_last5, avg_points_last5 FROM form"
    ),
    "form_last5_actual": _sql(
        "sums",
        select="""SELECT game_id, team_id,
        is_win_last5 / CAST(least(games_played, 5) AS DOUBLE) AS win_rate_last5,
        points_for_last5 / CAST(least(games_played, 5) AS DOUBLE) AS avg_points_last5
        FROM sums""",
    ),
    "form_by_season": _sql(
        "sides",
        select="""SELECT game_id, team_id, season, row_number() OVER w - 1 AS games_played,
               CASE WHEN row_number() OVER w > 1
                    THEN SUM(is_win) OVER past / CAST(row_number() OVER w - 1 AS DOUBLE) END
               AS win_rate,
               CAST(date_diff('day', LAG(game_date) OVER w, game_date) AS INT) AS rest_days
        FROM sides
        WINDOW w AS (PARTITION BY team_id, season ORDER BY game_date, game_id),
               past AS (PARTITION BY team_id, season ORDER BY game_date, game_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    ),
    "rest_days": _sql("sums", select="SELECT game_id, team_id, rest_days FROM sums"),
    "team_form_split": _sql(
        "form",
        select=f"""SELECT game_id, team_id, games_played, {_RATES}, win_rate_last5,
        avg_points_last5, rest_days FROM form""",
    ),
    "customer_orders_before": """SELECT o_orderkey AS orderkey, o_custkey AS custkey,
               CAST(row_number() OVER w - 1 AS BIGINT) AS games_played,
               CAST(SUM(CAST(FLOOR(o_totalprice) AS BIGINT)) OVER past AS BIGINT) AS price_cum
        FROM orders
        WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey),
               past AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "user_events_last5": """SELECT event_id, user_id,
               CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) OVER (PARTITION BY user_id
                    ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS BIGINT)
               AS cents_last5
        FROM events""",
    # schedule
    "schedule_stub": _sql("team", select=f"SELECT game_id, team_id, {_NEXT5} FROM team"),
    "next_is_home": _sql(
        "sides",
        select=f"""SELECT game_id, team_id, {_LEADS} FROM sides
        WINDOW w AS (PARTITION BY team_id ORDER BY game_date, game_id)""",
    ),
    "schedule_simple_next5": _sql(
        "simple5",
        select="""SELECT game_id, team_id, CAST(home5 AS INT) AS home_games_next5,
               CAST(5 - home5 AS INT) AS away_games_next5,
               ROUND(((5 - home5) * 0.20E0 + 5) / 5, 6) AS schedule_difficulty_next5
        FROM simple5""",
    ),
    "schedule_counts": _sql(
        "strength5",
        select="""SELECT game_id, team_id, home_games_next5, away_games_next5, b2b_games_next5
        FROM strength5""",
    ),
    "schedule_strength_next5": _sql(
        "strength5", select=f"SELECT {_STRENGTH_COLUMNS.format(n=5)} FROM strength5"
    ),
    "schedule_strength_next10": _sql(
        "strength10", select=f"SELECT {_STRENGTH_COLUMNS.format(n=10)} FROM strength10"
    ),
    "schedule_strength_split": _sql(
        "strength5", select=f"SELECT {_STRENGTH_COLUMNS.format(n=5)} FROM strength5"
    ),
    "sos_rank": _sql(
        "strength5",
        select="""SELECT team_id, game_id, schedule_difficulty_next5,
        CAST(rank() OVER (ORDER BY schedule_difficulty_next5 DESC) AS BIGINT) AS sos_rank
        FROM (SELECT * REPLACE (ROUND(schedule_difficulty_next5, 6) AS schedule_difficulty_next5)
              FROM strength5 WHERE schedule_difficulty_next5 IS NOT NULL
              QUALIFY row_number() OVER (PARTITION BY team_id
                      ORDER BY game_date DESC, game_id DESC) = 1)""",
    ),
    # dashboard
    "dash_win_rate_by_team": _top("win_rate", "win_rate_last5", 30),
    "dash_win_rate_top10": _top("win_rate", "win_rate_last5", 10),
    "dash_avg_points_by_team": _top("avg_points", "avg_points_last5", 30),
    "dash_home_away_games": _sql(
        "team", select="SELECT is_home, COUNT(*) AS games FROM team GROUP BY is_home"
    ),
    "dash_home_away_wins": _sql(
        "team",
        select="SELECT is_home, CAST(SUM(is_win) AS BIGINT) AS wins FROM team GROUP BY is_home",
    ),
    "dash_prob_histogram": _sql(
        "scored",
        select="""SELECT b / 10.0E0 AS bucket, COUNT(win_probability_home) AS matches
        FROM range(0, 11) r(b) LEFT JOIN scored
          ON CAST(FLOOR(win_probability_home * 10) AS BIGINT) = b
        GROUP BY b""",
    ),
    "dash_prob_histogram_025": _sql(
        "scored",
        select="""SELECT b / 4.0E0 AS bucket, COUNT(win_probability_home) AS matches
        FROM range(0, 5) r(b) LEFT JOIN scored
          ON CAST(FLOOR(CAST(win_probability_home AS DECIMAL(9,6)) * 4) AS BIGINT) = b
        GROUP BY b""",
    ),
    "dash_prob_histogram_03": _sql(
        "scored",
        select="""SELECT CAST(b * 0.3 AS DOUBLE) AS bucket, COUNT(win_probability_home) AS matches
        FROM range(0, 4) r(b) LEFT JOIN scored
          ON win_probability_home >= CAST(b * 0.3 AS DOUBLE)
             AND win_probability_home < CAST((b + 1) * 0.3 AS DOUBLE)
        GROUP BY b""",
    ),
    "dash_form_vs_result_025": _sql(
        "matches",
        select="""SELECT FLOOR(home_win_rate_last5 * 4) / 4 AS form, home_win, COUNT(*) AS matches
        FROM matches WHERE home_win_rate_last5 IS NOT NULL GROUP BY 1, 2""",
    ),
    "dash_filtered_matches": _sql(
        "matches",
        select="""SELECT game_id, home_team_name, away_team_name FROM matches
        WHERE home_team_name IN ('NATION_1', 'NATION_2') OR away_team_name IN ('NATION_1', 'NATION_2')""",
    ),
    "dash_win_rate_by_conference": _top("win_rate", "win_rate_last5", 2, "conference"),
    "dash_rest_days": _sql(
        "team",
        select=f"""SELECT rest_days, {_avg("win_rate_last5")} AS win_rate FROM team
        WHERE rest_days IS NOT NULL GROUP BY rest_days ORDER BY rest_days LIMIT 10""",
    ),
    "dash_pred_accuracy": _sql(
        "scored",
        select="""SELECT
        ROUND(AVG(CASE WHEN (home_win > 0.5E0) = (win_probability_home > 0.5E0) THEN 1.0E0
                       ELSE 0.0E0 END), 6) AS accuracy,
        ROUND(AVG(CASE WHEN (home_win = 1 AND win_probability_home > 0.5E0)
                         OR (home_win = 0 AND win_probability_home < 0.5E0) THEN 1.0E0
                       ELSE 0.0E0 END), 6) AS accuracy_strict
        FROM scored""",
    ),
    "dash_team_ranking": _sql(
        "team",
        select=f"""SELECT team_name, {_RANKING} FROM team GROUP BY team_name
        ORDER BY win_rate DESC, team_name LIMIT 30""",
    ),
    "dash_team_ranking_by_conference": _sql(
        "team",
        select=f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY conference
                   ORDER BY win_rate DESC NULLS LAST, team_name) AS INT) AS position
        FROM (SELECT conference, team_name, {_RANKING} FROM team GROUP BY conference, team_name))
        WHERE position <= 30""",
    ),
    "dash_home_win_monthly": _sql(
        "matches",
        select=f"""SELECT CAST(date_trunc('month', game_date) AS DATE) AS month,
        {_avg("home_win")} AS home_win_rate FROM matches GROUP BY 1""",
    ),
    "dash_score_diff_hist": _sql(
        "matches",
        select="""SELECT FLOOR((home_team_score - visitor_team_score) / 5.0E0) * 5 AS bucket,
        COUNT(*) AS matches FROM matches GROUP BY 1""",
    ),
    "dash_form_vs_result": _sql(
        "matches",
        select="""SELECT ROUND(home_win_rate_last5, 1) AS form, home_win, COUNT(*) AS matches
        FROM matches WHERE home_win_rate_last5 IS NOT NULL GROUP BY 1, 2""",
    ),
    "dash_calibration": _sql(
        "scored",
        select=f"""SELECT range_from, range_to, COUNT(win_probability_home) AS matches,
               {_avg("home_win")} AS home_win_rate
        FROM (VALUES (0.0E0, 0.2E0), (0.2E0, 0.4E0), (0.4E0, 0.6E0), (0.6E0, 0.8E0),
                     (0.8E0, 1.0E0)) r(range_from, range_to)
        LEFT JOIN scored ON win_probability_home >= range_from
             AND (win_probability_home < range_to
                  OR (range_to = 1.0E0 AND win_probability_home = 1.0E0))
        GROUP BY 1, 2""",
    ),
    "dash_confidence": _sql(
        "scored",
        select="SELECT ROUND(AVG(ABS(win_probability_home - 0.5E0) * 2), 6) AS confidence FROM scored",
    ),
    "dash_schedule_by_team": _top(
        "schedule_difficulty", "schedule_difficulty_next5", 30, block="team_strength"
    ),
    "dash_sos_table": _sql(
        "team_strength",
        select=f"""SELECT team_name, {_avg("schedule_difficulty_next5")} AS schedule_difficulty,
        {_avg("home_games_next5")} AS home_games, {_avg("away_games_next5")} AS away_games
        FROM team_strength GROUP BY team_name
        ORDER BY schedule_difficulty DESC, team_name LIMIT 30""",
    ),
    "dash_next5_home_away": _sql(
        "team_strength",
        select="""SELECT 'home' AS side, SUM(home_games_next5) AS games
        FROM team_strength
        UNION ALL SELECT 'away', SUM(away_games_next5) FROM team_strength""",
    ),
    "dash_filtered": _sql(
        "team",
        select="""SELECT game_id, team_id, team_name, win_rate, win_rate_last5 FROM team
        WHERE season IN (1999, 2000) AND team_name IN ('NATION_1', 'NATION_2', 'NATION_3')
          AND game_date BETWEEN DATE '1999-10-01' AND DATE '2000-07-01'""",
    ),
    "dash_last_30_days": _sql(
        "team",
        select="""SELECT game_id, game_date, team_id, avg_points_last5 FROM team
        WHERE game_date BETWEEN DATE '2001-08-01' - 30 AND DATE '2001-08-01'""",
    ),
    "baseline_home": _sql(
        "matches",
        select=f"""SELECT {_avg("home_win")} AS baseline FROM matches
        WHERE game_date >= DATE '2000-01-01'""",
    ),
    "peek_latest": _sql(
        "matches",
        select="""SELECT game_id, game_date, home_team_name, away_team_name, home_win FROM matches
        ORDER BY game_date DESC, game_id DESC LIMIT 10""",
    ),
    # model
    "match_features": _sql(
        "features",
        select=f"SELECT game_id, home_label, {', '.join(_INPUTS[-6:])} FROM features",
    ),
    "imputed_features": _sql(
        "features", select=f"SELECT game_id, {', '.join(map(_filled, _INPUTS))} FROM features"
    ),
    "temporal_split": _sql(
        "matches",
        select="""SELECT CASE WHEN game_date < DATE '2000-01-01' THEN 'train' ELSE 'test' END
        AS part, COUNT(*) AS n, CAST(SUM(home_win) AS BIGINT) AS home_wins
        FROM matches GROUP BY 1""",
    ),
    "auc_rank": _AUC,
    "auc_rank_split": _AUC,
    "accuracy": _sql(
        "scored",
        select="""SELECT ROUND(AVG(CASE WHEN home_win = CAST(win_probability_home > 0.5E0 AS INT)
        THEN 1.0E0 ELSE 0.0E0 END), 6) AS accuracy FROM scored""",
    ),
    "confusion": _sql(
        "scored",
        select="""SELECT home_win, CAST(win_probability_home > 0.5E0 AS INT) AS prediction,
        COUNT(*) AS n FROM scored GROUP BY 1, 2""",
    ),
    # stream
    "stream_incremental": _sql(
        "current_games", select=f"SELECT {_FORMATTED} FROM current_games"
    ),
}

ORACLE["sink_changes"] = ORACLE["sink_bulk_ndjson"]
ORACLE["sink_change_counts"] = _sql(
    "matches",
    select="""SELECT kind, COUNT(*) AS documents, CAST(SUM(id) AS BIGINT) AS id_sum FROM (
        SELECT 'new' AS kind, game_id AS id FROM matches WHERE season > 1998
        UNION ALL SELECT 'changed', game_id FROM matches WHERE season = 1998
        UNION ALL SELECT 'gone', -game_id - 1 FROM matches WHERE season = 1998)
    GROUP BY kind""",
)
# the panels from the cube answer what those from rows answer
_CUBE = {"win_rate_by_rest_days": "rest_days"}
ORACLE |= {
    f"cube_{panel}": ORACLE[f"dash_{_CUBE.get(panel, panel)}"]
    for panel in (
        "win_rate_by_team", "avg_points_by_team", "home_away_games", "home_away_wins", "win_rate_by_conference",
        "win_rate_by_rest_days", "team_ranking", "team_ranking_by_conference", "schedule_by_team", "sos_table",
        "next5_home_away",
    )
}
ORACLE["cube_ranking_in_range"] = _sql(
    "team",
    select=f"""SELECT team_name, {_RANKING} FROM team
    WHERE team_name IS NOT NULL AND game_date BETWEEN DATE '1996-03-17' AND DATE '1999-10-05'
    GROUP BY team_name ORDER BY win_rate DESC NULLS LAST, team_name LIMIT 30""",
)
ORACLE["cube_cells"] = _sql(
    "team",
    select="""SELECT game_date, season, team_name, conference, is_home, rest_days, COUNT(*) AS rows,
    CAST(SUM(is_win) AS BIGINT) AS wins, ROUND(CAST(SUM(CAST(avg_points_last5 AS DECIMAL(28, 12))) AS DOUBLE), 6) AS points,
    COUNT(rest_days) AS rested
    FROM team GROUP BY game_date, season, team_name, conference, is_home, rest_days""",
)
ORACLE["form_table"] = ORACLE["team_form_split"]
ORACLE["stream_upsert"] = ORACLE["stream_incremental"]
ORACLE["user_events_last5_split"] = ORACLE["user_events_last5"]
ORACLE["sos_rank_split"] = ORACLE["sos_rank"]
# what is certain about a forest: inputs, ranges, and measures computed in two ways
ORACLE["rf_predictions_valid"] = _sql(
    "features",
    select=f"""SELECT game_id, game_date, home_team_id, visitor_team_id, home_team_score,
    visitor_team_score, home_win, home_team_name, away_team_name,
    {", ".join(_filled(c) for c in _INPUTS)}, TRUE AS probability_valid, TRUE AS prediction_agrees
    FROM features WHERE game_date >= DATE '2000-01-01'""",
)
ORACLE["rf_importance_valid"] = f"""SELECT feature, TRUE AS valid, TRUE AS sum_is_one
    FROM (SELECT unnest([{", ".join(repr(c) for c in _INPUTS)}]) AS feature)"""
ORACLE["rf_evaluation"] = """SELECT unnest(['test_auc', 'test_accuracy']) AS measure, TRUE AS agrees"""
ORACLE["rf_score_by_nodes"] = _sql("games", select="SELECT game_id, TRUE AS agrees FROM games WHERE game_date >= DATE '2000-01-01'")
