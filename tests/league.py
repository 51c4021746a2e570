"""Small leagues, and the same features computed by hand in plain Python."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

GAMES = (
    "game_id long, game_date date, season int, home_team_id long, visitor_team_id long, "
    "home_team_score int, visitor_team_score int, status string"
)

GOLDEN = [
    (1, dt.date(2024, 10, 22), 2024, 1, 2, 110, 100, "final"),
    (2, dt.date(2024, 10, 24), 2024, 2, 1, 105, 99, "final"),
    (3, dt.date(2024, 10, 25), 2024, 1, 2, 120, 115, "final"),
    (4, dt.date(2024, 10, 29), 2024, 1, 2, 90, 101, "final"),
    (5, dt.date(2024, 10, 31), 2024, 2, 1, 88, 97, "final"),
    (6, dt.date(2024, 11, 1), 2024, 1, 2, 130, 125, "final"),
    (7, dt.date(2024, 11, 5), 2024, 2, 1, 111, 111, "final"),
]


def random_games(
    n: int,
    teams: int,
    days: int,
    seed: int,
    hot_team: float = 0.0,
    hot_day: float = 0.0,
    null_team: float = 0.0,
    ids=None,
):
    rng = random.Random(seed)
    games = []
    for i in range(n):
        home, visitor = rng.sample(range(teams), 2)
        if rng.random() < hot_team:
            home, visitor = 0, rng.randrange(1, teams)
        if rng.random() < null_team:
            home = None
        day = 5 if rng.random() < hot_day else rng.randrange(days)
        score = [None if rng.random() < 0.03 else rng.randrange(80, 140) for _ in range(2)]
        date = dt.date(2024, 1, 1) + dt.timedelta(days=day)
        game_id = ids(i) if ids else i
        games.append((game_id, date, 2024, home, visitor, *score, "final"))
    rng.shuffle(games)
    return games


def side_rows(games):
    """(team, day, game, scored, conceded, is_home, is_win, opponent) of both sides."""
    rows = []
    for game_id, day, _, home, visitor, hs, vs, _ in games:
        for team, opp, scored, conceded, is_home in (
            (home, visitor, hs, vs, 1),
            (visitor, home, vs, hs, 0),
        ):
            win = int(scored is not None and conceded is not None and scored > conceded)
            rows.append((team, day, game_id, scored, conceded, is_home, win, opp))
    return rows


def _total(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


def expected_form(games, n=5):
    by_team = defaultdict(list)
    for row in side_rows(games):
        by_team[row[0]].append(row)
    out = {}
    for team, rows in by_team.items():
        rows.sort(key=lambda r: (r[1], r[2]))
        for i, row in enumerate(rows):
            past, five = rows[:i], rows[max(0, i - n) : i]
            last = _total([r[3] for r in five])
            cum = [_total([r[k] for r in past]) for k in (3, 4, 6)]
            out[(row[2], team, row[5])] = {
                "games_played": i,
                "win_rate": cum[2] / i if i else None,
                "avg_points_for": cum[0] / i if i and cum[0] is not None else None,
                "avg_points_against": cum[1] / i if i and cum[1] is not None else None,
                "win_rate_last5": sum(r[6] for r in five) / n if last is not None else None,
                "avg_points_last5": last / n if last is not None else None,
                "rest_days": (row[1] - rows[i - 1][1]).days if i else None,
            }
    return out


def expected_strength(games, horizon, n=5):
    by_team = defaultdict(list)
    for row in side_rows(games):
        by_team[row[0]].append(row)
    forms = defaultdict(dict)  # team -> day -> last known form
    for team, rows in by_team.items():
        rows.sort(key=lambda r: (r[1], r[2]))
        for i, row in enumerate(rows):
            if i:
                forms[team][row[1]] = sum(r[6] for r in rows[max(0, i - n) : i]) / n
    out = {}
    for team, rows in by_team.items():
        for i, row in enumerate(rows):
            ahead = range(i + 1, min(i + 1 + horizon, len(rows)))
            values, b2b = [], 0
            for j in ahead:
                tired = int((rows[j][1] - rows[j - 1][1]).days <= 1)
                b2b += tired
                known = [d for d in forms[rows[j][7]] if d <= row[1]]
                if known:
                    form = forms[rows[j][7]][max(known)]
                    values.append(form * (1 + 0.2 * (1 - rows[j][5])) * (1 + 0.2 * tired))
            out[(row[2], team, row[5])] = (
                sum(rows[j][5] for j in ahead),
                sum(1 - rows[j][5] for j in ahead),
                b2b,
                sum(values) / len(values) if values else None,
            )
    return out
