"""All jobs of one day from a shell: spark-submit daily.py LAKE RUN_DATE --cutoff DATE [options]."""

from __future__ import annotations

import argparse
import json

from leaguelake.layout import LakeLayout
from leaguelake.plans import jobs
from leaguelake.session import build_session


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("lake")
    parser.add_argument("run_date")
    parser.add_argument("--cutoff", required=True, help="matches from this date on are predicted")
    parser.add_argument("--mode", choices=jobs.MODES, default="full")
    parser.add_argument("--schedule", choices=("constant", "simple", "strength"), default="constant")
    parser.add_argument("--multi-line", action="store_true", help="one document per file")
    parser.add_argument("--seasons", nargs=2, type=int, metavar=("FIRST", "LAST"))
    parser.add_argument("--dates", nargs=2, metavar=("FROM", "TO"), default=("-", "-"), help="- leaves an end open")
    parser.add_argument("--status", help="only games in this state")
    parser.add_argument("--train-on-all", action="store_true", help="learn from all runs up to the day")
    parser.add_argument("--export", choices=jobs.EXPORTS, default="all", help="all documents, or what changed")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    given = arguments(argv)
    start, end = (None if day == "-" else day for day in given.dates)
    scores = jobs.run(
        build_session(f"daily-{given.run_date}"),
        LakeLayout(given.lake),
        given.run_date,
        given.cutoff,
        given.mode,
        given.schedule,
        given.multi_line,
        tuple(given.seasons) if given.seasons else None,
        (start, end),
        given.status,
        given.train_on_all,
        given.export,
    )
    print(json.dumps(scores))


if __name__ == "__main__":
    main()
