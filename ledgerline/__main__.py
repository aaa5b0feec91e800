"""Run a flow from the command line or spark-submit:

python -m ledgerline run --source DIR --lake DIR --namespace NAME
python -m ledgerline increment --source DIR --lake DIR --batch NUMBER
python -m ledgerline models --lake DIR
python -m ledgerline profile --source DIR
"""

from __future__ import annotations

import argparse

from ledgerline.plans import run as flows
from ledgerline.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="ledgerline")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="generated files to published Gold")
    run.add_argument("--source", required=True)
    run.add_argument("--lake", required=True)
    run.add_argument("--namespace", default="banking")
    increment = commands.add_parser("increment", help="one more delivery of generated files into an incremental lake")
    increment.add_argument("--source", required=True)
    increment.add_argument("--lake", required=True)
    increment.add_argument("--batch", type=int, required=True)
    models = commands.add_parser("models", help="SQL models over the Silver tables of a lake")
    models.add_argument("--lake", required=True)
    profile = commands.add_parser("profile", help="profile of generated files")
    profile.add_argument("--source", required=True)
    given = parser.parse_args()

    spark = build_session()
    if given.command == "run":
        reports = flows.run(spark, given.source, given.lake, given.namespace)
    elif given.command == "increment":
        reports = flows.run_increment(spark, given.source, given.lake, given.batch)
    elif given.command == "models":
        reports = flows.run_models(spark, given.lake)
    else:
        reports = flows.run_profile(spark, given.source)
    for step, report in reports:
        print(f"== {step}")
        report.show(1000, truncate=False)  # reports hold one row per check, column or code
    spark.stop()


if __name__ == "__main__":
    main()
