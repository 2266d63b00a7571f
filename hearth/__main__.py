"""Command line: the batch prediction job, as submitted with spark-submit.

    spark-submit --py-files hearth.zip hearth/__main__.py predict \
        <train.csv> <test.csv> <output dir> [--grid smoke|full] [--na-mode literal|null]

(or ``python -m hearth predict ...`` for a local session). Writes
<out>/predictions (parquet), <out>/submission (csv) and <out>/report.
"""

from __future__ import annotations

import argparse
import sys

from hearth.session import get_session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="hearth")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("predict", help="train on a CSV, score another, write the results")
    p.add_argument("train")
    p.add_argument("test")
    p.add_argument("out")
    p.add_argument("--grid", choices=["smoke", "full"], default=None)
    p.add_argument("--na-mode", choices=["literal", "null"], default="literal")
    p.add_argument("--seed", type=int, default=7)
    p.add_argument("--run-id", default=None)
    args = parser.parse_args(argv)

    from hearth.plans.jobs import run_job
    spark = get_session("hearth-predict")
    res = run_job(spark, args.train, args.test, args.out, na_mode=args.na_mode,
                  grid=args.grid, seed=args.seed, run_id=args.run_id)
    print(f"validation rmse (log1p scale): {res.validation_rmse}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
