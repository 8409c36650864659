"""Job: read the three exports of a study and write all derived tables.

    spark-submit --py-files ... -m tallyward \\
        --inhosp PATH --exc PATH --fu PATH --as-of 2019-03-01 --out PATH [--by study_id]
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import replace

from tallyward.plans.icu_study import ICU_STUDY
from tallyward.plans.study import run_study
from tallyward.session import build_session
from tallyward.sources import load_inputs


def main(argv: list[str] | None = None) -> list[str]:
    parser = argparse.ArgumentParser(prog="tallyward", description=__doc__)
    for name in ("inhosp", "exc", "fu"):
        parser.add_argument(f"--{name}", required=True, nargs="+", help=f"export(s) of {name}")
    parser.add_argument("--as-of", required=True, type=dt.date.fromisoformat)
    parser.add_argument("--out", required=True)
    parser.add_argument("--by", nargs="*", default=[], help="grouping columns, e.g. study_id")
    parser.add_argument("--single-line", action="store_true", help="no line breaks in fields")
    args = parser.parse_args(argv)
    spark = build_session()
    inputs = load_inputs(
        spark,
        {name: getattr(args, name) for name in ("inhosp", "exc", "fu")},
        multi_line=not args.single_line,
    )
    return run_study(spark, inputs, replace(ICU_STUDY, by=tuple(args.by)), args.as_of, args.out)


if __name__ == "__main__":
    main()
