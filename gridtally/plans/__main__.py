"""Command line for the weekly jobs, for ``spark-submit``.

    spark-submit --master ... -m gridtally.plans kpi --root R --as-of 2024-01-17 --out O
    python -m gridtally.plans enb --root R --as-of 2024-01-17 --out O --input-bytes 3e12

The master, executors and memory come from spark-submit; ``--input-bytes``
sizes shuffles and scan splits (``sizing_conf``).
"""

from __future__ import annotations

import argparse
import json
import sys

from gridtally.plans.jobs import coverage_job, days_between, job_days, kpi_job
from gridtally.plans.session import JOB_ONLY_CONF, builder, sizing_conf
from gridtally.sources.scan import missing_days


def parse(argv: list[str]) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="gridtally.plans")
    ap.add_argument("job", choices=["kpi", "enb", "gnb"])
    ap.add_argument("--root", required=True, help="folder holding UTC_date=yyyyMMdd/ day folders")
    ap.add_argument("--as-of", required=True, help="reference day, yyyy-mm-dd")
    ap.add_argument("--out", required=True, help="output folder")
    ap.add_argument("--trailing", type=int, help="use the N days up to as-of instead of a week")
    ap.add_argument("--sample", type=float, help="keep this share of subscribers")
    ap.add_argument("--files", help="output files: a number, or for coverage 100=200,1000=20,...")
    ap.add_argument("--resolutions", default="100,1000,10000")
    ap.add_argument("--approx-distinct", action="store_true")
    ap.add_argument("--allow-missing", action="store_true",
                    help="run although days of the window have no folder")
    ap.add_argument("--keep-going", action="store_true")
    ap.add_argument("--reference-layout", action="store_true",
                    help="coverage files with the original five columns only")
    ap.add_argument("--input-bytes", type=float, help="approximate input size for sizing")
    ap.add_argument("--cores", type=int, default=300)
    ap.add_argument("--shuffle-share", type=float, default=1.0,
                    help="shuffled volume over raw input, for sizing")
    return ap.parse_args(argv)


def file_counts(text: str | None, resolutions: list[int]) -> dict[int, int] | None:
    """``"20"`` for every resolution, or ``"100=200,1000=20"``; None: the defaults."""
    if not text:
        return None
    if "=" not in text:
        return {r: int(text) for r in resolutions}
    return {int(r): int(n) for r, n in (x.split("=") for x in text.split(","))}


def main(argv: list[str] | None = None) -> int:
    a = parse(sys.argv[1:] if argv is None else argv)
    conf = dict(JOB_ONLY_CONF)
    if a.input_bytes:
        conf |= sizing_conf(int(a.input_bytes), a.cores, a.shuffle_share)
    spark = builder(f"gridtally-{a.job}", conf=conf).getOrCreate()
    start, end = job_days(a.as_of, a.job, a.trailing)
    absent = missing_days(spark, a.root, days_between(start, end))
    if a.job == "kpi":
        kpi_job(spark, a.root, a.as_of, a.out, files=int(a.files) if a.files else None,
                exact_distinct=not a.approx_distinct, allow_missing=a.allow_missing,
                trailing=a.trailing, sample_fraction=a.sample)
        print(json.dumps({"job": "kpi", "out": a.out, "missing_days": absent}))
    else:
        res = [int(r) for r in a.resolutions.split(",")]
        paths = coverage_job(spark, a.root, a.as_of, a.out, kind=a.job, resolutions=res,
                             files=file_counts(a.files, res), allow_missing=a.allow_missing,
                             trailing=a.trailing, sample_fraction=a.sample,
                             keep_going=a.keep_going, reference_layout=a.reference_layout)
        print(json.dumps({"job": a.job, "out": paths, "missing_days": absent}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
