"""Markdown summary of each query's final physical plan (after AQE).

Usage: python tests/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarize(plan: str) -> dict:
    final = plan.split("+- == Initial Plan ==")[0]
    count = lambda pat: len(re.findall(pat, final, re.M))
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", final) or re.findall(
        r"FileScan \w+ [^\[]*\[([^\]]*)\]", final)
    return {
        "scan_count": count(r"FileScan "),
        "shuffles": count(r"^[\s:|+-]*Exchange (hashpartitioning|RoundRobin|SinglePartition|rangepartitioning)"),
        "reused": count(r"ReusedExchange"),
        "broadcasts": count(r"BroadcastExchange"),
        "smj": count(r"SortMergeJoin"),
        "bhj": count(r"BroadcastHashJoin"),
        "windows": count(r"\bWindow \["),
        "group_limit": count(r"WindowGroupLimit"),
        "scans": sorted(set(scans)),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from gridtally.plans.session import builder
    import __spark_entry__ as E

    import tempfile
    scratch = tempfile.mkdtemp(prefix="gridtally-plans-")
    spark = builder("plans", 16, {"spark.ui.enabled": "false",
                                  "spark.checkpoint.dir": f"{scratch}/cp"}).master(
        "local[8]").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Final physical plans at `{sf_dir}` (local[8], AQE on)\n")
    print("Generated by `tests/plan_report.py` after running each query. Shuffles are "
          "the exchanges executed (reused exchanges are read again, not recomputed); "
          "broadcasts are what AQE measured small at runtime and, for the bursts, the "
          "numbering of their sort's partitions. The burst queries (`access_burst`, "
          "`burst_big_keys`, `burst_witnesses`) first build a checkpoint: one scan of three "
          "columns, one range exchange, one sort, one write; the rows below are what then "
          "reads it. The operators of `gridtally/llm` checkpoint too; the check tool's "
          "figures in the README cover all their jobs.\n")
    print("| Query | Scans | Shuffles | Reused | Broadcasts | SMJ | BHJ | Windows | Group limits | Scan read schemas |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in sorted(E.queries().items()):
        if re.match(r"op\d+_|pipeline", name):
            continue
        df = fn(spark, sf_dir)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()  # run this very plan, so AQE's final plan is shown
        s = summarize(qe.executedPlan().toString())
        scans = "<br>".join(f"`{x[:90]}`" for x in s["scans"])
        print(f"| {name} | {s['scan_count']} | {s['shuffles']} | {s['reused']} | {s['broadcasts']} | {s['smj']} | "
              f"{s['bhj']} | {s['windows']} | {s['group_limit']} | {scans} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
