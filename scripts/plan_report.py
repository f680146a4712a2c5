"""Physical-plan summary of every query of the catalog (formatted explain):
shuffles, broadcasts, nested-loop joins, windows, Python stages and the
columns each scan reads. Usage: python scripts/plan_report.py [sf_dir]"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plotline.plans import catalog  # noqa: E402
from plotline.session import local_session  # noqa: E402


def explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    print("| query | shuffles | broadcasts | reused | nested-loop | windows | python | scans (table: columns read) |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, q in catalog.QUERIES.items():
        p = explain(q(spark, sf))
        tree = p.split("\n\n")[0]
        shuffles = len(re.findall(r"\bExchange\b", tree))
        reused = len(re.findall(r"Reused", tree))
        bcast = len(re.findall(r"BroadcastExchange", tree))
        bnlj = len(re.findall(r"BroadcastNestedLoopJoin", tree))
        win = len(re.findall(r"\bWindow\b", tree))
        py = len(re.findall(r"MapInPandas|ArrowEvalPython|BatchEvalPython|PythonMapInArrow", tree))
        scans = re.findall(r"\[file:[^\]]*/([a-z_]+)\.parquet\]\n(?:.*\n){0,3}?ReadSchema: struct<([^>]*)>", p)
        seen = []
        for t, s in scans:
            cols = ",".join(c.split(":")[0] for c in s.split(","))
            item = f"{t}: {cols}"
            if item not in seen:
                seen.append(item)
        print(f"| {name} | {shuffles} | {bcast} | {reused} | {bnlj} | {win} | {py} | {'; '.join(seen)} |")
    spark.stop()


if __name__ == "__main__":
    main()
