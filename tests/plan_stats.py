"""Count scans, shuffles, broadcasts, reuse and sorts in each query's final adaptive plan."""

from __future__ import annotations

import contextlib
import io
import re
import sys


def final_plan(df) -> str:
    df.collect()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    text = out.getvalue()
    return text.split("+- == Initial Plan ==")[0]


def stats(df) -> dict[str, int]:
    plan = final_plan(df)
    return {
        "scan": len(re.findall(r"FileScan", plan)),
        "shuffle": len(re.findall(r"(?<!Reused)(?<!Broadcast)\bExchange ", plan)),
        "broadcast": len(re.findall(r"\bBroadcastExchange", plan)),
        "reused": len(re.findall(r"ReusedExchange", plan)),
        "smj": len(re.findall(r"SortMergeJoin", plan)),
        "bhj": len(re.findall(r"BroadcastHashJoin", plan)),
        "nested": len(re.findall(r"NestedLoop|Cartesian", plan)),
        "window": len(re.findall(r"\bWindow ", plan)),
    }


def main(sf_dir: str, *wanted: str) -> None:
    from cohortweave.catalog import QUERIES
    from cohortweave.session import local_session

    spark = local_session("8")
    for name in wanted or QUERIES:
        print(f"{name:32}", " ".join(f"{k}={v}" for k, v in stats(QUERIES[name](spark, sf_dir)).items()), flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
