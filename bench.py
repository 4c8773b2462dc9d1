"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and
cores. Each query runs once to warm up and BENCH_REPEAT times (default 1) for the record;
results go to a no-op sink, so whole rows are produced but not collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cohortweave.catalog import QUERIES  # noqa: E402
from cohortweave.session import local_session  # noqa: E402

HEADLINE = [
    "episode_spans",
    "gap_episodes",
    "episode_summary",
    "tiered_identify",
    "matched_codes",
    "claim_star",
    "latest_rows",
    "score_referral",
    "dedupe_by_policy",
    "study_groups",
    "active_span_lookup",
    "link_by_household",
    "anchor_and_window",
    "assembled_outcomes",
    "enrolled_k_of_n",
    "months_enrolled",
    "members_in_period",
    "period_flags",
    "member_months",
    "long_stays",
    "ltc_category",
    "weight_label",
    "exclude_in_windows",
    "unambiguous_latest",
    "feature_templates",
    "household_features",
    "assembled_features",
    "snapshot_features",
    "weighted_density",
    "maternity_outcome_costs",
    "weight_status_labels",
    "long_term_care_groups",
]


def timed(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    seconds = {}
    for name in HEADLINE:
        timed(spark, name, sf_dir)
        seconds[name] = round(min(timed(spark, name, sf_dir) for _ in range(repeat)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
