"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma
separated names, default the list below).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskbook.catalog import QUERIES  # noqa: E402
from riskbook.sources.session import local_session  # noqa: E402

HEADLINE = (
    "loans_per_quarter",
    "amount_by_issue_date",
    "median_amount_by_quarter",
    "sketch_median_amount_by_quarter",
    "median_rate_by_state",
    "status_counts_desc",
    "default_by_verification",
    "amount_by_state",
    "income_bin_status_amount",
    "mean_default_by_subgrade",
    "null_profile",
    "missing_over_half",
    "cleaned_loans",
    "hist_amount",
    "kde_purpose_term",
    "gamma_fit_amount",
    "five_number_amount",
    "box_subgrade_amount",
    "box_default_emp_rate",
    "mean_ci",
    "bootstrap_mean_ci",
    "string_index",
    "one_hot_subgrade",
    "one_hot_vector_sums",
    "hash_split",
    "nb_parameters",
    "confusion_counts",
    "roc_points_by_amount",
    "lr_predictions",
    "nb_test_predictions",
    "rf_predictions",
    "gbt_predictions",
)


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds to compute every row and column of a query, without fetching them."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "status_counts_desc", sf_dir)  # start-up is not part of any query
    seconds = {name: round(run(spark, name, sf_dir), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
