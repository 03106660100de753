"""Times of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from loomspan.queries import QUERIES
from loomspan.session import local_session

HEADLINE = (
    "coverage_sweep coverage_merge coverage_over_spans overlap_count overlap_anti band_join interval_islands limit_multiplicity dedup_to_unique "
    "full_outer_cases pair_mates hist_multiplicity mapping_statistics rpkm fold_change profile_pivot merge_min_max_sum trusted_junctions near_best_hits"
).split()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").count()
    took = {}
    for name in HEADLINE:
        times = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        took[name] = round(sorted(times)[1], 3)
    print(json.dumps({"metric": "total_median_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf)}))


if __name__ == "__main__":
    main()
