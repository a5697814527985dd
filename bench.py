"""Times the headline queries. Prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Every query runs to the end (all rows and columns, nothing kept); one untimed run warms the JVM.
"""

from __future__ import annotations

import json
import os
import time

from vacancia.plans.catalog import CATALOG
from vacancia.session import local_session

HEADLINE = [
    "salary_by_experience",
    "jobs_master",
    "jobs_master_clean",
    "key_duplicates",
    "referential_integrity",
    "clean_salaries",
    "market_overview",
    "top_companies",
    "price_quantiles_by_supplier",
    "correlation_matrix",
    "salary_boxes",
    "fact_jobs",
    "dim_calendar",
    "one_profile_scores",
    "part_name_tfidf",
    "standardized_prices",
    "roc_curve",
    "cluster_silhouette",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cpus, "bench")

    def run(name: str) -> float:
        start = time.perf_counter()
        CATALOG[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("salary_by_experience")
    times = {name: round(run(name), 3) for name in HEADLINE}
    total = round(sum(times.values()), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
