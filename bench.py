"""Time the headline queries: ``python bench.py`` prints one JSON line.

Each query is planned and run to a sink that discards rows, twice; the second run is reported and the
first, with compilation, is in ``first_run``. Derived nested inputs are landed before the clock starts,
as loading. Fitted models are not kept between runs.
"""

from __future__ import annotations

import json
import os
import time

from limnos import registry
from limnos.registry import modelling
from limnos.registry.core import lab_samples
from limnos.registry.plants import plant_samples
from limnos.session import local_session

HEADLINE = [
    "seasonal_weighted_mean", "site_year_chemistry", "chemistry_clean", "survey_taxa", "community_surveys", "richness_join",
    "pick_min", "shallowest", "parse_censored", "explode_inner", "harmonise_units", "group_mean_strict", "duplicate_groups",
    "profile_columns", "varying_columns", "corr_matrix", "corr_matrix_pairwise", "richness", "full_join", "cast_wide",
    "bivariate_class", "qq_pairs", "kernel_local_mean", "neighbour_join", "holdout_select", "predict_mean_sd",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "limnos-bench", shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    runners = registry.runners()
    for landed in (lab_samples, plant_samples):
        landed(spark, sf_dir)
    first: dict[str, float] = {}
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        for record in (first, seconds):
            modelling._KEPT.clear()
            start = time.perf_counter()
            runners[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            record[name] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": float(sf),
                      "first_run": round(sum(first.values()), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
