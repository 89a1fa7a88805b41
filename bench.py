"""Times the headline queries on local cores and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelcraft.plans import catalog
from panelcraft.session import build_session

HEADLINE = ["s01_scan_responses", "p17_label_encode", "p23_standardise", "j03_decode_answers", "a02_crosstab", "a06_chi2",
            "a09_post_hoc_bonferroni", "a13_categories", "a16_deliver", "a18_discover", "m01_uniqueness", "m04_core_slice",
            "m07_variability", "k01_silhouette_responses", "k02_davies_bouldin", "k07_adjusted_rand_responses",
            "c02_pca_variance", "c07_kmeans_fixed", "c08_kmodes_fixed", "c14_lca_step", "c03_kmeans_pca", "g01_knn_gower",
            "g04_laplacian_responses"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus, "spark.sql.files.maxPartitionBytes": "16m"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    queries["a01_proportions"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the workers
    times = {}
    for name in names:
        spark.catalog.clearCache()
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "cpus": int(cpus),
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
