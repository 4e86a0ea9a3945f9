"""Times the headline queries and prints one JSON line."""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from taxalith.plans import catalog

HEADLINE = ("tpm_by_feature", "funcover", "function_split_counts", "hierarchical_rollup", "lca_vote", "besthit_bestaver", "contig_consensus", "interval_overlap_counts", "most_abundant_others", "jaccard_pairs", "fst_pairs", "pavian_clade_counts")


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = catalog.queries(), {}
    queries["tpm_by_feature"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        began = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()
    sys.exit(0)


if __name__ == "__main__":
    main()
