"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is planned and run in full into the no-op sink, twice; the second time counts.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tabularium.checks.all import CHECKS

HEADLINE = (
    "flagship_brand_summary", "table_experiments", "table_protein_links", "table_interactions", "table_articles", "table_genes",
    "table_density_maps", "table_disorder_xrefs", "s2_unwrap_pages", "s3_page_audit", "s11_ontology_edges", "n9_explode_keep_parent",
    "n16_file_tree_leaves", "k1_parquet_round_trip", "j1_lookup_join", "f1_threshold_report", "a2_group_total", "a6_describe",
    "a12_correlation", "a15_histogram", "a17_entity_rollup", "x15_contrast_stretch", "g2_descendants", "o1_sorted",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.log.level", "ERROR").getOrCreate())
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            CHECKS[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
