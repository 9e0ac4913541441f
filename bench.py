"""Times the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]: one line of JSON, seconds each, median of three after a warm-up."""

from __future__ import annotations

import json
import os
import statistics
import time

from millrace.plans.queries import QUERIES
from millrace.session import session

HEADLINE = ("source_health", "backlog_partition", "merge_items", "near_duplicates", "fingerprint", "unchunked_items", "oa_queue", "vector_topk", "bm25_topk", "keyword_scan", "keyword_lookup", "inverted_index", "vector_topk_many", "ann_topk", "db_stats_corrected", "url_normalize", "give_up_domains", "chunk_documents")


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR"})
    took = {}
    for name in HEADLINE:
        runs = []
        for k in range(4):
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if k:
                runs.append(time.perf_counter() - began)
        took[name] = round(statistics.median(runs), 3)
    spark.stop()
    print(json.dumps({"metric": "total time of the headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": folder.rstrip("/").rpartition("sf")[2], "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
