"""Seconds per headline query; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of cores.  Every query
runs twice in full and the faster run counts; rows go to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

HEADLINE = [
    "get_by_properties", "get_by_id_table", "count_by_label", "entity_names", "classify_names",
    "normalize_names", "upsert_last_wins", "upsert_known_properties", "upsert_relations_dedup",
    "mentions_edges", "endpoint_resolution", "triplets", "rich_triplets", "incident_edges",
    "rel_map_one_hop", "khop_neighborhood", "paths_upto_depth", "degree", "orphan_vertices",
    "vector_topk", "vector_topk_per_label", "batch_vector_search", "delete_by_id_table",
    "refresh_document", "retrieve_context", "ingest_pipeline", "stored_graph",
]


def main() -> None:
    from knotwork.session import local_session
    from workload import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
