"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs once to warm up and then ``$BENCH_RUNS`` times (default 3); its time
is the median. Index searches are timed apart from their builds.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from vecspark.operators import fts, ivf
from vecspark.queries import QUERIES
from vecspark.queries.registry import table
from vecspark.queries.vectors import QUERY
from vecspark.session import local_session, scratch_path

HEADLINE = [
    "vec_l2_topk", "vec_cosine_topk", "vec_filtered_search", "vec_range_search", "vec_knn_join",
    "sparse_topk", "sparse_scan_topk", "fts_match_filter", "fts_bm25_topk", "fts_doc_freq",
    "hybrid_bool", "hybrid_query_string", "hybrid_knn", "hybrid_search", "json_select_agg",
    "json_update", "json_modify_column", "dml_upsert", "dml_delete_ids", "dml_update",
    "get_by_ids", "part_two_level", "write_partitioned", "conform_violations",
    "geo_distance", "geo_dwithin_join",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def drain(df) -> None:
    """Compute every row without moving them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 1))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, "bench", **{"spark.driver.memory": "12g"})

    jobs = {name: (lambda fn=QUERIES[name]: drain(fn(spark, sf_dir))) for name in HEADLINE}
    builds: dict[str, float] = {}
    vectors, docs = table(spark, sf_dir, "embeddings"), table(spark, sf_dir, "documents")
    for kind, options in (("flat", {}), ("sq8", {}), ("pq", {"m": 8})):
        path, built = scratch_path(spark, f"bench-{kind}"), {}
        build = lambda: built.update(i=ivf.build(vectors, "embedding", "vec_id", path, kind, **options))
        builds[f"ivf_{kind}_build"] = seconds(build)
        jobs[f"ivf_{kind}_search"] = lambda index=built["i"]: drain(ivf.search(spark, index, QUERY, 10))
    made = {}
    path = scratch_path(spark, "bench-fts")
    builds["fts_index_build"] = seconds(lambda: made.update(i=fts.TextIndex.build(docs, "text", "doc_id", path)))
    words = "which avec from nicht"
    jobs["fts_index_bm25_topk"] = lambda: drain(
        fts.bm25_topk(docs, words, "text", "doc_id", 25, index=made["i"]).withColumn("score", F.round("score", 5))
    )

    times = {}
    for name, job in jobs.items():
        job()
        times[name] = round(statistics.median(seconds(job) for _ in range(runs)), 4)
    times.update({name: round(value, 4) for name, value in builds.items()})
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median warm seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
