"""Times the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

A query is timed from building its plan to the last row (written to the ``noop`` sink, so every
column is computed). Rows per second refer to the rows a query reads.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rolefit.plans import fixtures  # noqa: E402
from rolefit.plans.catalog import QUERIES  # noqa: E402
from rolefit.session import local_session  # noqa: E402

HEADLINE = [
    "normalize_postings", "dedup_exact", "bloom_dedup", "ingest_stats", "enrich", "embed_texts", "cosine_knn", "candidates",
    "rank_topk", "tfidf_topk", "precision_at_k", "top_skills", "summary_stats", "count_min_sketch", "learner_fold", "stream_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, memory=os.environ.get("BENCH_MEMORY", "12g"), shuffle_partitions=2 * int(cpus))
    sizes = {
        "postings": fixtures.postings_raw(spark, sf_dir).count(),
        "documents": fixtures.table(spark, sf_dir, "documents").count(),
        "profiles": fixtures.table(spark, sf_dir, "customer").count(),
        "events": fixtures.table(spark, sf_dir, "events").count(),
        "vectors": fixtures.table(spark, sf_dir, "embeddings").count(),
    }
    reads = {"bloom_dedup": "documents", "count_min_sketch": "documents", "learner_fold": "events", "cosine_knn": "vectors"}
    seconds: dict[str, float] = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    rates = {n: round(sizes[reads.get(n, "postings")] / s) for n, s in seconds.items()}
    print(json.dumps({
        "metric": "headline queries, total seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "rows": sizes, "rows_per_sec": rates,
    }))


if __name__ == "__main__":
    main()
