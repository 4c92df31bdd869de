"""Time the headline queries: one JSON line. BENCH_SF_DIR and BENCH_CPUS set data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rrnlake.catalog.queries import QUERIES  # noqa: E402
from rrnlake.session import build_session  # noqa: E402

HEADLINE = (
    "operon_qc",
    "copy_number_stats",
    "genome_length_stats",
    "assembly_lookup",
    "missing_annotation",
    "extract_operons",
    "exact_dedupe",
    "tax_lca",
    "tax_maj",
    "tax_combined",
    "lineage_resolve",
    "insilico_pcr",
    "kmer_counts",
    "nb_classify",
    "ani_pairs",
    "greedy_clusters",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", cpus, os.environ.get("BENCH_MEMORY", "16g"))
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    times = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline query time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
