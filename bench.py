"""Benchmark the headline queries.

Runs Swing (R4), the feature pipeline (E14), exact top-k retrieval (R7), MMR
rerank (K3), group AUC (N2), behaviour history (W6) and the residual
quantiser (M1) on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line.  Each query is fully
executed (written to a no-op sink), one warm-up pass first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from recspark.plans import load_all  # noqa: E402
from recspark.session import get_spark  # noqa: E402

HEADLINE = {
    "R4_swing": "R4_swing",
    "E14_feature_pipeline": "E14_P1_feature_pipeline",
    "R7_topk_dot": "R7_topk_dot",
    "K3_mmr_rerank": "K3_mmr_rerank",
    "N2_gauc": "N2_gauc",
    "W6_history": "W6_R11_history",
    "M1_rq_encode": "M1_rq_encode",
}


def run_once(spark, q, sf_dir: str) -> float:
    t0 = time.perf_counter()
    q.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    reg = load_all()
    times = {}
    for short, name in HEADLINE.items():
        q = reg[name]
        run_once(spark, q, sf_dir)  # warm-up: JIT, file listing, python workers
        times[short] = round(min(run_once(spark, q, sf_dir) for _ in range(2)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf,
        "config": {"master": f"local[{cpus}]", "spark": spark.version,
                   "shuffle_partitions": int(cpus) * 2, "aqe": True},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
