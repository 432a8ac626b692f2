"""

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

One warm-up run per query, then the median of ``BENCH_RUNS`` (default 3)
runs, each forced by a ``noop`` write. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corvid.operators import geometry, kcenter, sales, words  # noqa: E402
from corvid.session import local_session  # noqa: E402
from corvid.sources import document_lines, embedding_points, lineitem_points, transactions  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
CORES = int(CPUS) if CPUS.isdigit() else (os.cpu_count() or 8)
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

K = 16
H = 10
COUNTRY = "NATION_7"
LI_K, LI_Z, LI_L = 10, 50, 16
EMB_K, EMB_Z, EMB_L = 8, 10, 4


def plans(spark):
    lines = lambda: document_lines(spark, SF_DIR, CORES)
    every = lambda: sales.sales_filtered(transactions(spark, SF_DIR), "all")
    li = lambda: lineitem_points(spark, SF_DIR, CORES)

    return {
        "word_count": lambda: words.word_count(lines()),
        "word_count_salted": lambda: words.word_count_salted(lines(), K),
        "word_count_rand_group": lambda: words.word_count_rand_group(lines(), K, 42),
        "word_count_partition": lambda: words.word_count_partition(lines()),
        "avg_word_length": lambda: words.avg_word_length(lines()),
        "top_products_by_country": lambda: sales.top_products_by_country(
            transactions(spark, SF_DIR), COUNTRY, H
        ),
        "popularity_grouped": lambda: sales.popularity_grouped(every()),
        "popularity_reduced": lambda: sales.popularity_reduced(every()),
        "coreset_lineitem": lambda: kcenter.coreset(li(), LI_K + LI_Z + 1, LI_L),
        "kcenter_outliers_lineitem": lambda: kcenter.solution_centers(
            kcenter.kcenter_outliers(li(), LI_K, LI_Z, LI_L, 2)
        ),
        "objective_lineitem": lambda: kcenter.kcenter_report(li(), LI_K, LI_Z, LI_L, 2),
        "kcenter_outliers_embeddings": lambda: kcenter.kcenter_report(
            embedding_points(spark, SF_DIR, CORES), EMB_K, EMB_Z, EMB_L, 2
        ),
    }


def run_once(make) -> float:
    t0 = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")
    spark = local_session(cpus=CPUS, shuffle_partitions=CORES * 2, checkpoint_dir=f"{scratch}/ckpt")
    results = {}
    for name, make in plans(spark).items():
        run_once(make)  # warm-up
        results[name] = round(statistics.median(run_once(make) for _ in range(RUNS)), 3)
        print(f"# {name}: {results[name]}s", file=sys.stderr)
    count = lambda t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").count()
    rows = {"documents": count("documents"), "lineitem": count("lineitem"), "embeddings": count("embeddings")}
    read = {n: rows["embeddings" if "embeddings" in n else "documents" if "word" in n else "lineitem"] for n in results}
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    out = {
        "metric": "total_median_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else None,
        "rows_per_sec": {n: round(read[n] / sec) for n, sec in results.items()},
        "cpus": CPUS,
        "runs": RUNS,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
