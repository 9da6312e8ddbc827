"""Recall and scored pairs of the neighbour graph by size: python tools/measure_graph.py [rows ...]

Sizes up to 18,000 are the products of TESTDATA and the check tables, larger ones Gaussian vectors of 64
components (no clusters, the hard case). Recall is that of 200 sampled products against exact neighbours over all rows.
"""

from __future__ import annotations

import os
import sys
import time

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from catalog_sync import fixtures as fx  # noqa: E402
from catalog_sync.operators import neighbour_graph as ng  # noqa: E402
from catalog_sync.operators import similar as sim  # noqa: E402
from catalog_sync.session import local_session, materialize_at, release_scratch, scratch_path  # noqa: E402

TABLES = {1800: "sf0.1", 9230: "check_s", 18000: "check_l"}


def products(spark, n):
    if n in TABLES:
        return fx.vectors(spark, f"/root/testdata/{TABLES[n]}").filter("is_vector")
    path = scratch_path(spark, "made")
    for at in range(0, n, 10_000):
        x = np.random.default_rng(at).standard_normal((min(10_000, n - at), 64))
        rows = [(at + i, None, f"B{i % 5}", None, True, v) for i, v in enumerate(x.astype(float).tolist())]
        spark.createDataFrame(rows, "id long, description string, brand string, category string, is_vector boolean, vector array<double>").write.mode("append").parquet(path)
    return spark.read.parquet(path)


def main():
    spark = local_session(cores="8", shuffle_partitions=32)
    for n in [int(a) for a in sys.argv[1:]] or [*TABLES, 72000]:
        df = products(spark, n)
        for w in (0.0, 0.5) if n in TABLES else (0.0,):
            report, began = ng.GraphReport(), time.time()
            got = ng.similar_for_all_graph(df, k=4, w=w, report=report)
            got.count()
            took = time.time() - began
            items = sim._items(df, "id", "vector", "is_vector")
            sample = items.orderBy(F.xxhash64("id")).limit(200)
            sample = materialize_at(sample, "sampled")[0]
            true = sim._best(sim._scan_against(sample, items, items.count(), 200, 4, w, False, 4096, 1024), 4)
            hits = true.select("id", "neighbor_id").join(got.select("id", "neighbor_id", F.lit(1).alias("hit")), ["id", "neighbor_id"], "left")
            recall = hits.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
            print(f"{items.count()} rows, w={w}: recall {recall:.3f}, {report.scored} pairs scored ({report.scored / items.count():.0f} a row), new edges by round {report.rounds}, {took:.0f} s", flush=True)
            release_scratch()
    spark.stop()


if __name__ == "__main__":
    main()
