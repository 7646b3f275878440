"""Bench the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full (``noop`` sink: every row computed, nothing collected)
after one warm-up; the reported time is the median of ``BENCH_RUNS`` (default 3) runs.
``store_write_lineitem`` also writes and publishes a real store snapshot;
``store_rerun_plain`` / ``store_rerun_bucketed`` merge new tags into an existing store
version (a daily re-run), with plain and with key-bucketed snapshots;
``tagging_lineitem_plain`` / ``tagging_lineitem_bucketed`` run the job model end to end from
user cells, with cells and store in plain folders or both bucketed by the user key.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tagweave.plans.queries import QUERIES  # noqa: E402
from tagweave.session import local_session  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tagweave.operators.merge import merged_tag  # noqa: E402
from tagweave.plans.models import job_tag  # noqa: E402
from tagweave.plans.runner import run  # noqa: E402
from tagweave.plans.testbed import (CELL_TIME, USERS_TABLE, base_catalog, line_history,  # noqa: E402
                                    line_users)
from tagweave.sources.cells import to_cells  # noqa: E402
from tagweave.sources.layers import LayeredStore  # noqa: E402
from tagweave.sources.store import TagStore  # noqa: E402

# lineitem-sized users, two end-to-end tagging jobs and two catalog jobs.
HEADLINE = ["match_lookup", "merge_left", "cells_latest", "store_upsert",
            "match_lookup_lineitem", "merge_left_lineitem", "upsert_merge_lineitem",
            "tagging_job", "tagging_age", "path_upsert", "model_state", "match_age_range_join", "upsert_repeated_keys"]


def _timed(fn, runs):
    fn()  # warm-up
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, max(8, 2 * int(cpus) if cpus.isdigit() else 16))
    results = {}
    for name in HEADLINE:
        query = QUERIES[name]
        results[name] = round(_timed(
            lambda q=query: q(spark, sf_dir).write.format("noop").mode("overwrite").save(), runs), 3)

    scratch = tempfile.mkdtemp(prefix="tagweave-bench-", dir="/tmp")
    counter = iter(range(10_000))

    def store_write():
        store = TagStore(spark, f"{scratch}/store-{next(counter)}")
        store.commit(QUERIES["upsert_merge_lineitem"](spark, sf_dir), None)

    results["store_write_lineitem"] = round(_timed(store_write, runs), 3)

    # a daily re-run: merge new tags into the latest stored version, plain vs bucketed store
    new = QUERIES["match_lookup_lineitem"](spark, sf_dir).selectExpr("userId", "CAST(tagIds AS STRING) AS tagIds")
    shuffle_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for label, buckets in (("store_rerun_plain", None), ("store_rerun_bucketed", shuffle_parts)):
        store = TagStore(spark, f"{scratch}/{label}", buckets=buckets)
        store.commit(QUERIES["upsert_merge_lineitem"](spark, sf_dir), None)

        def rerun(store=store):
            store.upsert(new, combine={"tagIds": lambda o, n: merged_tag(o, n)})

        results[label] = round(_timed(rerun, runs), 3)
    # the same re-run into layers (what the first one changed is there, so the timed ones find nothing to write)
    layered = LayeredStore(spark, f"{scratch}/store_rerun_layers")
    layered.upsert(QUERIES["upsert_merge_lineitem"](spark, sf_dir), unique=True)
    results["store_rerun_layers"] = round(_timed(
        lambda: layered.upsert(new, combine={"tagIds": lambda o, n: merged_tag(o, n)}, unique=True), runs), 3)
    # one user in a hundred, each time with a tag that it doesn't have yet: a delta of these users
    tags = iter(range(900, 10_000))

    def some():
        part = new.where(F.pmod(F.xxhash64("userId"), F.lit(100)) == 0).select("userId", F.lit(str(next(tags))).alias("tagIds"))
        layered.upsert(part, combine={"tagIds": lambda o, n: merged_tag(o, n)}, unique=True)

    results["store_layers_1pct"] = round(_timed(some, runs), 3)
    # a full tagging run (job model) over order-line users read from cells: cells and store in plain
    # folders vs both bucketed by the user key (then the run moves no large data)
    cells = to_cells(line_users(spark, sf_dir), "id", "base", ts=F.lit(CELL_TIME).cast("timestamp"),
                     fields=["id", "job"])
    catalog = base_catalog(spark, sf_dir)
    for label, buckets in (("tagging_lineitem_plain", None), ("tagging_lineitem_bucketed", shuffle_parts)):
        folder = f"{scratch}/{label}-cells"
        if buckets:
            name = f"bench_cells_{uuid.uuid4().hex}"
            cells.write.bucketBy(buckets, "rowkey").option("path", folder).saveAsTable(name)
            source = spark.table(name)
        else:
            cells.write.parquet(folder)
            source = spark.read.parquet(folder)
        store = TagStore(spark, f"{scratch}/{label}-store", buckets=buckets)
        store.commit(line_history(spark, sf_dir), None)
        results[label] = round(_timed(
            lambda store=store, source=source: run(job_tag(), catalog, store, {USERS_TABLE: source}), runs), 3)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({"metric": "total_median_sec", "value": round(sum(results.values()), 3), "unit": "sec",
                      "queries": results, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
