"""Run one tag model as a batch job.

    python -m tagweave run --model job --catalog /data/tbl_basic_tag \\
        --store /shared/tags --table crm_people=/data/user_cells

(on a cluster: ``spark-submit --py-files tagweave.zip tagweave/__main__.py run ...``)

``--catalog`` is a Parquet path or a ``jdbc:`` URL; ``--table name=path`` registers a
Parquet folder under the name a level-4 rule uses (otherwise the rule's
``hbaseTable`` is read as a path).  Prints the published store version.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tagweave.plans import models as M
from tagweave.plans.runner import run
from tagweave.session import ensure_checkpoint_dir
from tagweave.sources.catalog import load_tag_catalog
from tagweave.sources.store import TagStore

PRESETS = {
    "job": M.job_tag, "blacklist": M.blacklist_tag, "nationality": M.nationality_tag,
    "gender": M.gender_model, "job_model": M.job_model, "age": M.age_model,
}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tagweave")
    sub = parser.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="compute one model's tags and publish a new store version")
    r.add_argument("--model", required=True, choices=sorted(PRESETS))
    r.add_argument("--column", help="source column the model reads (default: the model's own)")
    r.add_argument("--catalog", required=True)
    r.add_argument("--store", required=True)
    r.add_argument("--table", action="append", default=[], metavar="NAME=PATH")
    r.add_argument("--check-unique", action="store_true", help="fail if a user id repeats in the source")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"tagweave-{args.model}").getOrCreate()
    ensure_checkpoint_dir(spark)
    model = PRESETS[args.model](args.column) if args.column else PRESETS[args.model]()
    tables = {}
    for item in args.table:
        name, _, path = item.partition("=")
        tables[name] = spark.read.parquet(path)
    version = run(model, load_tag_catalog(spark, args.catalog), TagStore(spark, args.store), tables,
                  check_unique=args.check_unique)
    print(version)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
