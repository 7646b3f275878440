"""Run a tag model every N minutes over newly arrived cells.

The jobs are meant to be re-run on a schedule.  Here the schedule is a Structured
Streaming query over the cell folder: each micro-batch holds the cells written since
the last one.  Every row key of a batch is re-tagged from **all** its cells - a semi
join of the cell table with the batch's keys - so the result equals a full re-run.  The
store then gets a new version through the same merge/upsert as ``runner.run``.  Users
whose cells did not change are not re-tagged; a full re-run would merge the same tag
again (a no-op).

Progress is kept in the streaming checkpoint; a batch that is replayed after a failure
re-applies an idempotent merge (``merge(merge(o, n), n) == merge(o, n)``), so the store
ends in the same state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tagweave.operators.lookup import source_spec_of
from tagweave.plans.models import TagModel
from tagweave.plans.runner import STORE_SCHEMA, plan
from tagweave.schemas import CELLS
from tagweave.sources.store import ConcurrentUpdateError, TagStore


def start(model: TagModel, catalog: DataFrame, cells_path: str, store: TagStore, *,
          checkpoint_location: str, processing_time: str | None = None,
          max_files_per_trigger: int | None = None, cells_table: str | None = None) -> StreamingQuery:
    """Start the scheduled job.  ``processing_time=None`` runs once over what is there
    (``availableNow``); e.g. ``"5 minutes"`` keeps running on that interval.

    ``cells_table`` names a table over the same folder (e.g. bucketed by ``rowkey``) to
    read all cells of the touched keys from, so the semi join can use its layout."""
    spark = catalog.sparkSession
    spec = source_spec_of(catalog, model.tag_id, model.spec_default)
    if (spec.get("inType") or "").lower() not in ("hbase", "cells"):
        raise ValueError(f"tag {model.tag_id}: the scheduled job needs a cells source, "
                         f"not inType={spec.get('inType')!r}")
    table = spec.get("hbaseTable") or ""

    def apply(batch: DataFrame, batch_id: int) -> None:
        touched = batch.select("rowkey").distinct()
        every_cell = spark.table(cells_table) if cells_table else spark.read.schema(CELLS).parquet(cells_path)
        cells = every_cell.join(touched, "rowkey", "left_semi")
        for attempt in range(3):  # redo the merge on top of a concurrently published version
            base = store.latest_version()
            old = store.read(base, schema=STORE_SCHEMA)
            try:
                store.commit(plan(model, catalog, old, {table: cells}), base)
                return
            except ConcurrentUpdateError:
                if attempt == 2:
                    raise

    reader = spark.readStream.schema(CELLS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    writer = reader.parquet(cells_path).writeStream.foreachBatch(apply) \
        .option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(processingTime=processing_time) if processing_time else \
        writer.trigger(availableNow=True)
    return writer.start()
