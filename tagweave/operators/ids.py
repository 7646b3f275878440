"""Consecutive ids in a given order, assigned in parallel.

``row_number()`` over an unpartitioned window runs in a single task.  Here the rows are
range-partitioned and sorted by the order columns, checkpointed (so a lost executor
re-reads the same rows in the same order), numbered inside each partition, and shifted
by the row counts of the partitions before it.  Only the per-partition counts reach the
driver - one row per partition, bounded by the partition count, never by the data - and
they come back as a broadcast offsets table of the same bounded size.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.frames import literal_frame

_POS_BITS = 33  # monotonically_increasing_id = (partition index << 33) + position


def sequential_ids(df: DataFrame, order: list[Column | str], start: int,
                   id_col: str = "id") -> tuple[DataFrame, int]:
    """``(df + id_col, row count)``: ids ``start, start + 1, ...`` following ``order``.

    Callers should make ``order`` total (unique) for repeatable ids.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = (df.repartitionByRange(*cols).sortWithinPartitions(*cols)
              .withColumn("_mid", F.monotonically_increasing_id()))
    # persisted first, so writing the checkpoint does not recompute the sort
    ranged = ranged.persist(StorageLevel.MEMORY_AND_DISK)
    frozen = ranged.checkpoint(eager=True)
    ranged.unpersist()
    frozen = (frozen.withColumn("_part", F.shiftright("_mid", _POS_BITS))
              .withColumn("_pos", F.col("_mid").bitwiseAND((1 << _POS_BITS) - 1)))
    counts = sorted((r["_part"], r["_n"]) for r in
                    frozen.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).collect())
    starts = [0, *accumulate(n for _, n in counts)]
    offsets = literal_frame(df.sparkSession, [(p, starts[i]) for i, (p, _) in enumerate(counts)],
                            "_part LONG, _off LONG")
    out = frozen.join(F.broadcast(offsets), "_part")
    out = out.withColumn(id_col, (F.lit(start) + F.col("_off") + F.col("_pos")).cast("long")) \
        .drop("_mid", "_part", "_pos", "_off")
    return out, starts[-1]


def with_sequential_id(df: DataFrame, order: list[Column | str], start: int,
                       id_col: str = "id") -> DataFrame:
    """``df`` with consecutive ids from ``start`` in ``order`` (see :func:`sequential_ids`)."""
    return sequential_ids(df, order, start, id_col)[0]
