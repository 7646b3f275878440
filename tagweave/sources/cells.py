"""The wide-column source: cells ``(rowkey, family, qualifier, value, ts)`` -> rows.

Each row key becomes one row; each selected qualifier of the family becomes a string
column holding its latest value (highest ``ts``); a missing cell is null.  As in a
wide-column table scan, a row key appears even when none of the selected cells exist.

The pivot is one ``groupBy(rowkey)`` with a ``max_by`` per qualifier; no pivot value
discovery job is needed because the qualifier list is given.  ``max_by`` on strings sorts
the cells of its task, and a task that scans a file may hold tens of millions.  So the
cells are dealt first, by row key and by one of ``SPREAD`` classes of the time stamp: a
task sorts one shuffle partition only, cells of one put stay together, and a row key
holding millions of versions is reduced to ``SPREAD`` rows by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

SPREAD = 32  # tasks that share the versions of one row key


def parse_fields(select_fields: str | Sequence[str]) -> list[str]:
    """``"id,job"`` -> ``["id", "job"]`` (empty items dropped)."""
    if isinstance(select_fields, str):
        return [f for f in select_fields.split(",") if f != ""]
    return list(select_fields)


def fields_schema(select_fields: str | Sequence[str]) -> StructType:
    """Schema of a wide-column read: every selected field a nullable string."""
    return StructType([StructField(f, StringType(), True) for f in parse_fields(select_fields)])


def read_cells(cells: DataFrame, family: str, select_fields: str | Sequence[str], *,
               rowkey_as: str | None = None, order_by: Column | None = None,
               only_rows_with_cells: bool = False) -> DataFrame:
    """Pivot a cell table into one row per row key.

    ``rowkey_as`` names a column that takes the row key itself (it wins over a cell of
    the same name).  ``order_by`` decides the latest version (default ``(ts, value)``,
    so equal timestamps resolve the same way every run).  The values come from a scan
    into which the ``family`` / ``qualifier`` filters are pushed.  By default every row
    key is kept: a second scan reads the row keys alone.  ``only_rows_with_cells=True``
    leaves that scan out and returns only row keys that have at least one selected cell.
    """
    fields = parse_fields(select_fields)
    order = order_by if order_by is not None else F.struct(F.col("ts"), F.col("value"))
    c = cells.where((F.col("family") == F.lit(family)) & F.col("qualifier").isin(fields))
    put = F.pmod(F.xxhash64(F.col("ts") if "ts" in cells.columns else order), F.lit(SPREAD))
    c = c.select("rowkey", "qualifier", F.col("value").cast("string").alias("value"), order.alias("_order"),
                 put.alias("_put")).repartition("rowkey", "_put")
    aggs = []
    for f in fields:
        if f == rowkey_as:
            continue
        hit = F.col("qualifier") == F.lit(f)
        aggs.append(F.max_by(F.when(hit, F.col("value")), F.when(hit, F.col("_order"))).alias(f))
    if not aggs:
        wide = (c if only_rows_with_cells else cells).select("rowkey").distinct()
    else:
        wide = c.groupBy("rowkey").agg(*aggs)
        if not only_rows_with_cells:
            wide = cells.select("rowkey").distinct().join(wide, "rowkey", "left")
    out = []
    for f in fields:
        out.append(F.col("rowkey").alias(f) if f == rowkey_as else F.col(f).cast("string"))
    if rowkey_as and rowkey_as not in fields:
        out.insert(0, F.col("rowkey").alias(rowkey_as))
    return wide.select(*out)


def to_cells(df: DataFrame, key: str, family: str, ts: Column | None = None,
             fields: Sequence[str] | None = None) -> DataFrame:
    """Explode a wide DataFrame into cells (the write side of the cell layout).

    Null values produce no cell, like a wide-column put that skips a missing value.
    """
    fields = list(fields) if fields is not None else [c for c in df.columns if c != key]
    stamp = ts if ts is not None else F.current_timestamp()
    cells = F.array(*[F.struct(F.lit(f).alias("qualifier"), F.col(f).cast("string").alias("value"))
                      for f in fields])
    return (df.select(F.col(key).cast("string").alias("rowkey"), F.inline(cells), stamp.alias("ts"))
            .where(F.col("value").isNotNull())
            .select("rowkey", F.lit(family).alias("family"), "qualifier", "value", "ts"))
