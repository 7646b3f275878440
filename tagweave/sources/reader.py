"""Load the source a level-4 rule names (``inType`` chooses the reader).

=========  ==============================================================
inType     reader
=========  ==============================================================
hbase /    cell table (``hbaseTable`` = a registered DataFrame or a Parquet
cells      path) pivoted by :func:`read_cells` for ``family``/``selectFields``
parquet    ``spark.read.parquet(hbaseTable)``
table      ``spark.table(hbaseTable)``
jdbc       ``spark.read.format("jdbc")`` with ``dbtable`` = ``hbaseTable``
=========  ==============================================================

Keys of the rule other than the seven source keys (``url``, ``user``, ``driver``, ...) are
passed to the parquet and jdbc readers as options.

Every reader returns the ``selectFields`` columns as strings, in that order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.schemas import SOURCE_KEYS
from tagweave.sources.cells import parse_fields, read_cells


def load_source(spark: SparkSession, spec: Mapping[str, str | None],
                tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    in_type = (spec.get("inType") or "").lower()
    name = spec.get("hbaseTable") or ""
    fields = parse_fields(spec.get("selectFields") or "")
    if not fields:
        raise ValueError("source rule has no selectFields")
    registered = (tables or {}).get(name)
    options = {k: v for k, v in spec.items() if k not in SOURCE_KEYS and v is not None}
    if in_type in ("hbase", "cells"):
        cells = registered if registered is not None else spark.read.parquet(name)
        row_key = spec.get("rowKey") or None
        return read_cells(cells, spec.get("family") or "", fields,
                          rowkey_as=row_key if row_key in fields else None)
    if registered is not None:
        df = registered
    elif in_type == "parquet":
        df = spark.read.options(**options).parquet(name)
    elif in_type == "table":
        df = spark.table(name)
    elif in_type == "jdbc":
        if not options.get("url"):
            raise ValueError(f"jdbc source {name!r}: its rule has no url")
        df = spark.read.format("jdbc").options(**options).option("dbtable", name).load()
    else:
        raise ValueError(f"unknown inType {spec.get('inType')!r} for source {name!r}")
    return df.select(*[F.col(f).cast("string").alias(f) for f in fields])
