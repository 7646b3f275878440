"""Small literal DataFrames built inside the JVM.

``spark.createDataFrame(list)`` goes through a Python RDD, so every job that scans it
starts Python workers; one ``lit`` per value costs a driver round trip each.  Literal
rows are instead passed as one JSON text and expanded with ``inline(from_json(...))``
over a one-row range: one literal, and the plan stays in the JVM.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def _plain(v):
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    return v


def literal_frame(spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str) -> DataFrame:
    """A DataFrame of ``rows`` (tuples in schema order) with exactly ``schema``."""
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    names = [f.name for f in st.fields]
    text = json.dumps([{n: _plain(v) for n, v in zip(names, r)} for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), ArrayType(st)))).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in st.fields])
