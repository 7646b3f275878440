"""Scans of the tag catalog and the model catalog.

Both are small tables.  A source may be a DataFrame, a Parquet path, or a JDBC URL
(``jdbc:...``; the driver jar must be on the cluster's class path).  Whatever the
source, the result is conformed to the fixed schema so later steps can rely on types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagweave.schemas import MODEL_CATALOG, TAG_CATALOG


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns in order, cast; a missing column becomes null."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def _load(spark: SparkSession, source, table: str, properties: dict | None) -> DataFrame:
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, str) and source.startswith("jdbc:"):
        return spark.read.jdbc(source, table, properties=properties or {})
    return spark.read.parquet(source)


def load_tag_catalog(spark: SparkSession, source, *, table: str = "tbl_basic_tag",
                     properties: dict | None = None) -> DataFrame:
    """The tag tree ``(id, pid, level, name, rule, ctime, utime)``."""
    return conform(_load(spark, source, table, properties), TAG_CATALOG)


def load_model_catalog(spark: SparkSession, source, *, table: str = "tbl_model",
                       properties: dict | None = None) -> DataFrame:
    """The model table ``(id, tag_id, model_name, ..., state, args)``."""
    return conform(_load(spark, source, table, properties), MODEL_CATALOG)
