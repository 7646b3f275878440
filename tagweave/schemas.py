"""Schemas and fixed values of the tag catalog, model catalog, cells and tag store."""

from __future__ import annotations

from pyspark.sql.types import (IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)

TAG_CATALOG = StructType([
    StructField("id", LongType()),
    StructField("pid", LongType()),
    StructField("level", IntegerType()),
    StructField("name", StringType()),
    StructField("rule", StringType()),
    StructField("ctime", TimestampType()),
    StructField("utime", TimestampType()),
])

MODEL_CATALOG = StructType([
    StructField("id", LongType()),
    StructField("tag_id", LongType()),
    StructField("model_name", StringType()),
    StructField("model_main", StringType()),
    StructField("model_path", StringType()),
    StructField("sche_time", StringType()),
    StructField("ctime", TimestampType()),
    StructField("utime", TimestampType()),
    StructField("state", IntegerType()),
    StructField("args", StringType()),
])

# One cell of a wide-column table: row key -> family -> qualifier -> value, versioned by ts.
CELLS = StructType([
    StructField("rowkey", StringType()),
    StructField("family", StringType()),
    StructField("qualifier", StringType()),
    StructField("value", StringType()),
    StructField("ts", TimestampType()),
])

# Fixed values (must equal the reference for the catalog to mean the same thing).
# Model state: 1 apply, 2 passed, 3 enable, 4 disable.
STATE_APPLY, STATE_PASSED, STATE_ENABLE, STATE_DISABLE = 1, 2, 3, 4
# Schedule frequency: 1 once, 2 day, 3 week, 4 month, 5 year.
FREQ_ONCE, FREQ_DAY, FREQ_WEEK, FREQ_MONTH, FREQ_YEAR = 1, 2, 3, 4, 5
# Keys of a level-4 source rule, in their natural order.
SOURCE_KEYS = ("inType", "zkHosts", "zkPort", "hbaseTable", "family", "selectFields", "rowKey")
# Tag store columns: one spelling for the whole library.
USER_KEY = "userId"
TAG_COL = "tagIds"
