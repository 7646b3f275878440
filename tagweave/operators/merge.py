"""Merge newly computed tags with each user's earlier tags.

Both sides are keyed by user id (unique per side), so the join is a sort-merge join
on the key with no hot key by construction.  In the end-to-end job the merge is folded
into the store upsert instead (one full outer join, see ``plans.runner``); this
function is the stand-alone form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions.tags import merge_tags, register_sql_functions
from tagweave.schemas import TAG_COL, USER_KEY
from tagweave.sources.store import require_key

JOINS = ("inner", "left")
ORDERS = ("old_first", "new_first")


def merged_tag(old, new, order: str = "old_first", blank: str = "blank"):
    """Merged tag column of the old and new lists in the chosen order."""
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}")
    return merge_tags(old, new, blank) if order == "old_first" else merge_tags(new, old, blank)


def merge_with_history(new: DataFrame, old: DataFrame, *, key: str = USER_KEY, tag: str = TAG_COL,
                       join: str = "left", order: str = "old_first",
                       blank: str = "blank") -> DataFrame:
    """``(key, tag)`` rows of ``new`` merged with ``old``.

    ``join="inner"``: only users present in both (users without history get nothing);
    ``join="left"``: every new user, merged with history when there is one.  A null key
    of ``new`` is an error, as in the store.
    """
    if join not in JOINS:
        raise ValueError(f"join must be one of {JOINS}")
    n = require_key(new, key).select(F.col(key).cast("string").alias("_nk"), F.col(tag).cast("string").alias("_nt"))
    o = old.select(F.col(key).cast("string").alias("_ok"), F.col(tag).cast("string").alias("_ot"))
    j = n.join(o, n["_nk"] == o["_ok"], join)
    out_key = F.coalesce(F.col("_ok"), F.col("_nk")) if join == "inner" else F.col("_nk")
    return j.select(out_key.alias(key),
                    merged_tag(F.col("_ot"), F.col("_nt"), order, blank).alias(tag))


def merge_with_history_sql(spark: SparkSession, new: DataFrame, old: DataFrame) -> DataFrame:
    """The SQL form: ``new LEFT JOIN old`` with the registered ``merge_tags(old, new)``
    (blank-aware, old first).  Catalyst plans it exactly like :func:`merge_with_history`."""
    register_sql_functions(spark)
    return spark.sql(
        f"SELECT n.{USER_KEY} AS {USER_KEY}, "
        f"merge_tags(CAST(o.{TAG_COL} AS STRING), CAST(n.{TAG_COL} AS STRING)) AS {TAG_COL} "
        f"FROM {{new}} n LEFT JOIN {{old}} o ON o.{USER_KEY} = n.{USER_KEY}",
        new=new, old=old)
