"""Inputs for the registered queries, derived by Spark from the given tables.

* users: one per ``customer`` and one per ``supplier`` (the wide source of the tag models;
  suppliers hold the untidy values: ``'01'``, ``' 2'``, nulls); the bench also uses one
  user per ``lineitem`` key (``orderkey-linenumber``) and one per ``orders`` row.
* tag history: the store as the previous run left it: one user per customer of all
  ``orders`` and one per user of all ``events`` (all ``lineitem`` keys and all ``part``
  rows).  Suppliers (orders) are new users, event users (parts) old ones.
* tag catalog: regions (level 1) and nations (level 2) from the tables, the model
  tags and value rules below, and one level-4 model tag per order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.frames import literal_frame
from tagweave.functions.rules import format_rule
from tagweave.functions.schedule import encode_schedule
from tagweave.operators.catalog_ops import add_model_tags
from tagweave.plans import models as M
from tagweave.schemas import MODEL_CATALOG, TAG_CATALOG
from tagweave.sources.catalog import conform
from tagweave.sources.cells import to_cells

# Fixed values of the fixture (invented unless they are a reference tag id).
CATALOG_TIME = dt.datetime(2019, 9, 24, 6, 15)
NOW = dt.datetime(2019, 9, 30, 6, 15)
PROFILE_NODE = 40  # level-3 node holding the model tags
USERS_TABLE = "crm_people"
CELL_TIME = dt.datetime(2019, 9, 1)
HISTORY_TAGS = ["", "65", "62,65", None, "  ", "67,70", "\u3000"]  # by row count mod 7
BIRTHDAY_BASE = "1955-01-01"

USER_FIELDS = "id,job,job_code,gender,nationality,is_blackList,birthday"


def _rule(fields: str) -> str:
    return format_rule([("inType", "HBase"), ("zkHosts", "zk-1"), ("zkPort", "2181"),
                        ("hbaseTable", USERS_TABLE), ("family", "base"),
                        ("selectFields", fields), ("rowKey", "id")])


# (id, pid, level, name, rule): model tags (level 4) and their value rules (level 5).
FIXED_TAGS = [
    (PROFILE_NODE, 10, 3, "profile", None),
    (M.NATIONALITY_TAG_ID, PROFILE_NODE, 4, "nationality", _rule("id,nationality")),
    (M.JOB_TAG_ID, PROFILE_NODE, 4, "job", _rule("id,job")),
    (65, M.JOB_TAG_ID, 5, "automobile", "AUTOMOBILE"),
    (66, M.JOB_TAG_ID, 5, "building", "BUILDING"),
    (67, M.JOB_TAG_ID, 5, "furniture", "FURNITURE"),
    (68, M.JOB_TAG_ID, 5, "machinery", "MACHINERY"),
    (69, M.JOB_TAG_ID, 5, "furniture (newer rule)", "FURNITURE"),
    (M.BLACKLIST_TAG_ID, PROFILE_NODE, 4, "blacklist", _rule("id,is_blackList")),
    (72, M.BLACKLIST_TAG_ID, 5, "listed", "1"),
    (73, M.BLACKLIST_TAG_ID, 5, "not listed", "0"),
    (M.GENDER_TAG_ID, PROFILE_NODE, 4, "gender", _rule("id,gender")),
    (257, M.GENDER_TAG_ID, 5, "male", "1"),
    (258, M.GENDER_TAG_ID, 5, "female", "2"),
    (M.JOB_MODEL_TAG_ID, PROFILE_NODE, 4, "job code", _rule("id,job_code")),
    (M.AGE_TAG_ID, PROFILE_NODE, 4, "age", _rule("id,birthday")),
]
NATIONALITY_RULE_BASE = 400  # level-5 nationality rule id = 400 + n_nationkey


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _history_tag(n: Column) -> Column:
    out = None
    for i, tag in enumerate(HISTORY_TAGS):
        cond = n % len(HISTORY_TAGS) == i
        val = F.lit(tag).cast("string")
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), s.cast("string")).alias("id"),
        F.when(s % 2 == 0, "AUTOMOBILE").alias("job"),
        F.concat(F.lit(" "), (F.lit(1) + s % 8).cast("string")).alias("job_code"),
        F.concat(F.lit("0"), (F.lit(1) + s % 3).cast("string")).alias("gender"),
        F.col("s_nationkey").cast("string").alias("nationality"),
        F.when(F.col("s_acctbal") < 0, F.lit("1")).otherwise(F.lit("0")).alias("is_blackList"),
        F.when(s % 4 > 0, F.date_add(F.lit(BIRTHDAY_BASE).cast("date"), (s * 53 % 22000).cast("int"))
               .cast("string")).alias("birthday"),
    )
    customers = c.select(
        k.cast("string").alias("id"),
        F.col("c_mktsegment").alias("job"),
        (F.lit(1) + k % 8).cast("string").alias("job_code"),
        (F.lit(1) + k % 3).cast("string").alias("gender"),
        F.col("c_nationkey").cast("string").alias("nationality"),
        F.when(F.col("c_acctbal") < 0, F.lit("1")).otherwise(F.lit("0")).alias("is_blackList"),
        F.date_add(F.lit(BIRTHDAY_BASE).cast("date"), (k * 37 % 22000).cast("int"))
        .cast("string").alias("birthday"),
    )
    return customers.unionByName(suppliers)


def _line_key() -> Column:
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


def line_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user per order line ``orderkey-linenumber`` (the bench's large user table).

    A line number may repeat within an order, so the user's flag is the highest one
    among its rows (a map-side combined aggregate).
    """
    li = table(spark, sf_dir, "lineitem")
    per_key = li.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("flag"))
    flag, status = F.col("flag"), F.col("o_orderstatus")
    lines = per_key.select(
        _line_key().alias("id"),
        F.when(flag == "A", "AUTOMOBILE").when(flag == "N", "BUILDING").otherwise("HOUSEHOLD")
        .alias("job"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"),
        F.when(status == "F", "FURNITURE").when(status == "O", "MACHINERY").otherwise("HOUSEHOLD").alias("job"))
    return lines.unionByName(orders)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored tags ``(userId, tagIds)`` left by the previous run."""
    bought = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("userId"))
    seen = table(spark, sf_dir, "events") \
        .groupBy(F.concat(F.lit("e"), F.col("user_id").cast("string")).alias("userId"))
    both = [g.agg(F.count(F.lit(1)).alias("n")) for g in (bought, seen)]
    return both[0].unionByName(both[1]).select("userId", _history_tag(F.col("n")).alias("tagIds"))


def line_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    parts = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("userId"),
                                                _history_tag(F.col("p_size")).alias("tagIds"))
    return keys.select(_line_key().alias("userId"), _history_tag(F.col("l_linenumber")).alias("tagIds")) \
        .unionByName(parts)


def user_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``users`` stored as cells of family ``base`` (the wide-column source table)."""
    return to_cells(users(spark, sf_dir), "id", "base",
                    ts=F.lit(CELL_TIME).cast("timestamp"), fields=USER_FIELDS.split(","))


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as cells: row key = user, qualifier = event type, versioned by ts."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("string").alias("rowkey"), F.lit("events").alias("family"),
                    F.col("event_type").alias("qualifier"), F.col("value").cast("string").alias("value"),
                    F.col("ts").cast("timestamp").alias("ts"), "event_id")


def base_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, nations, the model tags and their value rules."""
    t = F.lit(CATALOG_TIME).cast("timestamp")
    regions = table(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 1).alias("id"), F.lit(-1).alias("pid"), F.lit(1).alias("level"),
        F.col("r_name").alias("name"), F.lit(None).cast("string").alias("rule"))
    nation = table(spark, sf_dir, "nation")
    nations = nation.select(
        (F.col("n_nationkey") + 10).alias("id"), (F.col("n_regionkey") + 1).alias("pid"),
        F.lit(2).alias("level"), F.col("n_name").alias("name"), F.lit(None).cast("string").alias("rule"))
    nat_rules = nation.select(
        (F.col("n_nationkey") + NATIONALITY_RULE_BASE).alias("id"), F.lit(M.NATIONALITY_TAG_ID).alias("pid"),
        F.lit(5).alias("level"), F.col("n_name").alias("name"), F.col("n_nationkey").cast("string").alias("rule"))
    fixed = literal_frame(
        spark,
        FIXED_TAGS
        + [(tag, M.AGE_TAG_ID, 5, f"{lo}-{hi}", f"{lo}-{hi}") for lo, hi, tag in M.AGE_RANGES]
        + [(tag, M.JOB_MODEL_TAG_ID, 5, f"code {v}", v) for v, tag in M.JOB_VALUES.items()],
        "id LONG, pid LONG, level INT, name STRING, rule STRING")
    allrows = regions.unionByName(nations).unionByName(nat_rules).unionByName(fixed)
    return conform(allrows.withColumn("ctime", t).withColumn("utime", t), TAG_CATALOG)


def model_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One level-4 model tag request per order, scheduled from its order date."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey"),
        F.concat(F.lit("model-"), F.col("o_orderkey").cast("string")).alias("name"),
        F.lit(PROFILE_NODE).cast("long").alias("pid"),
        F.concat(F.lit("inType=parquet##hbaseTable=orders##selectFields=o_orderkey,o_orderstatus"
                       "##rowKey="), F.col("o_orderkey").cast("string")).alias("rule"),
        F.concat(F.lit("model-"), F.col("o_orderkey").cast("string")).alias("model_name"),
        F.lit("tagweave.plans.models").alias("model_main"),
        F.concat(F.lit("/models/"), F.col("o_orderpriority")).alias("model_path"),
        F.col("o_orderstatus").alias("args"),
        F.lit(1).alias("state"),
        (F.lit(1) + F.col("o_orderkey") % 5).cast("int").alias("frequency"),
        F.col("o_orderdate").alias("start"),
        F.timestamp_add("DAY", F.lit(30), F.col("o_orderdate")).alias("end"),
    )


def empty_models(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, [], MODEL_CATALOG)


def catalogs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(tag_catalog, model_catalog)``: the base catalog plus one model tag per order."""
    base = base_catalog(spark, sf_dir)
    tags, models = add_model_tags(base, empty_models(spark), model_requests(spark, sf_dir),
                                  ["o_orderkey"], now=NOW)
    return base.unionByName(tags), models


ORDER_TAG_BASE = 100_000  # stored_catalogs: tag id of an order's model


def stored_catalogs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(tag_catalog, model_catalog)`` as tables that already hold their ids.

    One model tag per order with ids taken from the order key, so a read is one plan that
    filters reach, without numbering rows first.
    """
    r = model_requests(spark, sf_dir)
    t = F.lit(NOW).cast("timestamp")
    tag_id = F.col("o_orderkey") + ORDER_TAG_BASE
    tags = conform(r.select(tag_id.alias("id"), "pid", F.lit(4).alias("level"), "name", "rule",
                            t.alias("ctime"), t.alias("utime")), TAG_CATALOG)
    models = conform(r.select(F.col("o_orderkey").alias("id"), tag_id.alias("tag_id"), "model_name", "model_main",
                              "model_path", encode_schedule("frequency", "start", "end").alias("sche_time"),
                              t.alias("ctime"), t.alias("utime"), "state", "args"), MODEL_CATALOG)
    return base_catalog(spark, sf_dir).unionByName(tags), models


def part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base catalog with only the first two regions and their nations."""
    c = base_catalog(spark, sf_dir)
    return c.where(~((F.col("level") == 1) & (F.col("id") > 2)) & ~((F.col("level") == 2) & (F.col("pid") > 2)))


def state_changes(spark: SparkSession, sf_dir: str, tags: DataFrame) -> DataFrame:
    """A model state change per lineitem, for the model of its order, at ship time."""
    li = table(spark, sf_dir, "lineitem")
    t = tags.where(F.col("level") == 4).select(F.col("id").alias("tag_id"), "name")
    return (li.select(F.concat(F.lit("model-"), F.col("l_orderkey").cast("string")).alias("name"),
                      (F.lit(1) + F.col("l_linenumber") % 4).cast("int").alias("state"),
                      F.col("l_shipdate").alias("changed_at"), "l_linenumber")
            .join(t, "name").select("tag_id", "state", "changed_at", "l_linenumber"))


def customer_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(region, nation, segment) of every customer."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
            .select(F.col("r_name").alias("level1"), F.col("n_name").alias("level2"),
                    F.col("c_mktsegment").alias("level3")))
