"""Registered queries: one per operator group, each with a DuckDB oracle.

Every query reads the given tables (through ``testbed``) and runs over them whole.
Spark queries are built with the library; the oracle SQL restates the same result in
plain SQL so the two can be compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions.rules import parse_rule, source_spec
from tagweave.functions.schedule import decode_schedule, encode_schedule, scheduler_time
from tagweave.operators import catalog_ops as C
from tagweave.operators.lookup import value_rules
from tagweave.operators.match import date_digits, match_ranges, match_rules, match_values
from tagweave.operators.merge import merge_with_history, merge_with_history_sql
from tagweave.plans import models as M
from tagweave.plans import testbed as T
from tagweave.plans.runner import plan, run, snapshot_after
from tagweave.schemas import SOURCE_KEYS
from tagweave.session import ensure_checkpoint_dir
from tagweave.sources.catalog import load_model_catalog, load_tag_catalog
from tagweave.sources.cells import read_cells
from tagweave.sources.store import StoreSpec, upsert_frame

Query = Callable[[SparkSession, str], DataFrame]
EVENT_TYPES = ["view", "click", "purchase", "signup", "error"]


# ---------------------------------------------------------------- Spark side
def _catalog(spark, d):
    return T.base_catalog(spark, d)


def _tables(spark, d):
    return {T.USERS_TABLE: T.user_cells(spark, d)}


def q_match_lookup(spark, d):
    return match_rules(T.users(spark, d), value_rules(_catalog(spark, d), M.JOB_TAG_ID), "job")


def q_match_blacklist(spark, d):
    return match_rules(T.users(spark, d), value_rules(_catalog(spark, d), M.BLACKLIST_TAG_ID),
                       "is_blackList")


def q_match_nationality(spark, d):
    return match_rules(T.users(spark, d), value_rules(_catalog(spark, d), M.NATIONALITY_TAG_ID),
                       "nationality")


def q_match_case_gender(spark, d):
    return match_values(T.users(spark, d), "gender", M.GENDER_VALUES)


def q_match_case_job(spark, d):
    return match_values(T.users(spark, d), "job_code", M.JOB_VALUES)


def q_match_age_range(spark, d):
    return match_ranges(T.users(spark, d), date_digits("birthday"), M.AGE_RANGES)


def _age_rule_rows(spark, d):
    c = _catalog(spark, d).where(F.col("pid") == M.AGE_TAG_ID)
    parts = F.split("rule", "-")
    return c.select(parts.getItem(0).cast("bigint").alias("lo"), parts.getItem(1).cast("bigint").alias("hi"),
                    F.col("id").cast("int").alias("id"))


def q_match_age_range_join(spark, d):
    """The same ranges read from the catalog and matched by an interval index."""
    return match_ranges(T.users(spark, d), date_digits("birthday"), _age_rule_rows(spark, d))


def q_merge_inner(spark, d):
    return merge_with_history(q_match_lookup(spark, d), T.history(spark, d), join="inner",
                              order="old_first", blank="empty")


def q_merge_left(spark, d):
    return merge_with_history(q_match_age_range(spark, d), T.history(spark, d), join="left",
                              order="old_first", blank="blank")


def q_merge_left_sql(spark, d):
    return merge_with_history_sql(spark, q_match_age_range(spark, d), T.history(spark, d))


def q_merge_left_new_first(spark, d):
    return merge_with_history(q_match_case_job(spark, d), T.history(spark, d), join="left",
                              order="new_first", blank="blank")


def q_cells_latest(spark, d):
    return read_cells(T.event_cells(spark, d), "events", EVENT_TYPES, rowkey_as="userId",
                      order_by=F.struct("ts", "event_id"))


def q_user_cells(spark, d):
    """The users read back from their cell table (the wide-column source scan)."""
    return read_cells(T.user_cells(spark, d), "base", T.USER_FIELDS, rowkey_as="id")


def q_store_upsert(spark, d):
    return upsert_frame(T.history(spark, d), q_cells_latest(spark, d), "userId",
                        fields=["click", "purchase"])


def q_store_replace(spark, d):
    return upsert_frame(T.history(spark, d), q_match_case_gender(spark, d).select(
        "userId", F.col("tagIds").cast("string").alias("tagIds")), "userId", fields=["tagIds"])


def _customer_rules(spark, d):
    c = T.table(spark, d, "customer")
    rule = F.concat(F.lit("inType=HBase##hbaseTable=crm_people##family=base##selectFields=id,"),
                    F.lower("c_mktsegment"), F.lit("####rowKey=id##note="), F.col("c_name"),
                    F.lit("=x##family="), F.col("c_mktsegment"), F.lit("##flag##"))
    return c.select(F.col("c_custkey").alias("id"), rule.alias("rule"))


def q_rule_parse(spark, d):
    r = _customer_rules(spark, d)
    return r.select("id", F.explode(parse_rule("rule")).alias("key", "value"))


def q_source_spec(spark, d):
    r = _customer_rules(spark, d)
    return r.select("id", source_spec(parse_rule("rule"), "").alias("s")).select("id", "s.*")


def q_catalog_specs(spark, d):
    """Every level-4 rule of the catalog as a source spec (missing keys null)."""
    tags = _full(spark, d)[0].where(F.col("level") == 4)
    return tags.select("id", source_spec(parse_rule("rule"), None).alias("s")).select("id", "s.*")


def q_schedule_roundtrip(spark, d):
    o = T.table(spark, d, "orders")
    packed = encode_schedule((F.lit(1) + F.col("o_orderkey") % 5).cast("int"), F.col("o_orderdate"),
                             F.timestamp_add("DAY", F.lit(30), F.col("o_orderdate")))
    s = o.select("o_orderkey", packed.alias("sche_time"))
    s = s.select("o_orderkey", "sche_time", decode_schedule("sche_time").alias("d"))
    return s.select("o_orderkey", "sche_time", F.col("d.frequency").alias("frequency"),
                    F.col("d.start").alias("start_time"), F.col("d.end").alias("end_time"),
                    scheduler_time(F.col("d.start")).alias("start_param"))


def _full(spark, d):
    return T.stored_catalogs(spark, d)


def q_tags_by_level(spark, d):
    return C.tags_by_level(_full(spark, d)[0], 2)


def q_tags_by_parent(spark, d):
    return C.tags_by_parent(_full(spark, d)[0], T.PROFILE_NODE)


def q_tags_find(spark, d):
    return C.find_tags(_full(spark, d)[0], "job", 4, T.PROFILE_NODE)


def q_tag_with_model(spark, d):
    tags, models = _full(spark, d)
    t = C.tags_with_models(tags, models, T.PROFILE_NODE)
    return t.select(F.col("tag.id").alias("tag_id"), F.col("tag.pid").alias("tag_pid"),
                    F.col("tag.level").alias("tag_level"), F.col("tag.name").alias("tag_name"),
                    F.col("tag.rule").alias("tag_rule"), F.col("model.id").alias("model_id"),
                    F.col("model.name").alias("model_name"), F.col("model.main_class").alias("main_class"),
                    F.col("model.path").alias("model_path"), F.col("model.args").alias("args"),
                    F.col("model.state").alias("state"),
                    F.col("model.schedule.frequency").alias("frequency"),
                    F.col("model.schedule.start").alias("start_time"),
                    F.col("model.schedule.end").alias("end_time"))


MODEL_OUT = ["id", "tag_id", "model_name", "model_main", "model_path", "sche_time", "state", "args"]


def q_add_model_tag(spark, d):
    return T.catalogs(spark, d)[1].select(*MODEL_OUT)


def q_model_state(spark, d):
    tags, models = _full(spark, d)
    changes = T.state_changes(spark, d, tags)
    return C.apply_state_changes(models, changes, F.struct("changed_at", "l_linenumber")).select(*MODEL_OUT)


def q_path_upsert(spark, d):
    """Category paths of all customers into a catalog that holds two of the regions."""
    _, inserted = C.upsert_paths(T.part_catalog(spark, d), T.customer_paths(spark, d),
                                 ["level1", "level2", "level3"], now=T.NOW, rules=[None, None, "level3"])
    return inserted.select(*C.TAG_VIEW, F.col("ctime").cast("string").alias("ctime"),
                           F.col("utime").cast("string").alias("utime"))


def q_add_value_tag(spark, d):
    seg = T.table(spark, d, "customer").select("c_mktsegment").distinct()
    req = seg.select(F.lower("c_mktsegment").alias("name"), F.lit(M.JOB_TAG_ID).cast("long").alias("pid"),
                     F.col("c_mktsegment").alias("rule"))
    return C.tag_view(C.add_value_tags(_catalog(spark, d), req, ["name"], now=T.NOW))


def _tagging(model):
    def q(spark, d):
        return plan(model, _catalog(spark, d), T.history(spark, d), _tables(spark, d))
    return q


def q_upsert_repeated_keys(spark, d):
    """All raw lineitems by order key (many rows per key) written over the line history."""
    li = T.table(spark, d, "lineitem").select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-1")).alias("userId"),
        F.col("l_partkey").cast("string").alias("tagIds"), "l_linenumber", "l_extendedprice")
    return upsert_frame(T.line_history(spark, d), li, "userId", fields=["tagIds"],
                        order=F.struct("l_extendedprice", "l_linenumber"))


def q_run_two_models(spark, d):
    """Two models run into a store, with the catalogs loaded from where they are stored.

    The store starts with the history; the job and the age model each publish a version;
    the result is the store as read back.
    """
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    tags, models = T.stored_catalogs(spark, d)
    tags.write.parquet(f"{root}/tags")
    models.write.parquet(f"{root}/models")
    T.user_cells(spark, d).write.parquet(f"{root}/cells")
    catalog = load_tag_catalog(spark, f"{root}/tags")
    known = load_model_catalog(spark, f"{root}/models")
    store = StoreSpec.from_options({"path": f"{root}/store", "rowKey": "userId", "selectFields": "tagIds"}).open(spark)
    store.upsert(T.history(spark, d))
    for model in (M.job_tag(), M.age_model()):
        run(model, catalog, store, {T.USERS_TABLE: spark.read.parquet(f"{root}/cells")})
    return store.read().withColumn("version", F.lit(store.latest_version()).cast("int")) \
        .withColumn("models", F.lit(known.count()).cast("long"))


def q_match_lookup_lineitem(spark, d):
    return match_rules(T.line_users(spark, d), value_rules(_catalog(spark, d), M.JOB_TAG_ID), "job")


def q_merge_left_lineitem(spark, d):
    return merge_with_history(q_match_lookup_lineitem(spark, d), T.line_history(spark, d), join="left",
                              order="old_first", blank="blank")


def q_upsert_merge_lineitem(spark, d):
    new = q_match_lookup_lineitem(spark, d).select("userId", F.col("tagIds").cast("string").alias("tagIds"))
    return snapshot_after(M.age_model(), T.line_history(spark, d), new)


QUERIES: dict[str, Query] = {
    "match_lookup": q_match_lookup,
    "match_blacklist": q_match_blacklist,
    "match_nationality": q_match_nationality,
    "match_case_gender": q_match_case_gender,
    "match_case_job": q_match_case_job,
    "match_age_range": q_match_age_range,
    "match_age_range_join": q_match_age_range_join,
    "merge_inner": q_merge_inner,
    "merge_left": q_merge_left,
    "merge_left_sql": q_merge_left_sql,
    "merge_left_new_first": q_merge_left_new_first,
    "cells_latest": q_cells_latest,
    "user_cells": q_user_cells,
    "store_upsert": q_store_upsert,
    "store_replace": q_store_replace,
    "rule_parse": q_rule_parse,
    "source_spec": q_source_spec,
    "catalog_specs": q_catalog_specs,
    "schedule_roundtrip": q_schedule_roundtrip,
    "tags_by_level": q_tags_by_level,
    "tags_by_parent": q_tags_by_parent,
    "tags_find": q_tags_find,
    "tag_with_model": q_tag_with_model,
    "add_model_tag": q_add_model_tag,
    "model_state": q_model_state,
    "path_upsert": q_path_upsert,
    "add_value_tag": q_add_value_tag,
    "tagging_job": _tagging(M.job_tag()),
    "tagging_blacklist": _tagging(M.blacklist_tag()),
    "tagging_nationality": _tagging(M.nationality_tag()),
    "tagging_gender": _tagging(M.gender_model()),
    "tagging_job_model": _tagging(M.job_model("job_code")),
    "tagging_age": _tagging(M.age_model()),
    "match_lookup_lineitem": q_match_lookup_lineitem,
    "merge_left_lineitem": q_merge_left_lineitem,
    "upsert_merge_lineitem": q_upsert_merge_lineitem,
    "upsert_repeated_keys": q_upsert_repeated_keys,
    "run_two_models": q_run_two_models,
}


# ---------------------------------------------------------------- oracle SQL (DuckDB)
def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _values(rows, names) -> str:
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS v({', '.join(names)})"


def _blank_sql(x: str, blank: str) -> str:
    if blank == "empty":
        return f"({x} IS NULL OR {x} = '')"
    return f"({x} IS NULL OR regexp_matches({x}, '^[\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{3000}}]*$'))"


def merge_sql(a: str, b: str, blank: str) -> str:
    """``a`` first; empty ``a`` -> ``b``; empty ``b`` -> ``a``; else distinct items."""
    items = f"list_filter(list_concat(string_split({a}, ','), string_split({b}, ',')), lambda t: t <> '')"
    both = f"array_to_string(list_filter({items}, lambda x, i: list_position({items}, x) = i), ',')"
    return (f"CASE WHEN {_blank_sql(a, blank)} THEN {b} WHEN {_blank_sql(b, blank)} THEN {a} "
            f"ELSE {both} END")


_HIST = " ".join(f"WHEN {i} THEN {_lit(t)}" for i, t in enumerate(T.HISTORY_TAGS))
USERS_SQL = (
    "users AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS job, "
    "CAST(1 + c_custkey % 8 AS VARCHAR) AS job_code, CAST(1 + c_custkey % 3 AS VARCHAR) AS gender, "
    "CAST(c_nationkey AS VARCHAR) AS nationality, "
    "CASE WHEN c_acctbal < 0 THEN '1' ELSE '0' END AS is_blackList, "
    f"CAST(DATE '{T.BIRTHDAY_BASE}' + CAST(c_custkey * 37 % 22000 AS INTEGER) AS VARCHAR) AS birthday "
    "FROM customer UNION ALL SELECT 's' || s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'AUTOMOBILE' END, "
    "' ' || (1 + s_suppkey % 8), '0' || (1 + s_suppkey % 3), CAST(s_nationkey AS VARCHAR), "
    "CASE WHEN s_acctbal < 0 THEN '1' ELSE '0' END, CASE WHEN s_suppkey % 4 > 0 THEN "
    f"CAST(DATE '{T.BIRTHDAY_BASE}' + CAST(s_suppkey * 53 % 22000 AS INTEGER) AS VARCHAR) END FROM supplier)"
)
HISTORY_SQL = (
    f"history AS (SELECT userId, CASE n % {len(T.HISTORY_TAGS)} {_HIST} END AS tagIds FROM ("
    "SELECT CAST(o_custkey AS VARCHAR) AS userId, count(*) AS n FROM orders GROUP BY o_custkey "
    "UNION ALL SELECT 'e' || user_id, count(*) FROM events GROUP BY user_id))"
)
LINE_USERS_SQL = (
    "line_users AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, "
    "CASE max(l_returnflag) WHEN 'A' THEN 'AUTOMOBILE' WHEN 'N' THEN 'BUILDING' ELSE 'HOUSEHOLD' END AS job "
    "FROM lineitem GROUP BY l_orderkey, l_linenumber UNION ALL SELECT 'o' || o_orderkey, "
    "CASE o_orderstatus WHEN 'F' THEN 'FURNITURE' WHEN 'O' THEN 'MACHINERY' ELSE 'HOUSEHOLD' END FROM orders)"
)
LINE_HISTORY_SQL = (
    "line_history AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS userId, "
    f"CASE l_linenumber % {len(T.HISTORY_TAGS)} {_HIST} END AS tagIds FROM (SELECT DISTINCT l_orderkey, "
    f"l_linenumber FROM lineitem) UNION ALL SELECT 'p' || p_partkey, "
    f"CASE p_size % {len(T.HISTORY_TAGS)} {_HIST} END FROM part)"
)
_TAG_COLS = ["id", "pid", "level", "name", "rule"]
BASE_SQL = (
    "base AS (SELECT CAST(id AS BIGINT) AS id, CAST(pid AS BIGINT) AS pid, CAST(level AS INTEGER) AS level, "
    "name, CAST(rule AS VARCHAR) AS rule FROM ("
    "SELECT r_regionkey + 1 AS id, -1 AS pid, 1 AS level, r_name AS name, NULL AS rule FROM region "
    "UNION ALL SELECT n_nationkey + 10, n_regionkey + 1, 2, n_name, NULL FROM nation "
    f"UNION ALL SELECT n_nationkey + {T.NATIONALITY_RULE_BASE}, {M.NATIONALITY_TAG_ID}, 5, n_name, "
    "CAST(n_nationkey AS VARCHAR) FROM nation "
    f"UNION ALL SELECT * FROM {_values(T.FIXED_TAGS, _TAG_COLS)} "
    "UNION ALL SELECT * FROM "
    + _values([(tag, M.AGE_TAG_ID, 5, f"{lo}-{hi}", f"{lo}-{hi}") for lo, hi, tag in M.AGE_RANGES], _TAG_COLS)
    + " UNION ALL SELECT * FROM "
    + _values([(tag, M.JOB_MODEL_TAG_ID, 5, f"code {v}", v) for v, tag in M.JOB_VALUES.items()], _TAG_COLS)
    + "))"
)
RULE_PREFIX = "inType=parquet##hbaseTable=orders##selectFields=o_orderkey,o_orderstatus##rowKey="
FULL_SQL = (
    BASE_SQL + ", "
    "req AS (SELECT *, (SELECT max(id) FROM base) AS m, row_number() OVER (ORDER BY o_orderkey) AS rn "
    "FROM orders), "
    f"order_tags AS (SELECT CAST(m + rn AS BIGINT) AS id, CAST({T.PROFILE_NODE} AS BIGINT) AS pid, 4 AS level, "
    f"'model-' || CAST(o_orderkey AS VARCHAR) AS name, '{RULE_PREFIX}' || CAST(o_orderkey AS VARCHAR) AS rule "
    "FROM req), "
    "tags AS (SELECT * FROM base UNION ALL SELECT * FROM order_tags), "
    "models AS (SELECT CAST(rn AS BIGINT) AS id, CAST(m + rn AS BIGINT) AS tag_id, "
    "'model-' || CAST(o_orderkey AS VARCHAR) AS model_name, 'tagweave.plans.models' AS model_main, "
    "'/models/' || o_orderpriority AS model_path, "
    "CAST(1 + o_orderkey % 5 AS VARCHAR) || ',' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ',' || "
    "strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d %H:%M:%S') AS sche_time, 1 AS state, "
    "o_orderstatus AS args, o_orderdate AS start_time, o_orderdate + INTERVAL 30 DAY AS end_time, "
    "CAST(1 + o_orderkey % 5 AS INTEGER) AS frequency FROM req)"
)


# the same catalogs with ids taken from the order key (read queries)
STORED_SQL = (FULL_SQL.replace("CAST(m + rn AS BIGINT)", f"CAST({T.ORDER_TAG_BASE} + o_orderkey AS BIGINT)")
              .replace("CAST(rn AS BIGINT)", "CAST(o_orderkey AS BIGINT)"))


def _rules_sql(pid: int) -> str:
    return f"rules AS (SELECT rule, CAST(max(id) AS INTEGER) AS id FROM base WHERE pid = {pid} GROUP BY rule)"


def _match_sql(pid: int, column: str) -> str:
    return (f"WITH {USERS_SQL}, {BASE_SQL}, {_rules_sql(pid)} "
            f"SELECT u.id AS userId, CAST(COALESCE(r.id, 0) AS INTEGER) AS tagIds "
            f"FROM users u LEFT JOIN rules r ON r.rule = u.{column}")


def _case_sql(column: str, mapping) -> str:
    whens = " ".join(f"WHEN TRY_CAST({column} AS INTEGER) = {k} THEN {v}" for k, v in mapping.items())
    return f"CAST(CASE {whens} END AS INTEGER)"


def _age_sql(column: str) -> str:
    b = f"TRY_CAST(replace({column}, '-', '') AS BIGINT)"
    whens = " ".join(f"WHEN {b} BETWEEN {lo} AND {hi} THEN {tag}" for lo, hi, tag in M.AGE_RANGES)
    return f"CAST(CASE {whens} END AS INTEGER)"


def _new_sql(kind: str) -> str:
    """``new`` CTE: ``(userId, tagIds STRING)`` of one model over ``users``."""
    if kind == "job":
        return ("new AS (SELECT u.id AS userId, CAST(COALESCE(r.id, 0) AS VARCHAR) AS tagIds FROM users u "
                "LEFT JOIN rules r ON r.rule = u.job)")
    if kind == "blacklist":
        return ("new AS (SELECT u.id AS userId, CAST(COALESCE(r.id, 0) AS VARCHAR) AS tagIds FROM users u "
                "LEFT JOIN rules r ON r.rule = u.is_blackList)")
    if kind == "nationality":
        return ("new AS (SELECT u.id AS userId, CAST(COALESCE(r.id, 0) AS VARCHAR) AS tagIds FROM users u "
                "LEFT JOIN rules r ON r.rule = u.nationality)")
    if kind == "gender":
        return f"new AS (SELECT id AS userId, CAST({_case_sql('gender', M.GENDER_VALUES)} AS VARCHAR) AS tagIds FROM users)"
    if kind == "job_code":
        return f"new AS (SELECT id AS userId, CAST({_case_sql('job_code', M.JOB_VALUES)} AS VARCHAR) AS tagIds FROM users)"
    if kind == "age":
        return f"new AS (SELECT id AS userId, CAST({_age_sql('birthday')} AS VARCHAR) AS tagIds FROM users)"
    raise ValueError(kind)


def _merge_join_sql(kind: str, join: str, first: str, blank: str, rules_pid: int | None = None) -> str:
    a, b = ("o.tagIds", "n.tagIds") if first == "old" else ("n.tagIds", "o.tagIds")
    rules = f", {BASE_SQL}, {_rules_sql(rules_pid)}" if rules_pid is not None else ""
    key = "COALESCE(o.userId, n.userId)" if join == "inner" else "n.userId"
    how = "JOIN" if join == "inner" else "LEFT JOIN"
    return (f"WITH {USERS_SQL}, {HISTORY_SQL}{rules}, {_new_sql(kind)} "
            f"SELECT {key} AS userId, {merge_sql(a, b, blank)} AS tagIds "
            f"FROM new n {how} history o ON o.userId = n.userId")


def _tagging_sql(kind: str, merge: str, first: str = "old", blank: str = "blank",
                  rules_pid: int | None = None) -> str:
    rules = f", {BASE_SQL}, {_rules_sql(rules_pid)}" if rules_pid is not None else ""
    head = f"WITH {USERS_SQL}, {HISTORY_SQL}{rules}, {_new_sql(kind)} "
    if merge == "replace":
        return (head + "SELECT COALESCE(o.userId, n.userId) AS userId, COALESCE(n.tagIds, o.tagIds) AS tagIds "
                "FROM history o FULL OUTER JOIN new n ON o.userId = n.userId")
    a, b = ("o.tagIds", "n.tagIds") if first == "old" else ("n.tagIds", "o.tagIds")
    merged = f"COALESCE({merge_sql(a, b, blank)}, o.tagIds)"
    if merge == "inner":
        return head + (f"SELECT o.userId AS userId, {merged} AS tagIds "
                       "FROM history o LEFT JOIN new n ON o.userId = n.userId")
    return head + (f"SELECT COALESCE(o.userId, n.userId) AS userId, {merged} AS tagIds "
                   "FROM history o FULL OUTER JOIN new n ON o.userId = n.userId")


_EV = ", ".join(
    f"arg_max(CAST(value AS VARCHAR), (ts, event_id)) FILTER (WHERE event_type = '{t}') AS \"{t}\""
    for t in EVENT_TYPES)
CELLS_SQL = f"SELECT CAST(user_id AS VARCHAR) AS userId, {_EV} FROM events GROUP BY user_id"
_USER_FIELDS = T.USER_FIELDS.split(",")

PARSE_RULES_SQL = (
    "items AS (SELECT id, item, pos FROM (SELECT id, unnest(string_split(rule, '##')) AS item, "
    "generate_subscripts(string_split(rule, '##'), 1) AS pos FROM crules) WHERE item <> ''), "
    "kv AS (SELECT id, split_part(item, '=', 1) AS key, "
    "CASE WHEN strpos(item, '=') > 0 THEN split_part(item, '=', 2) END AS value, pos FROM items), "
    "kv_last AS (SELECT id, key, value FROM (SELECT *, row_number() OVER (PARTITION BY id, key "
    "ORDER BY pos DESC) AS rn FROM kv) WHERE rn = 1)"
)
CUSTOMER_RULES_SQL = (
    "crules AS (SELECT c_custkey AS id, 'inType=HBase##hbaseTable=crm_people##family=base##selectFields=id,' "
    "|| lower(c_mktsegment) || '####rowKey=id##note=' || c_name || '=x##family=' || c_mktsegment || "
    "'##flag##' AS rule FROM customer), " + PARSE_RULES_SQL
)
_SPEC = ", ".join(f"COALESCE(max(value) FILTER (WHERE key = '{k}'), '') AS \"{k}\"" for k in SOURCE_KEYS)
_SPEC_NULL = ", ".join(f"max(value) FILTER (WHERE key = '{k}') AS \"{k}\"" for k in SOURCE_KEYS)

ORACLE: dict[str, str] = {
    "match_lookup": _match_sql(M.JOB_TAG_ID, "job"),
    "match_blacklist": _match_sql(M.BLACKLIST_TAG_ID, "is_blackList"),
    "match_nationality": _match_sql(M.NATIONALITY_TAG_ID, "nationality"),
    "match_case_gender": f"WITH {USERS_SQL} SELECT id AS userId, {_case_sql('gender', M.GENDER_VALUES)} AS tagIds FROM users",
    "match_case_job": f"WITH {USERS_SQL} SELECT id AS userId, {_case_sql('job_code', M.JOB_VALUES)} AS tagIds FROM users",
    "match_age_range": f"WITH {USERS_SQL} SELECT id AS userId, {_age_sql('birthday')} AS tagIds FROM users",
    "match_age_range_join": f"WITH {USERS_SQL} SELECT id AS userId, {_age_sql('birthday')} AS tagIds FROM users",
    "merge_inner": _merge_join_sql("job", "inner", "old", "empty", M.JOB_TAG_ID),
    "merge_left": _merge_join_sql("age", "left", "old", "blank"),
    "merge_left_sql": _merge_join_sql("age", "left", "old", "blank"),
    "merge_left_new_first": _merge_join_sql("job_code", "left", "new", "blank"),
    "cells_latest": CELLS_SQL,
    "user_cells": f"WITH {USERS_SQL} SELECT {', '.join(_USER_FIELDS)} FROM users",
    "store_upsert": (f"WITH {HISTORY_SQL}, cells AS ({CELLS_SQL}) SELECT COALESCE(o.userId, n.userId) AS userId, "
                     "o.tagIds AS tagIds, n.click AS click, n.purchase AS purchase "
                     "FROM history o FULL OUTER JOIN cells n ON o.userId = n.userId"),
    "store_replace": _tagging_sql("gender", "replace").replace("WITH ", "WITH ", 1),
    "rule_parse": f"WITH {CUSTOMER_RULES_SQL} SELECT id, key, value FROM kv_last",
    "source_spec": f"WITH {CUSTOMER_RULES_SQL} SELECT id, {_SPEC} FROM kv_last GROUP BY id",
    "catalog_specs": (f"WITH {STORED_SQL}, crules AS (SELECT id, rule FROM tags WHERE level = 4), {PARSE_RULES_SQL} "
                      f"SELECT c.id AS id, {', '.join(f's.{chr(34)}{k}{chr(34)} AS {chr(34)}{k}{chr(34)}' for k in SOURCE_KEYS)} "
                      f"FROM crules c LEFT JOIN (SELECT id, {_SPEC_NULL} FROM kv_last GROUP BY id) s ON s.id = c.id"),
    "schedule_roundtrip": (
        "SELECT o_orderkey, CAST(1 + o_orderkey % 5 AS VARCHAR) || ',' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') "
        "|| ',' || strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d %H:%M:%S') AS sche_time, "
        "CAST(1 + o_orderkey % 5 AS INTEGER) AS frequency, o_orderdate AS start_time, "
        "o_orderdate + INTERVAL 30 DAY AS end_time, strftime(o_orderdate, '%Y-%m-%dT%H:%M+0800') AS start_param "
        "FROM orders"),
    "tags_by_level": f"WITH {STORED_SQL} SELECT id, pid, level, name, rule FROM tags WHERE level = 2",
    "tags_by_parent": f"WITH {STORED_SQL} SELECT id, pid, level, name, rule FROM tags WHERE pid = {T.PROFILE_NODE}",
    "tags_find": (f"WITH {STORED_SQL} SELECT id, pid, level, name, rule FROM tags "
                  f"WHERE name = 'job' AND level = 4 AND pid IS NOT DISTINCT FROM {T.PROFILE_NODE}"),
    "tag_with_model": (
        f"WITH {STORED_SQL} SELECT t.id AS tag_id, t.pid AS tag_pid, t.level AS tag_level, t.name AS tag_name, "
        "t.rule AS tag_rule, m.id AS model_id, m.model_name AS model_name, m.model_main AS main_class, "
        "m.model_path AS model_path, m.args AS args, m.state AS state, m.frequency AS frequency, "
        "m.start_time AS start_time, m.end_time AS end_time "
        f"FROM tags t LEFT JOIN models m ON m.tag_id = t.id WHERE t.pid = {T.PROFILE_NODE}"),
    "add_model_tag": f"WITH {FULL_SQL} SELECT {', '.join(MODEL_OUT)} FROM models",
    "model_state": (
        f"WITH {STORED_SQL}, changes AS (SELECT t.id AS tag_id, CAST(1 + l_linenumber % 4 AS INTEGER) AS state, "
        "l_shipdate AS changed_at, l_linenumber FROM lineitem l JOIN tags t "
        "ON t.level = 4 AND t.name = 'model-' || CAST(l.l_orderkey AS VARCHAR)), "
        "latest AS (SELECT tag_id, state FROM (SELECT *, row_number() OVER (PARTITION BY tag_id "
        "ORDER BY changed_at DESC, l_linenumber DESC) AS rn FROM changes) WHERE rn = 1) "
        "SELECT m.id, m.tag_id, m.model_name, m.model_main, m.model_path, m.sche_time, "
        "CAST(COALESCE(l.state, m.state) AS INTEGER) AS state, m.args FROM models m "
        "LEFT JOIN latest l ON l.tag_id = m.tag_id"),
    "path_upsert": (
        f"WITH {BASE_SQL.replace(chr(98)+'ase AS (', 'whole AS (', 1)}, base AS (SELECT * FROM whole WHERE NOT (level = 1 AND id > 2) "
        "AND NOT (level = 2 AND pid > 2)), paths AS (SELECT DISTINCT r_name AS l1, n_name AS l2, c_mktsegment AS l3 "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey), "
        "n1 AS (SELECT DISTINCT l1 AS name, CAST(-1 AS BIGINT) AS pid FROM paths), "
        "e1 AS (SELECT name, pid, min(id) AS id FROM base WHERE level = 1 GROUP BY name, pid), "
        "m1 AS (SELECT name, pid FROM n1 ANTI JOIN e1 USING (name, pid)), "
        "i1 AS (SELECT (SELECT max(id) FROM base) + row_number() OVER (ORDER BY pid, name) AS id, pid, 1 AS level, "
        "name FROM m1), "
        "r1 AS (SELECT name, pid, id FROM e1 UNION ALL SELECT name, pid, id FROM i1), "
        "n2 AS (SELECT DISTINCT p.l2 AS name, r1.id AS pid FROM paths p JOIN r1 ON r1.name = p.l1 AND r1.pid = -1), "
        "e2 AS (SELECT name, pid, min(id) AS id FROM base WHERE level = 2 GROUP BY name, pid), "
        "m2 AS (SELECT name, pid FROM n2 ANTI JOIN e2 USING (name, pid)), "
        "i2 AS (SELECT (SELECT max(id) FROM (SELECT id FROM base UNION ALL SELECT id FROM i1)) "
        "+ row_number() OVER (ORDER BY pid, name) AS id, pid, 2 AS level, name FROM m2), "
        "r2 AS (SELECT name, pid, id FROM e2 UNION ALL SELECT name, pid, id FROM i2), "
        "n3 AS (SELECT DISTINCT p.l3 AS name, r2.id AS pid FROM paths p JOIN r1 ON r1.name = p.l1 AND r1.pid = -1 "
        "JOIN r2 ON r2.name = p.l2 AND r2.pid = r1.id), "
        "e3 AS (SELECT name, pid, min(id) AS id FROM base WHERE level = 3 GROUP BY name, pid), "
        "m3 AS (SELECT name, pid FROM n3 ANTI JOIN e3 USING (name, pid)), "
        "i3 AS (SELECT (SELECT max(id) FROM (SELECT id FROM base UNION ALL SELECT id FROM i1 UNION ALL "
        "SELECT id FROM i2)) + row_number() OVER (ORDER BY pid, name) AS id, pid, 3 AS level, name FROM m3) "
        "SELECT CAST(id AS BIGINT) AS id, CAST(pid AS BIGINT) AS pid, CAST(level AS INTEGER) AS level, name, "
        "CASE WHEN level = 3 THEN name END AS rule, "
        f"'{T.NOW}' AS ctime, '{T.NOW}' AS utime "
        "FROM (SELECT * FROM i1 UNION ALL SELECT * FROM i2 UNION ALL SELECT * FROM i3)"),
    "add_value_tag": (
        f"WITH {BASE_SQL}, seg AS (SELECT DISTINCT c_mktsegment FROM customer) "
        "SELECT CAST((SELECT max(id) FROM base) + row_number() OVER (ORDER BY lower(c_mktsegment)) AS BIGINT) AS id, "
        f"CAST({M.JOB_TAG_ID} AS BIGINT) AS pid, 5 AS level, lower(c_mktsegment) AS name, c_mktsegment AS rule FROM seg"),
    "tagging_job": _tagging_sql("job", "inner", "old", "empty", M.JOB_TAG_ID),
    "tagging_blacklist": _tagging_sql("blacklist", "inner", "old", "empty", M.BLACKLIST_TAG_ID),
    "tagging_nationality": _tagging_sql("nationality", "inner", "old", "empty", M.NATIONALITY_TAG_ID),
    "tagging_gender": _tagging_sql("gender", "replace"),
    "tagging_job_model": _tagging_sql("job_code", "left", "new", "blank"),
    "tagging_age": _tagging_sql("age", "left", "old", "blank"),
    "match_lookup_lineitem": (
        f"WITH {LINE_USERS_SQL}, {BASE_SQL}, {_rules_sql(M.JOB_TAG_ID)} SELECT u.id AS userId, "
        "CAST(COALESCE(r.id, 0) AS INTEGER) AS tagIds FROM line_users u LEFT JOIN rules r ON r.rule = u.job"),
    "merge_left_lineitem": (
        f"WITH {LINE_USERS_SQL}, {LINE_HISTORY_SQL}, {BASE_SQL}, {_rules_sql(M.JOB_TAG_ID)}, "
        "new AS (SELECT u.id AS userId, CAST(COALESCE(r.id, 0) AS VARCHAR) AS tagIds FROM line_users u "
        "LEFT JOIN rules r ON r.rule = u.job) "
        f"SELECT n.userId AS userId, {merge_sql('o.tagIds', 'n.tagIds', 'blank')} AS tagIds "
        "FROM new n LEFT JOIN line_history o ON o.userId = n.userId"),
    "upsert_merge_lineitem": (
        f"WITH {LINE_USERS_SQL}, {LINE_HISTORY_SQL}, {BASE_SQL}, {_rules_sql(M.JOB_TAG_ID)}, "
        "new AS (SELECT u.id AS userId, CAST(COALESCE(r.id, 0) AS VARCHAR) AS tagIds FROM line_users u "
        "LEFT JOIN rules r ON r.rule = u.job) "
        "SELECT COALESCE(o.userId, n.userId) AS userId, "
        f"COALESCE({merge_sql('o.tagIds', 'n.tagIds', 'blank')}, o.tagIds) AS tagIds "
        "FROM line_history o FULL OUTER JOIN new n ON o.userId = n.userId"),
    "upsert_repeated_keys": (
        f"WITH {LINE_HISTORY_SQL}, n AS (SELECT CAST(l_orderkey AS VARCHAR) || '-1' AS userId, "
        "arg_max(CAST(l_partkey AS VARCHAR), (l_extendedprice, l_linenumber, CAST(l_partkey AS VARCHAR))) AS tagIds "
        "FROM lineitem GROUP BY l_orderkey) "
        "SELECT COALESCE(o.userId, n.userId) AS userId, COALESCE(n.tagIds, o.tagIds) AS tagIds "
        "FROM line_history o FULL OUTER JOIN n ON o.userId = n.userId"),
    "run_two_models": (
        f"WITH {USERS_SQL}, {HISTORY_SQL}, {BASE_SQL}, {_rules_sql(M.JOB_TAG_ID)}, {_new_sql('job')}, "
        f"{_new_sql('age').replace('new AS', 'aged AS', 1)}, "
        f"first AS (SELECT o.userId AS userId, COALESCE({merge_sql('o.tagIds', 'n.tagIds', 'empty')}, o.tagIds) AS tagIds "
        "FROM history o LEFT JOIN new n ON o.userId = n.userId) "
        f"SELECT COALESCE(o.userId, n.userId) AS userId, COALESCE({merge_sql('o.tagIds', 'n.tagIds', 'blank')}, o.tagIds) "
        "AS tagIds, 3 AS version, (SELECT count(*) FROM orders) AS models "
        "FROM first o FULL OUTER JOIN aged n ON o.userId = n.userId"),
}
