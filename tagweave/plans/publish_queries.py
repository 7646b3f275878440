"""Registered queries that publish: the layered tag store, the catalog store, anchored path requests.

Each writes its own store under the shared checkpoint folder, runs the library's jobs on it
over whole tables and returns what is read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.operators import catalog_ops as C
from tagweave.plans import models as M
from tagweave.plans import queries as Q
from tagweave.plans import testbed as T
from tagweave.plans.multi import run_all
from tagweave.plans.runner import run
from tagweave.session import ensure_checkpoint_dir
from tagweave.sources.catalog_store import CatalogStore
from tagweave.sources.store import StoreSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def run_models_layered(spark: SparkSession, d: str) -> DataFrame:
    """Gender (replace), job code (new first) and age (old first) run into a layered store.

    The result is the store read through its layers and again after compaction, with the
    number of layers and the rows of the last one.
    """
    options = {"path": _folder(spark, "layers"), "rowKey": "userId", "selectFields": "tagIds", "layered": "true"}
    store = StoreSpec.from_options(options).open(spark)
    store.upsert(T.history(spark, d))
    catalog, cells = T.base_catalog(spark, d), {T.USERS_TABLE: T.user_cells(spark, d)}
    for model in (M.gender_model(), M.job_model("job_code"), M.age_model()):
        run(model, catalog, store, cells)

    def now(stage: str) -> DataFrame:
        layers = store.layers()
        return store.read().select(F.lit(stage).alias("stage"), "userId", "tagIds", F.lit(len(layers)).alias("layers"),
                                   F.lit(layers[-1]["rows"]).cast("long").alias("last_rows"))

    before = now("layers")
    store.compact()
    return before.unionByName(now("compacted"))


QUERIES["run_models_layered"] = run_models_layered
ORACLE["run_models_layered"] = (
    f"WITH {Q.USERS_SQL}, {Q.HISTORY_SQL}, {Q._new_sql('gender').replace('new AS', 'gender AS', 1)}, "
    f"{Q._new_sql('job_code').replace('new AS', 'code AS', 1)}, {Q._new_sql('age').replace('new AS', 'age AS', 1)}, "
    "s1 AS (SELECT COALESCE(o.userId, n.userId) AS userId, COALESCE(n.tagIds, o.tagIds) AS tagIds "
    "FROM history o FULL OUTER JOIN gender n ON o.userId = n.userId), "
    f"s2 AS (SELECT COALESCE(o.userId, n.userId) AS userId, COALESCE({Q.merge_sql('n.tagIds', 'o.tagIds', 'blank')}, o.tagIds) AS tagIds "
    "FROM s1 o FULL OUTER JOIN code n ON o.userId = n.userId), "
    f"s3 AS (SELECT COALESCE(o.userId, n.userId) AS userId, COALESCE({Q.merge_sql('o.tagIds', 'n.tagIds', 'blank')}, o.tagIds) AS tagIds, "
    "o.userId IS NULL AS added, o.tagIds AS was FROM s2 o FULL OUTER JOIN age n ON o.userId = n.userId), "
    "c AS (SELECT count(*) AS n, count(*) FILTER (WHERE added OR tagIds IS DISTINCT FROM was) AS changed FROM s3) "
    "SELECT 'layers' AS stage, userId, tagIds, 4 AS layers, changed AS last_rows FROM s3, c UNION ALL "
    "SELECT 'compacted', userId, tagIds, 1, n FROM s3, c")


def run_all_models(spark: SparkSession, d: str) -> DataFrame:
    """All six models in one pass over the users' cells, published as one version of a snapshot store
    and of a layered one; the result is both as read back."""
    catalog, cells = T.base_catalog(spark, d), {T.USERS_TABLE: T.user_cells(spark, d)}
    models = [M.job_tag(), M.gender_model(), M.blacklist_tag(), M.job_model("job_code"), M.nationality_tag(), M.age_model()]
    parts = []
    for kind in ("false", "true"):
        store = StoreSpec.from_options({"path": _folder(spark, "all"), "rowKey": "userId", "selectFields": "tagIds",
                                        "layered": kind}).open(spark)
        store.upsert(T.history(spark, d))
        run_all(models, catalog, store, cells)
        parts.append(store.read().select(F.lit(kind).alias("layered"), "userId", "tagIds",
                                         F.lit(store.latest_version()).alias("version")))
    return parts[0].unionByName(parts[1])


QUERIES["run_all_models"] = run_all_models


def _next_sql(name: str, before: str, new: str, merge: str, first: str = "old", blank: str = "blank") -> str:
    """The store after one more model, as a CTE over the one before."""
    a, b = ("o.tagIds", "n.tagIds") if first == "old" else ("n.tagIds", "o.tagIds")
    value = "n.tagIds" if merge == "replace" else Q.merge_sql(a, b, blank)
    how = "LEFT JOIN" if merge == "inner" else "FULL OUTER JOIN"
    return (f"{name} AS (SELECT COALESCE(o.userId, n.userId) AS userId, COALESCE({value}, o.tagIds) AS tagIds "
            f"FROM {before} o {how} {new} n ON o.userId = n.userId)")


def _rule_tags_sql(name: str, pid: int, column: str) -> str:
    return (f"{name} AS (SELECT u.id AS userId, CAST(COALESCE(r.id, 0) AS VARCHAR) AS tagIds FROM users u LEFT JOIN "
            f"(SELECT rule, max(id) AS id FROM base WHERE pid = {pid} GROUP BY rule) r ON r.rule = u.{column})")


ORACLE["run_all_models"] = "WITH " + ", ".join([
    Q.USERS_SQL, Q.HISTORY_SQL, Q.BASE_SQL, _rule_tags_sql("n1", M.JOB_TAG_ID, "job"),
    Q._new_sql("gender").replace("new AS", "n2 AS", 1), _rule_tags_sql("n3", M.BLACKLIST_TAG_ID, "is_blackList"),
    Q._new_sql("job_code").replace("new AS", "n4 AS", 1), _rule_tags_sql("n5", M.NATIONALITY_TAG_ID, "nationality"),
    Q._new_sql("age").replace("new AS", "n6 AS", 1),
    _next_sql("s1", "history", "n1", "inner", "old", "empty"), _next_sql("s2", "s1", "n2", "replace"),
    _next_sql("s3", "s2", "n3", "inner", "old", "empty"), _next_sql("s4", "s3", "n4", "left", "new"),
    _next_sql("s5", "s4", "n5", "inner", "old", "empty"), _next_sql("s6", "s5", "n6", "left")]) + (
    " SELECT v.layered AS layered, userId, tagIds, 2 AS version FROM s6, (VALUES ('false'), ('true')) v(layered)")


def anchored_requests(spark: SparkSession, d: str) -> DataFrame:
    """Category requests of every customer, a third of them from the region down, a third under a given
    region id and a third under a given nation id (some of these ids are not in the catalog); and one
    tag without any parent per order."""
    c, n, r = (T.table(spark, d, t) for t in ("customer", "nation", "region"))
    rows = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    rule = F.concat(F.lit("c"), F.col("c_custkey").cast("string"))
    kind = F.col("c_custkey") % 3

    def tag(level: int, name: str | F.Column, pid=None):
        name = F.col(name) if isinstance(name, str) else name
        return F.struct(F.lit(level).alias("level"), name.alias("name"),
                        (pid if pid is not None else F.lit(None)).cast("long").alias("pid"), rule.alias("rule"))

    own = F.concat(F.lower("c_mktsegment"), F.lit(" of "), F.col("n_name"))
    whole = F.array(tag(1, "r_name"), tag(2, "n_name"), tag(3, "c_mktsegment"))
    region = F.array(tag(2, "n_name", F.col("n_regionkey") + 1), tag(3, "c_mktsegment"))
    nation = F.array(tag(3, "c_mktsegment", F.col("n_nationkey") + 10), tag(4, own))
    paths = rows.select(F.col("c_custkey").alias("path_id"),
                        F.inline(F.when(kind == 0, whole).when(kind == 1, region).otherwise(nation)))
    alone = T.table(spark, d, "orders").select(
        (-F.col("o_orderkey")).alias("path_id"), F.lit(4).alias("level"), F.col("o_orderpriority").alias("name"),
        F.lit(None).cast("long").alias("pid"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("rule"))
    return paths.unionByName(alone)


def path_upsert_anchored(spark: SparkSession, d: str) -> DataFrame:
    """Requests with and without given parents into a catalog that holds two of the regions; the second
    run of the same requests is part of the result and inserts nothing."""
    nodes = anchored_requests(spark, d)
    after, first = C.upsert_nodes(T.part_catalog(spark, d), nodes, now=T.NOW)
    _, again = C.upsert_nodes(after, nodes, now=T.NOW)
    return C.tag_view(first).withColumn("run", F.lit(1)).unionByName(C.tag_view(again).withColumn("run", F.lit(2)))


QUERIES["path_upsert_anchored"] = path_upsert_anchored


def _resolved_sql(level: int) -> str:
    """``r<level>``: the requested tags of a level with their id, or the order key of a new one."""
    if level == 1:
        asked = "SELECT path_id, name, rule, CAST(-1 AS BIGINT) AS pid, none AS pk FROM req, nokey WHERE level = 1"
    else:
        asked = (f"SELECT q.path_id, q.name, q.rule, COALESCE(q.pid, p.id) AS pid, CASE WHEN q.pid IS NULL THEN p.key END AS pk "
                 f"FROM req q LEFT JOIN r{level - 1} p ON p.path_id = q.path_id WHERE q.level = {level}")
    own = f"{{'c': 2, 'e': CAST({level} AS BIGINT), 'n': a.name}}"
    return (f"r{level} AS (SELECT a.*, e.id, CASE WHEN e.id IS NOT NULL THEN NULL WHEN a.pk IS NULL "
            f"THEN [{{'c': 0, 'e': COALESCE(a.pid, -9), 'n': ''}}, {own}] "
            f"ELSE list_concat([{{'c': 1, 'e': CAST(0 AS BIGINT), 'n': ''}}], a.pk, [{own}]) END AS key FROM ({asked}) a "
            f"LEFT JOIN e ON a.pk IS NULL AND e.level = {level} AND e.name = a.name AND e.pid IS NOT DISTINCT FROM a.pid)")


ORACLE["path_upsert_anchored"] = (
    f"WITH {Q.BASE_SQL.replace('base AS (', 'whole AS (', 1)}, base AS (SELECT * FROM whole WHERE NOT (level = 1 AND id > 2) "
    "AND NOT (level = 2 AND pid > 2)), "
    "cust AS (SELECT c_custkey AS path_id, c_custkey % 3 AS kind, 'c' || c_custkey AS rule, c_mktsegment AS seg, n_name, r_name, "
    "n_regionkey, n_nationkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey), "
    "req AS (SELECT path_id, 1 AS level, r_name AS name, CAST(NULL AS BIGINT) AS pid, rule FROM cust WHERE kind = 0 "
    "UNION ALL SELECT path_id, 2, n_name, CASE WHEN kind = 1 THEN n_regionkey + 1 END, rule FROM cust WHERE kind < 2 "
    "UNION ALL SELECT path_id, 3, seg, CASE WHEN kind = 2 THEN n_nationkey + 10 END, rule FROM cust "
    "UNION ALL SELECT path_id, 4, lower(seg) || ' of ' || n_name, NULL, rule FROM cust WHERE kind = 2 "
    "UNION ALL SELECT -o_orderkey, 4, o_orderpriority, NULL, 'o' || o_orderkey FROM orders), "
    "nokey AS (SELECT CAST(NULL AS STRUCT(c INTEGER, e BIGINT, n VARCHAR)[]) AS none), "
    "e AS (SELECT name, level, pid, min(id) AS id FROM base GROUP BY name, level, pid), "
    + ", ".join(_resolved_sql(k) for k in (1, 2, 3, 4)) + ", every AS ("
    + " UNION ALL ".join(f"SELECT {k} AS level, path_id, name, rule, pid, pk, key FROM r{k} WHERE id IS NULL" for k in (1, 2, 3, 4))
    + "), fresh AS (SELECT level, name, pid, pk, key, arg_min(rule, path_id) AS rule FROM every GROUP BY level, name, pid, pk, key), "
    "num AS (SELECT *, (SELECT max(id) FROM base) + row_number() OVER (ORDER BY level, key) AS id FROM fresh) "
    "SELECT CAST(n.id AS BIGINT) AS id, CAST(COALESCE(n.pid, p.id) AS BIGINT) AS pid, CAST(n.level AS INTEGER) AS level, n.name AS name, "
    "n.rule AS rule, 1 AS run FROM num n LEFT JOIN num p ON n.pk = p.key")


def catalog_published(spark: SparkSession, d: str) -> DataFrame:
    """Two ingests of model tags, one of value rules and all state changes, each published as a version;
    the result is the latest version's models with their tags."""
    store = CatalogStore(spark, _folder(spark, "catalog"))
    store.start(T.base_catalog(spark, d))
    asked = T.model_requests(spark, d)
    finished = F.col("args") == "F"
    store.add_model_tags(asked.where(finished), ["o_orderkey"], now=T.NOW)
    CatalogStore(spark, store.path).add_model_tags(asked.where(~finished), ["o_orderkey"], now=T.NOW)
    segments = T.table(spark, d, "customer").select("c_mktsegment").distinct()
    store.add_value_tags(segments.select(F.lower("c_mktsegment").alias("name"), F.lit(M.JOB_TAG_ID).cast("long").alias("pid"),
                                         F.col("c_mktsegment").alias("rule")), ["name"], now=T.NOW)
    store.change_states(T.state_changes(spark, d, store.tags()), F.struct("changed_at", "l_linenumber"))
    tags, models = store.read()
    named = tags.select(F.col("id").alias("tag_id"), F.col("name").alias("tag_name"), F.col("pid").alias("tag_pid"))
    return models.join(named, "tag_id", "left").select(
        *Q.MODEL_OUT, "tag_name", "tag_pid", F.lit(store.latest_version()).alias("version"),
        F.lit(tags.count()).cast("long").alias("n_tags"), F.lit(tags.agg(F.max("id")).first()[0]).cast("long").alias("last_id"))


QUERIES["catalog_published"] = catalog_published
_TWO_INGESTS = Q.FULL_SQL.replace("ORDER BY o_orderkey", "ORDER BY o_orderstatus <> 'F', o_orderkey")
ORACLE["catalog_published"] = (
    f"WITH {_TWO_INGESTS}, changes AS (SELECT t.id AS tag_id, CAST(1 + l_linenumber % 4 AS INTEGER) AS state, "
    "l_shipdate AS changed_at, l_linenumber FROM lineitem l JOIN tags t "
    "ON t.level = 4 AND t.name = 'model-' || CAST(l.l_orderkey AS VARCHAR)), "
    "latest AS (SELECT tag_id, arg_max(state, (changed_at, l_linenumber)) AS state FROM changes GROUP BY tag_id), "
    "c AS (SELECT (SELECT count(*) FROM tags) + (SELECT count(DISTINCT c_mktsegment) FROM customer) AS n, "
    "(SELECT max(id) FROM tags) + (SELECT count(DISTINCT c_mktsegment) FROM customer) AS m) "
    "SELECT m.id, m.tag_id, m.model_name, m.model_main, m.model_path, m.sche_time, "
    "CAST(COALESCE(l.state, m.state) AS INTEGER) AS state, m.args, t.name AS tag_name, t.pid AS tag_pid, 5 AS version, "
    "CAST(c.n AS BIGINT) AS n_tags, CAST(c.m AS BIGINT) AS last_id "
    "FROM models m JOIN tags t ON t.id = m.tag_id LEFT JOIN latest l ON l.tag_id = m.tag_id, c")
