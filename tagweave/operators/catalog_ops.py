"""Catalog queries and maintenance jobs as DataFrame functions.

Reads: tags by level, by parent, by ``(name, level, pid)``, and a parent's children
with their models.  Writes return new DataFrames (the caller stores them): category
path upsert, level-4 tag + model ingest, level-5 rule ingest, and model state changes.
New ids continue after the current maximum, in a stated order, assigned in parallel
(:func:`with_sequential_id`).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.functions.schedule import decode_schedule, encode_schedule
from tagweave.operators.ids import sequential_ids, with_sequential_id
from tagweave.sources.catalog import conform
from tagweave.schemas import MODEL_CATALOG, TAG_CATALOG

TAG_VIEW = ("id", "pid", "level", "name", "rule")


def tag_view(catalog: DataFrame) -> DataFrame:
    """The tag fields a caller sees (times dropped)."""
    return catalog.select(*TAG_VIEW)


def tags_by_level(catalog: DataFrame, level: int) -> DataFrame:
    return tag_view(catalog.where(F.col("level") == F.lit(level)))


def tags_by_parent(catalog: DataFrame, pid: int) -> DataFrame:
    return tag_view(catalog.where(F.col("pid") == F.lit(pid)))


def find_tags(catalog: DataFrame, name: str, level: int, pid: int | None) -> DataFrame:
    """Tags with this name, level and parent; ``pid=None`` matches a null parent."""
    return tag_view(catalog.where((F.col("name") == F.lit(name)) & (F.col("level") == F.lit(level))
                                  & F.col("pid").eqNullSafe(F.lit(pid).cast("long"))))


def _now(now: datetime | None) -> Column:
    return F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()


def prepare_tags(rows: DataFrame, now: datetime | None = None) -> DataFrame:
    """Catalog rows ready to insert: level 1 gets ``pid = -1``; ``ctime = utime = now``."""
    stamp = _now(now)
    prepared = (rows.withColumn("pid", F.when(F.col("level") == 1, F.lit(-1)).otherwise(F.col("pid"))
                                .cast("long"))
                .withColumn("ctime", stamp).withColumn("utime", stamp))
    return conform(prepared, TAG_CATALOG)


def tags_with_models(catalog: DataFrame, models: DataFrame, pid: int) -> DataFrame:
    """Children of ``pid``, each with its model (null when it has none).

    Output: struct ``tag`` (the tag view) and struct ``model`` (model fields with the
    schedule decoded).  Model ``tag_id`` is assumed unique.
    """
    tags = tags_by_parent(catalog, pid)
    m = models.select(
        F.col("tag_id").alias("_tid"),
        F.struct(F.col("id"), F.col("model_name").alias("name"), F.col("model_main").alias("main_class"),
                 F.col("model_path").alias("path"), F.col("args"), F.col("state"),
                 decode_schedule("sche_time").alias("schedule")).alias("model"))
    j = tags.join(m, tags["id"] == m["_tid"], "left")
    return j.select(F.struct(*[F.col(c) for c in TAG_VIEW]).alias("tag"), "model")


def _max_id(df: DataFrame) -> int:
    row = df.agg(F.max("id").alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0


_KEY_ITEM = "struct<c:int,e:bigint,n:string>"


def _key_item(c: int, e: Column, n: Column) -> Column:
    return F.struct(F.lit(c).alias("c"), e.cast("bigint").alias("e"), n.cast("string").alias("n"))


def upsert_paths(catalog: DataFrame, paths: DataFrame, levels: list[str], now: datetime | None = None,
                 rules: list[str | None] | None = None) -> tuple[DataFrame, DataFrame]:
    """Insert the category paths that are not in the catalog yet.

    ``paths`` has one column per level, named by ``levels`` (level 1 first); a null
    ends a path, and a path that has lower levels but no level 1 is an error.  A node is found by ``(name, level, pid)`` (the oldest id wins if
    several match) or inserted; level-1 parents are ``-1``.  New ids continue after the
    catalog's maximum, level by level, each level ordered by ``(pid, name)`` - the
    order in which inserting one level at a time would number them.  Running the
    same paths twice inserts nothing the second time.

    All levels are resolved in one lazy plan: a node under a *new* parent is new, so
    existence never needs new ids.  Each new node carries an order key - its level,
    then its parent (an existing parent's id, or the new parent's own key, which
    sorts after every existing id), then its name - so one parallel numbering over all
    new nodes gives the level-by-level ids, and one join on the parent path fills in
    new parents' ids.

    The catalog must be a consistent tree: every ``pid`` names an existing tag (or is
    ``-1``).  New ids are above the current maximum, so no existing tag can sit under a
    new one.

    ``rules`` names per level the column that holds the rule of an inserted node (the
    highest one if its paths differ), or None.

    Returns ``(catalog_after, inserted)``.
    """
    cols = list(levels)
    rules = list(rules or [None] * len(cols))
    # one timestamp for the whole run, so re-evaluating a lazy result gives the same rows
    now = now or datetime.now()
    rule_of = [f"_rule{k}" for k in range(len(cols))]
    distinct_paths = paths.select(
        *[F.col(c).cast("string").alias(c) for c in cols],
        *[(F.col(r) if r else F.lit(None)).cast("string").alias(n) for r, n in zip(rules, rule_of)])
    if len(cols) > 1:  # such a path would be lost whole
        headless = F.col(cols[0]).isNull() & F.coalesce(*cols[1:]).isNotNull()
        if not distinct_paths.where(headless).isEmpty():
            raise ValueError(f"a path has lower levels but no {cols[0]}")
    distinct_paths = distinct_paths.distinct()
    no_key = F.lit(None).cast(f"array<{_KEY_ITEM}>")
    previous = None
    new_parts = []
    for depth, col in enumerate(cols, start=1):
        prefix = cols[:depth]
        nodes = distinct_paths.where(F.col(col).isNotNull()).groupBy(*prefix) \
            .agg(F.max(rule_of[depth - 1]).alias("_rule"))
        if previous is None:
            nodes = nodes.select(*prefix, "_rule", F.lit(-1).cast("long").alias("_parent_id"),
                                 no_key.alias("_parent_key"))
        else:
            parent = previous.select(*cols[:depth - 1], F.col("_id").alias("_parent_id"),
                                     F.col("_key").alias("_parent_key"))
            nodes = nodes.join(parent, cols[:depth - 1], "inner")
        existing = (catalog.where(F.col("level") == depth)
                    .groupBy(F.col("name").alias("_ename"), F.col("pid").alias("_epid"))
                    .agg(F.min("id").alias("_eid")))
        nodes = nodes.join(existing, (F.col(col) == F.col("_ename")) & (F.col("_parent_id") == F.col("_epid")),
                           "left")
        name_item = F.array(_key_item(2, F.lit(0), F.col(col)))
        key = F.when(F.col("_parent_id").isNotNull(),
                     F.concat(F.array(_key_item(0, F.col("_parent_id"), F.lit(""))), name_item)) \
            .otherwise(F.concat(F.array(_key_item(1, F.lit(0), F.lit(""))), F.col("_parent_key"), name_item))
        previous = nodes.select(*prefix, F.col("_eid").alias("_id"),
                                F.when(F.col("_eid").isNull(), key).alias("_key"), "_parent_id", "_rule")
        new_parts.append(previous.where(F.col("_id").isNull()).select(
            F.lit(depth).alias("level"), F.col(col).alias("name"),
            F.array(*[F.col(c) for c in prefix]).alias("_path"),
            F.array(*[F.col(c) for c in cols[:depth - 1]]).cast("array<string>").alias("_parent_path"),
            "_parent_id", "_key", "_rule"))
    new_nodes = new_parts[0]
    for part in new_parts[1:]:
        new_nodes = new_nodes.unionByName(part)
    numbered, _ = sequential_ids(new_nodes, ["level", "_key"], _max_id(catalog) + 1)
    parents = numbered.select(F.col("_path").alias("_pp"), F.col("id").alias("_new_pid"))
    linked = numbered.join(parents, numbered["_parent_path"] == parents["_pp"], "left")
    inserted = prepare_tags(linked.select(
        "id", F.coalesce(F.col("_parent_id"), F.col("_new_pid")).alias("pid"), "level", "name",
        F.col("_rule").alias("rule")), now)
    return catalog.unionByName(inserted), inserted


_STEP = "struct<level:int,name:string>"


def _chains(nodes: DataFrame) -> DataFrame:
    """Per distinct node of the requests: ``anchor`` (given parent id, null for none), ``chain``
    (levels and names from the anchor down to the node), ``rule`` of its first request, ``first``."""
    in_order = Window.partitionBy("path_id").orderBy("level", "position", "name", "pid", "rule")
    rows = nodes.withColumn("_at", F.row_number().over(in_order)) \
        .withColumn("_starts", (F.col("level") == 1) | F.col("pid").isNotNull() | (F.col("_at") == 1)) \
        .withColumn("_segment", F.sum(F.col("_starts").cast("int")).over(Window.partitionBy("path_id").orderBy("_at")))
    # a request's nodes from its last anchor on: as long as one request, never as a group of requests
    segment = Window.partitionBy("path_id", "_segment").orderBy("_at")
    rows = rows.select(
        F.first(F.when(F.col("level") == 1, F.lit(-1)).otherwise(F.col("pid"))).over(segment).cast("long").alias("anchor"),
        F.collect_list(F.struct("level", "name")).over(segment).cast(f"array<{_STEP}>").alias("chain"),
        "rule", F.struct("path_id", "_at").alias("_order"))
    return rows.groupBy("anchor", "chain").agg(F.min("_order").alias("first"), F.min_by("rule", "_order").alias("rule"))


def upsert_nodes(catalog: DataFrame, nodes: DataFrame, now: datetime | None = None,
                 first_id: Callable[[int], int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Insert requested tags that are not in the catalog, some under a given parent, some under the node before.

    ``nodes`` holds one row per tag of a request: ``path_id`` (the request), ``level``, ``name``,
    ``pid`` (nullable), ``rule`` and optionally ``position`` (order among tags of one level).  A
    request is worked from its lowest level up.  A tag with its own ``pid`` is looked up and
    inserted under that parent, whether or not the parent exists; level 1 always has parent
    ``-1``; any other tag hangs under the tag before it in its request (found or inserted), and
    under no parent (null) if it is the first.  A tag is found by ``(name, level, pid)``, null
    matching null; of several the smallest id counts.  The same tag asked for by many requests,
    also once by its parent's id and once by the path to that parent, is one tag; it takes the
    rule of the first request that names it (by ``path_id``).  A null level is an error.

    Ids continue after the catalog's maximum (or start at ``first_id(count)``, which reserves
    them), level by level, then by parent and name.  Running the same requests twice inserts
    nothing the second time.

    All requests are resolved together: what leads from an anchor to a node is reduced to its
    distinct values first (a parent shared by a third of all requests is one row), then one
    join per step of the longest chain finds the existing ids; a new node's order key is made
    of its parent's id or key, its level and its name.

    Returns ``(catalog_after, inserted)``.
    """
    now = now or datetime.now()
    if "position" not in nodes.columns:
        nodes = nodes.withColumn("position", F.lit(0))
    checked = nodes.where(F.assert_true(F.col("level").isNotNull(), F.lit("a tag without a level")).isNull())
    # written once: every step reads it, and the steps' join keys come from it
    chains = _chains(checked.select("path_id", F.col("level").cast("int").alias("level"), F.col("name").cast("string").alias("name"),
                                    F.col("pid").cast("long").alias("pid"), F.col("rule").cast("string").alias("rule"), "position")) \
        .withColumn("_depth", F.size("chain")).checkpoint()
    depth = chains.agg(F.max("_depth")).first()[0] or 0
    existing = catalog.groupBy(F.col("name").alias("_ename"), F.col("level").alias("_elevel"), F.col("pid").alias("_epid")) \
        .agg(F.min("id").alias("_eid"))
    no_key = F.lit(None).cast(f"array<{_KEY_ITEM}>")
    previous, new_parts = None, []
    for step in range(1, depth + 1):
        here = chains.where(F.col("_depth") == step).withColumn("_tag", F.element_at("chain", -1))
        if previous is None:
            here = here.withColumns({"_parent_id": F.col("anchor"), "_parent_key": no_key})
        else:
            above = previous.select(F.col("anchor").alias("_panchor"), F.col("chain").alias("_pchain"),
                                    F.col("_id").alias("_parent_id"), F.col("_key").alias("_parent_key"))
            here = here.join(above, F.col("anchor").eqNullSafe(F.col("_panchor"))
                             & (F.slice("chain", 1, step - 1) == F.col("_pchain"))).drop("_panchor", "_pchain")
        found = here.join(existing, F.col("_tag.name").eqNullSafe(F.col("_ename")) & (F.col("_tag.level") == F.col("_elevel"))
                          & F.col("_parent_id").eqNullSafe(F.col("_epid")) & F.col("_parent_key").isNull(), "left")
        own = F.array(_key_item(2, F.col("_tag.level"), F.col("_tag.name")))
        key = F.when(F.col("_parent_key").isNull(), F.concat(F.array(_key_item(0, F.col("_parent_id"), F.lit(""))), own)) \
            .otherwise(F.concat(F.array(_key_item(1, F.lit(0), F.lit(""))), F.col("_parent_key"), own))
        previous = found.select("anchor", "chain", "rule", "first", F.col("_eid").alias("_id"), "_parent_id", "_parent_key",
                                F.when(F.col("_eid").isNull(), key).alias("_key"), F.col("_tag.level").alias("level"),
                                F.col("_tag.name").alias("name")).checkpoint()
        new_parts.append(previous.where(F.col("_id").isNull()))
    if not new_parts:
        empty = catalog.limit(0)
        return catalog, prepare_tags(empty, now)
    fresh = reduce(DataFrame.unionByName, new_parts).groupBy("level", "name", "_key", "_parent_id", "_parent_key") \
        .agg(F.min_by("rule", "first").alias("rule"))
    numbered, count = sequential_ids(fresh, ["level", "_key"], 0)
    start = first_id(count) if first_id is not None and count else _max_id(catalog) + 1
    numbered = numbered.withColumn("id", F.col("id") + start)
    parents = numbered.select(F.col("_key").alias("_pk"), F.col("id").alias("_new_pid"))
    linked = numbered.join(parents, F.col("_parent_key") == F.col("_pk"), "left")
    inserted = prepare_tags(linked.select("id", F.coalesce("_parent_id", "_new_pid").alias("pid"), "level", "name", "rule"), now)
    return catalog.unionByName(inserted), inserted


def add_model_tags(catalog: DataFrame, models: DataFrame, requests: DataFrame,
                   order: list[str], now: datetime | None = None,
                   first_ids: tuple[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Ingest level-4 tags, each with its model.

    ``requests`` columns: ``name, pid, rule`` for the tag; ``model_name, model_main,
    model_path, args, state, frequency, start, end`` for the model.  Tag ids and model
    ids continue after each table's maximum in ``order``; each model row gets its new
    tag's id and the packed schedule.  ``first_ids`` gives reserved first ids of both instead.
    Returns ``(new_tags, new_models)``.
    """
    stamp = _now(now)
    tag_start, model_start = first_ids or (_max_id(catalog) + 1, _max_id(models) + 1)
    # both id columns follow the same order, so one numbering serves both
    with_ids = with_sequential_id(requests, order, tag_start, "_tag_id")
    with_ids = with_ids.withColumn("_model_id", F.col("_tag_id") - F.lit(tag_start) + F.lit(model_start))
    tags = prepare_tags(with_ids.select(F.col("_tag_id").alias("id"), "pid", F.lit(4).alias("level"),
                                        "name", "rule"), now)
    new_models = conform(with_ids.select(
        F.col("_model_id").alias("id"), F.col("_tag_id").alias("tag_id"), "model_name", "model_main",
        "model_path", encode_schedule("frequency", "start", "end").alias("sche_time"),
        stamp.alias("ctime"), stamp.alias("utime"), "state", "args"), MODEL_CATALOG)
    return tags, new_models


def add_value_tags(catalog: DataFrame, requests: DataFrame, order: list[str],
                   now: datetime | None = None, first_id: int | None = None) -> DataFrame:
    """Ingest level-5 value rules ``(name, pid, rule)``; ids continue after the maximum, or from ``first_id``."""
    fresh = with_sequential_id(requests.select("name", "pid", "rule"), order,
                               first_id if first_id is not None else _max_id(catalog) + 1)
    return prepare_tags(fresh.withColumn("level", F.lit(5)), now)


def apply_state_changes(models: DataFrame, changes: DataFrame,
                        order: Column | None = None) -> DataFrame:
    """Models after a log of state changes ``(tag_id, state, changed_at)``.

    The latest change per tag wins (``order`` default: ``changed_at``, then the higher
    state on a tie, so the pick is repeatable); ``max_by`` is combined map-side, so a
    tag with a flood of changes does not load one task.
    Changes for a tag without a model are ignored.  Starting or stopping the
    scheduled job is not part of this function.
    """
    key = order if order is not None else F.struct(F.col("changed_at"), F.col("state"))
    latest = (changes.groupBy(F.col("tag_id").alias("_tid"))
              .agg(F.max_by(F.col("state"), key).alias("_state")))
    j = models.join(latest, models["tag_id"] == latest["_tid"], "left")
    out = [F.coalesce(F.col("_state"), F.col("state")).cast("int").alias("state") if c == "state"
           else F.col(c) for c in models.columns]
    return j.select(*out)
