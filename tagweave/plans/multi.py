"""Several tag models in one pass: each source read once, one merge, one published version.

``run_all(models, ...)`` leaves the store as running the models one after the other would.  Models
whose level-4 rules name the same source share one scan (and pivot) over the union of their
fields.  Every model is applied to those rows with the tags found so far carried along inside
the key, so rule tables stay broadcast joins of one stage and nothing is shuffled between models;
tags are then reduced to one row per user once.  The merges become one fold over the user's
stored tags, in the order of the models: an ``inner`` model sees a user that an earlier ``left``
or ``replace`` model of the same pass would have inserted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.operators.lookup import source_specs_of, value_rules
from tagweave.operators.merge import merged_tag
from tagweave.plans.models import TagModel
from tagweave.plans.runner import STORE_SCHEMA
from tagweave.schemas import TAG_COL, USER_KEY
from tagweave.sources.cells import parse_fields
from tagweave.sources.layers import LayeredStore
from tagweave.sources.manifest import ConcurrentUpdateError
from tagweave.sources.reader import load_source
from tagweave.sources.store import TagStore, require_key


def _tag(k: int) -> str:
    return f"_tag{k}"


def _has(k: int) -> str:
    return f"_has{k}"


def _applied(models: Sequence[TagModel], numbers: Sequence[int], catalog: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``(userId, _tag<k>...)``, one row per user: the models applied to the same source rows."""
    fields = [c for c in source.columns if c != key]
    rows = source.select(F.struct(F.col(key).cast("string").alias("key"), *[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)])
                         .alias("row"))
    done: list[int] = []
    for k in numbers:
        # the key a model hands on holds the row and the tags of the models before it
        frame = rows.select(F.col("row").alias(key), *[F.col(f"row.f{i}").alias(c) for i, c in enumerate(fields)])
        out = models[k].compute(value_rules(catalog, models[k].tag_id), frame)
        held = [F.col(f"{USER_KEY}.{c}").alias(c) for c in ("key", *[f"f{i}" for i in range(len(fields))], *[_tag(j) for j in done])]
        rows = out.select(F.struct(*held, F.col(TAG_COL).cast("string").alias(_tag(k))).alias("row"))
        done.append(k)
    flat = require_key(rows.select(F.col("row.key").alias(USER_KEY), *[F.col(f"row.{_tag(k)}").alias(_tag(k)) for k in numbers]), USER_KEY)
    return flat.groupBy(USER_KEY).agg(*[F.max(_tag(k)).alias(_tag(k)) for k in numbers])


def new_tags_all(models: Sequence[TagModel], catalog: DataFrame, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``(userId, _tag<k>, _has<k>)`` per user of any model's source: model ``k``'s tag, and whether its source holds the user."""
    spark = catalog.sparkSession
    specs = source_specs_of(catalog, [(m.tag_id, m.spec_default) for m in models])
    groups: dict[tuple, list[int]] = {}
    for k, (spec, model) in enumerate(zip(specs, models)):
        same = tuple(sorted((x, y) for x, y in spec.items() if x != "selectFields" and y))
        groups.setdefault((model.key, same), []).append(k)
    frames = []
    for (key, _), numbers in groups.items():
        fields = list(dict.fromkeys(f for k in numbers for f in parse_fields(specs[k].get("selectFields") or "")))
        source = load_source(spark, {**specs[numbers[0]], "selectFields": ",".join(fields)}, tables)
        found = _applied(models, numbers, catalog, source, key)
        frames.append(found.withColumns({_has(k): F.lit(True) for k in numbers}))
    out = reduce(lambda a, b: a.join(b, USER_KEY, "full_outer"), frames)
    return out.select(USER_KEY, *[_tag(k) for k in range(len(models))],
                      *[F.coalesce(_has(k), F.lit(False)).alias(_has(k)) for k in range(len(models))])


def fold(models: Sequence[TagModel], stored: Column, there: Column, tag, has) -> tuple[Column, Column]:
    """``(tags, is stored)`` of a user after all models; ``tag(k)`` and ``has(k)`` give model ``k``'s columns.

    A merge reads the tags so far several times, so they are bound to a lambda's variable at every
    step: written out, the expression would grow as a power of the number of models.
    """
    def step(k: int, model: TagModel, before: Column, writes: Column) -> Column:
        def value(old: Column) -> Column:
            new = tag(k) if model.merge == "replace" else merged_tag(old, tag(k), model.order, model.blank)
            return F.when(writes, F.coalesce(new, old)).otherwise(old)
        return F.get(F.transform(F.array(before), value), 0)

    for k, model in enumerate(models):
        stored = step(k, model, stored, has(k) & there if model.merge == "inner" else has(k))
        there = there if model.merge == "inner" else there | has(k)
    return stored, there


def snapshot_after_all(models: Sequence[TagModel], old: DataFrame, new: DataFrame) -> DataFrame:
    """The store after all models: one full outer join on the key."""
    o = old.select(F.col(USER_KEY).alias("_old_key"), *[F.col(c).alias(f"_old_{c}") for c in old.columns if c != USER_KEY])
    joined = o.join(new, F.col("_old_key") == F.col(USER_KEY), "full_outer")
    before = F.col(f"_old_{TAG_COL}") if TAG_COL in old.columns else F.lit(None).cast("string")
    tags, there = fold(models, before, F.col("_old_key").isNotNull(), lambda k: F.col(_tag(k)),
                       lambda k: F.coalesce(F.col(_has(k)), F.lit(False)))
    names = old.columns if TAG_COL in old.columns else [*old.columns, TAG_COL]
    value = {USER_KEY: F.coalesce("_old_key", USER_KEY), TAG_COL: tags}
    return joined.where(there).select(*[value.get(c, F.col(f"_old_{c}")).alias(c) for c in names])


def plan_all(models: Sequence[TagModel], catalog: DataFrame, old: DataFrame,
             tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """What :func:`run_all` would publish, lazily."""
    return snapshot_after_all(models, old, new_tags_all(models, catalog, tables))


def run_all(models: Sequence[TagModel], catalog: DataFrame, store: TagStore | LayeredStore,
            tables: Mapping[str, DataFrame] | None = None, retries: int = 2) -> int | None:
    """Compute all models, merge them in order and publish one version (see the module); returns its number.

    When another job publishes first, the merge is redone on top of that version.
    """
    models = list(models)
    if not models:
        raise ValueError("no models")
    new = new_tags_all(models, catalog, tables)
    if isinstance(store, LayeredStore):
        packed = new.select(USER_KEY, F.struct(*[c for c in new.columns if c != USER_KEY]).alias(TAG_COL))
        inserted = reduce(lambda a, b: a | b, [F.col(f"{TAG_COL}.{_has(k)}") for k, m in enumerate(models) if m.merge != "inner"],
                          F.lit(False))

        def merged(old: Column, row: Column, there: Column) -> Column:
            return fold(models, old, there, lambda k: row.getField(_tag(k)), lambda k: row.getField(_has(k)))[0]

        return store.upsert(packed, fields=[TAG_COL], fold={TAG_COL: ("string", merged)}, insert_new=inserted, unique=True,
                            retries=retries)
    for attempt in range(retries + 1):
        base = store.latest_version()
        old = store.read(base, schema=STORE_SCHEMA)
        try:
            return store.commit(snapshot_after_all(models, old, new), base)
        except ConcurrentUpdateError:
            if attempt == retries:
                raise
    raise AssertionError("unreachable")
