"""The tagging job: catalog + source + store -> a new store version.

The store is either kept as whole snapshots (:class:`TagStore`) or as layers
(:class:`LayeredStore`: only the touched keys are written).

``plan`` builds one lazy DataFrame: the source scan, the match (a projection or a
broadcast join), and a single full/left outer join of the stored snapshot with the
new tags that merges and upserts in the same pass.  ``run`` writes it as a new
snapshot - one action, nothing collected but the one level-4 rule.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.operators.lookup import source_spec_of, value_rules
from tagweave.operators.merge import merged_tag
from tagweave.plans.models import TagModel
from tagweave.schemas import TAG_COL, USER_KEY
from tagweave.sources.layers import LayeredStore
from tagweave.sources.manifest import ConcurrentUpdateError
from tagweave.sources.reader import load_source
from tagweave.sources.store import Combine, TagStore, upsert_frame

STORE_SCHEMA = f"{USER_KEY} STRING, {TAG_COL} STRING"


def new_tags(model: TagModel, catalog: DataFrame,
             tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``(userId, tagIds)`` computed by ``model`` from the source its rule names."""
    spark = catalog.sparkSession
    spec = source_spec_of(catalog, model.tag_id, model.spec_default)
    source = load_source(spark, spec, tables)
    out = model.compute(value_rules(catalog, model.tag_id), source)
    return out.select(F.col(USER_KEY).cast("string").alias(USER_KEY),
                      F.col(TAG_COL).cast("string").alias(TAG_COL))


def merge_rule(model: TagModel) -> tuple[dict[str, Combine], bool]:
    """``(combine, insert_new)`` of the model's merge."""
    if model.merge == "replace":
        return {}, True
    return {TAG_COL: lambda o, n: merged_tag(o, n, model.order, model.blank)}, model.merge == "left"


def snapshot_after(model: TagModel, old: DataFrame, new: DataFrame) -> DataFrame:
    """The store snapshot after writing ``new`` with the model's merge rule."""
    combine, insert_new = merge_rule(model)
    return upsert_frame(old, new, USER_KEY, fields=[TAG_COL], combine=combine, insert_new=insert_new)


def plan(model: TagModel, catalog: DataFrame, old: DataFrame,
         tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    return snapshot_after(model, old, new_tags(model, catalog, tables))


class DuplicateKeyError(ValueError):
    """The source produced more than one row for a user id."""


def check_unique_keys(df: DataFrame, key: str = USER_KEY) -> None:
    """Raise if ``key`` repeats (one aggregate, combined map-side; stops at the first hit)."""
    dup = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"{key} {dup[0][key]!r} appears {dup[0]['_n']} times")


def run(model: TagModel, catalog: DataFrame, store: TagStore | LayeredStore,
        tables: Mapping[str, DataFrame] | None = None, check_unique: bool = False,
        retries: int = 2) -> int | None:
    """Compute, merge and publish a new store version; returns the version number.

    Keys must be unique in the computed tags (else the merge join multiplies rows);
    ``check_unique=True`` verifies it first at the cost of one extra aggregation.
    When another job publishes first (``ConcurrentUpdateError``), the merge is redone
    on top of the version it published, up to ``retries`` times, so neither job's
    tags are lost.
    """
    new = new_tags(model, catalog, tables)
    if check_unique:
        check_unique_keys(new)
    if isinstance(store, LayeredStore):
        combine, insert_new = merge_rule(model)
        return store.upsert(new, fields=[TAG_COL], combine=combine, insert_new=insert_new, retries=retries)
    for attempt in range(retries + 1):
        base = store.latest_version()
        old = store.read(base, schema=STORE_SCHEMA)
        try:
            return store.commit(snapshot_after(model, old, new), base)
        except ConcurrentUpdateError:
            if attempt == retries:
                raise
    raise AssertionError("unreachable")
