"""Catalog lookups used by a tagging job.

Only the level-4 rule of the one tag being computed reaches the driver: it names the
source to read, so it must be known before the plan can be built.  It is parsed in
Spark (:func:`parse_rule`) and fetched with ``limit(2)``, so a missing or duplicated
tag id fails clearly.  Level-5 rules stay a DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.functions.rules import parse_rule, source_spec


def rule_row(catalog: DataFrame, tag_id: int) -> DataFrame:
    """``rule`` of the tag with this id (one row when the id exists)."""
    return catalog.where(F.col("id") == F.lit(tag_id)).select("rule")


def source_spec_of(catalog: DataFrame, tag_id: int, default: str | None = "") -> dict:
    """The parsed level-4 rule of ``tag_id``: all its keys, the seven source keys filled in."""
    rows = (rule_row(catalog, tag_id)
            .select(source_spec(parse_rule("rule"), default).alias("spec"), parse_rule("rule").alias("all"))
            .limit(2).collect())
    if not rows:
        raise LookupError(f"tag {tag_id} is not in the catalog")
    if len(rows) > 1:
        raise LookupError(f"tag id {tag_id} is not unique in the catalog")
    return {**(rows[0]["all"] or {}), **rows[0]["spec"].asDict()}


def source_specs_of(catalog: DataFrame, wanted: Sequence[tuple[int, str | None]]) -> list[dict]:
    """:func:`source_spec_of` for several ``(tag id, default)`` in one job; as many rows reach the driver."""
    ids = sorted({i for i, _ in wanted})
    rows = (catalog.where(F.col("id").isin(ids))
            .select("id", source_spec(parse_rule("rule"), None).alias("spec"), parse_rule("rule").alias("all"))
            .limit(len(ids) + 1).collect())
    found: dict[int, tuple[dict, dict]] = {}
    for r in rows:
        if r["id"] in found:
            raise LookupError(f"tag id {r['id']} is not unique in the catalog")
        found[r["id"]] = (r["all"] or {}, r["spec"].asDict())
    missing = [i for i in ids if i not in found]
    if missing:
        raise LookupError(f"tag {missing[0]} is not in the catalog")
    return [{**found[i][0], **{k: default if v is None else v for k, v in found[i][1].items()}} for i, default in wanted]


def value_rules(catalog: DataFrame, tag_id: int) -> DataFrame:
    """Level-5 rules under ``tag_id``: ``(id INT, rule STRING)``."""
    return (catalog.where(F.col("pid") == F.lit(tag_id))
            .select(F.col("id").cast("int").alias("id"), F.col("rule").cast("string").alias("rule")))
