"""Tag matching: a user's source value -> one tag id.

* :func:`match_rules` - exact match against level-5 rules (a broadcast hash join).
* :func:`match_values` - a fixed ``{value: tag}`` CASE.
* :func:`match_ranges` - numeric ranges ``lo <= v <= hi`` (CASE, an interval index, or a lookup of distinct values).

Rule values are compared as strings; the fixed maps compare whole-number keys as numbers
(``'01'`` and ``' 1'`` equal 1) by ``try_cast``, so ANSI mode never raises on ``'abc'``.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.frames import literal_frame
from tagweave.operators.joins import DEFAULT_BROADCAST_ROWS, bounded_broadcast
from tagweave.schemas import TAG_COL, USER_KEY


INDEX_ROWS = 10_000  # ranges that become an index inside the plan
SALTS = 32  # tasks that share a hot source value where the lookup is not broadcast


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lookup_join(src: DataFrame, lookup: DataFrame, max_broadcast_rows: int) -> DataFrame:
    """``src(_key, _v)`` left join ``lookup(_v, _tag)`` (one row per value).

    The lookup is broadcast when proven small.  Otherwise both sides are salted: every
    value, and the null ones, is dealt over ``SALTS`` tasks.
    """
    small = bounded_broadcast(lookup, max_broadcast_rows)
    if small is not lookup:
        return src.join(small, "_v", "left")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = src.withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int"))
    # a null value meets nothing; its own negative salt spreads it over the partitions
    salted = salted.withColumn("_salt", F.when(F.col("_v").isNull(), -1 - F.pmod(F.xxhash64("_key"), F.lit(1 << 20)))
                               .otherwise(F.col("_salt")).cast("int"))
    return salted.join(lookup.withColumn("_salt", salts), ["_v", "_salt"], "left").drop("_salt")


def date_digits(c: Column | str) -> Column:
    """``'1990-05-17'`` -> ``19900517`` (BIGINT); text that is not a number -> null."""
    return F.regexp_replace(_col(c).cast("string"), "-", "").try_cast("bigint")


def dedupe_rules(rules: DataFrame) -> DataFrame:
    """One row per rule value; when several tags share a value the highest id wins."""
    return (rules.where(F.col("rule").isNotNull())
            .groupBy("rule").agg(F.max(F.col("id").cast("int")).alias("_tag")))


def match_rules(source: DataFrame, rules: DataFrame, value_col: str, *, key_col: str = "id",
                out_key: str = USER_KEY, out_tag: str = TAG_COL, default: int | None = 0,
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Tag each source row with the id of the rule whose ``rule`` equals its value.

    ``rules`` has columns ``(id, rule)``.  No match or a null value gives ``default``
    (``None`` leaves the tag null).  Rules are deduplicated per value first, so the join
    is many-to-one and keeps the source row count; the deduplicated rules are broadcast
    when their row count is proven small, so the (large) source is not shuffled; beyond
    the bound the join is salted.
    """
    src = source.select(_col(key_col).alias("_key"), _col(value_col).cast("string").alias("_v"))
    joined = _lookup_join(src, dedupe_rules(rules).withColumnRenamed("rule", "_v"), max_broadcast_rows)
    tag = F.col("_tag") if default is None else F.coalesce(F.col("_tag"), F.lit(default))
    return joined.select(F.col("_key").alias(out_key), tag.cast("int").alias(out_tag))


def case_column(value: Column | str, mapping: Mapping[str, int]) -> Column:
    """``CASE value WHEN k THEN tag ... END`` (no ELSE: unmatched -> null).

    A whole-number key equals the value as a number, any other key as text.
    """
    v = _col(value).cast("string")
    number = v.try_cast("int")
    out = None
    for k, tag in mapping.items():
        whole = str(k).lstrip("-").isdigit()
        cond = number == F.lit(int(k)) if whole else v == F.lit(str(k))
        out = F.when(cond, F.lit(int(tag))) if out is None else out.when(cond, F.lit(int(tag)))
    return out.cast("int") if out is not None else F.lit(None).cast("int")


def match_values(source: DataFrame, value_col: str, mapping: Mapping[str, int], *,
                 key_col: str = "id", out_key: str = USER_KEY, out_tag: str = TAG_COL) -> DataFrame:
    """Tag by a fixed value map; no match -> null.  A projection, no shuffle."""
    return source.select(_col(key_col).alias(out_key),
                         case_column(value_col, mapping).alias(out_tag))


def range_column(value: Column, ranges: Sequence[tuple[int, int, int]]) -> Column:
    """``CASE WHEN value BETWEEN lo AND hi THEN tag ... END``; the first range wins."""
    out = None
    for lo, hi, tag in ranges:
        cond = value.between(F.lit(lo), F.lit(hi))
        out = F.when(cond, F.lit(int(tag))) if out is None else out.when(cond, F.lit(int(tag)))
    return out.cast("int") if out is not None else F.lit(None).cast("int")


def _literal_array(values: Sequence[int | None], kind: str) -> Column:
    # one text folded to an array when the query is optimized; a literal per value costs a driver call each
    return F.from_json(F.lit(json.dumps(list(values))), F.lit(f"array<{kind}>"))


def range_index(value: Column, ranges: Sequence[tuple[int, int, int]]) -> Column:
    """The tag of the range that holds ``value``, null if none, by binary search in sorted bounds.

    ``ranges`` are ``(lo, hi, tag)`` that do not overlap (else ``ValueError``); a range whose end is
    before its start holds nothing.  The bounds are three sorted arrays inside the plan, so
    every task holds them once; a row costs log2 of their number, whatever the ranges are.
    """
    rows = sorted(tuple(r) for r in ranges)
    if any(a[1] >= b[0] for a, b in zip(rows, rows[1:])):
        raise ValueError("range rules overlap; use a list of ranges for first-match order")
    if not rows:
        return F.lit(None).cast("int")
    los, his, tags = (_literal_array(c, k) for c, k in zip(zip(*rows), ("bigint", "bigint", "int")))
    steps = [1 << k for k in reversed(range(len(rows).bit_length()))]
    # how many ranges start at or before the value, found from the highest binary digit down
    started = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(
        (at + s <= len(rows)) & (F.get(los, at + s - 1) <= value), at + s).otherwise(at))
    tag = F.transform(F.array(started), lambda at: F.when((at > 0) & (value <= F.get(his, at - 1)), F.get(tags, at - 1)))
    return F.get(tag, 0).cast("int")


def match_ranges(source: DataFrame, value: Column, ranges: Sequence[tuple[int, int, int]] | DataFrame,
                 *, key_col: str = "id", out_key: str = USER_KEY, out_tag: str = TAG_COL,
                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Tag by the range that contains ``value``; none -> null.

    A list of ``(lo, hi, tag)`` becomes a CASE chain (first range wins).  A DataFrame
    ``(lo, hi, id)`` of non-overlapping ranges with at most ``INDEX_ROWS`` rows becomes an
    interval index (:func:`range_index`): the source is only projected.  Above that bound the
    ranges are looked up once per distinct source value by an exact sort
    (:func:`_floor_lookup`); the source then joins that lookup, broadcast when it is proven
    small and salted beyond.  A range with a null bound holds no value and is left out;
    overlapping ranges raise ``ValueError``.
    """
    if not isinstance(ranges, DataFrame):
        return source.select(_col(key_col).alias(out_key), range_column(value, ranges).alias(out_tag))
    r = ranges.select(F.col("lo").cast("bigint").alias("_lo"), F.col("hi").cast("bigint").alias("_hi"),
                      F.col("id").cast("int").alias("_tag"))
    src = source.select(_col(key_col).alias("_key"), value.alias("_v"))
    r = r.where(F.col("_lo").isNotNull() & F.col("_hi").isNotNull())
    # the only job before the plan: it reads the ranges and proves their number at once
    few = r.limit(min(INDEX_ROWS, max_broadcast_rows) + 1).collect()
    if len(few) <= min(INDEX_ROWS, max_broadcast_rows):
        return src.select(F.col("_key").alias(out_key), range_index(F.col("_v"), few).alias(out_tag))
    lookup = _floor_lookup(src.select("_v").where(F.col("_v").isNotNull()).distinct(), r)
    joined = _lookup_join(src, lookup, max_broadcast_rows)
    return joined.select(F.col("_key").alias(out_key), F.col("_tag").alias(out_tag))


def _floor_lookup(values: DataFrame, ranges: DataFrame) -> DataFrame:
    """``(_v, _tag)`` for distinct values against many non-overlapping ranges, exactly.

    Values and range starts are sorted together in one range-partitioned global
    order (a start sorts before an equal value) and checkpointed.  Inside each
    partition a window carries the latest start forward; each partition is seeded
    with the last start of the partitions before it (one row per partition reaches
    the driver).  A value takes that range's tag when it is not past the range's end.
    Values are distinct, so no value can load one partition; overlapping ranges are
    detected in the same pass and raise ``ValueError``.
    """
    rng = F.struct(F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), F.col("_tag").alias("tag"))
    items = (values.select(F.col("_v").alias("_pos"), F.lit(1).alias("_kind"),
                           F.lit(None).cast("struct<lo:bigint,hi:bigint,tag:int>").alias("_r"))
             .unionByName(ranges.select(F.col("_lo").alias("_pos"), F.lit(0).alias("_kind"), rng.alias("_r"))))
    ranged = (items.repartitionByRange("_pos", "_kind").sortWithinPartitions("_pos", "_kind")
              .withColumn("_mid", F.monotonically_increasing_id())).persist(StorageLevel.MEMORY_AND_DISK)
    frozen = ranged.checkpoint(eager=True)
    ranged.unpersist()
    frozen = frozen.withColumn("_part", F.shiftright("_mid", 33))
    is_start = F.col("_kind") == 0
    lasts = (frozen.groupBy("_part")  # one row per partition: bounded by the partition count
             .agg(F.max_by(F.when(is_start, F.col("_r")), F.when(is_start, F.col("_mid"))).alias("_last"))
             .collect())
    carry_rows, carried = [], None
    for row in sorted(lasts, key=lambda r: r["_part"]):
        if carried is not None:
            carry_rows.append((row["_part"], carried["lo"], carried["hi"], carried["tag"]))
        if row["_last"] is not None:
            carried = row["_last"]
    carry = literal_frame(values.sparkSession, carry_rows, "_part LONG, _clo LONG, _chi LONG, _ctag INT")
    w = Window.partitionBy("_part").orderBy("_mid")
    seen = frozen.join(F.broadcast(carry), "_part", "left").select(
        "_pos", "_kind", "_r",
        F.coalesce(F.last("_r", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
                   F.struct(F.col("_clo").alias("lo"), F.col("_chi").alias("hi"), F.col("_ctag").alias("tag")))
        .alias("_prev"),
        F.coalesce(F.last("_r", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
                   F.struct(F.col("_clo").alias("lo"), F.col("_chi").alias("hi"), F.col("_ctag").alias("tag")))
        .alias("_cur"))
    if seen.where((F.col("_kind") == 0) & (F.col("_prev.hi") >= F.col("_r.lo"))).limit(1).count():
        raise ValueError("range rules overlap; use a list of ranges for first-match order")
    hit = F.col("_cur.hi").isNotNull() & (F.col("_pos") <= F.col("_cur.hi"))
    return seen.where(F.col("_kind") == 1).select(
        F.col("_pos").alias("_v"), F.when(hit, F.col("_cur.tag")).alias("_tag"))
