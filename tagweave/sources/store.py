"""The tag store: a keyed table kept as versioned Parquet snapshots.

An upsert is one full outer join of the latest snapshot with the new rows on the key
(one shuffle per side; with ``buckets`` the stored side is read in place, already
hash-bucketed by key), written as a **new** snapshot folder.  Nothing is overwritten
in place, so a job may read the snapshot it is replacing, a failed job leaves the
published version untouched, and a lost executor only recomputes from files.

A version is published by one small file ``manifest/v<number>.json`` that names its
folder (:mod:`tagweave.sources.manifest`: of two writers exactly one succeeds).  Every write
attempt gets its own folder, so a job that died half way leaves only an unpublished folder
behind and a retry simply writes a new one.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)

from tagweave.frames import literal_frame
from tagweave.schemas import USER_KEY
from tagweave.sources.manifest import ConcurrentUpdateError, VersionedFolder

Combine = Callable[[Column, Column], Column]

_MANIFEST = StructType([
    StructField("version", LongType(), False),
    StructField("base_version", LongType(), True),
    StructField("committed_at", TimestampType(), False),
    StructField("path", StringType(), False),
    StructField("buckets", IntegerType(), True),
])


def require_key(df: DataFrame, key: str) -> DataFrame:
    """``df``; a row with a null key raises when it is read."""
    return df.where(F.assert_true(F.col(key).isNotNull(), f"null key in column {key}").isNull())


def one_row_per_key(df: DataFrame, key: str, fields: Sequence[str], order: Column | None = None) -> DataFrame:
    """``(key, fields)`` with one row per key (combined map-side; the join that follows
    reuses this aggregate's exchange)."""
    def pick(c: str) -> Column:
        if order is None:
            return F.max(c)
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(order.alias("o"), F.col(c).alias("c"))))
    if not fields:
        return df.select(key).distinct()
    return df.groupBy(key).agg(*[pick(c).alias(c) for c in fields])


def upsert_frame(old: DataFrame, new: DataFrame, key: str = USER_KEY, *,
                 fields: Sequence[str] | None = None, combine: Mapping[str, Combine] | None = None,
                 insert_new: bool = True, order: Column | None = None) -> DataFrame:
    """The snapshot after writing ``new`` over ``old``, cell by cell.

    * written columns are ``fields`` (default: every column of ``new`` but the key);
    * a key in both: each written cell is ``combine[c](old, new)`` when given, else the
      new value; a null result means "not written" and keeps the old cell;
    * a key only in ``old`` is kept as is; a key only in ``new`` is inserted, unless
      ``insert_new=False`` (then only existing keys are updated);
    * columns of ``old`` that are not written are kept; new columns are added.

    Rows of ``new`` with the same key become one first: each cell takes its non-null
    value of the row with the highest ``order`` (default: the highest value).  A null key
    is an error.  Keys of ``old`` are unique (it is a snapshot).
    """
    fields = list(fields) if fields is not None else [c for c in new.columns if c != key]
    combine = dict(combine or {})
    o = old.select(*[F.col(c).alias(f"_o_{c}") for c in old.columns])
    n = one_row_per_key(require_key(new, key), key, fields, order) \
        .select(F.col(key).alias(f"_n_{key}"), *[F.col(c).alias(f"_n_{c}") for c in fields])
    how = "full_outer" if insert_new else "left_outer"
    j = o.join(n, o[f"_o_{key}"] == n[f"_n_{key}"], how)
    cols = [F.coalesce(F.col(f"_o_{key}"), F.col(f"_n_{key}")).alias(key)]
    seen = {key}
    for c in old.columns:
        if c in seen:
            continue
        seen.add(c)
        oc = F.col(f"_o_{c}")
        if c in fields:
            nc = F.col(f"_n_{c}")
            written = combine[c](oc, nc) if c in combine else nc
            cols.append(F.coalesce(written, oc).alias(c))
        else:
            cols.append(oc.alias(c))
    for c in fields:
        if c not in seen:
            seen.add(c)
            cols.append(F.col(f"_n_{c}").alias(c))
    return j.select(*cols)


@dataclass(frozen=True)
class StoreSpec:
    """Where results go: folder, key column, written fields (None = all), buckets, or layers."""

    path: str
    key: str = USER_KEY
    fields: tuple[str, ...] | None = None
    buckets: int | None = None
    layered: bool = False

    @classmethod
    def from_options(cls, options: Mapping[str, str]) -> "StoreSpec":
        """From plain options: ``path`` (or ``hbaseTable``), ``rowKey``, ``selectFields``,
        ``buckets``, ``layered`` (``true``: base and delta layers instead of whole snapshots)."""
        path = options.get("path") or options.get("hbaseTable")
        if not path:
            raise ValueError("store options need 'path'")
        fields = options.get("selectFields")
        key = options.get("rowKey") or USER_KEY
        written = tuple(f for f in fields.split(",") if f and f != key) if fields else None
        buckets = int(options["buckets"]) if options.get("buckets") else None
        layered = str(options.get("layered", "")).lower() == "true"
        if layered and buckets:
            raise ValueError("a layered store has no buckets")
        return cls(path=path, key=key, fields=written, buckets=buckets, layered=layered)

    def open(self, spark: SparkSession) -> "TagStore | LayeredStore":
        if self.layered:
            from tagweave.sources.layers import LayeredStore
            return LayeredStore(spark, self.path, self.key, self.fields)
        return TagStore(spark, self.path, self.key, self.fields, self.buckets)


class TagStore(VersionedFolder):
    """Versioned snapshots of a keyed table under ``path`` (optionally key-bucketed)."""

    def __init__(self, spark: SparkSession, path: str, key: str = USER_KEY,
                 fields: Sequence[str] | None = None, buckets: int | None = None):
        super().__init__(spark, path)
        self.key = key
        self.fields = list(fields) if fields is not None else None
        self.buckets = buckets

    def _new_snapshot_path(self, version: int) -> str:
        return f"{self.path}/snapshots/v{version:010d}-{uuid.uuid4().hex}"

    def versions(self) -> DataFrame:
        """Published versions, one row each."""
        if not self._exists(self.manifest_path):
            return literal_frame(self.spark, [], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).option("pathGlobFilter", "v*.json").json(self.manifest_path)

    def _latest(self):
        return self.versions().orderBy(F.col("version").desc()).limit(1).collect()

    def latest_version(self) -> int | None:
        rows = self._latest()
        return int(rows[0]["version"]) if rows else None

    def _row_of(self, version: int):
        rows = self.versions().where(F.col("version") == version).select("path", "buckets").collect()
        if not rows:
            raise LookupError(f"{self.path}: version {version} is not published")
        return rows[0]

    def _path_of(self, version: int) -> str:
        return self._row_of(version)["path"]

    @staticmethod
    def _table_name(folder: str) -> str:
        return "tagweave_snapshot_" + folder.rsplit("-", 1)[-1]

    def _open(self, folder: str, buckets: int | None) -> DataFrame:
        """A snapshot folder; a bucketed one is registered with its bucket spec so joins
        on the key reuse its partitioning."""
        if not buckets:
            return self.spark.read.parquet(folder)
        name = self._table_name(folder)
        if not self.spark.catalog.tableExists(name):
            schema = self.spark.read.parquet(folder).schema
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
                f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {int(buckets)} BUCKETS "
                f"LOCATION '{folder}'")
        return self.spark.table(name)

    def read(self, version: int | None = None, schema: StructType | str | None = None) -> DataFrame:
        """A published snapshot (default: the latest).  An empty store gives an empty
        DataFrame with ``schema`` (default ``key STRING``)."""
        if version is None:
            rows = self._latest()
            if not rows:
                return literal_frame(self.spark, [], schema or f"{self.key} STRING")
            row = rows[0]
        else:
            row = self._row_of(version)
        return self._open(row["path"], row["buckets"])

    def _is_bucketed(self, snapshot: DataFrame) -> bool:
        """Whether the snapshot comes from a join with the bucketed store (already dealt by key)."""
        return self.latest_version() is not None and bool(self._latest()[0]["buckets"] == self.buckets)

    def commit(self, snapshot: DataFrame, base_version: int | None, sort_by_key: bool = True) -> int:
        """Write ``snapshot`` as version ``base + 1`` and publish it.

        Each file is sorted by key (a per-partition sort, no shuffle), so Parquet
        row-group statistics let a lookup by key skip most of a file.  With
        ``buckets`` the snapshot is written hash-bucketed by key; a join of the next
        run's new rows with it then shuffles only the new rows (keep ``buckets`` at or
        above ``spark.sql.shuffle.partitions``).
        """
        version = (base_version or 0) + 1
        if self.latest_version() != base_version:
            raise ConcurrentUpdateError(
                f"{self.path}: base version {base_version} is no longer the latest")
        folder = self._new_snapshot_path(version)
        if self.buckets:
            # one task per bucket, so a bucket is one file whatever came before
            snapshot = snapshot.repartition(self.buckets, self.key) if not self._is_bucketed(snapshot) else snapshot
            (snapshot.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
             .option("path", folder).mode("errorifexists").saveAsTable(self._table_name(folder)))
        else:
            if sort_by_key:
                snapshot = snapshot.sortWithinPartitions(self.key)
            snapshot.write.mode("errorifexists").parquet(folder)
        if self.latest_version() != base_version:
            raise ConcurrentUpdateError(
                f"{self.path}: base version {base_version} is no longer the latest")
        now = _dt.datetime.now(_dt.timezone.utc).isoformat()
        self._publish({"version": version, "base_version": base_version, "committed_at": now, "path": folder,
                       "buckets": self.buckets})
        return version

    def upsert(self, new: DataFrame, *, fields: Sequence[str] | None = None,
               combine: Mapping[str, Combine] | None = None, insert_new: bool = True,
               order: Column | None = None) -> int:
        """Write ``new`` over the latest snapshot (see :func:`upsert_frame`)."""
        base = self.latest_version()
        fields = fields if fields is not None else self.fields
        written = list(fields) if fields is not None else [c for c in new.columns if c != self.key]
        old = self.read(base, schema=new.select(self.key, *written).schema)
        return self.commit(upsert_frame(old, new, self.key, fields=fields, combine=combine,
                                        insert_new=insert_new, order=order), base)
