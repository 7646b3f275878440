"""The tag store as layers: a base and delta layers of touched keys, merged when read.

An upsert reads the stored cells of the keys it touches and writes **one delta layer with
those keys only**; nothing stored is rewritten, and rows that would not change are left out,
so the same upsert twice writes nothing.  ``read`` joins the base with the folded deltas
(one hash lookup without a shuffle of the base while the deltas are small, which their
manifest entries prove) and adds the keys that only deltas hold.  ``compact`` folds layers:
the deltas into one (cost of the deltas), or everything into a new base.  ``expire`` drops old
versions and the layers that only they name.

A version is one manifest row that lists its layers; a layer never changes, so a reader keeps
a complete snapshot.  Sequence numbers order the layers: of two layers that write a cell the
later one counts.  Every delta row says whether its key was new, so reading needs no full join.

Two writers: a version is published by exactly one of them (:mod:`tagweave.sources.manifest`).
The other looks at the layers published in between: if they share no key with its own delta,
it publishes that delta on top; else it computes its delta again from what is stored now.  A
compaction never delays a writer, nor loses a delta published while it ran.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagweave.frames import literal_frame
from tagweave.operators.joins import DEFAULT_BROADCAST_ROWS
from tagweave.schemas import USER_KEY
from tagweave.sources.manifest import ConcurrentUpdateError, VersionedFolder
from tagweave.sources.store import Combine, one_row_per_key, require_key

Fold = Callable[[Column, Column, Column], Column]

IS_NEW = "_layer_new"  # in a delta: no earlier layer holds the key
_SEQ = "_layer_seq"
BROADCAST_FILE_BYTES = 16 * 1024 * 1024  # of compressed files


class LayeredStore(VersionedFolder):
    """A keyed table under ``path`` as a base and delta layers."""

    def __init__(self, spark: SparkSession, path: str, key: str = USER_KEY, fields: Sequence[str] | None = None):
        super().__init__(spark, path)
        self.key = key
        self.fields = list(fields) if fields is not None else None

    # ------------------------------------------------------------ layers
    def latest_version(self) -> int | None:
        row = self.published()
        return row["version"] if row else None

    def layers(self, version: int | None = None) -> list[dict]:
        """``seq, kind, path, rows, bytes`` of the layers of a version (default: the latest), base first."""
        row = self.published(version)
        return row["layers"] if row else []

    def _write(self, frame: DataFrame, kind: str) -> dict:
        """``frame`` as a new, not yet published layer; each file is sorted by key."""
        folder = f"{self.path}/layers/{kind}-{uuid.uuid4().hex}"
        frame.sortWithinPartitions(self.key).write.mode("errorifexists").parquet(folder)
        # counted from the files' footers
        return {"kind": kind, "path": folder, "rows": self.spark.read.parquet(folder).count(), "bytes": self._size(folder)}

    def _open(self, layer: dict) -> DataFrame:
        return self.spark.read.parquet(layer["path"])

    @staticmethod
    def _small(layers: Sequence[dict]) -> bool:
        return sum(x["rows"] for x in layers) <= DEFAULT_BROADCAST_ROWS and sum(x["bytes"] for x in layers) <= BROADCAST_FILE_BYTES

    def _fold(self, deltas: Sequence[dict]) -> DataFrame | None:
        """One row per key of the deltas: each cell's latest written value, and whether the key is new."""
        if not deltas:
            return None
        frames = [self._open(x).withColumn(_SEQ, F.lit(x["seq"]).cast("long")) for x in deltas]
        if len(frames) == 1:
            return frames[0].drop(_SEQ)
        every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        cells = [c for c in every.columns if c not in (self.key, IS_NEW, _SEQ)]
        return every.groupBy(self.key).agg(
            *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(_SEQ))).alias(c) for c in cells],
            F.bool_or(IS_NEW).alias(IS_NEW))

    # ------------------------------------------------------------ read
    def read(self, version: int | None = None, schema: StructType | str | None = None) -> DataFrame:
        """The rows of a version (default: the latest); an empty store gives no rows with ``schema``."""
        layers = self.layers(version)
        if not layers:
            return literal_frame(self.spark, [], schema or f"{self.key} STRING")
        return self._merged(layers)

    def _merged(self, layers: Sequence[dict]) -> DataFrame:
        base, deltas = self._open(layers[0]), layers[1:]
        changes = self._fold(deltas)
        if changes is None:
            return base
        names = [*base.columns, *[c for c in changes.columns if c not in base.columns and c != IS_NEW]]
        written = [c for c in changes.columns if c not in (self.key, IS_NEW)]
        known = changes.where(~F.col(IS_NEW)).select(F.col(self.key).alias("_layer_key"),
                                                     *[F.col(c).alias(f"_layer_{c}") for c in written])
        known = F.broadcast(known) if self._small(deltas) else known
        joined = base.join(known, base[self.key] == F.col("_layer_key"), "left")

        def cell(c: str) -> Column:
            if c not in written:
                return base[c]
            return F.coalesce(F.col(f"_layer_{c}"), base[c]).alias(c) if c in base.columns else F.col(f"_layer_{c}").alias(c)

        stored = joined.select(*[cell(c) for c in names])
        fresh = changes.where(IS_NEW)
        return stored.unionByName(fresh.select(*[F.col(c) if c in fresh.columns else F.lit(None).alias(c) for c in names]))

    # ------------------------------------------------------------ write
    def upsert(self, new: DataFrame, *, fields: Sequence[str] | None = None, combine: Mapping[str, Combine] | None = None,
               insert_new: bool | Column = True, order: Column | None = None, unique: bool = False, retries: int = 5,
               fold: Mapping[str, tuple[str, Fold]] | None = None) -> int | None:
        """Write ``new`` over the store, cell by cell; returns the version (see ``upsert_frame`` for the rules).

        ``insert_new`` may be a condition on the rows of ``new``.  ``fold`` gives, for a field whose new
        cells are not of the stored type, that type and ``f(stored cell, new cell, key is stored)``.
        ``unique=True`` states that ``new`` has one row per key (no aggregate is made).  An
        upsert that changes nothing publishes nothing.  ``new`` is computed once, also when the
        delta has to be computed again.
        """
        fields = list(fields) if fields is not None else self.fields
        fields = fields if fields is not None else [c for c in new.columns if c != self.key]
        rows = require_key(new, self.key)
        rows = rows.select(self.key, *fields) if unique else one_row_per_key(rows, self.key, fields, order)
        given = self._write(rows, "given")  # staged: read twice below, and again after a conflict
        try:
            for attempt in range(retries + 1):
                base = self.published()
                layer = self._delta(given, base["layers"] if base else [], fields, dict(combine or {}), dict(fold or {}), insert_new)
                if not layer["rows"]:
                    self._delete(layer["path"])
                    return base["version"] if base else None
                version = self._append(layer, base)
                if version is not None:
                    return version
                self._delete(layer["path"])
        finally:
            self._delete(given["path"])
        raise ConcurrentUpdateError(f"{self.path}: other writers kept changing the same keys")

    def _delta(self, given: dict, layers: list[dict], fields: list[str], combine: dict[str, Combine],
               fold: dict[str, tuple[str, Fold]], insert_new: bool | Column) -> dict:
        """The layer of ``given`` over ``layers``: the cells it writes, for keys whose cells change."""
        key, new = self.key, self._open(given)
        kind = {c: fold[c][0] if c in fold else new.schema[c].dataType for c in fields}
        insert = insert_new if isinstance(insert_new, Column) else F.lit(insert_new)

        def cell(c: str, old: Column, there: Column) -> Column:
            if c in fold:
                return fold[c][1](old, F.col(c), there)
            return combine[c](old, F.col(c)) if c in combine else F.col(c)

        if not layers:
            first = new.where(insert).select(key, *[cell(c, F.lit(None).cast(kind[c]), F.lit(False)).alias(c) for c in fields])
            return self._write(first, "base")
        keys = new.select(F.col(key).alias("_layer_key"))
        keys = F.broadcast(keys) if self._small([given]) else keys
        changes, base = self._fold(layers[1:]), self._open(layers[0])
        # the stored cells of the touched keys: scans that keep only these rows
        stored = base.join(keys, base[key] == F.col("_layer_key")).select(
            key, *[F.col(c) if c in base.columns else F.lit(None).cast(kind[c]).alias(c) for c in fields])
        old = stored.select(F.col(key).alias("_layer_key"), *[F.col(c).alias(f"_layer_{c}") for c in fields])
        rows = new.join(old, F.col(key) == F.col("_layer_key"), "left").withColumn("_layer_old", F.col("_layer_key").isNotNull())
        rows = rows.drop("_layer_key")
        if changes is not None:
            later = changes.select(F.col(key).alias("_layer_key"), *[
                (F.col(c) if c in changes.columns else F.lit(None).cast(kind[c])).alias(f"_later_{c}") for c in fields])
            rows = rows.join(later, F.col(key) == F.col("_layer_key"), "left") \
                .withColumn("_layer_old", F.col("_layer_old") | F.col("_layer_key").isNotNull())
            for c in fields:
                rows = rows.withColumn(f"_layer_{c}", F.coalesce(F.col(f"_later_{c}"), F.col(f"_layer_{c}")))
        before = {c: F.col(f"_layer_{c}") for c in fields}
        after = {c: cell(c, before[c], F.col("_layer_old")) for c in fields}
        changed = reduce(lambda a, b: a | b, [x.isNotNull() & ~x.eqNullSafe(before[c]) for c, x in after.items()], F.lit(False))
        keep = F.when(F.col("_layer_old"), changed).otherwise(insert)
        return self._write(rows.where(keep).select(key, *[x.alias(c) for c, x in after.items()],
                                                   (~F.col("_layer_old")).alias(IS_NEW)), "delta")

    def _append(self, layer: dict, base: dict | None) -> int | None:
        """Publish ``layer``, computed over ``base``; None if keys it holds were written since."""
        seen = base["version"] if base else 0
        now = base
        while True:
            version = (now["version"] if now else 0) + 1
            layers = now["layers"] if now else []
            try:
                self._publish(self._row(version, layers=[*layers, layer | {"seq": version}]))
                return version
            except ConcurrentUpdateError:
                now = self.published()
            # a first base, or a compaction of layers not seen, can't be told apart by key any more
            if not seen or now["layers"][0]["seq"] > seen:
                return None
            since = [x for x in now["layers"][1:] if x["seq"] > seen]
            if since and self._share_keys(layer, since):
                return None

    def _share_keys(self, layer: dict, others: Sequence[dict]) -> bool:
        mine = self._open(layer).select(self.key)
        theirs = reduce(DataFrame.union, [self._open(x).select(self.key) for x in others])
        return not mine.join(theirs, self.key, "left_semi").isEmpty()

    # ------------------------------------------------------------ maintenance
    def compact(self, full: bool = True) -> int | None:
        """Fold the layers of the latest version: all into a new base, or (``full=False``) the deltas into one.

        Deltas published meanwhile stay on top.  Returns the version, None if there was
        nothing to fold or another compaction came first.
        """
        row = self.published()
        taken = (row["layers"] if full else row["layers"][1:]) if row else []
        if len(taken) < 2:
            return None
        folded = self._merged(taken) if full else self._fold(taken)
        layer = self._write(folded, "base" if full else "delta") | {"seq": taken[-1]["seq"]}
        paths = [x["path"] for x in taken]
        while True:
            there = [x["path"] for x in row["layers"]]
            if not set(paths) <= set(there):
                self._delete(layer["path"])
                return None
            at = there.index(paths[0])
            rest = [x for x in row["layers"] if x["path"] not in paths]
            try:
                version = row["version"] + 1
                self._publish(self._row(version, layers=[*rest[:at], layer, *rest[at:]]))
                return version
            except ConcurrentUpdateError:
                row = self.published()

    def maintain(self, max_deltas: int = 8, share: float = 0.25) -> int | None:
        """Compact by need: all layers once the deltas hold ``share`` of the base's rows, the
        deltas alone once there are more than ``max_deltas``."""
        layers = self.layers()
        if len(layers) < 2:
            return None
        if sum(x["rows"] for x in layers[1:]) >= share * layers[0]["rows"]:
            return self.compact()
        return self.compact(full=False) if len(layers) - 1 > max_deltas else None

    def expire(self, keep: int = 2) -> list[str]:
        """Drop all but the latest ``keep`` versions and the layers that only those name; returns these layers.

        Unpublished layers (of writers at work) are never touched.  Keep as many versions as
        readers may still be reading.
        """
        if keep < 1:
            raise ValueError("at least the latest version is kept")
        numbers = self._numbers(self.manifest_path)
        old, kept = numbers[:-keep], numbers[-keep:]
        used = {x["path"] for n in kept for x in self.layers(n)}
        gone = sorted({x["path"] for n in old for x in self.layers(n)} - used)
        for n in old:  # first the versions, so none is left that names a missing layer
            self._delete(f"{self.manifest_path}/v{n:010d}.json")
        for folder in gone:
            self._delete(folder)
        return gone
