"""The tag and model catalogs as one versioned store with ids that are never given twice.

Both tables are published together: a version is one manifest row that lists the Parquet parts
of each (:mod:`tagweave.sources.manifest`), so no reader sees a tag without the model that was
ingested with it.  An ingest writes its own new rows as parts and lists them behind the
published ones; nothing stored is rewritten.

Ids come from reservations: ``ids/<table>/v<n>.json`` holds the first id after block ``n``; the
next block is created by an operation that fails if it exists, so two ingests at the same time
get disjoint ids, whatever they publish later.  As with an identity column, a failed ingest
leaves a gap.  So an ingest that loses the race for a version only lists its parts again,
without computing or renumbering anything.

What depends on the stored rows (path upserts, state changes) is computed again on top of the
version that came first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.frames import literal_frame
from tagweave.operators import catalog_ops as C
from tagweave.schemas import MODEL_CATALOG, TAG_CATALOG
from tagweave.sources.catalog import conform
from tagweave.sources.manifest import ConcurrentUpdateError, VersionedFolder

TABLES = {"tags": TAG_CATALOG, "models": MODEL_CATALOG}
MAX_PARTS = 32  # of one table; beyond it a publish folds them into one


class CatalogStore(VersionedFolder):
    """Published versions of the tag and the model catalog under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path)

    # ------------------------------------------------------------ read
    def latest_version(self) -> int | None:
        row = self.published()
        return row["version"] if row else None

    def _table(self, name: str, row: dict | None) -> DataFrame:
        parts = row[name] if row else []
        if not parts:
            return literal_frame(self.spark, [], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(*parts)

    def tags(self, version: int | None = None) -> DataFrame:
        return self._table("tags", self.published(version))

    def models(self, version: int | None = None) -> DataFrame:
        return self._table("models", self.published(version))

    def read(self, version: int | None = None) -> tuple[DataFrame, DataFrame]:
        """``(tags, models)`` of one and the same version."""
        row = self.published(version)
        return self._table("tags", row), self._table("models", row)

    # ------------------------------------------------------------ ids
    def reserve(self, table: str, count: int) -> int:
        """The first of ``count`` consecutive ids of ``table`` that nobody else gets."""
        folder = f"{self.path}/ids/{table}"
        while True:
            blocks = self._numbers(folder)
            if blocks:
                first = json.loads(self._text(f"{folder}/v{blocks[-1]:010d}.json"))["next"]
            else:  # ids of rows that were published before any block was taken
                first = (self._table(table, self.published()).agg(F.max("id")).first()[0] or 0) + 1
            block = (blocks[-1] if blocks else 0) + 1
            if self._create(f"{folder}/v{block:010d}.json", json.dumps({"next": first + count}) + "\n"):
                return first

    # ------------------------------------------------------------ write
    def _part(self, name: str, rows: DataFrame) -> str:
        folder = f"{self.path}/{name}/{uuid.uuid4().hex}"
        conform(rows, TABLES[name]).write.mode("errorifexists").parquet(folder)
        return folder

    def _append(self, parts: dict[str, str]) -> int:
        """Publish new parts behind those of whatever version is the latest."""
        while True:
            row = self.published()
            version = (row["version"] if row else 0) + 1
            lists = {t: [*(row[t] if row else []), *([parts[t]] if t in parts else [])] for t in TABLES}
            for name, held in lists.items():
                if len(held) > MAX_PARTS:
                    lists[name] = [self._part(name, self.spark.read.schema(TABLES[name]).parquet(*held))]
            try:
                self._publish(self._row(version, **lists))
                return version
            except ConcurrentUpdateError:
                continue

    def _redo(self, change: Callable[[dict | None], dict[str, list[str]] | None], retries: int) -> int | None:
        """Publish ``change(latest row)`` (new part lists); compute it again if another version came first."""
        for attempt in range(retries + 1):
            row = self.published()
            lists = change(row)
            if lists is None:
                return row["version"] if row else None
            held = {t: lists.get(t, row[t] if row else []) for t in TABLES}
            try:
                version = (row["version"] if row else 0) + 1
                self._publish(self._row(version, **held))
                return version
            except ConcurrentUpdateError:
                if attempt == retries:
                    raise
        raise AssertionError("unreachable")

    def start(self, tags: DataFrame, models: DataFrame | None = None) -> int:
        """Publish given tables (with their ids) as the first version."""
        if self.latest_version() is not None:
            raise ConcurrentUpdateError(f"{self.path}: the catalog is there already")
        parts = {"tags": [self._part("tags", tags)], "models": [self._part("models", models)] if models is not None else []}
        self._publish(self._row(1, **parts))
        return 1

    def add_model_tags(self, requests: DataFrame, order: list[str], now: datetime | None = None) -> int:
        """Ingest level-4 tags, each with its model (see ``catalog_ops.add_model_tags``), as one version."""
        count = requests.count()
        first = self.reserve("tags", count), self.reserve("models", count)
        # numbered and written once: the models are read from the tags' own rows
        tags, models = C.add_model_tags(self.tags(), self.models(), requests, order, now, first)
        return self._append({"tags": self._part("tags", tags), "models": self._part("models", models)})

    def add_value_tags(self, requests: DataFrame, order: list[str], now: datetime | None = None) -> int:
        """Ingest level-5 value rules (see ``catalog_ops.add_value_tags``) as one version."""
        first = self.reserve("tags", requests.count())
        return self._append({"tags": self._part("tags", C.add_value_tags(self.tags(), requests, order, now, first))})

    def upsert_nodes(self, nodes: DataFrame, now: datetime | None = None, retries: int = 5) -> int | None:
        """Insert the requested tags that are missing (see ``catalog_ops.upsert_nodes``).

        Ids are reserved like any ingest's; a request that finds everything publishes nothing.
        """
        def change(row: dict | None) -> dict[str, list[str]] | None:
            tags = self._table("tags", row)
            _, fresh = C.upsert_nodes(tags, nodes, now, first_id=lambda n: self.reserve("tags", n))
            part = self._part("tags", fresh)
            if self.spark.read.schema(TAG_CATALOG).parquet(part).isEmpty():
                self._delete(part)
                return None
            return {"tags": [*(row["tags"] if row else []), part]}

        return self._redo(change, retries)

    def change_states(self, changes: DataFrame, order: Column | None = None, retries: int = 5) -> int | None:
        """Apply a log of state changes (see ``catalog_ops.apply_state_changes``): the models become one new part."""
        def change(row: dict | None) -> dict[str, list[str]] | None:
            if not row or not row["models"]:
                return None
            return {"models": [self._part("models", C.apply_state_changes(self._table("models", row), changes, order))]}

        return self._redo(change, retries)
