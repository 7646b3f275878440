"""Numbered versions of a folder, each published by one small file that only one writer can create.

A version is published by ``manifest/v<number>.json``.  The file is written under another
name and then given its final one by an operation that fails if that name exists (a rename
on HDFS, a hard link on a local disk), so of two writers of one version exactly one
succeeds, whatever their clocks say; the other gets ``ConcurrentUpdateError``.  On a store
whose rename replaces files (plain object stores) only one job may write at a time.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class ConcurrentUpdateError(RuntimeError):
    """Another writer published a version after this writer's base version."""


class VersionedFolder:
    """The versions of ``path``: small metadata only, read and written by the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    @property
    def manifest_path(self) -> str:
        return f"{self.path}/manifest"

    def _path(self, name: str):
        """A Hadoop path and its file system."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, name: str) -> bool:
        path, fs = self._path(name)
        return fs.exists(path)

    def _size(self, folder: str) -> int:
        """Bytes of the files in ``folder``."""
        path, fs = self._path(folder)
        return int(fs.getContentSummary(path).getLength())

    def _delete(self, name: str) -> None:
        path, fs = self._path(name)
        fs.delete(path, True)

    def _create(self, final: str, text: str) -> bool:
        """Create the file ``final`` with ``text``; False if it is there already."""
        target, fs = self._path(final)
        draft, _ = self._path(f"{final.rsplit('/', 1)[0]}/_draft-{uuid.uuid4().hex}")
        fs.mkdirs(target.getParent())
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        jvm = self.spark._jvm
        try:
            if fs.getUri().getScheme() != "file":
                return not fs.exists(target) and fs.rename(draft, target)
            place = jvm.java.nio.file.Paths.get
            local = [place(fs.makeQualified(p).toUri()) for p in (target, draft)]
            try:
                jvm.java.nio.file.Files.createLink(*local)
                return True
            except Py4JJavaError as error:
                if "FileAlreadyExistsException" not in str(error.java_exception):
                    raise
                return False
        finally:
            fs.delete(draft, False)

    def _publish(self, row: dict) -> None:
        """Create the version's manifest file, or raise if it is there already."""
        if not self._create(f"{self.manifest_path}/v{row['version']:010d}.json", json.dumps(row) + "\n"):
            raise ConcurrentUpdateError(f"{self.path}: another writer published version {row['version']} first")

    def _numbers(self, folder: str) -> list[int]:
        """Numbers of the files ``v<number>.json`` in ``folder``, ascending."""
        path, fs = self._path(folder)
        if not fs.exists(path):
            return []
        names = (status.getPath().getName() for status in fs.listStatus(path))
        return sorted(int(m[1]) for m in (re.fullmatch(r"v(\d+)\.json", n) for n in names) if m)

    def _text(self, name: str) -> str:
        path, fs = self._path(name)
        stream = fs.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def published(self, version: int | None = None) -> dict | None:
        """The manifest row of a version (default: the latest; None if nothing is published)."""
        numbers = self._numbers(self.manifest_path)
        if version is None and not numbers:
            return None
        if version is not None and version not in numbers:
            raise LookupError(f"{self.path}: version {version} is not published")
        return json.loads(self._text(f"{self.manifest_path}/v{(version or numbers[-1]):010d}.json"))

    def _row(self, version: int, **fields) -> dict:
        now = _dt.datetime.now(_dt.timezone.utc).isoformat()
        return {"version": version, "base_version": version - 1 or None, "committed_at": now, **fields}
