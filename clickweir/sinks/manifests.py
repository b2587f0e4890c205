"""Numbered manifests in a shared folder: what counts as written, published atomically.

Data is written first, into folders that nobody reads yet. One small file then names it; the
file gets its final name by a rename that fails where the name is taken. So of two writers
one wins, a crash leaves nothing half-published, and readers see whole states only.

Every manifest holds the state that the next writer needs and the parts that it adds. Each
``WHOLE``-th one lists all parts so far, so that a reader opens few files.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

WHOLE = 64
_NAME = re.compile(r"(\d{12})\.json")


@dataclass(frozen=True)
class Manifest:
    """``version`` -1: nothing has been published."""

    version: int = -1
    state: dict = field(default_factory=dict)
    added: tuple = ()
    whole: tuple | None = None


class ManifestLog:
    """The manifests below one folder of any file system that Spark can reach."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._text = jvm.org.apache.commons.io.IOUtils
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        folder = self._path(self.path)
        self._files = folder.getFileSystem(self._conf)
        qualified = self._files.makeQualified(folder)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            qualified.toUri(), self._conf
        )
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        # without an option a rename never replaces
        self._plain = spark.sparkContext._gateway.new_array(rename, 0)

    def versions(self) -> list[int]:
        folder = self._path(self.path)
        if not self._files.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(folder)]
        return sorted(int(m[1]) for m in map(_NAME.fullmatch, names) if m)

    def read(self, version: int) -> Manifest:
        text = self.text(self._name(version))
        if text is None:
            raise ValueError(f"{self.path} has no version {version}")
        content = json.loads(text)
        whole = content.get("whole")
        return Manifest(
            version, content["state"], tuple(content["added"]), None if whole is None else tuple(whole)
        )

    def latest(self) -> Manifest:
        versions = self.versions()
        return self.read(versions[-1]) if versions else Manifest()

    def parts(self, version: int | None = None) -> list:
        """All parts up to a version, in order."""
        if version is None:
            versions = self.versions()
            version = versions[-1] if versions else -1
        found: list = []
        while version >= 0:
            manifest = self.read(version)
            if manifest.whole is not None:
                return [*manifest.whole, *reversed(found)]
            found += reversed(manifest.added)
            version -= 1
        return list(reversed(found))

    def publish(
        self, version: int, state: dict, added: Sequence = (), whole: Sequence | None = None
    ) -> bool:
        """Whether this manifest became that version; False if another one was first.

        ``whole`` replaces the list of parts, for a writer that also takes some away.
        """
        if whole is None and version % WHOLE == 0:
            whole = [*self.parts(version - 1), *added]
        content = {"state": state, "added": list(added)}
        if whole is not None:
            content["whole"] = list(whole)
        temporary = self._path(f"{self.path}/.{uuid.uuid4().hex}")
        out = self._files.create(temporary, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        try:
            self._context.rename(
                self._files.makeQualified(temporary),
                self._files.makeQualified(self._path(self._name(version))),
                self._plain,
            )
        except Exception as error:
            self._files.delete(temporary, False)
            if "AlreadyExists" in str(error):
                return False
            raise
        return True

    def remove(self, path: str) -> None:
        """Delete a folder of data that no manifest names any more."""
        self._files.delete(self._path(path), True)

    def children(self, path: str) -> list[str]:
        """Names of what is directly below a folder."""
        folder = self._path(path)
        if not self._files.exists(folder):
            return []
        return [status.getPath().getName() for status in self._files.listStatus(folder)]

    def children_with_times(self, path: str) -> list[tuple[str, int]]:
        """The same with the times, in ms, at which they were last changed."""
        folder = self._path(path)
        if not self._files.exists(folder):
            return []
        return [
            (status.getPath().getName(), status.getModificationTime())
            for status in self._files.listStatus(folder)
        ]

    def time_of(self, version: int) -> int:
        """When a version was published, in ms."""
        return self._files.getFileStatus(self._path(self._name(version))).getModificationTime()

    def text(self, path: str) -> str | None:
        """A small text file of this file system; None where there is none."""
        file = self._path(path)
        if not self._files.exists(file):
            return None
        stream = self._files.open(file)
        try:
            return self._text.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _name(self, version: int) -> str:
        return f"{self.path}/{version:012d}.json"
