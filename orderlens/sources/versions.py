"""Tables replaced as a whole, in versions.

A version is a folder `_v-<id>` of the table's folder, written aside. It becomes the table when
its mark, an empty file `_versions/<number>.<id>`, is made: one step of the file system, so a
reader finds the old version or the new one, and a writer that dies before it leaves the old one.
The mark with the highest name counts. DataFrames made before a replacement go on reading
their version: the last KEEP versions stay, older ones are deleted after a commit, with
folders that a dead writer left behind and that are older than the oldest version kept.

Names with `_` are hidden from Spark's listings, so a version's files are seen through it only.
Needs the session's JVM handles (a classic session), for the file system of the path.
"""
from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import SparkSession

#: Versions kept, the current one among them.
KEEP = 3
_MARKS, _FOLDER = "_versions", "_v-"


class Version(NamedTuple):
    number: int
    id: str
    path: str


class Folder:
    """A folder on the file system that its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._type = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._type(self.path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _at(self, name: str):
        return self._type(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> dict[str, int]:
        """The entries of a folder, with their times; none if it isn't there."""
        if not self.exists(name):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self._fs.listStatus(self._at(name))}

    def create(self, name: str) -> bool:
        """An empty file; False if it is there already."""
        self._fs.mkdirs(self._at(name).getParent())
        return self._fs.createNewFile(self._at(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The committed versions of a table, oldest first; none of a folder without versions."""
    folder = Folder(spark, path)
    marks = sorted(m for m in folder.names(_MARKS) if "." in m and not m.startswith("."))
    split = [(m.split(".", 1)) for m in marks]
    return [Version(int(n), i, f"{folder.path}/{_FOLDER}{i}") for n, i in split]


def resolve(spark: SparkSession, path: str, back: int = 0) -> str:
    """The folder to read: that of the current version, or of the one `back` before it; the
    path itself where the table has no versions."""
    found = versions(spark, path)
    if not found and not back:
        return path
    if len(found) <= back:
        raise FileNotFoundError(f"{path} has no version {back} before the current one")
    return found[-1 - back].path


def begin(path: str) -> tuple[str, str]:
    """(id, folder) of a new version, for its writer."""
    name = uuid.uuid4().hex
    return name, f"{path.rstrip('/')}/{_FOLDER}{name}"


def commit(spark: SparkSession, path: str, name: str, keep: int = KEEP) -> Version:
    """Make the folder of `name` the table. Of two writers, the last to commit wins, whole."""
    folder = Folder(spark, path)
    number = max([v.number for v in versions(spark, path)], default=0) + 1
    folder.create(f"{_MARKS}/{number:012d}.{name}")
    kept = versions(spark, path)[-keep:]
    marks, folders = folder.names(_MARKS), folder.names()
    for mark in marks:
        if "." in mark and not mark.startswith(".") and mark.split(".", 1)[1] not in {v.id for v in kept}:
            folder.delete(f"{_MARKS}/{mark}")
    oldest = min(folders.get(_FOLDER + v.id, 0) for v in kept)
    for entry, time in folders.items():
        if entry.startswith(_FOLDER) and entry[len(_FOLDER):] not in {v.id for v in kept} and time < oldest:
            folder.delete(entry)
    return kept[-1]
