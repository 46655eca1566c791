"""Published folders that switch together or not at all.

A table's folder holds versions (``_v-<id>``), each a whole copy of its rows, and entries
(``_log/<number>.json``) that name a version and the commit record of the publish it belongs
to. The record is one empty file, put in place last by a rename: an entry counts only if its
record is there. So all tables of a publish are switched by that one rename, and a publish
that dies before it, wherever that is, changes nothing. Taking the record away undoes it.

One publish of a table may run at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

VERSION, LOG, COMMITS = "_v-", "_log", "_commits"


def hadoop_path(spark: SparkSession, place: str):
    """The Hadoop file system of a path, and the path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def names_below(spark: SparkSession, place: str) -> list[str]:
    system, path = hadoop_path(spark, place)
    return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []


def exists(spark: SparkSession, place: str) -> bool:
    system, path = hadoop_path(spark, place)
    return system.exists(path)


def remove(spark: SparkSession, place: str) -> None:
    system, path = hadoop_path(spark, place)
    system.delete(path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename, or raise: some file systems only say that it did not work."""
    system, path = hadoop_path(spark, source)
    if not system.rename(path, hadoop_path(spark, target)[1]):
        raise OSError(f"{source} could not be moved to {target}")


def write_text(spark: SparkSession, place: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    fresh = f"{place}.{uuid.uuid4().hex}.tmp"
    system, path = hadoop_path(spark, fresh)
    stream = system.create(path, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    move(spark, fresh, place)


def read_text(spark: SparkSession, place: str) -> str:
    system, path = hadoop_path(spark, place)
    stream = system.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


@dataclass(frozen=True)
class Entry:
    """One published or prepared version of a folder."""

    number: int
    version: str
    commit: str


def entries(spark: SparkSession, place: str) -> list[Entry]:
    """The entries of a published folder, the newest first, whether or not they count."""
    log = f"{place.rstrip('/')}/{LOG}"
    found = [n for n in names_below(spark, log) if n.endswith(".json")]
    return [Entry(int(n.removesuffix(".json")), **json.loads(read_text(spark, f"{log}/{n}"))) for n in sorted(found, reverse=True)]


def committed(spark: SparkSession, place: str) -> list[Entry]:
    return [e for e in entries(spark, place) if exists(spark, e.commit)]


def root_of(location: str) -> str:
    """The published folder that a table's location lies in."""
    head, _, tail = location.rstrip("/").rpartition("/")
    return head if tail.startswith(VERSION) else location.rstrip("/")


def current_folder(spark: SparkSession, place: str) -> str:
    """Where the rows of a published folder are: its newest committed version, or the folder itself."""
    newest = next(iter(committed(spark, place)), None)
    return f"{place.rstrip('/')}/{newest.version}" if newest else place


def new_version(place: str) -> str:
    return f"{place.rstrip('/')}/{VERSION}{uuid.uuid4().hex}"


def switch(spark: SparkSession, versions: dict[str, str]) -> str:
    """Make a written version the current one in each of the folders; the commit record's path.

    Undo it with :func:`undo`.
    """
    places = sorted(versions)
    commit = f"{places[0]}/{COMMITS}/{uuid.uuid4().hex}"
    for place in places:
        number = max((e.number for e in entries(spark, place)), default=0) + 1
        entry = {"version": versions[place].rsplit("/", 1)[-1], "commit": commit}
        write_text(spark, f"{place}/{LOG}/{number:012d}.json", json.dumps(entry))
    write_text(spark, commit, "")
    return commit


def undo(spark: SparkSession, commit: str) -> None:
    remove(spark, commit)


def tidy(spark: SparkSession, place: str, keep: int = 1) -> None:
    """Remove what is neither current nor one of ``keep`` versions before it.

    Readers that opened the version before can finish. Entries without a record go too,
    and so do the versions that failed publishes left.
    """
    kept = committed(spark, place)[: 1 + keep]
    if not kept:
        return
    for e in entries(spark, place):
        if e not in kept:
            remove(spark, f"{place}/{LOG}/{e.number:012d}.json")
    for name in names_below(spark, place):
        if name.startswith(VERSION) and name not in {e.version for e in kept}:
            remove(spark, f"{place}/{name}")
