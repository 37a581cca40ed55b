"""Versions of a model under one folder, published whole or not at all.

A save writes a folder of its own and then creates one empty file whose name holds
the version's number and folder. Creating a file is a single step in any store, so a
save that fails half-way leaves an unpublished folder that nobody reads, and readers
stay on the version that they have resolved.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Version:
    number: int
    path: str


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, folder: str) -> list[Version]:
    """All published versions, oldest first; of two published at once, the one with the greater name is later."""
    place, system = _place(spark, f"{folder}/published")
    if not system.exists(place):
        return []
    names = sorted(status.getPath().getName() for status in system.listStatus(place))
    return [Version(int(n.split("-")[0]), f"{folder}/versions/{n.split('-')[1]}") for n in names if "-" in n]


def latest(spark: SparkSession, folder: str) -> Version | None:
    return next(reversed(versions(spark, folder)), None)


def save(spark: SparkSession, folder: str, write: Callable[[str], None]) -> Version:
    """Let `write` fill a new folder, then publish it. If `write` fails, nothing changes for readers."""
    name = uuid.uuid4().hex
    path = f"{folder}/versions/{name}"
    write(path)
    known = latest(spark, folder)
    number = known.number + 1 if known else 1
    marker, system = _place(spark, f"{folder}/published/{number:012d}-{name}")
    system.create(marker, False).close()
    return Version(number, path)


def resolve(spark: SparkSession, folder: str) -> str:
    """The folder of the latest version; `folder` itself if it holds no versions."""
    found = latest(spark, folder)
    return found.path if found else folder


def retire(spark: SparkSession, folder: str, keep: int) -> int:
    """Take back all but the last `keep` versions and remove their tables; returns how many. Readers must have left them."""
    old = versions(spark, folder)[: -keep or None]
    for version in old:
        marker, system = _place(spark, f"{folder}/published/{version.number:012d}-{version.path.rsplit('/', 1)[1]}")
        system.delete(marker, False)
        place, system = _place(spark, version.path)
        system.delete(place, True)
    return len(old)
