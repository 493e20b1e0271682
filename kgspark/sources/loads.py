"""Loads of a named table: each in a fresh folder, the current one named by a marker that is written last.

A marker is an empty file ``_current/<name>/<number>.<load>``: its creation is one step on any store, the highest number
counts, and readers need only a listing. Whatever is interrupted before it leaves the former load as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from kgspark.errors import PublishError

MARKERS = "_current"
#: A load without any row has no folder.
EMPTY = "empty"


def path_of(spark: SparkSession, path: str):
    """A path and its file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the folder or file exists, on whatever file system it names."""
    where, fs = path_of(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    where, fs = path_of(spark, path)
    fs.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the parent of the target is made, a target that exists is an error."""
    (old, fs), (new, _) = path_of(spark, source), path_of(spark, target)
    fs.mkdirs(new.getParent())
    if fs.exists(new) or not fs.rename(old, new):
        raise PublishError(f"{source} cannot become {target}")


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    where, fs = path_of(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def fresh_load() -> str:
    return uuid.uuid4().hex


def published(spark: SparkSession, root: str, name: str) -> list[tuple[int, str]]:
    """Marked loads of a name, ``number, load``, the current one last."""
    markers = (m.partition(".") for m in names_in(spark, f"{root}/{MARKERS}/{name}"))
    return sorted((int(number), load) for number, _, load in markers if number.isdecimal() and load)


def publish(spark: SparkSession, root: str, name: str, load: str, folder: str) -> None:
    """Make ``load`` the current one of ``name``; loads and markers before it go afterwards.

    ``folder`` is the name's folder below the root, with one folder ``load=<load>`` for each load. Of two loads
    published at the same moment one counts, and the other's caller gets an error.
    """
    before = published(spark, root, name)
    number = before[-1][0] + 1 if before else 1
    where, fs = path_of(spark, f"{root}/{MARKERS}/{name}/{number:012d}.{load}")
    fs.create(where, False).close()
    if published(spark, root, name)[-1] != (number, load):
        fs.delete(where, False)
        raise PublishError(f"another load of {name} was published at the same time")
    for old, other in before:
        remove(spark, f"{root}/{MARKERS}/{name}/{old:012d}.{other}")
        if other not in (EMPTY, load):
            remove(spark, f"{root}/{folder}/load={other}")


def current_loads(spark: SparkSession, root: str) -> dict[str, str]:
    """Current load of every name with a marker."""
    found = {name: published(spark, root, name) for name in names_in(spark, f"{root}/{MARKERS}")}
    return {name: loads[-1][1] for name, loads in found.items() if loads}
