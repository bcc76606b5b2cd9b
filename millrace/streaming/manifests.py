"""Commits that readers see whole or not at all: small JSON files, put in place by one rename."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    there = _path(spark, path)
    return _files(spark, there).exists(there)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, ascending; none if there is no such folder. Names of hidden files are left out."""
    folder = _path(spark, path)
    files = _files(spark, folder)
    if not files.exists(folder):
        return []
    found = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(name for name in found if not name.startswith(("_", ".")))


def commit(spark: SparkSession, path: str, content: object) -> None:
    """Write ``content`` as JSON beside ``path`` and move it there; fails if there is one already."""
    target = _path(spark, path)
    files = _files(spark, target)
    files.mkdirs(target.getParent())
    draft = _path(spark, f"{target.getParent().toString()}/.draft-{uuid.uuid4().hex}")
    out = files.create(draft)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise FileExistsError(path)


def committed(spark: SparkSession, path: str) -> object | None:
    """What was committed at ``path``; None if nothing was."""
    if not exists(spark, path):
        return None
    source = _path(spark, path)
    stream = _files(spark, source).open(source)
    try:
        data = stream.readAllBytes()
    finally:
        stream.close()
    return json.loads(bytes(data))


def move(spark: SparkSession, source: str, target: str) -> None:
    """One rename; nothing if an earlier attempt has moved the file."""
    here, there = _path(spark, source), _path(spark, target)
    files = _files(spark, here)
    if not files.exists(here):
        if not files.exists(there):
            raise FileNotFoundError(source)
        return
    files.mkdirs(there.getParent())
    if not files.rename(here, there):
        raise OSError(f"cannot move {source} to {target}")
