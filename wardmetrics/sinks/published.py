"""Publication by marker: data is staged, and counts from the moment one small file names it.

A marker is created whole or not at all and never changed. Readers follow
markers, so what a job that died has staged is never seen, and a rerun that finds
its marker has nothing left to do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_FOLDER = "_markers"


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def put_marker(spark: SparkSession, base: str, name: str, text: str) -> bool:
    """Create the marker ``name`` of ``base``; False, and nothing done, where it is there already."""
    folder = f"{base.rstrip('/')}/{_FOLDER}"
    target, store = _file_system(spark, f"{folder}/{name}")
    staged, _ = _file_system(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    if store.exists(target):
        return False
    out = store.create(staged)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return bool(store.rename(staged, target))


def marker_names(spark: SparkSession, base: str) -> list[str]:
    folder, store = _file_system(spark, f"{base.rstrip('/')}/{_FOLDER}")
    if not store.exists(folder):
        return []
    return sorted(name for name in (entry.getPath().getName() for entry in store.listStatus(folder)) if not name.startswith("."))


def marker_text(spark: SparkSession, base: str, name: str) -> str | None:
    path, store = _file_system(spark, f"{base.rstrip('/')}/{_FOLDER}/{name}")
    if not store.exists(path):
        return None
    stream = store.open(path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def take_place(spark: SparkSession, staged: str, path: str) -> None:
    """Put a whole staged folder in the place of ``path``; what was there goes once the new one is in."""
    new, store = _file_system(spark, staged)
    target, _ = _file_system(spark, path)
    folder, name = path.rstrip("/").rsplit("/", 1)
    old, _ = _file_system(spark, f"{folder}/_old-{name}-{uuid.uuid4().hex}")
    there = store.exists(target)
    if there and not store.rename(target, old):
        raise OSError(f"{path} cannot be moved aside")
    if not store.rename(new, target):
        if there:
            store.rename(old, target)
        raise OSError(f"{staged} cannot take the place of {path}")
    if there:
        store.delete(old, True)
