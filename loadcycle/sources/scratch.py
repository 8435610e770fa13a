"""Shared scratch space for tables that cut a long lineage."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


def _base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; without it a local session uses its warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


_OWN: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, or below the folder of the run that is under way."""
    return f"{_OWN[-1] if _OWN else _base(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def own_scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside go when the block ends; what it returns must be written elsewhere by then."""
    _OWN.append(f"{_base(spark)}/run-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        remove(spark, _OWN.pop())


def _store(spark: SparkSession, path: str):
    """A path of the cluster's store and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in place of the one that may be there; a reader sees the old one or the new one."""
    place, store = _store(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}-{uuid.uuid4().hex}")
    out = store.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not store.rename(draft, place):  # some stores do not rename onto a file
        store.delete(place, False)
        store.rename(draft, place)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, or None if there is none."""
    place, store = _store(spark, path)
    if not store.exists(place):
        return None
    source = store.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def exists(spark: SparkSession, path: str) -> bool:
    place, store = _store(spark, path)
    return store.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    place, store = _store(spark, path)
    store.delete(place, True)


#: Spark's setting by which an execution's shuffle files go when it ends, instead of when the driver next collects garbage.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITES: dict[str, object] = {"lock": threading.Lock(), "under way": 0, "before": None}


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files behind: nobody can read them again. The session's setting is put back."""
    with _WRITES["lock"]:
        if not _WRITES["under way"]:
            _WRITES["before"] = spark.conf.get(_RELEASE, None)
            spark.conf.set(_RELEASE, "true")
        _WRITES["under way"] += 1
    try:
        yield
    finally:
        with _WRITES["lock"]:
            _WRITES["under way"] -= 1
            if not _WRITES["under way"]:
                before = _WRITES["before"]
                spark.conf.unset(_RELEASE) if before is None else spark.conf.set(_RELEASE, before)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: later steps prune columns on the written table and survive lost executors."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_released(df.sparkSession):
        df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *builds: Callable[[], T]) -> list[T]:
    """Run builds that start jobs of their own side by side, so the cluster is not left idle between them."""
    with ThreadPoolExecutor(len(builds)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(build)) for build in builds]]
