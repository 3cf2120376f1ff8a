"""Leases: of several jobs that want to build the same artifact, one does and the others wait.

A lease is a file next to the artifact, made by a create that fails if it exists. While its holder
builds, it renews the file's time of change; a lease that was not renewed for ``expiry`` seconds
belongs to a job that has ended, and is taken over.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import SparkSession

EXPIRY, LOOK = 120.0, 1.0


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder if it is there, on whatever file system it names."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a finished folder to a name that must be free."""
    files, old = _file_system(spark, source)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise FileExistsError(f"{target} is taken or cannot be written")


def _age(files, target) -> float | None:
    """Seconds since the lease was renewed; None if it has gone."""
    if not files.exists(target):
        return None
    try:
        return time.time() - files.getFileStatus(target).getModificationTime() / 1000
    except Exception:
        if files.exists(target):
            raise
        return None


@contextmanager
def lease(spark: SparkSession, path: str, done: Callable[[], bool], expiry: float = EXPIRY, look: float = LOOK):
    """Yields True with the lease on ``path`` held, or False as soon as ``done()`` holds without it."""
    files, target = _file_system(spark, f"{path}.lease")
    files.mkdirs(target.getParent())
    while True:
        if done():
            yield False
            return
        if files.createNewFile(target):
            break
        age = _age(files, target)
        if age is not None and age > expiry:
            # One of those who see it expired moves it away, and that one only.
            aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.lease-{uuid.uuid4().hex}")
            if files.rename(target, aside):
                files.delete(aside, False)
            continue
        time.sleep(look)

    ended = threading.Event()

    def renew() -> None:
        while not ended.wait(expiry / 4):
            files.setTimes(target, int(time.time() * 1000), -1)

    renewal = threading.Thread(target=renew, daemon=True)
    renewal.start()
    try:
        # The holder before may have finished between the look and the create.
        yield not done()
    finally:
        ended.set()
        renewal.join()
        files.delete(target, False)
