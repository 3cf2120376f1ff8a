"""Small intermediate tables, written to the shared folder and read back.

Several steps first derive a list of keys from all rows and then apply it to the
same rows. Writing the list has three effects: the plan stays linear (one pass
to derive, one to apply) instead of carrying the derivation inside every later
step; a lost executor does not bring the derivation back; and the size of the
list is known, so Catalyst broadcasts it only if it is below the threshold.

What is staged has an owner: the innermost open ``scratch`` block, or else the
application. A block removes its tables when it ends, also if it fails; so it must
hold whatever reads them. What the application owns goes when it ends.

Spark keeps the shuffle files of a query until the driver's garbage is collected, which
in a loop of large steps is late. ``stage_parts`` writes a table in parts whose shuffles
go with each part; ``collected`` is for loops inside MLlib, which cannot be taken apart.
"""

from __future__ import annotations

import atexit
import threading
from collections.abc import Callable, Iterable
from contextlib import contextmanager, suppress

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

from tastemill.session import shared_dir
from tastemill.sources.lease import remove

Stage = Callable[[str, DataFrame], DataFrame]

#: Rows in a file of a staged table. Columns of few bytes would else give a task that reads them, and may
#: group them by keys that hardly repeat, tens of millions of rows.
ROWS_PER_FILE = 250_000

#: Bytes that a step in parts shuffles at once.
PASS_BYTES = 4 * 2**30
#: Removes a query's shuffle files when the query ends (since Spark 4.1; unknown to others, and then of no effect).
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Seconds between two collections of the driver's garbage.
COLLECT_EVERY = 30.0

_scopes = threading.local()
_cleaning, _inside = threading.Lock(), {"n": 0, "before": None}
_left: list[str] = []
_exit: list[SparkSession] = []


def _owned(spark: SparkSession, path: str) -> str:
    scope = getattr(_scopes, "open", None)
    if scope:
        scope[-1].append(path)
    else:
        _left.append(path)
        if spark not in _exit:
            _exit.append(spark)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder that goes with its owner."""
    return _owned(spark, shared_dir(spark, name))


@contextmanager
def scratch(spark: SparkSession):
    """Owner of all that is staged inside, by the same thread; what reads it must run inside too."""
    scopes = _scopes.__dict__.setdefault("open", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            remove(spark, path)


@atexit.register
def _remove_left() -> None:
    """At the end of the application, as far as its session still runs."""
    spark = next((s for s in _exit if s.sparkContext._jsc is not None), None)
    # The gateway may have ended before this process does; then there is nobody left to ask.
    with suppress(Py4JError, OSError):
        if spark is not None and not spark.sparkContext._jsc.sc().isStopped():
            for path in _left:
                remove(spark, path)


def stage_table(name: str, df: DataFrame) -> DataFrame:
    """Write ``df`` to a fresh folder and return the scan of it."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"stage-{name}")
    df.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Inside, by whatever thread, the shuffle files of a query go when the query has ended."""
    with _cleaning:
        if not _inside["n"]:
            _inside["before"] = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _inside["n"] += 1
    try:
        yield
    finally:
        with _cleaning:
            _inside["n"] -= 1
            if not _inside["n"]:
                if _inside["before"] is None:
                    spark.conf.unset(CLEANUP)
                else:
                    spark.conf.set(CLEANUP, _inside["before"])


def stage_parts(path: str, frames: Iterable[DataFrame]) -> DataFrame:
    """The scan of one folder that the frames, of the same columns, are written to one after the other.

    A part is only planned when the one before it is written and its shuffle files are gone.
    """
    for df in frames:
        with shuffles_removed(df.sparkSession):
            df.write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def collected(spark: SparkSession):
    """Inside, and once at its end, the driver's garbage is collected every so often, and with it go the shuffle files that nothing reads any more."""
    done = threading.Event()

    def collect() -> None:
        while not done.wait(COLLECT_EVERY):
            spark._jvm.System.gc()

    thread = threading.Thread(target=collect, daemon=True)
    thread.start()
    try:
        yield
    finally:
        done.set()
        thread.join()
        spark._jvm.System.gc()


def stage_nothing(name: str, df: DataFrame) -> DataFrame:
    """Keep everything in one lazy plan."""
    return df
