"""Write once, then read: splits, recommendations, models and results."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tastemill.schema import ITEM, RESULTS_DDL, SPLIT, USER
from tastemill.sources.lease import lease, rename

DONE_MARKER = "_SUCCESS"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing ``path``; a crashed one leaves no marker."""
    return path_exists(spark, f"{path}/{DONE_MARKER}")


def write_frame(
    df: DataFrame, path: str, sort_by: tuple[str, ...] = (), partition_by: tuple[str, ...] = (), mode: str = "errorifexists"
) -> None:
    """Write Parquet, globally ordered by ``sort_by`` if given.

    Range partitioning goes by all sort columns, so with (user, item) a user
    with very many rows spreads over several files and the order by user holds.
    """
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def materialize(
    df_or_build: DataFrame | Callable[[], DataFrame],
    spark: SparkSession,
    path: str,
    sort_by: tuple[str, ...] = (USER, ITEM),
    partition_by: tuple[str, ...] = (),
    replace_incomplete: bool = False,
    schema: StructType | None = None,
) -> DataFrame:
    """Read ``path`` if it is complete, else write it and read it back.

    ``schema`` is needed for a partitioned table that may be empty, as such a
    table has no file to take the schema from.

    A path that exists without its completion marker is someone else's folder or
    the rest of a crashed job. It is an error unless ``replace_incomplete`` says
    that the caller owns the path.
    """
    if not is_complete(spark, path):
        exists = path_exists(spark, path)
        if exists and not replace_incomplete:
            raise FileExistsError(f"{path} exists but is not a finished table")
        df = df_or_build() if callable(df_or_build) else df_or_build
        write_frame(df, path, sort_by, partition_by, "overwrite" if exists else "errorifexists")
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def identity(spark: SparkSession, path: str) -> str:
    """A key over the files at ``path``: their names, sizes and times of change.

    Another table under the same path is another input.
    """
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(hadoop_path, True)
    found = []
    while files.hasNext():
        status = files.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return fingerprint(files=sorted(found))


def fingerprint(**config) -> str:
    """A short key over everything that determines an artifact."""
    text = json.dumps(config, sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:20]


@dataclass(frozen=True)
class ArtifactStore:
    """Artifacts under ``root``, each in a folder named by its full configuration.

    ``source`` names the input data, so stores of two data sets do not mix.
    """

    spark: SparkSession
    root: str
    source: str

    def path(self, folder: str, /, **config) -> str:
        return f"{self.root}/{folder}/{fingerprint(source=self.source, **config)}"

    def has(self, folder: str, /, **config) -> bool:
        """Whether the artifact is there and finished."""
        return is_complete(self.spark, self.path(folder, **config))

    def frame(
        self,
        folder: str,
        build: Callable[[], DataFrame],
        sort_by: tuple[str, ...] = (),
        partition_by: tuple[str, ...] = (),
        schema: StructType | None = None,
        /,
        **config,
    ) -> DataFrame:
        path = self.path(folder, **config)
        with lease(self.spark, path, lambda: is_complete(self.spark, path)):
            return materialize(build, self.spark, path, sort_by, partition_by, True, schema)

    def splits(self, build: Callable[[], DataFrame], schema: StructType, /, **config) -> DataFrame:
        """Splits are stored in one folder per split, so reading one skips the others."""
        return self.frame("splits", build, (USER, ITEM), (SPLIT,), schema, **config)

    def model(self, fit: Callable[[], ALSModel], /, **config) -> ALSModel:
        """A stored model, fitted and saved first if need be.

        It is loaded back after saving: the stored factors carry no lineage.
        """
        path = self.path("models", **config)
        # The writer saves the metadata first, so only the last part proves completion.
        with lease(self.spark, path, lambda: is_complete(self.spark, f"{path}/itemFactors")) as mine:
            if mine:
                fit().write().overwrite().save(path)
        return ALSModel.load(path)


def commit_results(spark: SparkSession, path: str, rows: list[tuple], /, **config) -> None:
    """Put the evaluation results of one configuration into the results table, in one step.

    They are written aside and then renamed, so a job that is killed leaves nothing to be read. The
    same configuration again is another commit of the same id, of which readers take the last.
    """
    aside = f"{path}/.attempt-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, RESULTS_DDL).coalesce(1).write.parquet(aside)
    rename(spark, aside, f"{path}/id={fingerprint(**config)}/commit={time.time_ns()}")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The last committed rows of each configuration; none if there is no table yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], RESULTS_DDL)
    stored = spark.read.schema(f"{RESULTS_DDL}, id STRING, commit BIGINT").parquet(path)
    last = F.max("commit").over(Window.partitionBy("id"))
    return stored.withColumn("last", last).filter("commit = last").drop("id", "commit", "last")
