"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession

RECOMMENDED_CONF = {
    # AQE sizes the shuffles, turns joins with small sides into broadcast joins
    # at run time and splits hot join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Feeds are clocked at UTC+8, a zone without daylight saving, so that
    # parsing a local time and printing it again never moves it.
    "spark.sql.session.timeZone": "+08:00",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "kpiloom", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach: as named by the cluster, else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"


def work_folder(spark: SparkSession, purpose: str) -> str:
    """Name of a new, not yet existing folder below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def side_by_side[R](spark: SparkSession, calls: dict[str, Callable[[], R]]) -> dict[str, R]:
    """The results of calls that need nothing of each other, made at the same time.

    While one of them plans, lists files or commits, the tasks of the others have the machines.
    An error is raised once all of them have ended.
    """

    def inheriting(call: Callable[[], R]) -> Callable[[], R]:
        """The call, with the properties that this thread has set, such as its job group; they belong to threads if pinned."""
        wrap = inheritable_thread_target(spark)
        return call if wrap is spark else wrap(call)

    with ThreadPoolExecutor(max(1, len(calls))) as pool:
        made = {name: pool.submit(inheriting(call)) for name, call in calls.items()}
    return {name: future.result() for name, future in made.items()}


def land_observed(df: DataFrame, folder: str, **aggregates: Column) -> tuple[DataFrame, dict]:
    """As `land`, with values of the aggregates that the same pass has taken."""
    seen = Observation()
    df.observe(seen, *[c.alias(name) for name, c in aggregates.items()]).write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), seen.get


def land(df: DataFrame, folder: str) -> DataFrame:
    """Write a frame as Parquet once and read it back.

    Several outputs of one feed then share a single parse, read only the columns
    they need, and survive the loss of executors. `folder` is new, from
    `work_folder`; whoever named it removes it once the outputs are written.
    """
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def file_system(spark: SparkSession, path: str):
    """Hadoop file system of a path, and the constructor of its paths."""
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark._jsc.hadoopConfiguration()), to_path


def folder_exists(spark: SparkSession, folder: str) -> bool:
    fs, to_path = file_system(spark, folder)
    return fs.exists(to_path(folder))


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Removes a work folder and what is in it."""
    fs, to_path = file_system(spark, folder)
    fs.delete(to_path(folder), True)


@contextmanager
def landed(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """The landed frame, for as long as the block takes."""
    spark = df.sparkSession
    folder = work_folder(spark, purpose)
    try:
        yield land(df, folder)
    finally:
        remove_folder(spark, folder)
