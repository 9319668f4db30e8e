"""Session helpers: settings, table access and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROWS_A_FILE = 50_000  # of narrow tables whose size is known; placement only


def local_session(cores: str = "8", shuffle_partitions: int = 8, name: str = "keeprate") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can write to.

    It is the cluster's ``spark.checkpoint.dir``. Only a session inside one process, as in
    tests, gets a folder of its own where that is unset; a cluster without the setting is
    an error, since its executors could not see such a folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="keeprate-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_folder(spark)}/keeprate-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Deletes what this application has written to the shared folder.

    For the end of a job, or between jobs whose results have been written elsewhere:
    DataFrames that read intermediate tables can't be used afterwards.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settled(df: DataFrame, name: str, about: int | None = None) -> DataFrame:
    """Writes a table to the shared folder and continues from the copy.

    ``about`` so many rows, where a caller knows, go to no more files than they fill: on local files Hadoop starts
    processes for each file, and many small tables in hundreds of files keep executors at that.

    For results that several later steps read: it cuts the plan, which would
    otherwise be repeated inside every reader, outlives lost executors, and gives
    the readers column pruning and true sizes to plan joins with.
    """
    path = scratch_path(df.sparkSession, name)
    if about is not None:
        df = df.coalesce(max(1, -(-about // ROWS_A_FILE)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``settled`` wrote, where a job makes many that it needs for a step only."""
    for df in tables:
        own = run_folder(df.sparkSession)
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            if f"{own.rsplit('/', 1)[1]}/" not in folder:
                raise ValueError(f"{folder} is not a scratch table")
            path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
