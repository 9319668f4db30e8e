"""A commit log for model versions and their tables under concurrent writers.

A folder holds data folders, which nobody reads by listing them, and numbered commit files, each
put in place only if the number is free. A writer that finds its number taken looks at the log
again and tries the next one, so decisions that depend on the log, such as the next version,
are made one after the other. Readers see the data of the commits up to a number: whole writes
only, and the same ones whenever they read up to that number again.
"""

from __future__ import annotations

import datetime
import json
import os
import random
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from keeprate.sources.versions import FIRST_VERSION, following_version

ENTRY = "number long, kind string, version string, run_id string, path string, ts timestamp"
PAUSE = 0.05  # seconds that a writer who lost a number waits at most, before the next try


def _store(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file under a hidden name and gives it its own only if that is free.

    Local files get it by a hard link, others by a rename that does not overwrite. That is atomic in
    file systems with atomic renames, such as HDFS; plain object stores have none.
    """
    jvm = spark.sparkContext._jvm
    target, store = _store(spark, path)
    hidden = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = store.create(hidden, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if store.getScheme() == "file":
            os.link(hidden.toUri().getPath(), target.toUri().getPath())
        else:
            files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            files.rename(hidden, target, none)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        store.delete(hidden, False)


def last_commit(spark: SparkSession, folder: str) -> int:
    """The highest number of a commit, 0 without any."""
    path, store = _store(spark, f"{folder}/commits")
    if not store.exists(path):
        return 0
    names = [status.getPath().getName() for status in store.listStatus(path)]
    return max((int(name.removesuffix(".json")) for name in names if name[0].isdigit()), default=0)


def entries(spark: SparkSession, folder: str, upto: int | None = None) -> DataFrame:
    """The commits up to a number (all, if None), as a table of ``ENTRY``."""
    last = last_commit(spark, folder) if upto is None else upto
    if not last:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).json(f"{folder}/commits").filter(F.col("number") <= last)


def commit(spark: SparkSession, folder: str, entry: Callable[[int], dict]) -> dict:
    """Adds the entry that ``entry(number of the last commit)`` gives, asked again after every lost race."""
    while True:
        last = last_commit(spark, folder)
        now = datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="milliseconds")
        made = {"number": last + 1, "ts": now} | entry(last)
        if made["number"] <= last or put_if_absent(spark, f"{folder}/commits/{last + 1:020d}.json", json.dumps(made)):
            return made
        time.sleep(random.uniform(0, PAUSE))


def append(spark: SparkSession, rows: DataFrame, folder: str, kind: str, **noted: str) -> int:
    """Writes rows to a folder of their own and commits it; returns the commit's number."""
    path = f"data/{kind}-{uuid.uuid4().hex}"
    rows.write.parquet(f"{folder}/{path}")
    return commit(spark, folder, lambda _: {"kind": kind, "path": path, **noted})["number"]


def rows(spark: SparkSession, folder: str, kind: str, upto: int | None = None, schema=None) -> DataFrame:
    """All committed rows of a kind, up to a commit; without any an empty table of ``schema``, or an error if that is None."""
    paths = [f"{folder}/{r.path}" for r in entries(spark, folder, upto).filter(F.col("kind") == kind).orderBy("number").select("path").collect()]
    if not paths and schema is None:
        raise LookupError(f"no committed {kind} in {folder}")
    return spark.read.parquet(*paths) if paths else spark.createDataFrame([], schema)


def reserve_version(spark: SparkSession, folder: str, run_id: str) -> str:
    """The next free version, which no other run gets; the run's own one if it has reserved before. The first is 1.0."""

    def following(last: int) -> dict:
        taken = entries(spark, folder, last).filter("version IS NOT NULL")
        own = taken.filter((F.col("kind") == "reserved") & (F.col("run_id") == run_id)).first()
        if own:
            return {"number": own.number, "version": own.version}
        version = following_version(taken).first()["next_version"] if taken.take(1) else FIRST_VERSION
        return {"kind": "reserved", "version": version, "run_id": run_id}

    return commit(spark, folder, following)["version"]


def save_model(spark: SparkSession, folder: str, model: PipelineModel, version: str, run_id: str | None = None) -> str:
    """Saves a model and commits it under its version; returns its path below the folder."""
    path = f"versions/v{version}-{uuid.uuid4().hex}"
    model.write().save(f"{folder}/{path}")
    commit(spark, folder, lambda _: {"kind": "model", "version": version, "path": path, "run_id": run_id})
    return path


def load_model(spark: SparkSession, folder: str, version: str) -> PipelineModel:
    """The model last committed under a version."""
    saved = entries(spark, folder).filter((F.col("kind") == "model") & (F.col("version") == version))
    last = saved.orderBy(F.desc("number")).first()
    if not last:
        raise LookupError(f"no committed model of version {version} in {folder}")
    return PipelineModel.load(f"{folder}/{last.path}")


def history(spark: SparkSession, folder: str) -> DataFrame:
    """(version, timestamp) of every committed model."""
    return entries(spark, folder).filter("kind = 'model'").select("version", F.col("ts").alias("timestamp"))
