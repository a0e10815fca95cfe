"""Session helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ROOT = str(Path(__file__).resolve().parent.parent)


def on_workers(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it.

    On a cluster whose executors don't have that folder, ship the package with `--py-files` as usual. Rows can be long
    (whole texts, masks), so Arrow batches get ROWS rows, unless the session asks for another number than Spark's own.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(ROWS))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
    return spark


def read(spark: SparkSession, folder: str, *names: str):
    """The Parquet tables of those names, one or a tuple."""
    found = tuple(spark.read.parquet(f"{folder}/{name}.parquet") for name in names)
    return found if len(found) > 1 else found[0]


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Where that is unset, a temporary folder in local mode, as in tests; an error elsewhere,
    as executors don't see the driver's folders."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(rows: DataFrame) -> DataFrame:
    """The rows without lineage, in the shared folder."""
    spark = rows.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return rows.checkpoint()
