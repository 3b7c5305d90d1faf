"""Session settings and the two helpers that need the session itself."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings the library is written for. Partition counts are left to AQE: set
# spark.sql.shuffle.partitions high on a cluster and let it coalesce.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Checkpoints of the numbering go when their rows are no longer referred to.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "opsmetrics", **conf: str) -> SparkSession:
    """A session with the recommended settings; `conf` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def dimension(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small table held in code, as a DataFrame.

    It is handed over as Arrow, which makes it a local relation of known size:
    Catalyst then broadcasts it exactly when it is under
    `spark.sql.autoBroadcastJoinThreshold`, and no hint is needed.
    """
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    fields = to_arrow_schema(schema)
    table = pa.table([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)
    return spark.createDataFrame(table, schema=schema)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own, which
    goes when the program ends; on a cluster a machine-local folder would be
    lost with its machine. A folder that the setting names is the caller's to
    clear.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="opsmetrics-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on whatever file system it is."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there, on whatever file system it is."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(location, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` reliably, so that every later use sees the same rows in
    the same partitions even after executors are lost."""
    spark = df.sparkSession
    folder = checkpoint_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
