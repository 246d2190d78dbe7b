"""Session helpers: the shared scratch folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine; on a cluster an
    unset folder is an error, because executors would write to disks nobody else can read.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="skuloom-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses; nothing is created yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint, so a lost executor replays from shared files."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def small_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few driver rows as a DataFrame.

    Arrow data becomes a local relation of known size: Spark can broadcast it on its own and no
    Python worker takes part, unlike rows passed as a plain list.
    """
    names = StructType.fromDDL(schema).fieldNames()
    columns = {n: [r[i] for r in rows] for i, n in enumerate(names)}
    return spark.createDataFrame(pa.table(columns), schema)
