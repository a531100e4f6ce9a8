"""Session settings, the shared folder and staged tables."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
ROWS_PER_CHUNK_KEY = "churnwright.rowsPerChunk"


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "churnwright") -> SparkSession:
    """A session for tests and the bench. On a cluster, pass the session the cluster gives you."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where the session names none (local tests) is one made and set, so that
    a cluster never ends up on a machine-local folder.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="churnwright-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return os.path.join(shared_dir(spark), "churnwright", f"{label}-{uuid.uuid4().hex[:12]}")


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back.

    Used where an aggregated table is read several times: the lineage is cut, the
    readers still prune columns, and a lost executor loses nothing.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    schema = df.schema
    df.write.mode("error").parquet(path)
    return spark.read.schema(schema).parquet(path)


def chunks_for(rows: int, spark: SparkSession) -> int:
    """How many ordered chunks to cut ``rows`` into.

    One chunk, that is a plain window, while the rows fit comfortably in one task
    (``churnwright.rowsPerChunk``); from there on as many as the data asks for.
    """
    return max(1, math.ceil(rows / int(spark.conf.get(ROWS_PER_CHUNK_KEY, "1000000"))))
