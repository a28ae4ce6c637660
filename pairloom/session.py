"""Session settings the operators are designed for, and a reliable cut of lineage."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings; a cluster sets its own sizes (executors, memory, shuffle partitions).
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One hot text, dataset or key may hold a third of the rows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

BATCH_SETTING, DEFAULT_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", 4 << 20


def build_session(app: str = "pairloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_folder() -> str:
    """The folder of a local session, which goes with it."""
    folder = tempfile.mkdtemp(prefix="pairloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def staging_folder(spark: SparkSession, fallback_dir: str | None = None) -> str:
    """A new folder that driver and executors all see.

    It lies under ``spark.checkpoint.dir``; only where that is unset under ``fallback_dir``,
    and without either only a local session may go on, with a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or fallback_dir
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    return f"{base}/staging_{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, fallback_dir: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and go on from the files.

    Readers of it take only the columns they need, and a lost executor costs no recomputation.
    """
    path = f"{staging_folder(df.sparkSession, fallback_dir)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of ``BATCH_BYTES``, where the session leaves that size at its default.

    A batch lies in the executor's memory several times: as Arrow buffers on both sides and as Python
    objects.  Its size never changes a result.
    """
    if spark.conf.get(BATCH_SETTING) == DEFAULT_BATCH:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
