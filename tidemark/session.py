"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. Cluster sizing (executors, memory, shuffle
# partitions) is left to the submitter; AQE coalesces whatever is chosen.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package, once per application; also for a session the caller made."""
    sc = spark.sparkContext
    if not getattr(sc, "_tidemark_shipped", False):
        root = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="tidemark-src-"), "tidemark_src.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, source.relative_to(root.parent))
        sc.addPyFile(str(archive))
        sc._tidemark_shipped = True
    return spark


def give_back() -> None:
    """Free memory back to the system: a worker stays for later tasks, and others run beside it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for cut lineage: the session's ``spark.checkpoint.dir``.

    A local folder is made only in local mode (unit tests): executors of a
    cluster would not see it.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current is None:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
        current = sc.getCheckpointDir()
    return current


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on the shared folder; survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
