"""Session settings and the small pieces of plumbing every operator shares."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "foliant", cores: int | None = None, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own settings."""
    n = cores or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Let the executors import this package, wherever it lies on the driver. Once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_foliant_shipped", False):
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="foliant-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / "foliant_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(archive))  # served to the executors by the driver
    sc._foliant_shipped = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files.

    The folder is the session's ``spark.checkpoint.dir``. Where that is unset, a session within one process, as in tests, takes
    a temporary folder; on a cluster that is an error, as executors could not read such a folder.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    ship(spark)
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="foliant-checkpoint-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def hashed_sample(df: DataFrame, key: str, rows: int) -> list:
    """At most ``rows`` rows, those with the smallest hashes of ``key``, on the driver. A threshold on the hash comes first, so
    no partition sends more than its part."""
    n = df.count()
    hashed = df.withColumn("_h", F.xxhash64(key))
    if n > 1.1 * rows:
        hashed = hashed.filter(F.col("_h") < int(-(2**63) + 2**64 * (1.1 * rows / n)))
    return sorted(hashed.collect(), key=lambda r: r["_h"])[:rows]


def latest_delivery(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """One row per ``key``: the row delivered last by ``order``. Null keys are left out."""
    rest = [c for c in columns if c != key]
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max_by(F.struct(*rest), F.coalesce(F.col(order).cast("timestamp"), F.lit(0).cast("timestamp"))).alias("_r"))
        .select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])
    )
