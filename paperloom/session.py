"""Session helpers shared by every plan.

Nothing here keeps state of its own: the session carries the settings, so the
same code runs on ``local[8]`` and on a cluster.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession


def get_spark(app: str = "paperloom", cpus: str | int = "*") -> SparkSession:
    """A local session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PAPERLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives the workers this package, wherever the driver was started.

    Once per application the package's sources go into one archive that Spark serves to
    its executors; a worker that already finds the package on its path is not disturbed.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="paperloom-")) / "paperloom.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    spark.sparkContext.addPyFile(str(archive))


def in_arrow(df: DataFrame, f: Callable, ddl: str) -> DataFrame:
    """``df.mapInArrow`` for functions of this package, which the workers get first; for ``DataFrame.transform``."""
    ship_package(df.sparkSession)
    return df.mapInArrow(f, ddl)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str | Column) -> DataFrame:
    """Read one table; naming the columns keeps the scan to those columns."""
    ship_package(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, whose workers
    share the machine's disk, may go without: it gets a temporary folder that is removed at
    the end. A cluster without the setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = sc.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir names no shared folder")
        folder = tempfile.mkdtemp(prefix="paperloom-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    The files are removed when the returned frame is no longer used, where the session sets
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` (``get_spark`` does).
    """
    ship_package(df.sparkSession)
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
