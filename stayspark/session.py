"""Sessions: settings for local work, and shipping this package to executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
ARROW_BYTES = 4 << 20
_ARROW = "spark.sql.execution.arrow.maxBytesPerBatch"


def local_session(cpus: int = 8, partitions: int = 8, name: str = "stayspark", memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as spark.checkpoint.dir names it. Where it is unset, a local session gets
    a temporary one; on a cluster that would be another folder on every machine, so there it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        own = tempfile.mkdtemp(prefix="shared-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(own)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


TASKS_A_CORE = 3


def spread(df: DataFrame) -> DataFrame:
    """df's rows over all cores. For short rows with much work each: a small file is read by one task, whatever its rows cost.
    Select the columns that are needed before: these are shuffled."""
    return df.repartition(TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism)


def bounded(spark: SparkSession) -> None:
    """Batches that go to Python hold ARROW_BYTES, however long their rows, unless the session has a bound of its own."""
    if spark.conf.get(_ARROW, None) is None:
        spark.conf.set(_ARROW, str(ARROW_BYTES))


def ship(spark: SparkSession) -> None:
    """Give executors this package, once an application; Spark's own file server carries it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    d = tempfile.mkdtemp(prefix="ship-")
    atexit.register(shutil.rmtree, d, ignore_errors=True)  # local executors copy the file when they need it
    path = os.path.join(d, f"{root.name}-{app}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
