"""Session settings that the engine's plans rely on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kbforge")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session that already exists."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give this package to the session's Python workers, once per application: they need not find it themselves."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package, folder = Path(__file__).parent, tempfile.mkdtemp(prefix="kbforge-code-")
        atexit.register(shutil.rmtree, folder, True)
        with zipfile.ZipFile(f"{folder}/kbforge.zip", "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, str(path.relative_to(package.parent)))
        context.addPyFile(f"{folder}/kbforge.zip")
        _SHIPPED.add(context.applicationId)
    return spark
