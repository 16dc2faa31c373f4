"""A session with the settings that the operators count on."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution and skew-join splitting; anything else is the cluster's own."""
    builder = SparkSession.builder.appName("bindery")
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"} | conf
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return builder.config(map=settings).getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, so that their Python workers can import it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).parent
        path = Path(tempfile.mkdtemp(prefix="bindery-")) / "bindery.zip"
        with zipfile.ZipFile(path, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(str(path))
        _shipped.add(context.applicationId)
