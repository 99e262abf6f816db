"""Session settings the operators rely on."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Instants are stored in UTC, re-planning and skew splitting are left to AQE,
# and failed conversions are handled with try_* functions under ANSI mode. The JVM never compiles
# methods beyond 8,000 bytes of bytecode: a stage that parses texts in one such method is interpreted
# for every row, so these run as separate, smaller functions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


_SHIPPED: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's SQL settings to an existing session, and send it the package."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Python workers import this package; it travels with the session, once, as an archive that
    Spark hands to every executor, whatever their folder or PYTHONPATH."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="millrace-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "millrace", memory: str = "8g") -> SparkSession:
    """Single-machine session for tests and benches."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.scheduler.mode", "FAIR"))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables that every executor can reach: under the
    cluster's ``spark.checkpoint.dir``, else under the warehouse. Only a single-machine
    session without the setting gets a temporary folder."""
    name = f"millrace-{purpose}-{uuid.uuid4().hex}"
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{name}"
    if re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
        return tempfile.mkdtemp(prefix=f"millrace-{purpose}-")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}"
