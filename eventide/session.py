"""Session settings the library relies on, and where durable scratch data goes."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "eventide", cores: str = "*", shuffle_partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.python.unix.domain.socket.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Windows are aligned to the UTC epoch, so zone-less input is read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def durable_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    A machine-local folder is only used where no shared one is configured, as in tests.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    name = f"{label}-{uuid.uuid4().hex}"
    if shared:
        return f"{shared.rstrip('/')}/{name}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    return os.path.join(tempfile.mkdtemp(prefix="eventide-"), name)
