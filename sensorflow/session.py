"""Session helpers: a local session for tests and the bench, and the shared folder."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "sensorflow", conf: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters bring their own session."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("SENSORFLOW_DRIVER_MEMORY", "16g"))
    for k, v in {**_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path in the folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset a local session takes a folder below its SQL warehouse; a cluster is an
    error, as its machines need not share the warehouse's folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return "/".join([base.rstrip("/"), *parts])
