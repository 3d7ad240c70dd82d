"""One place that knows how a session is configured."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def get_session(app: str = "ferrule", cores: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the operators rely on; the cluster's own settings win where it sets them."""
    builder = SparkSession.builder.appName(app)
    if "SPARK_MASTER" not in os.environ:
        builder = builder.master(f"local[{cores or '*'}]")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, if they can't otherwise."""
    root = str(Path(__file__).resolve().parents[1])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))
