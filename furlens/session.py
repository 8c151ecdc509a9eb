"""Session helpers. Operators never create a session; callers do."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import furlens

# Defaults that suit these jobs. On a cluster, spark-submit settings win over
# them, and the shuffle partition count is a start value that AQE coalesces.
DEFAULTS = {
    "spark.scheduler.mode": "FAIR",  # concurrent models share the cores
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "furlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(*others) -> None:
    """Send the Python functions of this package, and of ``others``, with the tasks that use them.

    Executors then need no installed copy.
    """
    for module in (furlens, *others):
        cloudpickle.register_pickle_by_value(module)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session.

    A local session without ``spark.checkpoint.dir``, as in tests, gets a
    temporary folder; on a cluster the setting is required, because executors
    do not share local folders.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        hadoop_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if hadoop_dir.isDefined():
            root = hadoop_dir.get()
        elif spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
            root = tempfile.mkdtemp(prefix="furlens-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
