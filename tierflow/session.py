"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs are written for. Adaptive execution sizes shuffles, splits skewed join
# partitions and turns small join sides into broadcasts from measured sizes, so no plan in this
# package carries a broadcast hint on data whose size can grow.
ENGINE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

# On a cluster: many small initial shuffle partitions, merged at run time to the advisory size.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(master: str | None = None, app: str = "tierflow", **conf: str) -> SparkSession:
    """Start (or reuse) a session. Without ``master`` the submit command decides it."""
    builder = SparkSession.builder.appName(app)
    settings = dict(ENGINE_CONF)
    if master is not None:
        builder = builder.master(master)
    if master is None or not master.startswith("local"):
        settings.update(CLUSTER_CONF)
    settings.update({name.replace("__", "."): str(value) for name, value in conf.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate tables that every executor can reach.

    The cluster names the shared root in ``spark.checkpoint.dir``. Only a local session without
    that setting falls back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tierflow-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
