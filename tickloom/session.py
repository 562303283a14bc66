"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings every job relies on.  They are set on the session in
# use, because a job may be handed a session somebody else built.
RUNTIME_CONF = {
    # The warehouse semantics truncate days and hours in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when the next operator wants the join's
    # partitioning: one more shuffle is cheaper than one task with a third of
    # the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Cut groups to their first rows before the shuffle for up to this many rows.
    "spark.sql.optimizer.windowGroupLimitThreshold": "4000",
}


def build_session(app_name: str = "tickloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and scratch tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without that setting gets a temporary folder: on a cluster such a folder
    would be lost with its machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        shared = tempfile.mkdtemp(prefix="run-tickloom-")
    sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()
