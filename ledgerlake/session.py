"""Spark session settings shared by jobs, tests and the bench.

Everything that changes results (time zone, ANSI casts) is set here so the
same code gives the same answer on a laptop and on a cluster.  Cluster-only
knobs (executor sizes, shuffle partitions) are left to the submitter; the
defaults below only apply when the session does not set them already.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that define semantics: always enforced.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that only affect the physical plan.  AQE re-plans joins from
# runtime sizes (sort-merge -> broadcast when a side turns out small), splits
# skewed shuffle partitions and coalesces tiny ones.
PHYSICAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # target ~128 MB per shuffle partition after coalescing / skew splitting
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    # 64 MB input splits keep scan tasks well under executor memory.
    "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def build_session(master: str | None = None, app: str = "ledgerlake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``master`` is only used when given (local tests, bench); on a cluster the
    launcher decides.  ``spark.ui.enabled`` is off: no web server is started.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SEMANTIC_CONF)
    conf.update(PHYSICAL_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.sql.execution.arrow.pyspark.enabled"] = "true"
    if master and master.startswith("local"):
        # local runs only: a scratch folder; clusters name a shared one
        conf.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(
            prefix="ledgerlake-ckpt-", dir=os.environ.get("LEDGERLAKE_SCRATCH", "/tmp")))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply semantic settings to an existing session (e.g. one the driver made)."""
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)
    for k, v in PHYSICAL_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


MIN_PARTITIONS = "spark.sql.adaptive.coalescePartitions.minPartitionNum"


@contextmanager
def even_tasks(spark: SparkSession, per_core: int = 4):
    """While it is open, AQE leaves ``per_core`` shuffle partitions a core instead of about one: with one it cuts a stage into one
    task more than there are cores, and that last task runs alone.  A number set by the submitter is kept."""
    ours = spark.conf.get(MIN_PARTITIONS, None) is None
    if ours:
        spark.conf.set(MIN_PARTITIONS, str(per_core * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if ours:
            spark.conf.unset(MIN_PARTITIONS)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediates.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared folder
    there).  Only when it is unset, as in local tests, a scratch folder is
    created and registered.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: checkpoints and written "
                               "intermediates must survive the loss of any one machine")
        d = tempfile.mkdtemp(prefix="ledgerlake-ckpt-",
                             dir=os.environ.get("LEDGERLAKE_SCRATCH", "/tmp"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
