"""SparkSession construction and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every mediamart job relies on. Timestamps in the feeds are UTC wall
# clock, so the session zone is pinned; AQE re-plans joins at run time
# (broadcast conversion, partition coalescing, skew splitting).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str = "local[8]", app: str = "mediamart",
              shuffle_partitions: int = 8, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the mediamart settings applied."""
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(BASE_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.setdefault("spark.driver.memory", "8g")
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (e.g. the driver's)."""
    for key, value in BASE_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)


def shared_root(spark: SparkSession) -> str:
    """Root of the shared scratch folder.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (shared
    storage every executor can reach). Where it is unset, a local session (as in
    tests) gets a temporary folder; a cluster session gets an error, since a
    folder of one machine would be short on the others.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root and not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="mediamart-")
        sc.setCheckpointDir(root)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared root for one job's outputs."""
    return f"{shared_root(spark)}/mediamart/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str = "model"):
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    One job (a reliable ``checkpoint()`` without a cache computes the plan
    twice), the data lands on shared storage so a lost executor loses
    nothing, the lineage is cut so a model that several later models read is
    computed once, and the planner sees the table's real size for its join
    choices. Never a local checkpoint.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within, Spark deletes the shuffle files of each job as the job ends, and not
    when their plan happens to be collected as garbage. For a write whose result is read back
    from its files. The session has one such setting: not for jobs submitted together."""
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)
