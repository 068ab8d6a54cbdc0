"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on or profit from. Partition counts and memory
# stay with whoever submits the job.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A union of inputs partitioned alike is taken to keep that partitioning
    # (Spark 4.1), but adaptive execution may since have coalesced the inputs
    # differently: such plans fail, or would group wrongly.
    "spark.sql.unionOutputPartitioning": "false",
    # Namespaces may be larger than the default row limit of recursive queries.
    "spark.sql.cteRecursionRowLimit": "-1",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ensure(spark: SparkSession) -> None:
    """Apply the settings results depend on, unless they are in force."""
    for key in ("spark.sql.session.timeZone", "spark.sql.unionOutputPartitioning"):
        if spark.conf.get(key, None) != SETTINGS[key]:
            spark.conf.set(key, SETTINGS[key])


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without that setting uses a folder of its warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path under the shared folder; what the session left there goes when it ends."""
    context = spark.sparkContext
    base = f"{shared_dir(spark)}/tagloom-{context.applicationId}"
    folder = context._jvm.org.apache.hadoop.fs.Path(base)
    store = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not store.exists(folder):
        store.mkdirs(folder)
        store.deleteOnExit(folder)
    return f"{base}/{purpose}-{uuid.uuid4().hex}"
