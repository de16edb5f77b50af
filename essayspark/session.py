"""SparkSession construction and cluster-safe scratch locations.

The library never creates its own session inside an operator: every
function takes a DataFrame (or a session) handed in by the caller. This
module only exists for scripts, tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a 1000-executor job wants too; local runs just inherit them.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A partition counts as skewed when 5x the median and over 256 MB;
    # AQE then splits it and replicates the other side's matching part.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # top-N per group (row_number() <= N) gets a partial per-task limit
    # before the shuffle only when N is under this threshold (default 1000);
    # vocabularies per group use N = 10,000.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "essayspark", extra: dict | None = None) -> SparkSession:
    """Return a session; on a cluster the launcher's settings win."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):  # one JVM holds everything; a cluster's launcher decides itself
        b = b.config("spark.driver.memory", os.environ.get("ESSAYSPARK_DRIVER_MEMORY", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only when it is
    unset (tests, local runs) fall back to a fresh local scratch folder."""
    conf = spark.sparkContext.getConf()
    d = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith(("local[", "local-cluster")) and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="essayspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package (pandas UDFs pickle functions by
    module reference).  Every Python function carries ``sc.environment`` to
    its workers, so the package root is put on their PYTHONPATH whatever the
    driver's working directory.  On a cluster whose executors do not see
    this path, ship the package with ``--py-files`` as usual."""
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT] + parts)


def checkpointed(df):
    """Write narrow, reused rows once to the shared checkpoint folder and
    continue from them (cuts lineage; a lost executor re-reads these rows
    instead of recomputing what produced them)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df):
    """As ``checkpointed``, but as a Parquet table in that folder: its size in bytes is the files', so the planner
    broadcasts it in a join only while it is small."""
    path = scratch_path(df.sparkSession, f"rows-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
