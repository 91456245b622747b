"""Session helpers: a shared scratch folder and a local test session."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def _own_folder(master: str) -> str:
    """A folder on this machine, for local sessions only: on a cluster the executors would not see it."""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="landfall-ckpt-")


def scratch_dir(spark: SparkSession) -> str:
    """A folder every executor can reach: under ``spark.checkpoint.dir``.

    The cluster names that folder; only a local session (tests, a laptop) may
    leave it unset and gets one of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        d = spark.conf.get("spark.checkpoint.dir", None) or _own_folder(spark.conf.get("spark.master", "remote"))
        return d.rstrip("/") + "/landfall"
    d = sc.getCheckpointDir()
    if not d:
        conf = sc.getConf().get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(conf or _own_folder(sc.master))
        d = sc.getCheckpointDir()
    return d.rstrip("/") + "/landfall"


def shared_dir(spark: SparkSession) -> str:
    """The configured ``spark.checkpoint.dir`` itself, the same for every
    application (``scratch_dir`` adds a per-application folder). Falls back to
    ``scratch_dir`` when nothing is configured."""
    try:
        conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    except Exception:  # Spark Connect
        conf = spark.conf.get("spark.checkpoint.dir", None)
    return conf.rstrip("/") + "/landfall" if conf else scratch_dir(spark)


def parallelism(spark: SparkSession) -> int:
    """Task slots of the session (shuffle partitions under Spark Connect)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions", "8"))


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "landfall") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]")
             .appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
