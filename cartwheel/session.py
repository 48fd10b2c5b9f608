"""Session helpers.

Library functions never create or configure a session; they take DataFrames.
These helpers are for jobs, tests and the bench.  Cluster settings (shuffle
partitions, checkpoint folder) are read from the session when present and only
filled in when unset, as in local tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job here wants.  AQE re-plans joins and aggregates at run time
# (coalesces small shuffle partitions, splits skewed join partitions, turns
# joins into broadcasts once the real size of a side is known).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cartwheel") -> SparkSession:
    """A local session for tests and the bench (not for cluster jobs)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cartwheel-ckpt-", dir="/tmp"))
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    b = (b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
          .config("spark.driver.memory", os.environ.get("CARTWHEEL_DRIVER_MEM", "8g"))
          .config("spark.sql.session.timeZone", "UTC")
          # Local runs: broadcast only really small sides (dimensions); fact
          # tables of a few MB join faster as parallel shuffle joins here.
          .config("spark.sql.autoBroadcastJoinThreshold", str(2 << 20)))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Where it is not set, a session whose driver and executors are one process
    (``local[n]``) gets a temporary one; on a cluster that is an error, since a
    folder of one machine would lose state and offsets with it."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="cartwheel-ckpt-", dir="/tmp")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def ship_package(spark: SparkSession) -> None:
    """Make ``cartwheel`` importable in Python workers (state functions and
    UDTFs are pickled by reference).  Zips the package once per session and
    hands it to ``addPyFile``, which distributes it with the job."""
    if spark.conf.get("cartwheel.shipped", "false") == "true":
        return
    import shutil
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="cartwheel-pkg-")
    archive = shutil.make_archive(os.path.join(out, "cartwheel"), "zip", os.path.dirname(pkg), "cartwheel")
    spark.sparkContext.addPyFile(archive)
    spark.conf.set("cartwheel.shipped", "true")
