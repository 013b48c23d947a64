"""Session helpers: the settings every job here relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the plans assume. AQE re-plans at runtime (coalesces small shuffle
# partitions, turns a join whose side proves small at runtime into a broadcast,
# and splits skewed join partitions even when that costs an extra exchange).
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

# Used only when this module starts the JVM of a local master (tests, bench): there the driver does the work.
LOCAL_JVM_CONF = {"spark.driver.memory": "8g"}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "eligo", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`SESSION_CONF` applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if master and master.startswith("local"):
        conf.update(LOCAL_JVM_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of :data:`SESSION_CONF` to an existing session."""
    for key, value in SESSION_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Order: the session setting, then a folder already registered on the
    SparkContext, and only when neither exists (local runs, tests) a private
    temporary folder registered with ``setCheckpointDir``. A cluster setting is
    always read, never replaced.
    """
    sc = spark.sparkContext
    current = (spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
               or sc.getCheckpointDir())
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: a machine-local folder "
                               "is not visible to every executor")
        current = tempfile.mkdtemp(prefix="eligo-ckpt-")
        sc.setCheckpointDir(current)
    return current


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 * 1024 * 1024, minimum: int = 8) -> int:
    """Shuffle partition count so each reduce partition holds about ``target_bytes``.

    AQE coalesces partitions that turn out small but never splits large ones
    (except skewed join partitions), so the count must be large enough for
    the biggest shuffle: e.g. 100 TB of charges -> about 400,000 partitions at 256 MB.
    """
    return max(minimum, -(-int(input_bytes) // int(target_bytes)))
