"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every billflow job relies on. AQE re-plans joins from runtime sizes
# and splits skewed shuffle partitions; the UI stays off (no listening port).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # State of streams on executors' disks, not their heaps; streaming/ledger.py needs this store.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Python call-site capture costs several JVM round trips per Column call
    # while plans are built; error messages lose the Python line, nothing else.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, app: str = "billflow",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with billflow's base settings.

    On a cluster pass ``master=None`` so spark-submit decides; tests pass
    ``local[*]`` and a small shuffle partition count.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_DIRS: dict[int, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    The cluster names it in ``spark.checkpoint.dir``. Only where driver and
    executors are one process (a ``local`` master, as in tests) and it is unset is
    a private folder made; elsewhere an unset folder is an error, as executors
    could not read what others write.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_DIRS.get(id(spark))
    if not d:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = _LOCAL_DIRS[id(spark)] = tempfile.mkdtemp(prefix="billflow-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - some deployments reject core settings at runtime
            pass
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        pass
    return d
