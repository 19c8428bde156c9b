"""Session construction and shared scratch space.

Scale notes
-----------
* AQE is on: shuffle partitions are coalesced at runtime toward
  ``advisoryPartitionSizeInBytes`` and skewed join partitions are split, so
  the static ``spark.sql.shuffle.partitions`` is an upper bound, not a guess
  that has to be right for every stage.
* Broadcasts are only made by Spark's own size-checked rule
  (``autoBroadcastJoinThreshold`` on plan statistics, and the AQE variant on
  measured shuffle sizes) or of results bounded by construction
  (:func:`shelfwise.operators.joins.semi_join_top`).
* Intermediate tables and round-trip outputs go below the shared folder named
  in ``spark.checkpoint.dir``.  Only when that setting is missing and the
  master is local (tests, laptops) is a private temporary folder created.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: dict[int, str] = {}


def build_session(
    master: str | None = None,
    app_name: str = "shelfwise",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session tuned for the pipelines in this package.

    Master, shuffle partitions and memory are the cluster's business: they come
    from the submit command or the Spark defaults unless given here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (or the
    one set with ``SparkContext.setCheckpointDir``).

    If there is none and the master is local, a private folder is
    made and registered as the checkpoint directory (test set-up only).  On a
    cluster without the setting we refuse rather than write to a disk only one
    machine can see.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    key = id(sc)
    if key in _LOCAL_SCRATCH:
        return _LOCAL_SCRATCH[key]
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; shelfwise needs a shared folder "
            "(HDFS, object store) for intermediate tables on a cluster"
        )
    root = tempfile.mkdtemp(prefix="shelfwise-")
    sc.setCheckpointDir(f"{root}/checkpoints")
    _LOCAL_SCRATCH[key] = root
    return root


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it.

    Workers get the folder on their path.  That is all a local master needs; on
    a cluster the package is installed or sent with ``--py-files`` and the
    folder need not exist.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared scratch root.

    Paths are never reused, so a lazily evaluated DataFrame that reads one
    stays valid after the function that produced it returns.
    """
    return f"{_shared_root(spark)}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    """A catalog-safe unique table name."""
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


@contextlib.contextmanager
def session_conf(spark: SparkSession, **settings: str):
    """Temporarily set SQL confs (dots written as ``__``) and restore them."""
    keys = {k.replace("__", "."): str(v) for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield spark
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextlib.contextmanager
def session_time_zone(spark: SparkSession, zone: str = "UTC"):
    """Pin the session time zone while a DataFrame is *built*.

    Time-zone-aware expressions receive their zone during analysis, which
    PySpark runs eagerly, so a plan built inside this block keeps ``zone``
    after the block restores the caller's setting.
    """
    with session_conf(spark, spark__sql__session__timeZone=zone):
        yield spark
