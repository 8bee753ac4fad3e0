"""Session helpers: a configured builder for tests/bench and the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import SparkSession

# Settings the kernels rely on. Duplicate JSON keys keep the last value, as a
# JSON decoder into a map does.
REQUIRED_CONF = {
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "freshstate", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench. Cluster jobs bring their own."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "8g"))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and state tables.

    Read from the session: the SparkContext checkpoint dir, else the
    ``spark.checkpoint.dir`` setting. Never invents a machine-local folder:
    callers such as tests set one explicitly when the session has none.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
    if not d:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder "
            "(tests set a scratch folder with set_checkpoint_dir)")
    return d.rstrip("/")


def set_checkpoint_dir(spark: SparkSession, path: str) -> None:
    """Only for sessions without a checkpoint folder (tests, local runs)."""
    spark.sparkContext.setCheckpointDir(path)


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder, removed when the
    driver's Python ends (a returned DataFrame may read it until then)."""
    path = f"{checkpoint_root(spark)}/freshstate/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append((spark, path))
    return path


def remove_scratch(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _remove_all() -> None:
    for spark, path in _SCRATCH:
        if spark.sparkContext._jsc is None:
            return  # the session has ended before
        try:
            remove_scratch(spark, path)
        except Exception:  # the JVM may be gone already
            return
