"""Spark session helpers.

The library never builds its own cluster session: callers pass a
``SparkSession``. ``build_session`` exists for tests, benches and local runs.

Reliable checkpoints go to the shared folder named by ``spark.checkpoint.dir``.
A private temporary folder is only chosen when the session runs in local mode
and no directory is configured (tests, benches).
"""

from __future__ import annotations

import tempfile
from contextlib import contextmanager
import uuid

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Local mode: the driver JVM is the executor; only applies when this
    # builder starts the JVM.
    "spark.driver.memory": "12g",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "sprout", conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    settings = dict(LOCAL_DEFAULTS)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, configuring it if needed.

    Order: the directory already set on the context, then the
    ``spark.checkpoint.dir`` setting, then (local mode only) a fresh
    temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/object store) so iterative jobs survive executor loss")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sprout-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursively delete a scratch path through the session's Hadoop filesystem."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def replace_output(spark: SparkSession, path: str, write) -> None:
    """Overwrite ``path`` with what ``write(staging)`` writes, or leave it as it is.

    The new output is written whole to a folder beside ``path`` and then takes
    its place; a write that fails leaves the old output and no staging folder. Between the
    two renames a reader may find neither, never a mixture; the old output is
    deleted last and put back if its successor can't be moved in.
    """
    jvm = spark.sparkContext._jvm
    mark = uuid.uuid4().hex
    base = path.rstrip("/")
    parent, _, name = base.rpartition("/")
    beside = f"{parent}/" if parent or base.startswith("/") else ""
    # Hidden names: a reader of the parent folder doesn't take them for data.
    staging, old = f"{beside}_{name}.new-{mark}", f"{beside}_{name}.old-{mark}"
    target, new, aside = (jvm.org.apache.hadoop.fs.Path(x) for x in (base, staging, old))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        write(staging)
    except BaseException:
        fs.delete(new, True)
        raise
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        fs.delete(new, True)
        raise OSError(f"can't move the old output {base}")
    if not fs.rename(new, target):
        if had:
            fs.rename(aside, target)
        fs.delete(new, True)
        raise OSError(f"can't move the new output to {base}")
    if had:
        fs.delete(aside, True)


@contextmanager
def scoped_conf(spark: SparkSession, settings: dict):
    """Apply SQL settings for the duration of a block, then restore them."""
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
