"""Session settings, table loading and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Run-time settings every query relies on; sizes stay with the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a skewed join even where that costs one more shuffle later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_roots: dict[str, str] = {}


def build(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("millrace")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table. Times stay TIMESTAMP_NTZ so filters on them reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small table out over all cores, before work that is heavy per row.

    For frames straight from a scan (asking a shuffled frame for its partitions would run it). A file with one row group is one task, however many cores wait. Inputs that already have a
    partition per core, as large ones do, are left as they are and not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_roots:
        made = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _local_roots[context.applicationId] = made
    return _local_roots[context.applicationId]


_made: list[str] = []


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, until ``release``."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def made() -> int:
    """How many scratch paths there are, to be asked for those made later by ``held``."""
    return len(_made)


def held(first: int) -> list[str]:
    """The scratch paths made since ``made()`` returned ``first``."""
    return _made[first:]


def release(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Remove scratch files of this driver, all or the given ones. For callers that are done with the frames built on them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in list(_made if paths is None else paths):
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
        if name in _made:
            _made.remove(name)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write the frame once to the shared folder and read it back.

    For frames read by several jobs. Survives lost executors, unlike a cache. The copy stays until
    ``release``.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
