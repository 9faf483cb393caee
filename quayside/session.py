"""Session settings and shared storage locations.

Everything the library writes (tables, staging areas) lives under the shared
folder named by ``spark.checkpoint.dir``.  On a cluster that setting points to
shared storage (HDFS, object store); we only pick a local folder when it is
unset, which happens in unit tests.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings the library relies on.  All are session-scoped and can be
# changed on a live session.
RUNTIME_CONF = {
    # Reference clocks are UTC; day boundaries and epoch conversions assume it.
    "spark.sql.session.timeZone": "UTC",
    # AQE: coalesce small shuffle partitions, split skewed ones, switch join
    # strategy from runtime sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Table maintenance rewrites only the partitions present in the output.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Partition directory values are typed by our table specs, never guessed.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Payload flatteners generate large expressions; a generated method above the
    # JVM's JIT limit (8000 bytecodes) would run interpreted, so fall back to
    # per-expression code generation instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library needs; safe to call repeatedly."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    shared_root(spark)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "quayside") -> SparkSession:
    """Session for tests and local runs (cluster jobs receive theirs)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_LOCAL_ROOT: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and library-managed tables.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    on a local master (tests) a temporary folder is created and registered as the
    checkpoint directory, so ``DataFrame.checkpoint()`` works too.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
        return root.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        # A checkpoint dir set programmatically: use its parent folder.
        return current.rstrip("/").rsplit("/", 1)[0]
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    key = spark.sparkContext.applicationId
    if key not in _LOCAL_ROOT:
        _LOCAL_ROOT[key] = tempfile.mkdtemp(prefix="quayside-")
        spark.sparkContext.setCheckpointDir(_LOCAL_ROOT[key] + "/checkpoints")
    return _LOCAL_ROOT[key]


_GIVEN: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared root, removed when the program ends."""
    path = f"{shared_root(spark)}/quayside/{name}-{uuid.uuid4().hex[:12]}"
    if not _GIVEN:
        atexit.register(drop_scratch)
    _GIVEN.append((spark, path))
    return path


def drop_scratch() -> None:
    """Remove what was written under :func:`scratch_path`.  Frames that read it are
    of no use afterwards; a session that has ended leaves it behind."""
    while _GIVEN:
        spark, path = _GIVEN.pop()
        if spark.sparkContext._jsc is None:
            continue
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        # What is kept beside a table has the table's name and two underscores.
        for kept in fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + "*")) or []:
            fs.delete(kept.getPath(), True)


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end(spark: SparkSession):
    """Writes in it remove their shuffle files when they end.  What is written is read
    back, and a write's plan is never run again; else the files stay until the driver
    happens to collect its garbage, and a job of many writes keeps all of them."""
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


# Inputs smaller than this are never re-spread: one task handles them quickly.
SPREAD_MIN_BYTES = 1 << 20


def spread_if_narrow(spark: SparkSession, df, input_bytes: int):
    """Round-robin ``df`` over all cores when a sizeable input arrives in fewer
    splits than cores (e.g. a file written as one Parquet row group, which
    Spark cannot split).  On a cluster, inputs come in many row groups and
    files, so this is a no-op there; it never adds a shuffle to a well-split scan.
    """
    cores = spark.sparkContext.defaultParallelism
    if input_bytes < SPREAD_MIN_BYTES:
        return df
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored under ``path`` on any Hadoop filesystem (0 when absent)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False):
    """A driver table; with ``spread`` it is re-spread over the cores when its
    file cannot be split (use before CPU-heavy per-row work such as JSON)."""
    path = table_path(sf_dir, name)
    df = spark.read.parquet(path)
    if not spread:
        return df
    return spread_if_narrow(spark, df, stored_bytes(spark, path))
