"""Session helpers: a tuned local/cluster session and the checkpoint folder."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Shuffle-partition sizing for the cluster: ~128 MB per post-shuffle partition.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
# Bytes of a method above which HotSpot doesn't compile it.
JIT_METHOD_BYTES = 8000


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sparkguard") -> SparkSession:
    """Return (or create) a session with AQE on and the UI off.

    On a cluster the master and most settings come from spark-submit; the
    values here only apply when they are not already set.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TARGET_PARTITION_BYTES))
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; set one only if unset.

    A machine-local temporary folder is only acceptable for local runs (tests),
    so it is chosen only when the master is local.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local_dir = tempfile.mkdtemp(prefix="sparkguard-ckpt-")
    sc.setCheckpointDir(local_dir)
    return local_dir


def keep_methods_small(spark: SparkSession) -> None:
    """Let wide stages be split into methods that the JVM compiles: it interprets a longer one for as long as the query runs.
    A limit that the session already has is kept."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(JIT_METHOD_BYTES))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the checkpoint directory for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


_MATERIALIZED: dict[tuple[str, str], str] = {}


def materialize(spark: SparkSession, name: str, build) -> "DataFrame":  # noqa: F821
    """Write a derived table once per application to the shared folder and
    return a scan of it (a written table cuts lineage; later scans prune
    columns and push filters)."""
    import uuid
    key = (spark.sparkContext.applicationId, name)
    path = _MATERIALIZED.get(key)
    if path is None:
        path = shared_dir(spark, f"{name.replace('/', '_')}-{uuid.uuid4().hex[:12]}")
        build().write.mode("overwrite").parquet(path)
        _MATERIALIZED[key] = path
    return spark.read.parquet(path)


def cut_lineage(df: "DataFrame", name: str = "stage", rows_per_file: int = 0) -> "DataFrame":  # noqa: F821
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return a scan of it.  Unlike an eager ``checkpoint()`` (which computes its
    input twice unless cached), the table is computed once; a lost executor
    re-reads files instead of recomputing the lineage.  ``rows_per_file``
    bounds the rows of a file (0: no bound)."""
    import uuid
    spark = df.sparkSession
    path = shared_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.parquet(path)


def cut_in_files(df: "DataFrame", name: str, rows_per_file: int) -> "DataFrame":  # noqa: F821
    """``cut_lineage`` in files of at most ``rows_per_file`` rows, the partitions of fits that read them."""
    return cut_lineage(df, name, rows_per_file)


def drop_table(df: "DataFrame") -> None:  # noqa: F821
    """Remove the files of a ``cut_lineage`` table that no frame reads any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        if path.getParent().getName() == "tables":
            path.getFileSystem(conf).delete(path, True)
