"""Session helpers: a local session for tests/bench and lineage truncation.

Iterative graph operators cut their lineage every round with
``DataFrame.checkpoint()``, which writes to the reliable checkpoint folder the
cluster names in ``spark.checkpoint.dir``.  On a cluster that setting must be
configured (a shared filesystem / object store path); only a local-mode
session without one gets a scratch folder under the system temp dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Whether the shuffle files of a query go when it ends; else they stay until the driver collects its garbage.
_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "airmesh") -> SparkSession:
    """A local session tuned for small scale factors (tests, bench)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder, configuring it if needed.

    Reads ``spark.checkpoint.dir`` from the session.  When it is unset and the
    master is local (tests, bench) a fresh scratch folder is used; on a
    cluster an unset value is an error because a machine-local folder would
    not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server applies its own spark.checkpoint.dir
        configured = spark.conf.get(_CHECKPOINT_KEY, None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir on the Spark Connect server") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "iterative operators need a shared checkpoint folder: set spark.checkpoint.dir "
            "to a path every executor can reach (HDFS, object store, shared mount)"
        )
    scratch = tempfile.mkdtemp(prefix="airmesh-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Mark ``df`` for the reliable checkpoint folder and return the truncated frame.

    The returned plan keeps the output partitioning of ``df`` so a frame that
    was hash-partitioned on a join key stays co-partitioned afterwards.
    With ``eager`` the rows are written now; otherwise the first action on the
    returned frame computes them and the write follows that job, re-running
    only its last stage from the job's shuffle files — iterative loops use
    their per-round convergence test as that action.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def materialize(df: DataFrame, name: str = "state") -> DataFrame:
    """Write ``df`` as a parquet table under the checkpoint folder and read it back.

    One job computes and writes the rows (no second pass as with an RDD
    checkpoint); the returned frame's lineage is just the file scan, so a lost
    executor re-reads files instead of recomputing earlier rounds.  The job's
    shuffle files, which nothing reads after it, go as soon as it has ended.
    """
    spark, path = df.sparkSession, fresh_folder(df.sparkSession, name)
    kept = spark.conf.get(_CLEANUP_KEY, "false")
    spark.conf.set(_CLEANUP_KEY, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(_CLEANUP_KEY, kept)
    return spark.read.parquet(path)


def discard_tables(df: DataFrame) -> None:
    """Delete the tables made by ``materialize`` that ``df`` reads; nothing may read them afterwards."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/airmesh-tables/" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path under the checkpoint folder that nothing has been written to."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/airmesh-tables/{name}-{uuid.uuid4().hex}"


def bucketed_table(df: DataFrame, key: str, buckets: int, name: str = "state") -> DataFrame:
    """Write ``df`` as a table bucketed and sorted on ``key`` under the checkpoint folder.

    Unlike a checkpoint (whose hash partitioning is lost under AQE), a bucketed
    scan reports ``hashpartitioning(key, buckets)``, so joins on ``key`` with
    another table bucketed the same way need no exchange on either side.  The
    rows are hash-partitioned first so each task writes exactly one bucket.
    Returns the table as a DataFrame; lineage is the file scan.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    table = f"airmesh_{name}_{uuid.uuid4().hex[:16]}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", f"{base}/airmesh-tables/{table}").saveAsTable(table))
    return spark.table(table)


def drop_table(df: DataFrame) -> None:
    """Forget a table made by ``bucketed_table`` and delete its files."""
    names = df.inputFiles()
    if not names:
        return
    folder = names[0].rstrip("/").rsplit("/", 1)[0]
    table = folder.rsplit("/", 1)[1]
    if table.startswith("airmesh_") and folder.endswith(f"/airmesh-tables/{table}"):
        spark = df.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
