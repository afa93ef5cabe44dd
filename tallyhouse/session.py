"""SparkSession setup shared by jobs, tests and the benchmark.

Everything here is plain Spark configuration.  The settings that change query
*results* (time zone, ANSI) are also applied at runtime by :func:`ensure_conf`,
because the driver of a query may hand us a session it built itself.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the engine relies on for correct results.
RESULT_CONF = {
    # timestamptz::date and the date spine are defined in UTC (trap T13).
    "spark.sql.session.timeZone": "UTC",
    # Strict casts and overflow checks, like the SQL the models were written for.
    "spark.sql.ansi.enabled": "true",
}

# Runtime settings that only affect the physical plan.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Runtime settings for sessions that have Spark's own value: (that value, ours).
SIZE_CONF = {
    # What a task sorts and hashes is many times its compressed shuffle blocks, so
    # joined partitions stay small: a task's memory does not grow with the input.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": ("67108864b", "8m"),
    # Folders are listed by few tasks, not by one each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": ("10000", "64"),
    # Shuffle files go when their query ends, not when the driver's heap is collected:
    # a job of many queries holds those of the running ones alone.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": ("false", "true"),
}


def build_session(master: str | None = None, app_name: str = "tallyhouse",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's configuration.

    ``master`` defaults to ``local[$BENCH_CPUS]`` or ``local[*]`` for local
    runs; on a cluster pass ``None`` and let spark-submit decide.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("TALLY_DRIVER_MEMORY", "16g"),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **RESULT_CONF,
        **PLAN_CONF,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session.

    A session that refuses one that changes results (other than by having it
    already) is an error; plan settings keep the cluster's value, sizes any that
    was chosen for the application or the session.
    """
    for k, v in RESULT_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    for k, v in PLAN_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    given = spark.sparkContext.getConf()
    for k, (default, v) in SIZE_CONF.items():
        if not given.contains(k) and spark.conf.get(k) == default:
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints and scratch tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Where
    neither is set, a local session gets a fresh folder of its own; on a cluster
    that is an error, as a folder of one machine is not seen by the others.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tallyhouse-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
        sc.setCheckpointDir(d)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under :func:`shared_dir` for one job's written tables."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under :func:`shared_dir` and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table under :func:`shared_dir` that nothing reads any more."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tallyhouse`` importable in the Python workers (once per app).

    Only the Arrow-batched Python steps (workbook parse/write) need it.  When
    the package is already installed on the executors this is a no-op import
    path; otherwise a zip of the package is registered with ``addPyFile``, which
    Spark distributes to every executor.
    """
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import tallyhouse
    root = os.path.dirname(os.path.abspath(tallyhouse.__file__))
    # Zipped on the driver; Spark sends it to the executors.
    stage = tempfile.mkdtemp(prefix="tallyhouse-pkg-")
    atexit.register(shutil.rmtree, stage, ignore_errors=True)
    path = os.path.join(stage, f"tallyhouse-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(dirpath, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
