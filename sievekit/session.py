"""Session helpers: building a session for tests/bench and locating the
shared scratch folder that lineage-cutting writes go to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "sievekit") -> SparkSession:
    """Session used by tests and bench.  On a cluster the session comes from
    the launcher; these settings are the ones that matter there too."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only read, never written to the session's settings.  On a cluster the
    setting is required: a machine-local folder would differ between
    executors.  In local mode without it (tests) one fresh folder per
    application is used."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder (master is {master})")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="sievekit-scratch-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    _MADE.append(f"{base}/{name}-{uuid.uuid4().hex[:12]}")
    return _MADE[-1]


_MADE: list[str] = []


def scratch_made() -> list[str]:
    """The scratch paths handed out and not cleared."""
    return [*_MADE]


def clear_scratch(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete scratch folders (all that were handed out, or these), once the
    results that read them have been written; returns how many there were."""
    jvm, done = spark.sparkContext._jvm, 0
    for path in scratch_made() if paths is None else paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        done += where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        _MADE.remove(path)
    return done


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise ``df`` as Parquet under the shared checkpoint folder and
    read it back: the lineage is cut (a lost executor re-reads files instead
    of recomputing upstream stages), the data is written in one pass (an
    eager ``checkpoint()`` of an unpersisted frame computes it twice), and
    the files carry statistics that AQE uses for join planning."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch = path
    return back


#: Bytes of an Arrow batch between Spark and its Python workers.
MOST_BATCH = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``MOST_BATCH`` bytes for this session from now on,
    unless a smaller bound is set: the default takes up to ten thousand whole
    texts, which Spark and its worker hold several times over."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).removesuffix("b")
    if not now.isdigit() or not 0 < int(now) <= MOST_BATCH:
        spark.conf.set(name, str(MOST_BATCH))


def with_partitions(df: DataFrame, partitions: int | None) -> DataFrame:
    """``df`` dealt to so many partitions if the caller asks for it.  For inputs
    of fewer splits than cores before CPU-heavy work on each row; never needed
    for large tables.  Select the needed columns first: all of them move."""
    return df if partitions is None else df.repartition(partitions)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
